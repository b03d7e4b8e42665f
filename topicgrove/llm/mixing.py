"""Mixing sources to target weights along a curriculum.

Every source has a target, its share of all words to take. Its documents, in an order fixed by a hash, are laid end to end,
twice over where the target exceeds the source, and taken as long as the running count of words stays below the
target. A schedule gives each source a weight that changes over training time 0..1; the integral of that weight is the
source's cumulative demand, and inverting the demand at a copy's running count gives the copy its position. A sort by ranges
of the position puts the mixture in training order.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.llm.common import shuffle_partitions, words_of
from topicgrove.session import written

#: Knots (time, weight) of a source's schedule, by its weight class: heavy sources fade, light ones come in late.
Schedule = tuple[tuple[float, float], ...]
WEIGHTS = (5, 2, 1)
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 0.5), (1.0, 1.5)),
)
#: Words to take in all, and at most from one source, as multiples of what there is.
SHARE, REPEATS = 1.5, 2
#: Documents per running-count bucket: what one sorted group of a source holds on average.
BUCKET_ROWS = 512


def inverse_demand(share: Column, schedule: Schedule) -> Column:
    """The time at which a source with this schedule has had ``share`` (0..1) of its words."""
    spans = list(zip(schedule, schedule[1:]))
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in spans]
    if not areas or min(areas) <= 0:
        raise ValueError("a schedule needs knots at rising times with positive weight between them")
    before = [0.0, *accumulate(areas)]
    wanted = share * F.lit(before[-1])
    time = F.lit(float(schedule[-1][0]))
    for (a, b), start in reversed(list(zip(spans, before))):
        slope = (b[1] - a[1]) / (b[0] - a[0])
        inside = wanted - F.lit(start)
        if slope:
            root = F.sqrt(F.greatest(F.lit(a[1] * a[1]) + F.lit(2 * slope) * inside, F.lit(0.0)))
            at = F.lit(a[0]) + (root - F.lit(a[1])) / F.lit(slope)
        else:
            at = F.lit(a[0]) + inside / F.lit(a[1])
        time = F.when(wanted < F.lit(start + areas[before.index(start)]), at).otherwise(time)
    return time


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, source_size, class, target)``, one row per source.

    The shares are those of the weights, except that no source exceeds ``REPEATS`` times its size and the rest goes to the
    others by weight. That is one water level: a source is full if at its own ratio of bound to weight all sources
    together would take no more than the total. Its windows run over one row per source.
    """
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.groupBy("source").agg(F.sum("words").alias("source_size")).withColumn(
        "class", ((F.row_number().over(by_code_point) - 1) % len(weights)).cast("int")
    )
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("class") + 1)
    ratio = F.lit(REPEATS) * F.col("source_size") / F.col("weight")
    rising = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    levels = (
        ranked.withColumn("weight", weight)
        .withColumn("ratio", ratio)
        .withColumns({"full_size": F.sum("source_size").over(rising), "full_weight": F.sum("weight").over(rising)})
        .withColumns({"all_size": F.sum("source_size").over(everything), "all_weight": F.sum("weight").over(everything)})
    )
    open_weight = F.col("all_weight") - F.col("full_weight")
    budget = F.lit(SHARE) * F.col("all_size")
    full = (F.lit(REPEATS) * F.col("full_size") + F.col("ratio") * open_weight) <= budget
    sums = levels.withColumn("full", full).withColumns(
        {
            "taken_size": F.sum(F.when(F.col("full"), F.col("source_size")).otherwise(0)).over(everything),
            "taken_weight": F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(everything),
        }
    )
    level = (budget - F.lit(REPEATS) * F.col("taken_size")) / (F.col("all_weight") - F.col("taken_weight"))
    target = F.when(F.col("full"), (F.lit(REPEATS) * F.col("source_size")).cast("double")).otherwise(level * F.col("weight"))
    return sums.select("source", "source_size", "class", target.alias("target"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, schedules: tuple[Schedule, ...] = SCHEDULES) -> DataFrame:
    """One row per document id, source and size: ``(doc_id, source, size, n_rows, source_size, target, taken, positions)``.

    ``positions`` has one training position (0..1) for each copy that the mixture takes: none, one or two; ``taken`` is
    their number times the size. A copy is taken if the middle of its words in the source's running count lies before the
    target, so each source comes within one document of its target. ``n_rows`` equal rows of one id are taken together.
    Null and empty texts have size 0 and are not taken. A null source is a source of its own, the last; null ids are one
    id. No rows give no rows, and extra columns are ignored.

    The running count is made in two steps, buckets of a hash and then rows inside a bucket, so that no source, however
    large, is sorted in one task.
    """
    size = F.size(words_of(F.col("text"))).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("n_rows"))
    hashed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sizes = written(rows.withColumns({"order": hashed, "words": F.col("size") * F.col("n_rows")}), "sizes")
    buckets = 2 ** (sizes.count() // BUCKET_ROWS).bit_length()
    bucket = F.conv(F.substring("order", 1, 7), 16, 10).cast("long") % F.lit(buckets)
    sizes = sizes.withColumn("bucket", bucket)

    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.groupBy("source", "bucket").agg(F.sum("words").alias("words")).select(
        "source", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    counted = sizes.withColumn("before", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    known = written(
        offsets.alias("o").join(targets(sizes, weights).alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select(
            F.col("o.source").alias("at_source"), F.col("o.bucket").alias("at_bucket"), "offset", "source_size", "class", "target"
        ),
        "targets",
    )
    placed = counted.join(known, counted["source"].eqNullSafe(F.col("at_source")) & (counted["bucket"] == F.col("at_bucket")))

    middle = lambda turn: F.col("offset") + F.col("before") + F.lit(turn) * F.col("source_size") + F.col("words") / 2
    copies = []
    for turn in range(REPEATS):
        share = middle(turn) / F.col("target")
        at = F.lit(None).cast("double")
        for k in range(len(weights)):
            at = F.when(F.col("class") == k, inverse_demand(share, schedules[k])).otherwise(at)
        copies.append(F.when((F.col("size") > 0) & (middle(turn) < F.col("target")), at))
    return placed.withColumn("positions", F.array_compact(F.array(*copies))).select(
        "doc_id", "source", "size", "n_rows", "source_size", "target", (F.size("positions") * F.col("size")).alias("taken"), "positions"
    )


def training_order(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, schedules: tuple[Schedule, ...] = SCHEDULES) -> DataFrame:
    """The mixture itself: rows of ``docs``, repeated or left out as ``plan`` says, sorted by training position.

    ``training_position`` follows the columns of ``docs``, unless they have one of that name, which then stays.
    """
    planned = plan(docs, weights, schedules).where("taken > 0").select(
        F.col("doc_id").alias("planned_id"), F.col("source").alias("planned_source"), F.col("size").alias("planned_size"), "positions"
    )
    rows = docs.select(F.struct("*").alias("doc"))  # one column, which no name of the plan can meet
    size = F.size(words_of(F.col("doc.text"))).cast("long")
    same = F.col("doc.doc_id").eqNullSafe(F.col("planned_id")) & F.col("doc.source").eqNullSafe(F.col("planned_source"))
    taken = rows.join(planned, same & (size == F.col("planned_size"))).select("doc", F.explode("positions").alias("training_position"))
    parts, order = shuffle_partitions(docs.sparkSession), ["training_position", "doc.doc_id"]
    dealt = taken.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.select("doc.*", *([] if "training_position" in docs.columns else ["training_position"]))
