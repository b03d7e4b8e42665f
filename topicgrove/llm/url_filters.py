"""URL filters: a sort-merge range join of page keys with the intervals of nested host and path rules.

A rule ``(host, path)`` covers its host, every subdomain, and every path that starts with its own. The canonical key
of a host and path is the host with its labels reversed, a separator below all other characters, and the path; under one
host the keys that a rule covers are then one interval, and two such intervals are nested or apart. A page has one key
for each suffix of its host.

Keys and interval ends are sorted together. A running sum of starts and ends is the depth of the stack of open rules, and
the top of the stack is the last rule that started at that depth: two window functions over one sort, no pairs. Only
page keys of the sweep's slice meet there: pages are dealt to slices by a hash of the row, so a host with a third of all
pages is spread evenly, and each slice gets a copy of the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.llm.common import ascii_lower, let, shuffle_partitions

LOW, HIGH = "\x01", "\U0010ffff"


def host_and_path(pages: DataFrame) -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both are empty where the URL is null or has no ``://``."""
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    return pages.withColumns(
        {
            "host": ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            "path": F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1),
        }
    )


def _key(labels, path):
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit(LOW), path)


def interval_ends(rules: DataFrame) -> DataFrame:
    """Two rows per distinct rule: where its interval of keys starts and where it ends."""
    rules = rules.where("host is not null and path is not null").select(
        ascii_lower(F.col("host")).alias("host"), "path", "verdict"
    )
    # of equal rules the stricter one holds
    rules = rules.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("block"))
    start = _key(F.split("host", r"\."), F.col("path"))
    shown = F.concat("host", F.when(F.col("path").startswith("/"), F.col("path")).otherwise(F.concat(F.lit("/"), "path")))
    rule = F.struct(
        F.length(F.concat("host", "path")).alias("length"),
        F.length("host").alias("host_length"),
        shown.alias("rule"),
        F.when(F.col("block"), "block").otherwise("allow").alias("verdict"),
    )
    ends = F.array(
        F.struct(start.alias("key"), F.lit(0).alias("kind"), F.length(start).alias("nth"), F.lit(1).alias("step")),
        F.struct(F.concat(start, F.lit(HIGH)).alias("key"), F.lit(2).alias("kind"), (-F.length(start)).alias("nth"), F.lit(-1).alias("step")),
    )
    return rules.select(rule.alias("rule"), F.explode(ends).alias("e")).select("e.*", "rule")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", slices: int | None = None) -> DataFrame:
    """One row ``(page_id, host, path, rule, verdict)`` per page row.

    ``rules`` is ``(host, path, verdict)`` with verdict block or allow. The longest fitting rule (host and path together,
    then the host) decides; ``default`` is the verdict where none fits. Among equal rules block wins; rules with a null
    host or path are ignored. Null and malformed URLs have empty host and path, so only rules for an empty host fit them.
    Repeated page rows are judged one by one, null ids included; other columns are ignored. No rules: all get the default.

    ``slices`` (four per shuffle partition unless given) bounds the pages of one sorted run: more pages, more slices.
    """
    slices = slices or 4 * shuffle_partitions(pages.sparkSession)
    rows = host_and_path(pages.select("page_id", "url")).withColumn("row", F.monotonically_increasing_id())
    page = F.struct("page_id", "host", "path", "row").alias("page")
    labels = F.split("host", r"\.")
    # only ends of the host with as many labels as some rule has can fit; their number is bounded by the rules, not by the host
    counts = sorted(r.n for r in rules.where("host is not null and path is not null").select(F.size(F.split("host", r"\.")).alias("n")).distinct().collect())
    ends = F.array(*[F.lit(n) for n in counts]).cast("array<int>")
    keys = let(labels, lambda x: F.transform(F.filter(ends, lambda n: n <= F.size(x)), lambda n: _key(F.slice(x, F.size(x) - n + 1, n), F.col("path"))))
    asked = rows.select(F.pmod(F.xxhash64("page_id", "url", "row"), F.lit(slices)).cast("int").alias("slice"), page, F.explode_outer(keys).alias("key"))
    bounds = interval_ends(rules).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    merged = asked.withColumns({"kind": F.lit(1), "nth": F.lit(0), "step": F.lit(0)}).unionByName(bounds, allowMissingColumns=True)

    order = [F.col("key"), F.col("kind"), F.col("nth")]
    so_far = (Window.unboundedPreceding, Window.currentRow)
    swept = merged.withColumn("depth", F.sum("step").over(Window.partitionBy("slice").orderBy(*order).rowsBetween(*so_far)))
    # an end closes the level above the depth that it leaves; it must not look like a start of the level below
    started = F.when(F.col("kind") == 0, F.col("rule"))
    stack = Window.partitionBy("slice", "depth").orderBy(*order).rowsBetween(*so_far)
    top = F.when(F.col("depth") > 0, F.last(started, ignorenulls=True).over(stack))
    best = swept.withColumn("top", top).where("kind = 1").groupBy("slice", "page").agg(F.max("top").alias("best"))
    return best.select(
        "page.page_id",
        "page.host",
        "page.path",
        "best.rule",
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
