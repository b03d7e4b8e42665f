"""Phrase collocations from FM-indexes: one index per shard over word ids, counts summed over shards.

Texts are cut into pieces at sentence marks and into words, and dealt by language into shards of bounded size, which are written as
a vocabulary and an array of codes. The first sum over shards counts words; those that reach the least count get global ids,
the others can be in no phrase and become cuts. Each shard then builds two depth-limited Burrows-Wheeler transforms, of its codes
and of their reverse. An n-gram is an interval in both; it is extended by every word to its right or left
at once, and extensions are intervals again. Every interval's size is the n-gram's count in the shard, and a second sum gives the counts of all.

Scores need the counts of both parts of every cut, which are looked up by joins over the n-grams that reach the least count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicgrove.llm.common import setting, shuffle_partitions, shuffles_dropped, slabs, texts_of
from topicgrove.session import written, written_and_measured

#: What ends a piece, and what parts words: fixed values.
CUTS, BLANK = r"[.,;:!?\x0A-\x0D]", "\t"
SLAB_BYTES = 2 << 20
#: Words of a shard; one without any cut may be longer.
SHARD_WORDS = 1 << 19
#: Shards that a task turns into n-grams; their counts are added up before they travel.
TASK_SHARDS = 8
#: Words are numbered below 2^31, and two numbers fit into one key column: phrases have at most four words.
MOST_WORDS = 4


class HalfIndex:
    """A depth-limited transform of ``text`` (0 is a cut): rows in the order of the first ``depth`` symbols of their suffixes."""

    def __init__(self, text: np.ndarray, n_symbols: int, depth: int):
        n = len(text)
        ahead = np.concatenate([text, np.zeros(depth, text.dtype)])
        bits = max(1, int(n_symbols).bit_length())
        if bits * depth <= 63:
            key = np.zeros(n, np.int64)
            for k in range(depth):
                key = (key << bits) | ahead[k : k + n]
            rows = np.argsort(key, kind="stable")
        else:
            rows = np.lexsort([ahead[k : k + n] for k in reversed(range(depth))])
        self.n = n
        self.last = text[rows - 1].astype(np.int64)  # the symbol before each suffix; the text is a ring that starts with a cut
        #: (symbol, row) of the last column in rising order: where a symbol's rows lie, and the rank of each
        self.places = np.sort(self.last * (n + 1) + np.arange(n))

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where suffixes that start with ``symbol`` and go on like those from ``row`` begin."""
        return np.searchsorted(self.places, symbol * (self.n + 1) + row)


def _extensions(half: HalfIndex, low: np.ndarray, size: np.ndarray, n_symbols: int) -> tuple[np.ndarray, ...]:
    """All extensions of disjoint intervals: ``(interval, symbol, count, occurrences of smaller symbols in the interval)``."""
    ends = np.cumsum(size)
    rows = np.repeat(low - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    keys = np.repeat(np.arange(len(low)), size) * (n_symbols + 1) + half.last[rows]
    found, count = np.unique(keys, return_counts=True)
    interval, symbol = np.divmod(found, n_symbols + 1)
    before = np.cumsum(count) - count
    return interval, symbol, count, before - (ends - size)[interval]


class BidirectionalIndex:
    """Intervals of n-grams in the transforms of a text and of its reverse, extended on either side."""

    def __init__(self, text: np.ndarray, n_symbols: int, depth: int):
        self.n_symbols, self.depth = n_symbols, depth
        self.forward = HalfIndex(text, n_symbols, depth)
        self.backward = HalfIndex(np.roll(text[::-1], 1), n_symbols, depth)  # starts with the cut too
        counts = np.bincount(text, minlength=n_symbols + 1)
        self.first, self.counts = (np.cumsum(counts) - counts)[1:], counts[1:]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All symbols that occur: ``(words, low, mirrored low, size)``."""
        symbols = np.flatnonzero(self.counts)
        return symbols[:, None] + 1, self.first[symbols], self.first[symbols], self.counts[symbols]

    def extend(self, grams: tuple, left: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams that have one word more on one side."""
        words, low, mirrored, size = grams
        if not left:
            low, mirrored = mirrored, low
        half = self.forward if left else self.backward
        order = np.argsort(low)
        words, low, mirrored, size = words[order], low[order], mirrored[order], size[order]
        parent, symbol, count, smaller = _extensions(half, low, size, self.n_symbols)
        real = symbol > 0
        parent, symbol, count, smaller = parent[real], symbol[real], count[real], smaller[real]
        low, mirrored = half.step(symbol, low[parent]), mirrored[parent] + smaller
        pair = (symbol[:, None], words[parent]) if left else (words[parent], symbol[:, None])
        return (np.hstack(pair), low, mirrored, count) if left else (np.hstack(pair), mirrored, low, count)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(words, counts)`` of all n-grams of two words up to the depth, extended right and left in turn."""
        grams = self.words()
        for length in range(2, self.depth + 1):
            grams = self.extend(grams, left=length % 2 == 1)
            yield grams[0], grams[3]


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in one array with a line break before every text and for every run of marks; where each text starts."""
    lowered = pc.replace_substring(pc.ascii_lower(texts), BLANK, " ")
    marked = pc.replace_substring_regex(lowered, f"(?:{CUTS} *)+", " \n ")
    lists = pc.split_pattern(pc.binary_join_element_wise(*(pa.scalar("\n", marked.type), marked, pa.scalar(" ", marked.type))), " ")
    flat = lists.flatten()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    full = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full), before[starts]


def shards(docs: DataFrame) -> DataFrame:
    """``(shard, lang, vocabulary, counts, codes)``: words of a shard, how often each occurs, and the text as 32-bit codes (0: a cut)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        total, number, task = 0, 0, TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, parts in held.items():
                coded = pa.concat_arrays([*parts, pa.array(["\n"], parts[0].type)]).dictionary_encode()
                ids, names = coded.indices.to_numpy().astype(np.int32), coded.dictionary  # a text starts with a cut: code 0
                cuts, low = np.flatnonzero(ids == 0), 0
                while low < len(ids) - 1:
                    high = int(cuts[min(np.searchsorted(cuts, low + SHARD_WORDS), len(cuts) - 1)])
                    codes = ids[low:high]
                    counts = np.bincount(codes, minlength=len(names))
                    seen = np.flatnonzero(counts[1:]) + 1
                    if len(seen):
                        place = np.zeros(len(names), np.int32)
                        place[seen] = np.arange(1, len(seen) + 1)
                        codes = place[codes]
                        ends = pa.array([0, len(seen)], pa.int32())
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([(task << 32) + number]),
                                pa.array([lang]),
                                pa.ListArray.from_arrays(ends, names.take(pa.array(seen)).cast(pa.string())),
                                pa.ListArray.from_arrays(ends, pa.array(counts[seen])),
                                pa.array([codes[(codes > 0) | np.concatenate([[True], codes[:-1] > 0])].tobytes()], pa.binary()),
                            ],
                            names=["shard", "lang", "vocabulary", "counts", "codes"],
                        )
                        number += 1
                    low = high
            held.clear()

        for batch in slabs(batches, limit=SLAB_BYTES):
            order = pc.sort_indices(batch.column("lang"))
            batch = batch.take(order)
            flat, starts = tokens_of(texts_of(batch))
            langs = batch.column("lang").to_pylist()
            edges = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1]), len(langs)]
            for a, b in zip(edges, edges[1:]):
                held.setdefault(langs[a], []).append(flat[starts[a] : starts[b]])
            total += len(flat)
            if total >= SHARD_WORDS:
                yield from flush()
                total = 0
        yield from flush()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(run, "shard long, lang string, vocabulary array<string>, counts array<long>, codes binary")


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with a dense number from 1 in ``id``: the offset of its part and its place there."""
    placed = written(words.withColumn("at", F.monotonically_increasing_id()), "phrase_words")
    part = F.shiftright("at", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())  # one row for each task
    starts = np.cumsum([1, *(r["count"] for r in sizes)]).tolist()
    if starts[-1] >= 1 << 31:
        raise ValueError("more than 2^31 words reach the least count")
    offsets = placed.sparkSession.createDataFrame([(r["part"], s) for r, s in zip(sizes, starts)], "part long, start long")
    return placed.join(F.broadcast(offsets), part == F.col("part")).select("lang", "word", "f", (F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).cast("int").alias("id"))


def _keys(words: np.ndarray) -> list[pa.Array]:
    """Word numbers, two in a column; 0 stands for no word."""
    full = np.zeros((len(words), MOST_WORDS), np.int64)
    full[:, : words.shape[1]] = words
    return [pa.array((full[:, 0] << 32) | full[:, 1]), pa.array((full[:, 2] << 32) | full[:, 3])]


def _word(k: int) -> Column:
    """Word number ``k`` (from 0) of the keys a and b."""
    key = F.col("ab"[k // 2])
    return (F.shiftright(key, 32) if k % 2 == 0 else key.bitwiseAND((1 << 32) - 1)).cast("int")


def _key(numbers: list[Column]) -> list[Column]:
    full = [*(n.cast("long") for n in numbers), *[F.lit(0).cast("long")] * (MOST_WORDS - len(numbers))]
    return [F.shiftleft(full[0], 32).bitwiseOR(full[1]), F.shiftleft(full[2], 32).bitwiseOR(full[3])]


def count_grams(docs: DataFrame, depth: int, min_count: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """N-grams of up to ``depth`` words that occur at least ``min_count`` times, by language.

    ``words (lang, word, f, id)``, ``grams (a, b, n_words, f)`` with the words' numbers in the keys a and b (single words included),
    and ``totals (lang, n)``, which counts all words.
    """
    with shuffles_dropped(docs.sparkSession):
        sharded, seen = written_and_measured(shards(docs), "phrase_shards", n=F.count(F.lit(1)))
        parts = max(shuffle_partitions(docs.sparkSession), (seen["n"] or 0) // TASK_SHARDS)
        each = sharded.select("shard", "lang", F.posexplode(F.arrays_zip("vocabulary", "counts")).alias("code", "entry"))
        each = each.select("shard", "lang", "code", F.col("entry.vocabulary").alias("word"), F.col("entry.counts").alias("f"))
        totals = written(sharded.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n")), "phrase_totals")
        words = written(_numbered(each.groupBy("lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)), "phrase_ids")
        # one list of at most a shard's vocabulary for each shard
        ids = each.drop("f").join(words.drop("f"), ["lang", "word"]).select("shard", "code", "id")
        known = written(ids.groupBy("shard").agg(F.collect_list(F.struct("code", "id")).alias("known")), "phrase_codes")
        merged = sharded.select("shard", "codes").repartition(parts, "shard").join(known.repartition(parts, "shard"), "shard").select("codes", "known")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    entries = batch.column("known")[i].values
                    code, number = (entries.field(c).to_numpy().astype(np.int64) for c in ("code", "id"))
                    codes = np.frombuffer(batch.column("codes")[i].as_buffer(), np.int32)
                    local = np.zeros(max(int(codes.max()), int(code.max()) + 1) + 1, np.int32)
                    local[code + 1] = np.arange(1, len(code) + 1)
                    text = local[codes]
                    text = np.concatenate([[0], text[(text > 0) | np.concatenate([[True], text[:-1] > 0])]]).astype(np.int32)
                    names = np.concatenate([[0], number])
                    for words_of, count in BidirectionalIndex(text, len(code), depth).grams():
                        for low in range(0, len(count), 1 << 18):
                            part = slice(low, low + (1 << 18))
                            yield pa.RecordBatch.from_arrays([*_keys(names[words_of[part]]), pa.array(count[part])], ["a", "b", "f"])

        found = merged.mapInArrow(run, "a long, b long, f long").groupBy("a", "b").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
        n_words = reduce(lambda x, y: x + y, [F.when(_word(k) > 0, 1).otherwise(0) for k in range(MOST_WORDS)])
        single = words.select(F.shiftleft(F.col("id").cast("long"), 32).alias("a"), F.lit(0).cast("long").alias("b"), "f")
        # a shard is a row of some MB: a batch holds few of them
        with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "2"):
            grams = written(single.unionByName(found).withColumn("n_words", n_words), "phrase_grams")
    return words, grams, totals


def _first_of_each(rows: DataFrame, top: int, order: list[Column]) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``: first of hashed slices, then of ever fewer, then of all."""
    slices = shuffle_partitions(rows.sparkSession)
    while slices > 1:
        dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
        rows = rows.withColumn("rank", F.row_number().over(dealt.orderBy(*order))).where(F.col("rank") <= top)
        slices = int(slices**0.5) if slices > 3 else 1
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, inside_percent: int = 50) -> DataFrame:
    """The best phrases of each language: ``(lang, rank, phrase, a, l, r, n, score, cut)``.

    Phrases of 2 to ``max_words`` (at most four) words inside pieces, with ``a`` occurrences, at least ``min_count``.
    ``n`` counts the language's words. Of the cuts of a phrase into two parts with ``l`` and ``r`` occurrences the one with the lowest
    score counts, ties to the shortest first part (``cut`` words): floor(1000000 a² / (l r)), in decimals of 38 digits, exact up to 10^15 occurrences.
    A phrase is dropped if a longer one that holds it has ``inside_percent`` of its occurrences or more. The first ``top`` of each
    language stand by falling score, falling ``a`` and rising phrase (UTF-8 byte order).

    A-Z are lowered. Null texts are empty and add nothing; a null language is ``und``, an empty one is a language of its own. Repeated
    rows and null ids count like others; other columns, ``doc_id`` too, are not read. A text is held whole in one task. No phrase
    that reaches the count gives no row.
    """
    if not 2 <= max_words <= MOST_WORDS:
        raise ValueError(f"phrases have 2 to {MOST_WORDS} words")
    words, grams, totals = count_grams(docs, max_words, min_count)
    with shuffles_dropped(docs.sparkSession):
        number = [_word(k) for k in range(MOST_WORDS)]
        cuts = []
        for size in range(2, max_words + 1):
            for k in range(1, size):
                left, right = _key(number[:k]), _key(number[k:size])
                sides = [F.struct(*(c.alias(n) for c, n in zip(side, "ab"))) for side in (left, right)]
                cuts.append(F.when(F.col("n_words") == size, F.struct(F.lit(k).alias("cut"), sides[0].alias("left"), sides[1].alias("right"))))
        phrases = grams.where("n_words > 1").withColumn("cuts", F.array_compact(F.array(*cuts)))
        each = phrases.select("a", "b", "n_words", "f", F.explode("cuts").alias("c")).select("a", "b", "n_words", "f", "c.*")
        counts = grams.select(F.col("a").alias("ka"), F.col("b").alias("kb"), F.col("f").alias("kf"))
        for side, name in (("left", "l"), ("right", "r")):
            each = each.join(counts, (F.col(f"{side}.a") == F.col("ka")) & (F.col(f"{side}.b") == F.col("kb")))
            each = each.drop("ka", "kb").withColumnRenamed("kf", name)
        a, left, right = (F.col(c).cast("decimal(15,0)") for c in ("f", "l", "r"))
        million = F.lit(1_000_000).cast("decimal(7,0)")
        each = each.withColumn("up", a * a * million).withColumn("down", left * right).withColumn("score", F.expr("up div down"))
        each = written(each.select("a", "b", "n_words", "f", "left", "right", "cut", "l", "r", "score"), "phrase_cuts")
        # a phrase inside a longer one is, a word at a time, the first or last part of one that has no fewer occurrences
        whole = F.when(F.col("cut") == 1, F.col("right")), F.when(F.col("cut") == F.col("n_words") - 1, F.col("left"))
        inside = each.where("n_words > 2").select("f", F.explode(F.array_compact(F.array(*whole))).alias("part"))
        inside = inside.groupBy(F.col("part.a").alias("a"), F.col("part.b").alias("b")).agg(F.max("f").alias("longer"))
        best = each.groupBy("a", "b", "n_words", "f").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
        kept = best.join(inside, ["a", "b"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("f")))
        kept = kept.select(*(n.alias(f"w{k}") for k, n in enumerate(number[:max_words])), F.col("f").alias("n_found"), "best.*")
        for k in range(max_words):
            name = words.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"word{k}"), *(["lang"] if k == 0 else []))
            kept = kept.join(name, f"w{k}", "inner" if k < 2 else "left")
        phrase = F.concat_ws(" ", *(f"word{k}" for k in range(max_words)))
        named = written(kept.select("lang", phrase.alias("phrase"), F.col("n_found").alias("a"), "l", "r", "score", "cut"), "phrase_names")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # few rows: one for each language, joined to at most ``top`` of each
    return _first_of_each(named, top, order).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("cut").cast("long").alias("cut"))
