"""Benchmark decontamination: a prefix-filtered set join with exact verification.

A window is a set of words that a document must contain whole, so one word of it, its rarest, is a sufficient prefix: a
document without that word cannot hold the window. Rarity is the number of occurrences in the documents themselves,
counted for the benchmark's words alone. Each occurrence of a prefix word in a document then proposes a place for the window;
places that would start before the document's first word or end after its last fall by the positional and length bounds,
and the rest are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicgrove.llm.common import ascii_lower
from topicgrove.session import written

#: Everything but ASCII letters and digits and all non-ASCII characters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Windows with at most this many bytes of words are sent to every task; more are joined by shuffling.
BROADCAST_BYTES = 16 << 20


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, window)``: every run of ``window`` words of an item, or the whole of a shorter one."""
    words = items.select("item_id", normal_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("window")).distinct()


def _prefixes(windows: DataFrame, texts: DataFrame, small: bool) -> DataFrame:
    """``(token, at, window)``: the rarest word of each different window and where it stands in it."""
    places = windows.select("window").distinct().select("window", F.posexplode("window").alias("at", "token"))
    vocabulary = written(places.select("token").distinct(), "vocabulary")
    known = F.broadcast(vocabulary) if small else vocabulary
    counts = texts.select(F.explode("words").alias("token")).join(known, "token").groupBy("token").agg(F.count("*").alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at")
    best = places.join(counts, "token", "left").groupBy("window").agg(F.min(rarity).alias("best"))
    return best.select("best.token", "best.at", "window")


def find_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, text_hash, start, window)``: every place (from 1) where a window of an item stands in a document.

    Documents are told apart by id and a hash of the text, so rows that repeat one id with other texts stay apart.
    """
    windows = written(item_windows(items, window), "windows")
    size = F.aggregate("window", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 8)
    small = (windows.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), normal_words(F.col("text")).alias("words"))
    prefixes = written(_prefixes(windows, texts, small), "prefixes")
    tokens = texts.select("doc_id", "text_hash", "words", F.posexplode("words").alias("place", "token"))
    if not small:
        # keep long arrays out of the shuffle by word: propose places first and fetch the words of the documents once
        slim = tokens.drop("words").join(prefixes, "token")
        tokens = slim.withColumnsRenamed({"doc_id": "at_id", "text_hash": "at_hash"}).join(
            texts, F.col("at_id").eqNullSafe(F.col("doc_id")) & F.col("at_hash").eqNullSafe(F.col("text_hash"))
        )
        proposed = tokens
    else:
        proposed = tokens.join(F.broadcast(prefixes), "token")
    start = F.col("place") - F.col("at") + 1
    bounded = proposed.where((start >= 1) & (start + F.size("window") - 1 <= F.size("words")))
    exact = F.slice("words", start, F.size("window")) == F.col("window")
    return bounded.where(exact).select("doc_id", "text_hash", start.alias("start"), "window").distinct()


def covered_words(spans: Column) -> Column:
    """How many places the spans ``(start, end)`` cover together."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("last"))
    step = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(x["end"] - F.greatest(x["start"] - 1, acc["last"]), F.lit(0))).alias("n"),
        F.greatest(acc["last"], x["end"]).alias("last"),
    )
    return F.aggregate(F.sort_array(spans), zero, step)["n"]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: ``(doc_id, text_hash, n_words, n_hit, items, contaminated)``.

    ``items`` are the ids, as sorted strings, of the items with a window in the document (null ids are no items);
    ``n_hit`` counts the document's words inside any window. Null and empty texts have no words; an item without words has no windows;
    repeated rows of either table change nothing but the number of rows. Without items no document is hit.
    """
    found = written(find_windows(docs, items, window), "found")
    places = found.groupBy("doc_id", "text_hash", "start").agg(F.max(F.size("window")).alias("length"))
    spans = places.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", (F.col("start") + F.col("length") - 1).alias("end"))).alias("spans")
    )
    owners = item_windows(items.where("item_id is not null"), window).select(F.col("item_id").cast("string").alias("item"), "window")
    named = found.select("doc_id", "text_hash", "window").distinct().join(owners, "window")
    listed = named.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("item")).alias("items"))
    key = lambda f: f.withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})
    hits = key(spans).join(
        listed, F.col("hit_id").eqNullSafe(F.col("doc_id")) & F.col("hit_hash").eqNullSafe(F.col("text_hash")), "left"
    ).select("hit_id", "hit_hash", covered_words(F.col("spans")).cast("long").alias("n_hit"), "items")
    hits = written(hits, "hits")
    counted = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(normal_words(F.col("text"))).cast("long").alias("n_words"))
    joined = counted.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
    return joined.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    hits = written(find_windows(docs, items, window).select("doc_id", "text_hash").distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(hits["doc_id"]) & (F.xxhash64(docs["text"]) == hits["text_hash"])
    return docs.join(hits, same, "left_anti")
