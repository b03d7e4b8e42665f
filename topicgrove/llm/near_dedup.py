"""MinHash near-duplicates with odd sketches.

A document is the set of its word shingles. Its MinHash samples are used twice: in bands, whose equal hashes propose
pairs, and folded into a parity bitmap, the odd sketch: each sample flips one bit, so the bits in which two sketches differ
count the samples in which the documents differ, and the similarity follows with small error where it is high. Proposed pairs that the
sketches put far below the threshold fall; the rest is confirmed on the full sets.

Documents with equal sets are one node from the start. The first node of a bucket is its pivot; each node joins the pivot whose
sketch is nearest, and these groups are verified on full sets where the sets are. Buckets whose nodes are then in one confirmed
component are done. In the others, sketches and sizes say which pairs of different components may still be similar; what those pairs
connect is a family and is verified in turn. Groups and families are cut into blocks by nodes and bytes, each task holds one tile
of them, and only links that connect new parts leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.llm.common import hash_strings, mixed, shuffle_partitions, slabs, split_words, texts_of
from topicgrove.llm.graph import components
from topicgrove.session import written, written_and_measured

#: Bands and samples in each: a pair at similarity 0.8 shares no bucket with probability (1 - 0.8**5)**32 = 3e-6.
BANDS, ROWS = 32, 5
SAMPLES, SKETCH_BITS = BANDS * ROWS, 512
#: Sketches may put a pair this far below the threshold before it falls: over five standard errors.
MARGIN = 0.2
#: Nodes and bytes of sets of one block of a group, and of one task that verifies small groups.
TILE_NODES, TILE_BYTES, TASK_NODES, TASK_BYTES = 4096, 24 << 20, 2000, 24 << 20
#: Sketches of one block of a bucket, and of one task that compares those of small buckets.
BUCKET_NODES, TASK_SKETCHES = 1 << 15, 50_000
_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, (4, SAMPLES), np.uint64) | np.uint64(1)


def shingle_hashes(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle hashes of each text, sorted inside a text, and where each text's hashes start.

    A text of fewer words than ``n``, but not none, has one shingle, the whole sequence.
    """
    words, starts = split_words(pc.ascii_lower(texts))
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    coded = words.dictionary_encode()
    w = hash_strings(coded.dictionary)[coded.indices.to_numpy()]
    counts = np.diff(starts)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(w)) - starts[owner]
    size = np.minimum(counts, n)[owner]
    total = size.astype(np.uint64)
    padded = np.concatenate([w, np.zeros(n, np.uint64)])
    for k in range(n):
        inside = k < size
        total = np.where(inside, total * np.uint64(0x9E3779B97F4A7C15) + padded[k : k + len(w)], total)
    valid = place <= counts[owner] - size
    hashes, owner = mixed(total[valid]), owner[valid]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(counts) + 1))


def set_digests(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers that tell sets apart (the sums of two hashes of the members)."""
    found = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ np.uint64(salt)))])
        found.append(total[starts[1:]] - total[starts[:-1]])
    return np.stack(found, axis=1)


def minhash(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``SAMPLES`` minima for each text that has shingles."""
    at = starts[:-1][np.diff(starts) > 0]
    minima = np.empty((len(at), SAMPLES), np.uint64)
    for k in range(SAMPLES if len(at) else 0):
        minima[:, k] = np.minimum.reduceat(hashes * _SEEDS[0, k] + _SEEDS[1, k], at)
    return minima


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, as rows of 64-bit numbers."""
    bits = mixed(minima ^ _SEEDS[2]) % np.uint64(SKETCH_BITS)
    cells = np.arange(len(minima))[:, None] * SKETCH_BITS + bits.astype(np.int64)
    odd = np.bincount(cells.ravel(), minlength=len(minima) * SKETCH_BITS).reshape(-1, SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.uint64)


def band_hashes(minima: np.ndarray) -> np.ndarray:
    grouped = minima.reshape(-1, BANDS, ROWS)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), grouped.shape[:2]).copy()
    for k in range(ROWS):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return total.view(np.int64)


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, hi, lo, odd, bands)`` per row; the last four are null where there are no words."""

    def rows(values: np.ndarray, present: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(np.where(present, values.shape[1], 0))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()), mask=pa.array(~present))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, limit=4 << 20):
            hashes, starts = shingle_hashes(texts_of(batch), n)
            count = np.diff(starts)
            present = count > 0
            digest = set_digests(hashes, starts).view(np.int64)
            minima = minhash(hashes, starts)
            hi, lo = (pa.array(digest[:, k], mask=~present) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(count.astype(np.int64)), hi, lo, *[rows(x, present) for x in (odd_sketches(minima).view(np.int64), band_hashes(minima))]],
                ["doc_id", "text_hash", "n_shingles", "hi", "lo", "odd", "bands"],
            )

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows_in.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, hi long, lo long, odd array<long>, bands array<long>")


def texts_once(docs: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, text)``, one row for each of ``keys`` (``doc_id, text_hash``) however often ``docs`` repeats it.

    ``rows`` are the sketches of ``docs``.
    """
    both = ["doc_id", "text_hash"]
    counted = rows.select(*both).join(keys, both, "left_semi").groupBy(*both).agg(F.count("*").alias("n_rows"))
    counted, seen = written_and_measured(counted, "wanted", most=F.max("n_rows"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    single = texts.join(counted.where("n_rows = 1"), both, "left_semi")
    if (seen["most"] or 0) <= 1:
        return single
    return single.union(texts.join(counted.where("n_rows > 1"), both, "left_semi").groupBy(*both).agg(F.first("text").alias("text")))


def full_sets(texts: DataFrame, n: int) -> DataFrame:
    """``(node, text_hash, odd, shingles)`` per row of ``(doc_id, text_hash, text)`` that has words, the last two as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, limit=4 << 20):
            hashes, starts = shingle_hashes(texts_of(batch), n)
            present = np.flatnonzero(np.diff(starts))
            odd = odd_sketches(minhash(hashes, starts))
            sets = [hashes[starts[i] : starts[i + 1]].tobytes() for i in present]
            keys = [batch.column(c).take(pa.array(present)) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array([x.tobytes() for x in odd], pa.binary()), pa.array(sets, pa.binary())], ["node", "text_hash", "odd", "shingles"]
            )

    return texts.select("doc_id", "text_hash", "text").mapInArrow(run, "node long, text_hash long, odd binary, shingles binary")


def estimated_similarity(differing: np.ndarray) -> np.ndarray:
    """What the number of differing bits of two odd sketches says about the share of equal samples."""
    share = np.minimum(2.0 * differing / SKETCH_BITS, 0.999)
    return 1 + np.log1p(-share) * SKETCH_BITS / (4 * SAMPLES)


def most_bits(percent: int) -> int:
    """How many bits two sketches may differ in before the pair falls."""
    return int(np.flatnonzero(estimated_similarity(np.arange(SKETCH_BITS + 1)) >= percent / 100 - MARGIN).max())


def bucket_links(nodes: np.ndarray, labels: np.ndarray, sizes: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Links that connect the nodes of one bucket as all pairs would that differ in label and may be similar enough.

    Each such pair has an end outside the most frequent label, so only these ends look at the sketches of the others, and only at those
    of fitting size.
    """
    order = np.argsort(sizes, kind="stable")
    nodes, sizes, sketch = nodes[order], sizes[order], sketch[order]
    _, label, counts = np.unique(labels[order], return_inverse=True, return_counts=True)
    least = np.searchsorted(sizes, -(-percent * sizes // 100))
    most = np.searchsorted(sizes, 100 * sizes // percent, side="right")
    group, bound = np.arange(len(nodes)), most_bits(percent)
    left, right = [], []
    for i in np.flatnonzero(label != counts.argmax()):
        a, b = least[i], most[i]
        place = a + np.flatnonzero((label[a:b] != label[i]) & (group[a:b] != group[i]))
        place = place[np.bitwise_count(sketch[place] ^ sketch[i]).sum(axis=1) <= bound]
        if len(place):
            met, first = np.unique(group[place], return_index=True)
            left += [int(nodes[i])] * len(met)
            right += nodes[place[first]].tolist()
            group[np.isin(group, met)] = group[i]
    return left, right


def _candidates(percent: int):
    def run(dealt: pa.Table) -> pa.Table:
        dealt = dealt.sort_by([("family", "ascending"), ("node", "ascending")])
        bucket, node, label, size = (dealt.column(c).to_numpy() for c in ("family", "node", "label", "n_shingles"))
        sketch = dealt.column("odd").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_BITS // 64)
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
        count = np.diff(bounds)
        one = bounds[:-1][count == 2]
        two = one + 1
        fits = (label[one] != label[two]) & (100 * np.minimum(size[one], size[two]) >= percent * np.maximum(size[one], size[two]))
        fits &= np.bitwise_count(sketch[one] ^ sketch[two]).sum(axis=1) <= most_bits(percent)
        left, right = node[one[fits]].tolist(), node[two[fits]].tolist()
        for k in np.flatnonzero(count > 2):
            own = slice(bounds[k], bounds[k + 1])
            x, y = bucket_links(node[own], label[own], size[own], sketch[own], percent)
            left += x
            right += y
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


def family_links(nodes: np.ndarray, labels: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
    """Links that connect the nodes of one tile as all pairs of similar sets would; equal labels are connected already.

    Each node looks at the sketches of those not yet connected with it; where one may be similar enough, the exact
    intersections with all others are counted through the postings of its members.
    """
    n = len(nodes)
    sizes = np.array([len(x) for x in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")
    owner = np.repeat(np.arange(n), sizes)[order]
    posting = np.searchsorted(token[order], np.arange(token.max() + 2))
    ends = np.cumsum(sizes)
    _, group = np.unique(labels, return_inverse=True)
    parts, bound = int(group.max()) + 1, most_bits(percent)
    left, right = [], []
    for i in range(n):
        if parts == 1:
            break
        place = np.flatnonzero((group != group[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])))
        place = place[np.bitwise_count(sketch[place] ^ sketch[i]).sum(axis=1) <= bound]
        if not len(place):
            continue
        mine = token[ends[i] - sizes[i] : ends[i]]
        shared = np.bincount(np.concatenate([owner[posting[t] : posting[t + 1]] for t in mine]), minlength=n)[place]
        similar = place[100 * shared >= percent * (sizes[i] + sizes[place] - shared)]
        if len(similar):
            met, first = np.unique(group[similar], return_index=True)
            left += [int(nodes[i])] * len(met)
            right += nodes[similar[first]].tolist()
            group[np.isin(group, met)] = group[i]
            parts -= len(met)
    return left, right


def _confirm(percent: int):
    def run(dealt: pa.Table) -> pa.Table:
        dealt = dealt.sort_by([("family", "ascending"), ("node", "ascending")])
        family, node, label = (dealt.column(c).to_numpy() for c in ("family", "node", "label"))
        sketch = np.frombuffer(b"".join(dealt.column("odd").to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64)
        sets = dealt.column("shingles")
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(family)) + 1, [len(family)]])
        left, right = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a > 1:
                members = [np.frombuffer(x.as_py(), np.uint64) for x in sets.slice(a, b - a)]
                x, y = family_links(node[a:b], label[a:b], sketch[a:b], members, percent)
                left += x
                right += y
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


def _pairs_of_blocks(cut: DataFrame) -> DataFrame:
    """Rows of ``(family, blocks, ...)`` with a ``tile`` for each pair of blocks that theirs is part of; an uncut family is tile 0."""
    block = F.pmod(F.xxhash64("node", "text_hash"), F.col("blocks"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: (o != F.col("block")) | (F.col("blocks") == 1))
    each = cut.withColumn("block", block).withColumn("other", F.explode(others))
    return each.withColumn("tile", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).drop("block", "other")


def _dealt(tiles: DataFrame, parts: int):
    """Uncut families share ``parts`` groups; each tile of a cut one is a group of its own."""
    cut = F.col("blocks") > 1
    part = F.when(cut, F.lit(-1)).otherwise(F.pmod(F.xxhash64("family"), F.lit(parts)).cast("int"))
    own, tile = F.when(cut, F.col("family")), F.when(cut, F.col("tile"))
    return tiles.withColumns({"part": part, "own": own, "own_tile": tile}).groupBy("part", "own", "own_tile")


def _blocks(families: DataFrame) -> DataFrame:
    most = F.greatest(F.count("*") / TILE_NODES, F.sum("n_shingles") * 8 / TILE_BYTES)
    return families.groupBy("family").agg(F.ceil(most).cast("long").alias("blocks"))


def _confirmed(tiles: DataFrame, docs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` inside tiles (``node, text_hash, n_shingles, label, family, blocks, tile``), on the full sets."""
    tiles, seen = written_and_measured(tiles, "tiles", n=F.count("*"), members=F.sum("n_shingles"))
    keys = tiles.select(F.col("node").alias("doc_id"), "text_hash").distinct()
    sets = full_sets(texts_once(docs, rows, keys), n)
    parts = max(shuffle_partitions(docs.sparkSession), seen["n"] // TASK_NODES, 8 * (seen["members"] or 0) // TASK_BYTES)
    dealt = _dealt(tiles.drop("n_shingles").join(sets, ["node", "text_hash"]), parts)
    return written(dealt.applyInArrow(_confirm(percent), "a long, b long"), "links")


def _pivot_tiles(members: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Tiles of each node with the pivot that is nearest by sketch among those of its buckets."""
    pairs = written(members.where("node <> pivot").select("node", "text_hash", "pivot").distinct(), "pairs")
    pivots = points.select(F.col("node").alias("pivot"), F.col("n_shingles").alias("pivot_size"), F.col("odd").alias("pivot_odd"))
    each = F.zip_with("odd", "pivot_odd", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    bits = F.aggregate(each, F.lit(0), lambda total, x: total + x)
    fits = 100 * F.least("n_shingles", "pivot_size") >= percent * F.greatest("n_shingles", "pivot_size")
    near = pairs.join(points, ["node", "text_hash"]).join(pivots, "pivot").where(fits).withColumn("bits", bits).where(F.col("bits") <= most_bits(percent))
    best = near.groupBy("node", "text_hash", "n_shingles").agg(F.min(F.struct("bits", "pivot")).alias("best"))
    groups = written(best.select("node", "text_hash", "n_shingles", F.col("best.pivot").alias("family")), "groups")
    blocks = written(_blocks(groups), "blocks")
    around = groups.join(blocks, "family").withColumn("tile", F.pmod(F.xxhash64("node", "text_hash"), F.col("blocks")))
    at_each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    centres = blocks.join(points.withColumnRenamed("node", "family"), "family").withColumns({"tile": at_each, "node": F.col("family")})
    columns = ["node", "text_hash", "n_shingles", F.col("node").alias("label"), "family", "blocks", "tile"]
    return around.select(*columns).union(centres.select(*columns))


def _open_tiles(members: DataFrame, labelled: DataFrame, percent: int) -> DataFrame:
    """Tiles of the nodes that may be similar to one of another label in a bucket of theirs."""
    both = ["node", "text_hash"]
    sides = members.select(*both, "bucket").join(labelled.select(*both, "label"), both)
    mixed = sides.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n_rows"))
    blocks = F.ceil(F.col("n_rows") / BUCKET_NODES).cast("long").alias("blocks")
    mixed, seen = written_and_measured(mixed.where("low <> high").select("bucket", "n_rows", blocks), "mixed", n=F.sum("n_rows"))
    cut = members.select(*both, "bucket").join(mixed, "bucket").select(*both, F.col("bucket").alias("family"), "blocks")
    compared = _pairs_of_blocks(cut).join(labelled, both)
    parts = max(shuffle_partitions(members.sparkSession), (seen["n"] or 0) // TASK_SKETCHES)
    found = components(_dealt(compared, parts).applyInArrow(_candidates(percent), "a long, b long"))
    families = written(found.select("node", F.col("label").alias("family")).join(labelled.drop("odd"), "node"), "families")
    return _pairs_of_blocks(families.join(_blocks(families), "family")).select(*both, "n_shingles", "label", "family", "blocks", "tile")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``(doc_id, text_hash, n_shingles, component_id, kept)``.

    Documents are linked where ``100 * intersection >= percent * union`` of their sets of ``n``-word shingles; words are lower-cased (A-Z)
    runs of other than ASCII white space. ``component_id`` is the smallest id reachable and ``kept`` whether it is the row's own.
    Null and empty texts have no shingles and are linked with nothing. Rows that share an id are one document. A null id is
    never a component: such a row takes that of a document with an equal set, or none, and is kept only in that case. No rows
    give no rows. Ids are integers; extra columns are ignored.
    """
    rows = written(sketches(docs, n), "sketches")
    known = rows.where("hi is not null and doc_id is not null")
    by_set = known.groupBy("hi", "lo").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("at"), *[F.first(c).alias(c) for c in ("n_shingles", "odd", "bands")]
    )
    nodes = written(by_set.select("hi", "lo", F.col("at.doc_id").alias("node"), F.col("at.text_hash").alias("text_hash"), "n_shingles", "odd", "bands"), "nodes")
    points = nodes.select("node", "text_hash", "n_shingles", "odd")
    banded = nodes.select("node", "text_hash", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot <> last").drop("last")
    members = written(banded.join(shared, "bucket"), "members")

    # an id with several texts joins the sets of all of them, and so does a set with several ids through its node
    same_id = known.select("doc_id", "hi", "lo").distinct()
    links = same_id.join(nodes.select("hi", "lo", "node"), ["hi", "lo"]).groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    links = written(links.where("a <> b").select("a", "b"), "links")
    stars = written(components(links.union(_confirmed(_pivot_tiles(members, points, percent), docs, rows, n, percent))), "stars")
    labelled = written(points.join(stars, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    rest = _confirmed(_open_tiles(members, labelled, percent), docs, rows, n, percent)
    labels = components(stars.select(F.col("node").alias("a"), F.col("label").alias("b")).union(rest))

    named = nodes.select("hi", "lo", "node").join(labels, "node", "left").select("hi", "lo", F.coalesce("label", "node").alias("component_id"))
    joined = rows.select("doc_id", "text_hash", "n_shingles", "hi", "lo").join(named, ["hi", "lo"], "left")
    found = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "text_hash", "n_shingles", found.alias("component_id"), F.coalesce(F.col("doc_id") == found, found.isNull()).alias("kept"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near-duplicates keeps the document with the smallest id.

    Of several rows with that id the one with the smallest text hash stays. Documents without words stay, and so do rows with a null id unless a
    document with an id has an equal set.
    """
    found = near_duplicates(docs, n, percent).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    named = found.where("kept_id is not null").groupBy("kept_id").agg(F.min("kept_hash").alias("kept_hash"), F.count("*").alias("n_rows"))
    nameless = found.where("kept_id is null").distinct().withColumn("n_rows", F.lit(1).cast("long"))
    stays, seen = written_and_measured(named.union(nameless), "kept", most=F.max("n_rows"))
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (F.xxhash64("doc.text") == F.col("kept_hash"))
    kept = docs.select(F.struct("*").alias("doc")).join(stays, same, "left_semi").select("doc.*")
    if (seen["most"] or 0) <= 1:
        return kept
    # rows equal in id and text are told apart by nothing; any one of them stays
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).union(kept.where("doc_id is null"))
