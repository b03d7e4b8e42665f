"""Token ids packed into rows of one length, best fit decreasing, with segment lengths and position resets.

Documents are encoded and closed with an end token. What is longer than a row is split without loss into full rows and a
rest. Pieces are packed in falling length: a segment tree over remaining capacities finds the open row with the least room
that still fits. Each task packs its own documents in pools of bounded size, so nothing is shuffled and no task holds more
than a pool; a pool leaves at most a few rows partly empty.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.llm.common import once, slabs, texts_of

#: Fixed value: how the byte-level vocabularies cut texts before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW_TOKENS = 2048
POOL_TOKENS = 1 << 20
SLAB_BYTES = 1 << 20
#: Packed rows that leave a pool together.
BATCH_ROWS = 64


class CapacityTree:
    """Open rows by remaining capacity; finds the least capacity of at least so much in a descent of the tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += n
            node >>= 1

    def push(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def pop_best(self, size: int) -> tuple[int, int] | None:
        """Take out ``(room, row)`` with the smallest room of at least ``size``."""
        node = size + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of piece numbers: best fit decreasing, ties by number."""
    tree, rows = CapacityTree(capacity), []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        room, row = tree.pop_best(size) or (capacity, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(piece)
        if room > size:
            tree.push(room - size, row)
    return rows


class Encoder:
    """Encodes texts with a rank file; pieces between single spaces are encoded once per batch."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed with the end token, and where each text's ids start.

        A piece with its leading space is encoded alike wherever it stands, unless white space meets white space;
        texts where it does are encoded whole.
        """
        mixed = pc.match_substring_regex(texts, r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]{2}")
        lists = pc.split_pattern(pc.if_else(mixed, "", texts), " ")
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        pieces, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        encode = self.encoding.encode_ordinary
        known = [encode(" " + p) for p in pieces]
        first, whole = codes[starts[:-1]].tolist(), mixed.to_numpy(zero_copy_only=False)
        extra: dict[int, int] = {}
        for i, code in enumerate(first):
            if whole[i]:
                codes[starts[i]] = len(known)
                known.append(encode(texts[i].as_py()))
            else:
                if code not in extra:
                    extra[code] = len(known)
                    known.append(encode(pieces[code]))
                codes[starts[i]] = extra[code]
        codes = np.insert(codes, starts[1:], len(known))
        known.append([self.end])
        lengths = np.fromiter(map(len, known), np.int64, len(known))
        flat = np.fromiter((t for ids in known for t in ids), np.int32, int(lengths.sum()))
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        taken = lengths[codes]
        ends = np.cumsum(taken)
        ids = flat[np.repeat(begin[codes] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[starts + np.arange(len(starts))]


def _pool_rows(ids: np.ndarray, starts: np.ndarray, doc_ids: pa.Array, capacity: int, end: int, shard: str, first_row: int, in_order: bool = False) -> Iterator[pa.RecordBatch]:
    """One packed row per record, a few at a time."""
    narrow = np.uint16 if end < 1 << 16 else np.uint32
    lengths = np.diff(starts)
    n_pieces = -(-lengths // capacity)
    doc = np.repeat(np.arange(len(lengths)), n_pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    at = starts[doc] + piece * capacity
    sizes = np.minimum(starts[doc + 1] - at, capacity)
    rows = best_fit(sizes, capacity)
    if in_order:
        rows.sort(key=lambda row: doc[row].mean())
    for low in range(0, len(rows), BATCH_ROWS):
        some = rows[low : low + BATCH_ROWS]
        yield _records(some, ids, at, sizes, doc, piece, doc_ids, capacity, end, narrow, shard, first_row + low)


def _records(rows, ids, at, sizes, doc, piece, doc_ids, capacity, end, narrow, shard, first_row) -> pa.RecordBatch:
    packed, places, bounds, owners, parts = [], [], [], [], []
    for row in rows:
        line, place = np.full(capacity, end, narrow), np.zeros(capacity, np.uint32)
        edges = np.concatenate([[0], np.cumsum(sizes[row])])
        for k, a, b in zip(row, edges[:-1], edges[1:]):
            line[a:b] = ids[at[k] : at[k] + sizes[k]]
            place[a:b] = np.arange(b - a)
        packed.append(line.tobytes())
        places.append(place.astype(np.uint16 if capacity <= 1 << 16 else np.uint32).tobytes())
        bounds.append(edges.astype(np.int32))
        owners += doc[row].tolist()
        parts += piece[row].tolist()
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard] * len(rows)),
            pa.array(np.arange(first_row, first_row + len(rows))),
            pa.array(np.array([b[-1] for b in bounds], np.int32)),
            pa.array(packed, pa.binary()),
            pa.array(places, pa.binary()),
            pa.array(bounds, pa.list_(pa.int32())),
            pa.ListArray.from_arrays(offsets, doc_ids.take(pa.array(owners, pa.int64()))),
            pa.ListArray.from_arrays(offsets, pa.array(parts, pa.int32())),
        ],
        names=["shard", "row", "n_tokens", "ids", "position_ids", "cu_seqlens", "doc_ids", "pieces"],
    )


def _of_one_file(batch: pa.RecordBatch, filed: bool) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch that come from one file; the batch itself where files do not matter."""
    if not filed or not batch.num_rows:
        yield batch
        return
    name = batch.column("name").dictionary_encode().indices.to_numpy()
    edges = [0, *(np.flatnonzero(np.diff(name)) + 1).tolist(), len(name)]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def pack(docs: DataFrame, path: str, capacity: int = ROW_TOKENS, pool_tokens: int = POOL_TOKENS, in_order: bool = False) -> DataFrame:
    """Packed rows: ``(shard, row, n_tokens, ids, position_ids, cu_seqlens, doc_ids, pieces)``.

    ``ids`` is ``capacity`` little-endian unsigned integers (2 bytes each where the vocabulary fits, else 4), filled up
    with the end token; together the rows of a shard are its id matrix. ``position_ids`` start again at 0 with
    each segment (2 bytes, or 4 for rows above 65,536 tokens). ``cu_seqlens`` are the bounds of the segments, from 0 to
    ``n_tokens``; segment k belongs to ``doc_ids[k]`` and is its piece number ``pieces[k]``. Pieces of one document in
    order give its ids back, without loss.

    Null and empty texts are an end token alone. Null ids and repeated rows are packed like others, and extra columns are
    ignored. A shard is a partition of the input; with ``in_order`` it is a piece of a part file, named by
    the file's number and the place of its first row, so that names sort as the input was written, and the rows of a pool stand by the mean place
    of their documents, else by falling length of their first piece. An input that is not in files is taken by partitions. No rows give no rows. ``path`` names a rank file on every machine.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = once(("packing.Encoder", path), lambda: Encoder(path)), 0
        shard = f"{TaskContext.get().partitionId():06d}"
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        following = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal row
            before = np.concatenate([[0], np.cumsum([len(ids) for ids, _, _ in held])])
            ids = np.concatenate([ids for ids, _, _ in held])
            starts = np.concatenate([[0], *[s[1:] + b for (_, s, _), b in zip(held, before)]]).astype(np.int64)
            owners = pa.concat_arrays([owner for _, _, owner in held])
            held.clear()
            for out in _pool_rows(ids, starts, owners, capacity, encoder.end, shard, row, in_order):
                yield out
                row += out.num_rows

        for batch in (part for whole in batches for one in _of_one_file(whole, filed) for part in slabs([one], limit=SLAB_BYTES)):
            if filed:
                number, name, first = (batch.column(c)[0].as_py() for c in ("number", "name", "place"))
                if (name, first) != following:
                    if held:
                        yield from flush()
                    row, shard = 0, f"{number:06d}-{name}-{first:012d}"
                following = (name, batch.column("place")[-1].as_py() + 1)
            held.append((*encoder.documents(texts_of(batch)), batch.column("doc_id")))
            if sum(len(ids) for ids, _, _ in held) >= pool_tokens:
                yield from flush()
        if held:
            yield from flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"shard string, row long, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<{kind}>, pieces array<int>"
    filed = in_order and bool(docs.inputFiles())
    place = []
    if filed:
        file = docs.metadataColumn("_metadata")
        number = F.coalesce(F.regexp_extract(file["file_name"], "^part-([0-9]+)", 1).try_cast("long"), F.lit(0))
        place = [number.alias("number"), file["file_name"].alias("name"), file["row_index"].alias("place")]
    return docs.select("doc_id", "text", *place).mapInArrow(run, schema)
