"""Byte-pair encoding with an index of pair occurrences, and decoding.

The different pieces of a task's texts are laid out in one array of symbols, a gap after each pre-token. An index maps every
merge rank to the positions where its pair stands. The lowest rank that has positions is applied everywhere at once; each merge
replaces two symbols by one, and the two pairs beside it are entered under their own ranks. A merge needs symbols that lower ranks
made, so ranks are met in ascending order and every rank is applied once its positions are complete.

Pieces that were encoded are remembered, up to a bounded number; texts are then put together from pieces.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.llm.common import once, slabs, split_words, texts_of
from topicgrove.llm.token_counts import UNICODE_SPACE, UNKNOWN, Counter, Merges, load_merges

#: Texts of this many bytes are encoded together.
SLAB_BYTES = 1 << 20
#: Pieces and ids that a task remembers; beyond either it starts anew.
MEMORY_PIECES, MEMORY_IDS = 100_000, 2_000_000
GAP, DEAD = -1, -2


def _assigned(cut: Counter, merges: Merges, path: str):
    """The cutting pattern where code points that are newer than the library's Unicode are no letters or digits, as there.

    Which those are is asked of the library once, for the few ranges that Python's own, older tables do not know.
    """
    import regex
    from tokenizers import Tokenizer

    free = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    late = regex.findall(r"[\p{L}\p{N}]", "".join(free))
    # a mark and a letter are cut apart, a mark and what is no letter or digit are not
    ends = {b for _, (_, b) in Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str(" ".join("!" + c for c in late))}
    early = [ord(c) for i, c in enumerate(late) if 3 * i + 1 not in ends]
    if not early:
        return cut.words
    opens = [c for a, c in zip([-2, *early], early) if c != a + 1]
    closes = [a for a, c in zip(early, [*early[1:], -2]) if c != a + 1]
    early = "".join(rf"\U{a:08x}-\U{c:08x}" for a, c in zip(opens, closes))
    pattern = merges.pattern.replace(r"[^\s\p{L}\p{N}]", "OTHER").replace(r"[\p{L}]", "LETTER").replace(r"[\p{N}]", "DIGIT")
    pattern = pattern.replace("OTHER", rf"[[^{UNICODE_SPACE}\p{{L}}\p{{N}}]||[{early}]]")
    return regex.compile("(?V1)" + pattern.replace("LETTER", rf"[\p{{L}}--[{early}]]").replace("DIGIT", rf"[\p{{N}}--[{early}]]"))


class PairIndex:
    """Symbols of all pre-tokens in one array, linked to their neighbours, and the positions of each rank's pair."""

    def __init__(self, symbols: np.ndarray, merges: Merges):
        self.merges, self.symbols = merges, symbols
        n = len(symbols)
        self.after = np.arange(1, n + 1)
        self.before = np.arange(-1, n - 1)
        self.at: dict[int, list[np.ndarray]] = defaultdict(list)
        self.active: list[int] = []
        self.by_rank = np.argsort(merges.ranks)
        starts = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
        self._enter(starts, symbols[starts] * merges.width + symbols[starts + 1])

    def _enter(self, starts: np.ndarray, codes: np.ndarray) -> None:
        """File the pairs that begin at ``starts`` under their ranks."""
        m = self.merges
        place = np.minimum(np.searchsorted(m.codes, codes), len(m.codes) - 1)
        known = m.codes[place] == codes
        if not known.any():
            return
        starts, ranks = starts[known], m.ranks[place[known]]
        order = np.argsort(ranks, kind="stable")
        starts, ranks = starts[order], ranks[order]
        edges = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for a, b in zip(edges, edges[1:]):
            rank = int(ranks[a])
            if rank not in self.at:
                heapq.heappush(self.active, rank)
            self.at[rank].append(starts[a:b])

    def merge_all(self) -> np.ndarray:
        """Apply every active rank in ascending order; the symbols that remain, gaps included."""
        if not len(self.merges.codes):
            return self.symbols
        rank_row = dict(zip(self.merges.ranks.tolist(), range(len(self.merges.ranks))))
        symbols, after, before, width = self.symbols, self.after, self.before, self.merges.width
        while self.active:
            rank = heapq.heappop(self.active)
            lists = self.at.pop(rank)
            row = rank_row[rank]
            left, right = divmod(int(self.merges.codes[row]), width)
            # in rising order, each once: a pair may have been entered from both its sides
            start = lists[0] if len(lists) == 1 else np.concatenate(lists)
            start = np.unique(start)
            second = after[start]
            held = (symbols[start] == left) & (symbols[second] == right)
            start, second = start[held], second[held]
            if left == right and len(start) > 1:
                # overlapping pairs (a a a): the first, third, ... of each unbroken run
                opens = np.concatenate([[True], start[1:] != second[:-1]])
                order = np.arange(len(start))
                taken = (order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0
                start, second = start[taken], second[taken]
            if not len(start):
                continue
            result = int(self.merges.results[row])
            beyond, prior = after[second], before[start]
            symbols[start], symbols[second] = result, DEAD
            after[start], before[beyond] = beyond, start
            has_left, has_right = symbols[prior] >= 0, symbols[beyond] >= 0
            prior, start = prior[has_left], start[has_right]
            starts = np.concatenate([prior, start])
            self._enter(starts, symbols[starts] * width + symbols[after[starts]])
        return symbols[symbols != DEAD]


class Encoder:
    """Ids of texts. Pieces between ASCII white space are encoded once and remembered."""

    def __init__(self, path: str):
        self.merges = load_merges(path)
        with open(path, encoding="utf-8") as file:
            self.special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        self.cut = Counter(self.merges)
        self.words = _assigned(self.cut, self.merges, path)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _pretokens(self, piece: str) -> list[str | int]:
        """Pre-tokens of a piece in order; ids for special strings."""
        parts: list[str | int] = []
        rest = 0
        for match in self.cut.special.finditer(piece) if self.special and "<" in piece else ():
            parts += [piece[rest : match.start()], self.special[match.group()]]
            rest = match.end()
        parts.append(piece[rest:])
        found: list[str | int] = []
        for part in parts:
            if isinstance(part, int):
                found.append(part)
                continue
            part = unicodedata.normalize("NFC", part)
            # one character at a time, so that a final sigma is lowered like any other
            part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
            found += (self.cut.words if part.isascii() else self.words).findall(part)
        return found

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not known yet, together."""
        new = [p for p in pieces if p not in self.place]
        if not new:
            return
        index: dict[str, int] = {}
        parts, sizes = [], []
        for piece in new:
            found = [piece.lower()] if piece.isascii() and piece.isalpha() else self._pretokens(piece)
            sizes.append(len(found))
            parts += [-1 - p if isinstance(p, int) else index.setdefault(p, len(index)) for p in found]
        flat, starts = self._encode_pretokens(list(index))
        part = np.array(parts, np.int64)
        ids, ends = gather(np.concatenate([flat, -1 - part[part < 0]]), *self._bounds(part, starts, len(flat)))
        of_piece = np.concatenate([[0], ends])[np.cumsum([0, *sizes])]
        self.place |= {p: len(self.starts) - 1 + i for i, p in enumerate(new)}
        self.starts = np.concatenate([self.starts, of_piece[1:] + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    @staticmethod
    def _bounds(part: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Begin and length of each part in the ids of all pre-tokens, followed by one id for each special string."""
        special = part < 0
        begin, length = np.zeros(len(part), np.int64), np.ones(len(part), np.int64)
        begin[~special], length[~special] = starts[part[~special]], np.diff(starts)[part[~special]]
        begin[special] = n + np.arange(special.sum())
        return begin, length

    def _encode_pretokens(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        m = self.merges
        raw = [p.encode("utf-8", "surrogatepass") for p in pretokens]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = m.plain[data].astype(np.int64)
        ends = np.cumsum(lengths)
        last = ends[lengths > 0] - 1
        symbols[last] = m.ending[data[last]]
        held = symbols != UNKNOWN  # bytes without a symbol are left out
        cut = np.concatenate([[0], np.cumsum(held)])[ends]
        symbols = np.insert(symbols[held], cut, GAP)
        merged = PairIndex(np.concatenate([[GAP], symbols, [GAP]]), m).merge_all()[1:-1]
        gaps = np.flatnonzero(merged == GAP)
        return merged[merged != GAP], np.concatenate([[0], gaps - np.arange(len(gaps))])

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids start (one more entry than texts).

        A letter and a mark after it are never in one pre-token or special string, so they are parted first: fewer pieces differ.
        """
        words, starts = split_words(pc.replace_substring_regex(texts, r"([A-Za-z])([,.;:!?)\x22])", r"\1 \2"))
        if not len(words):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        if len(self.place) > MEMORY_PIECES or len(self.ids) > MEMORY_IDS:
            self.forget()
        coded = words.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        self.learn(pieces)
        known = np.fromiter((self.place[p] for p in pieces), np.int64, len(pieces))[coded.indices.to_numpy()]
        ids, ends = gather(self.ids, self.starts[known], self.starts[known + 1] - self.starts[known])
        return ids, np.concatenate([[0], ends])[starts]


def gather(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``flat[begin:begin + length]`` one after the other, and where each ends."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(begin - (ends - length), length) + np.arange(total)], ends


def encode(docs: DataFrame, path: str, decoded: str | None = None) -> DataFrame:
    """One row per document: ``(doc_id, n_tokens, ids)``; ``ids`` are little-endian unsigned 32-bit integers.

    ``path`` names a vocabulary file that every machine has. Ids are those of the tokenizers library without begin, end or
    added tokens; special strings inside a text become their ids. Null texts are empty; empty ones have no ids. Null ids of
    documents and repeated rows are kept as they are; other columns are ignored. A text is held whole in one task, and a batch
    is cut to about ``SLAB_BYTES`` or one text. With ``decoded`` a column of that name holds what ``decode`` makes of the ids, in the
    same pass.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("bpe.Encoder", path), lambda: Encoder(path))
        decoder = once(("bpe.Decoder", path, False), lambda: Decoder(path)) if decoded else None
        for batch in slabs(batches, limit=SLAB_BYTES):
            ids, starts = encoder.of_texts(texts_of(batch))
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts * 4), pa.py_buffer(ids.astype("<u4"))])
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(np.diff(starts)), "ids": data.cast(pa.binary())}
            if decoder:
                columns[decoded] = pa.array([t.decode("utf-8", "replace") for t in decoder.of_ids(ids, starts)], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = f", `{decoded}` string" if decoded else ""
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary{more}")


class Decoder:
    """Texts of ids: the tokens as they stand in the vocabulary, joined by spaces, or ``plain`` text again."""

    def __init__(self, path: str, plain: bool = False):
        from topicgrove.llm.token_counts import _byte_characters

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        special = {t["id"] for t in spec["added_tokens"]}
        suffix, byte_of = spec["model"]["end_of_word_suffix"] or "", {c: b for b, c in enumerate(_byte_characters())}

        def shown(i: int) -> bytes:
            name = names.get(i)
            if name is None:  # the library skips ids that it does not know
                return b""
            if not plain:
                return name.encode() + b" "
            if i in special:
                return name.encode() + b" "
            ends = suffix and name.endswith(suffix)
            return bytes(byte_of[c] for c in (name.removesuffix(suffix) if ends else name)) + (b" " if ends else b"")

        shapes = [shown(i) for i in range(max(names, default=-1) + 2)]  # the last one stands for all unknown ids
        self.length = np.fromiter(map(len, shapes), np.int64, len(shapes))
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(shapes), np.uint8)

    def of_ids(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        ids = np.minimum(ids, len(self.length) - 1)
        data, ends = gather(self.flat, self.begin[ids], self.length[ids])
        edges, raw = np.concatenate([[0], ends])[starts].tolist(), data.tobytes()
        return [raw[a:b][:-1] if raw[b - 1 : b] == b" " and b > a else raw[a:b] for a, b in zip(edges, edges[1:])]


def decode(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded", plain: bool = False) -> DataFrame:
    """All columns of ``rows`` and the text of the ids in column ``ids`` (as ``encode`` writes them) as column ``into``.

    As the tokenizers library decodes with this file, special tokens included: tokens as the vocabulary writes them, joined
    by spaces. With ``plain``, bytes are put together again and a space follows each pre-token. Bytes that are not UTF-8
    give replacement characters. Null ids give a null text, none an empty one, and unknown ids are left out.
    A column of the name ``into`` is replaced.
    """
    names = [c for c in rows.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = once(("bpe.Decoder", path, plain), lambda: Decoder(path, plain))
        for batch in batches:
            for part in slabs([batch], ids, SLAB_BYTES):
                held = part.column(ids).to_pylist()
                starts = np.cumsum([0, *(len(h or b"") // 4 for h in held)])
                texts = decoder.of_ids(np.frombuffer(b"".join(h or b"" for h in held), "<u4").astype(np.int64), starts)
                texts = [None if h is None else t.decode("utf-8", "replace") for h, t in zip(held, texts)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(texts, pa.string())], [*names, into])

    kept = rows.select(names)
    return kept.mapInArrow(run, ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema) + f", `{into}` string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every document."""
    both = encode(docs, path, decoded="decoded")
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
