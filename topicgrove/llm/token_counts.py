"""Token counts by rank-synchronous merging of ragged arrays.

A batch of texts is cut into pre-tokens; the different ones are held together in one array of symbol ids with the bounds
of each. In every round each pre-token finds its pair of neighbours with the lowest merge rank, and the
pairs of that rank are merged in all pre-tokens at once, left to right, until no pair has a rank. What remains is counted, and
a text's count is the sum over its pre-tokens.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.llm.common import slabs, split_words, sums_between, texts_of

#: Fixed value: white space of the normaliser, as ranges.
UNICODE_SPACE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts of this many bytes are merged together.
SLAB_BYTES = 8 << 20
UNKNOWN = -1


class Merges(NamedTuple):
    """A vocabulary as arrays: sorted pair codes ``left * width + right`` with rank and result, and symbols of characters."""

    codes: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    width: int
    plain: np.ndarray  # byte to symbol id
    ending: np.ndarray  # byte to symbol id of the same byte at the end of a word
    pattern: str
    special: tuple[str, ...]


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one above 255."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(shown)]
    found = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [found[b] for b in range(256)]


def load_merges(path: str) -> Merges:
    """Read a byte-level BPE file with an end-of-word suffix, as the tokenizers library stores it."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, vocab = spec["model"], spec["model"]["vocab"]
    suffix = model["end_of_word_suffix"] or ""
    width = max(vocab.values()) + 1
    rows = []
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        rows.append((vocab[left] * width + vocab[right], rank, vocab[left + right]))
    codes, ranks, results = np.array(sorted(rows), np.int64).reshape(-1, 3).T
    first = np.concatenate([[True], codes[1:] != codes[:-1]])
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    chars = _byte_characters()
    return Merges(
        codes[first], ranks[first], results[first], width,
        np.array([vocab.get(c, UNKNOWN) for c in chars]), np.array([vocab.get(c + suffix, UNKNOWN) for c in chars]),
        split["pattern"]["Regex"], tuple(t["content"] for t in spec["added_tokens"]),
    )


def merge_all(symbols: np.ndarray, owner: np.ndarray, n: int, merges: Merges) -> np.ndarray:
    """How many symbols each of ``n`` pre-tokens keeps; ``owner`` says whose each symbol is, in rising order."""
    counts = np.bincount(owner, minlength=n)
    while len(symbols) > 1:
        beside = owner[:-1] == owner[1:]
        codes = symbols[:-1] * merges.width + symbols[1:]
        at = np.minimum(np.searchsorted(merges.codes, codes), len(merges.codes) - 1)
        known = beside & (merges.codes[at] == codes)
        if not known.any():
            break
        rank = np.where(known, merges.ranks[at], np.iinfo(np.int64).max)
        best = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(best, owner[:-1][known], rank[known])
        chosen = known & (rank == best[owner[:-1]])
        # overlapping pairs of one rank (a a a): take the first, third, ... of each unbroken run
        place = np.flatnonzero(chosen)
        opens = np.concatenate([[True], np.diff(place) > 1])
        run_start = place[np.maximum.accumulate(np.where(opens, np.arange(len(place)), 0))]
        place = place[(place - run_start) % 2 == 0]
        symbols = symbols.copy()
        symbols[place] = merges.results[at[place]]
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        # only pre-tokens that merged can merge again
        active = np.zeros(n, bool)
        active[owner[place]] = True
        counts -= np.bincount(owner[place], minlength=n)
        keep &= active[owner]
        symbols, owner = symbols[keep], owner[keep]
    return counts


def count_pretokens(pretokens: list[str], merges: Merges) -> np.ndarray:
    """Symbols that each pre-token keeps after all merges."""
    raw = [p.encode("utf-8", "surrogatepass") for p in pretokens]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8)
    symbols = merges.plain[data].astype(np.int64)
    ends = np.cumsum(lengths)[lengths > 0] - 1
    symbols[ends] = merges.ending[data[ends]]
    owner = np.repeat(np.arange(len(raw)), lengths)
    held = symbols != UNKNOWN  # bytes without a symbol are left out
    return merge_all(symbols[held], owner[held], len(raw), merges)


class Counter:
    """Counts the tokens of texts. Pieces between ASCII white space are cut and merged once per batch."""

    def __init__(self, merges: Merges):
        import regex

        self.merges = merges
        self.words = regex.compile(merges.pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{UNICODE_SPACE}\p{{L}}\p{{N}}]"))
        self.special = regex.compile("|".join(regex.escape(s) for s in merges.special)) if merges.special else None

    def _pretokens(self, piece: str) -> tuple[list[str], int]:
        """Pre-tokens of a piece, and how many special strings it holds."""
        parts, specials = [piece], 0
        if self.special and "<" in piece:
            parts = self.special.split(piece)
            specials = len(parts) - 1
        found = []
        for part in parts:
            part = unicodedata.normalize("NFC", part)
            # one character at a time, so that a final sigma is lowered like any other
            part = "".join(c.lower() for c in part) if "Σ" in part else part.lower()
            found += self.words.findall(part)
        return found, specials

    def of_pieces(self, pieces: list[str]) -> np.ndarray:
        tokens, owner, total = [], [], np.zeros(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            if piece.isascii() and piece.isalpha():
                found, specials = [piece.lower()], 0
            else:
                found, specials = self._pretokens(piece)
            total[i] = specials
            tokens += found
            owner += [i] * len(found)
        if not tokens:
            return total
        index: dict[str, int] = {}
        of = np.fromiter((index.setdefault(t, len(index)) for t in tokens), np.int64, len(tokens))
        counts = count_pretokens(list(index), self.merges)
        return total + np.bincount(np.array(owner), counts[of], minlength=len(pieces)).astype(np.int64)

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        words, starts = split_words(texts)
        if not len(words):
            return np.zeros(len(texts), np.int64)
        coded = words.dictionary_encode()
        each = self.of_pieces(coded.dictionary.to_pylist())
        return sums_between(each[coded.indices.to_numpy()], starts)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """One row per document: ``(doc_id, n_bytes, n_tokens, over_limit)``.

    ``path`` names a vocabulary file that every machine has. Counts are those of the tokenizers library without begin,
    end or added tokens; special strings inside a text count as one token each. Null texts are empty; empty ones have no
    tokens; null ids and repeated rows are kept as they are, other columns are ignored. A text is
    held whole in one task, and a batch is cut to about ``SLAB_BYTES`` or one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load_merges(path))
        for batch in slabs(batches, limit=SLAB_BYTES):
            texts = texts_of(batch)
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(counter.of_texts(texts))], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
