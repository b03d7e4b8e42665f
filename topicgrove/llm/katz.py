"""Katz backoff language models over words, kept as tables: fitted on documents, evaluated order by order on these or others.

The estimate of each order is Good-Turing discounted; what the discounts of a context free goes to its unseen successors in
proportion to the next lower order, with a weight for each context that makes its distribution sum to one exactly.
Unigrams are discounted alike, and their free mass is the probability of one class of unknown words. Counts above ``CUTOFF``
lose ``TAIL``, so that every context keeps some mass for the unseen.

A model is a table of words (number, count) and, for each order from 2, a table of counts by context and one of backoff
weights by context, dealt into buckets by a hash of the context. Documents are cut into slabs of bounded size; a slab
asks each bucket once, with its different contexts there and the words that follow them. So a row has at least one context,
and rows never outgrow the different contexts of the slabs, however many buckets a large corpus asks for. Scoring goes
upwards: with the order k - 1 probability of each token known, the table of order k either holds the token's n-gram or gives the weight
that the lower probability is multiplied with. Contexts with many successors are cut into slices by a hash of the successor.

Documents are numbered by slab and place, not by id: repeated or null ids and equal texts are rows like others.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicgrove.llm.common import delete_written, hash_strings, mixed, setting, shuffle_partitions, shuffles_dropped, slabs, split_words, texts_of
from topicgrove.session import written, written_and_measured
from topicgrove.sources.posts import with_seq

CUTOFF, TAIL = 5, 0.1
#: Fixed hash of the end token.
END = np.uint64(0x0E4D0E4D0E4D0E4D)
#: Numbers of the class of unknown words and of the place before the first token; words follow.
UNKNOWN, BEGIN, FIRST = 0, 1, 2
SLAB_BYTES = 3 << 20
#: Bytes of an Arrow batch of rows that a map takes: an executor holds it several times, in Spark and in Python.
BATCH_BYTES = 8 << 20
#: Training tokens for each part of a table; a context with a quarter of them is cut into slices.
PART_TOKENS = 1_000_000
HOT_SHARE = 4
#: Buckets of a table, at least; a part has at least as many as the second.
BUCKETS, PART_BUCKETS = 512, 4
_SALT = np.uint64(0x2545F4914F6CDD1D)


class Discounts(NamedTuple):
    """``kept[r]``: what is left of a count r up to CUTOFF."""

    kept: np.ndarray

    def of(self, counts: np.ndarray) -> np.ndarray:
        small = self.kept[np.minimum(counts, CUTOFF).astype(np.int64)]
        return np.where(counts > CUTOFF, counts - TAIL, small)


def good_turing(histogram: np.ndarray) -> Discounts:
    """From how many types were seen 1, 2, ... CUTOFF + 1 times. Where these give no discount between 0 and 1, half a count is taken."""
    n = np.concatenate([[0.0], histogram.astype(float)])
    kept = np.zeros(CUTOFF + 1)
    common = (CUTOFF + 1) * n[CUTOFF + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUTOFF + 1):
        ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        d = (ratio - common) / (1 - common) if common < 1 else 0.0
        kept[r] = r * d if 0 < d < 1 else r - 0.5
    return Discounts(kept)


@dataclass(frozen=True)
class Unigrams:
    """Totals of the training words: small values that every task gets."""

    tokens: int
    types: int
    documents: int
    discounts: Discounts
    unknown: float
    parts: int

    def log_probability(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(np.where(counts > 0, self.discounts.of(counts) / max(self.tokens, 1), self.unknown))

    @property
    def id_type(self) -> str:
        return "int" if self.types < 2**31 - FIRST else "long"

    @property
    def count_type(self) -> str:
        return "int" if self.tokens < 2**31 else "long"

    def counts(self, values: np.ndarray) -> pa.Array:
        return pa.array(values, pa.int32() if self.count_type == "int" else pa.int64())

    @property
    def bits(self) -> int:
        """How many bits of a hash tell the bucket."""
        return (max(BUCKETS, PART_BUCKETS * self.parts) - 1).bit_length()

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def part(self, bucket):
        """The part that a bucket (number or Column) belongs to."""
        whole = bucket * self.parts
        return F.shiftright(whole, self.bits).cast("int") if isinstance(bucket, Column) else (whole >> self.bits).astype(np.int32)

    def bucket_of(self, context: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return self.bucket(mixed(context.astype(np.int64).view(np.uint64) + (piece.astype(np.uint64) + np.uint64(1)) * _SALT))


#: Lists of a table of counts, an entry for each context and slice: how many successors were seen 1, 2, ... times.
SEEN = [f"seen{r}" for r in range(1, CUTOFF + 2)]


@dataclass(frozen=True)
class Order:
    """Tables of one order, a row for each bucket, with lists.

    ``counts``: contexts, slices, sizes (how many words), words, counts, and what the weights are made of. ``backoff``: contexts, slices,
    mass (training count) and log_weight.
    """

    counts: DataFrame
    backoff: DataFrame
    discounts: Discounts


@dataclass(frozen=True)
class Model:
    """``words``: word (hash), id, n, part. ``orders``: tables from order 2 upwards."""

    words: DataFrame
    unigrams: Unigrams
    orders: list[Order] = field(default_factory=list)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different tokens, the place among them of every token (words, and one end a text), and where texts start."""
    words, starts = split_words(pc.ascii_lower(texts))
    coded = words.dictionary_encode()
    names = np.concatenate([[END], hash_strings(coded.dictionary)]) if len(words) else np.array([END])
    n = len(starts) - 1
    codes = np.zeros(len(words) + n, np.int32)
    if len(words):
        codes[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(starts))] = coded.indices.to_numpy() + 1
    return names, codes, starts + np.arange(n + 1)


def _one(values) -> pa.ListArray:
    """All values as the list of a single row."""
    return _lists(values, np.array([0, len(values)]))


def _lists(values, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


@contextlib.contextmanager
def _lean(spark: SparkSession) -> Iterator[None]:
    """Inside, jobs drop their shuffle files when they end, and maps take small batches: memory outside the heap goes by the largest one."""
    with shuffles_dropped(spark), setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        yield


def _pair(run):
    """``run`` of a pair of groups, with Arrow's free buffers given back after it: workers that wait keep nothing."""

    def tidied(left: pa.Table, right: pa.Table) -> pa.Table:
        found = run(left, right)
        pa.default_memory_pool().release_unused()
        return found

    return tidied


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all slices ``starts[i] : starts[i] + lengths[i]``, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _flat(table: pa.Table, column: str) -> np.ndarray:
    lists = table.column(column).combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    return lists.flatten().to_numpy(zero_copy_only=False)


def _lengths(table: pa.Table, column: str) -> np.ndarray:
    return pc.list_value_length(table.column(column)).to_numpy().astype(np.int64)


def _packed(codes: np.ndarray, n: int) -> pa.Array:
    """Codes below ``n`` as the bytes of a single row, which Spark copies whole: 16 bits each, then a row of bits for each higher one that ``n`` asks for."""
    higher = [np.packbits(codes >> bit & 1).tobytes() for bit in range(16, (n - 1).bit_length())]
    return pa.array([b"".join([codes.astype(np.uint16).tobytes(), *higher])], pa.binary())


def _codes(packed: pa.Scalar, tokens: int) -> np.ndarray:
    raw, low = packed.as_buffer(), 2 * int(tokens)
    codes = np.frombuffer(raw, np.uint16, tokens).astype(np.int32)
    for k, bits in enumerate(np.frombuffer(raw, np.uint8, offset=low).reshape(-1, (tokens + 7) // 8)):
        codes |= np.unpackbits(bits, count=tokens).astype(np.int32) << 16 + k
    return codes


def _cut(docs: DataFrame, held_out: Column) -> DataFrame:
    """Slabs of documents: ``slab, words, trained, codes, starts, ids, held``; ``words`` rise as unsigned hashes, ``trained`` counts each in training documents."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in slabs(batches, limit=SLAB_BYTES):
            names, codes, starts = tokens_of(texts_of(batch))
            by = np.argsort(names)
            place = np.empty(len(by), np.int32)
            place[by] = np.arange(len(by), dtype=np.int32)
            names, codes = names[by], place[codes]
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            trains = np.repeat(~held, np.diff(starts))
            yield pa.RecordBatch.from_pydict({
                "slab": pa.array([at]), "words": _one(names.view(np.int64)), "trained": _one(np.bincount(codes[trains], minlength=len(names)).astype(np.int32)),
                "codes": _packed(codes, len(names)), "starts": _one(starts.astype(np.int32)), "ids": _one(batch.column("doc_id")), "held": _one(held),
            })
            at += 1

    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    schema = f"slab long, words array<long>, trained array<int>, codes binary, starts array<int>, ids array<{id_type}>, held array<boolean>"
    with _lean(docs.sparkSession):
        return written(rows.mapInArrow(run, schema), "slabs")


def _words(cut: DataFrame) -> Model:
    """Count the training words and number them, frequent ones first."""
    spark = cut.sparkSession
    measures = {f"n{r}": F.count_if(F.col("n") == r) for r in range(1, CUTOFF + 2)}
    end = F.sum(F.when(F.col("word") == int(END.view(np.int64)), F.col("n")))
    each = cut.select(F.inline(F.arrays_zip("words", "trained"))).where("trained > 0")
    counted = each.groupBy(F.col("words").alias("word")).agg(F.sum("trained").alias("n"))
    with _lean(spark):
        counts, seen = written_and_measured(counted, "words", tokens=F.sum("n"), types=F.count("*"), documents=end, **measures)
        numbered = with_seq(counts.withColumn("less", -F.col("n")), "less", "word")
        words = written(numbered.select("word", (F.col("seq") + FIRST).alias("id"), "n"), "numbered_words")
        delete_written(numbered)
    delete_written(counts)
    tokens, types, documents = (int(seen[k] or 0) for k in ("tokens", "types", "documents"))
    n = np.array([seen[f"n{r}"] or 0 for r in range(1, CUTOFF + 2)])
    discounts = good_turing(n)
    small = sum(n[r - 1] * (r - discounts.kept[r]) for r in range(1, CUTOFF + 1))
    unknown = (small + TAIL * (types - n[:CUTOFF].sum())) / tokens if tokens else 1.0
    parts = max(1, -(-tokens // PART_TOKENS), min(shuffle_partitions(spark), 16))
    return Model(words, Unigrams(tokens, types, documents, discounts, float(unknown), parts))


def _bucketed(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by bucket, the buckets that occur, and where each starts in that order."""
    by = np.argsort(bucket.astype(np.uint32), kind="stable")
    some, first = np.unique(bucket[by], return_index=True)
    return by, some, np.append(first, len(bucket))


def _numbered(cut: DataFrame, model: Model) -> DataFrame:
    """The slabs with words by number and count: ``slab, words, counts, codes, starts, ids, held``; ``words`` rises from 0 (unknown) and 1 (begin)."""
    known = model.unigrams
    fields = {f.name: f.dataType.simpleString() for f in cut.schema}
    numbers = pa.int32() if known.id_type == "int" else pa.int64()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column("words")[i].values.to_numpy()
                _, buckets, starts = _bucketed(known.bucket(words))  # the words are in this order
                yield pa.RecordBatch.from_pydict({
                    "slab": pa.array(np.full(len(buckets), batch.column("slab")[i].as_py())), "part": pa.array(known.part(buckets)),
                    "bucket": pa.array(buckets), "words": _lists(words, starts),
                })

    def answer(asked: pa.Table, table: pa.Table) -> pa.Table:
        wanted = _flat(asked, "words")
        ids, counts = np.full(len(wanted), UNKNOWN, np.int64), np.zeros(len(wanted), np.int64)
        if table.num_rows and len(wanted):
            own = table.column("word").to_numpy()
            by = np.argsort(own)
            at = by[np.minimum(np.searchsorted(own, wanted, sorter=by), len(by) - 1)]
            hit = own[at] == wanted
            ids[hit], counts[hit] = table.column("id").to_numpy()[at[hit]], table.column("n").to_numpy()[at[hit]]
        starts = np.concatenate([[0], np.cumsum(_lengths(asked, "words"))])
        return pa.table({"slab": asked.column("slab"), "bucket": asked.column("bucket"), "ids": _lists(pa.array(ids, numbers), starts), "counts": _lists(known.counts(counts), starts)})

    def put(slab: pa.Table, found: pa.Table) -> pa.Table:
        found = found.take(pa.array(np.argsort(found.column("bucket").to_numpy())))
        ids, counts = _flat(found, "ids").astype(np.int64), _flat(found, "counts")
        words, place = np.unique(np.concatenate([[UNKNOWN, BEGIN], ids]), return_inverse=True)
        n = np.zeros(len(words), np.int64)
        n[place[2:]], n[UNKNOWN], n[BEGIN] = counts, 0, known.documents
        codes = place[2:][_codes(slab.column("codes")[0], _flat(slab, "starts")[-1])]
        return pa.table({
            "slab": slab.column("slab"), "words": _one(pa.array(words, numbers)), "counts": _one(known.counts(n)), "codes": _packed(codes, len(words)),
            "starts": slab.column("starts"), "ids": slab.column("ids"), "held": slab.column("held"),
        })

    asked = cut.select("slab", "words").mapInArrow(ask, "slab long, part int, bucket long, words array<long>")
    table = model.words.withColumn("part", known.part(F.shiftrightunsigned("word", 64 - known.bits)))
    answers = f"slab long, bucket long, ids array<{known.id_type}>, counts array<{known.count_type}>"
    schema = f"slab long, words array<{known.id_type}>, counts array<{known.count_type}>, " + ", ".join(f"{c} {fields[c]}" for c in ("codes", "starts", "ids", "held"))
    with _lean(cut.sparkSession):
        found = written(asked.groupBy("part").cogroup(table.groupBy("part")).applyInArrow(_pair(answer), answers), "numbers")
        numbered = written(cut.drop("trained", "words").groupBy("slab").cogroup(found.groupBy("slab")).applyInArrow(_pair(put), schema), "numbered_slabs")
    delete_written(found)
    delete_written(cut)
    return numbered


class Grams(NamedTuple):
    """The different n-grams of a slab, by context, slice and word; rows are the runs of equal context and slice."""

    tokens: np.ndarray  # places of the tokens whose context holds no unknown word
    entry: np.ndarray  # the n-gram of each of them
    times: np.ndarray
    word: np.ndarray  # the code of each n-gram's last word
    first: np.ndarray  # a token of each n-gram
    heads: np.ndarray  # where rows start
    context: np.ndarray
    slice: np.ndarray
    slices: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.heads, len(self.word)))

    def entries(self, rows: np.ndarray) -> np.ndarray:
        """The n-grams of these rows, one row after the other."""
        return _ragged(self.heads[rows], self.sizes()[rows])


def grams(words: np.ndarray, counts: np.ndarray, codes: np.ndarray, starts: np.ndarray, order: int, usable: np.ndarray | None = None) -> Grams:
    """A context of one word is its number, a longer one a 64-bit hash of its numbers."""
    known = np.ones(len(codes), bool) if usable is None else usable.copy()
    bound = key = None
    into = np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))
    for back in range(1, order):
        before = np.full(len(codes), BEGIN, np.int32)
        before[back:][into[back:] >= back] = codes[:-back][into[back:] >= back]
        known &= before != UNKNOWN
        if order > 2:
            named = words[before].astype(np.uint64)
            key = named if key is None else mixed(key * np.uint64(0x9E3779B97F4A7C15) + named + np.uint64(back))
            bound = counts[before] if bound is None else np.minimum(bound, counts[before])
    tokens = np.flatnonzero(known)
    if order == 2:
        contexts, code, bound = words.astype(np.int64), before[tokens].astype(np.int64), counts
    else:
        contexts, at, code = np.unique(key[tokens].view(np.int64), return_index=True, return_inverse=True)
        bound = bound[tokens][at]
    # no context is followed by more tokens than its rarest word counts
    slices = np.maximum(bound * HOT_SHARE // PART_TOKENS, 1)
    most, n = int(slices.max(initial=1)), len(words)
    last = codes[tokens].astype(np.int64)
    piece = (mixed(words[last].astype(np.uint64)) % slices[code].astype(np.uint64)).astype(np.int64) if most > 1 else 0
    different, first, entry, times = np.unique((code * most + piece) * n + last, return_index=True, return_inverse=True, return_counts=True)
    row = different // n
    heads = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    of = row[heads] // most
    return Grams(tokens, entry, times, different % n, tokens[first], heads, contexts[of], row[heads] % most, slices[of])


def _slab(row: pa.RecordBatch | pa.Table, i: int = 0) -> dict[str, np.ndarray]:
    """The arrays of one slab; ``lower`` has log10 of each token's probability by the order reached so far."""
    names = [c for c in row.schema.names if c not in ("slab", "ids", "codes")]
    value = lambda c: row.column(c)[i].values.to_numpy(zero_copy_only=False)
    found = {c: value(c).astype(np.int64) if c == "counts" else value(c) for c in names}
    return found | {"codes": _codes(row.column("codes")[i], found["starts"][-1])}


def _lower(slab: dict[str, np.ndarray], known: Unigrams) -> np.ndarray:
    return slab["lower"] if "lower" in slab else known.log_probability(slab["counts"])[slab["codes"]]


def _requests(state: DataFrame, known: Unigrams, order: int, training: bool) -> DataFrame:
    """A row for each slab and bucket: contexts, slices, sizes, words; for training also times and lower of the words, and how many slices a context has.

    Contexts with an unknown word ask nothing: they were never seen.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                slab = _slab(batch, i)
                usable = np.repeat(~slab["held"].astype(bool), np.diff(slab["starts"])) if training else None
                g = grams(slab["words"], slab["counts"], slab["codes"], slab["starts"], order, usable)
                sizes = g.sizes()
                by, buckets, starts = _bucketed(known.bucket_of(g.context, g.slice))
                entries = g.entries(by)
                bounds = np.concatenate([[0], np.cumsum(sizes[by])])[starts]
                rows = {
                    "slab": pa.array(np.full(len(buckets), batch.column("slab")[i].as_py())), "part": pa.array(known.part(buckets)), "bucket": pa.array(buckets),
                    "contexts": _lists(g.context[by], starts), "slices": _lists(g.slice[by].astype(np.int32), starts),
                    "sizes": _lists(sizes[by].astype(np.int32), starts), "words": _lists(slab["words"][g.word][entries], bounds),
                }
                if training:
                    lower = 10.0 ** _lower(slab, known)[g.first][entries]
                    rows |= {"times": _lists(g.times[entries].astype(np.int32), bounds), "lower": _lists(lower, bounds), "ways": _lists(g.slices[by].astype(np.int32), starts)}
                yield pa.RecordBatch.from_pydict(rows)

    schema = f"slab long, part int, bucket long, contexts array<long>, slices array<int>, sizes array<int>, words array<{known.id_type}>"
    return state.mapInArrow(run, schema + ", times array<int>, lower array<double>, ways array<int>" * training)


def _row_keys(context: np.ndarray, piece: np.ndarray, contexts: np.ndarray, most: int) -> np.ndarray:
    """A number for each (context, slice), in their order; -1 where ``contexts``, which are sorted, lack the context."""
    if not len(contexts):
        return np.full(len(context), -1, np.int64)
    at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
    return np.where((contexts[at] == context) & (piece < most), at * most + piece, -1)


def _merged(known: Unigrams):
    """Add up one part's n-grams over the slabs, with what each context and slice gives to the backoff weight."""

    def run(group: pa.Table) -> pa.Table:
        context, piece = _flat(group, "contexts"), _flat(group, "slices").astype(np.int64)
        contexts, at = np.unique(context, return_index=True)
        ways, most = _flat(group, "ways")[at], int(piece.max()) + 1
        row = np.repeat(_row_keys(context, piece, contexts, most), _flat(group, "sizes"))
        word, times, lower = _flat(group, "words").astype(np.int64), _flat(group, "times"), _flat(group, "lower")
        width = int(word.max()) + 1
        key = row * width + word
        by = np.argsort(key, kind="stable")
        key = key[by]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.add.reduceat(times[by].astype(np.int64), heads)
        lower, row, word = lower[by][heads], key[heads] // width, key[heads] % width
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        total = lambda values: np.add.reduceat(values, starts)
        name = row[starts]
        context, piece, sizes = contexts[name // most], name % most, np.diff(np.append(starts, len(word)))
        facts = {f"seen{r}": total((count == r).astype(np.int64)) for r in range(1, CUTOFF + 2)} | {"mass": total(count), "covered": total(lower)}
        order, buckets, bounds = _bucketed(known.bucket_of(context, piece))
        entries = _ragged(starts[order], sizes[order])
        inner = np.concatenate([[0], np.cumsum(sizes[order])])[bounds]
        pa.default_memory_pool().release_unused()
        return pa.table({
            "part": pa.array(known.part(buckets)), "bucket": buckets, "contexts": _lists(context[order], bounds), "slices": _lists(piece[order].astype(np.int32), bounds),
            "ways": _lists(ways[name // most][order], bounds), "sizes": _lists(sizes[order].astype(np.int32), bounds),
            "words": _lists(pa.array(word[entries], group.schema.field("words").type.value_type), inner), "counts": _lists(known.counts(count[entries]), inner),
        } | {k: _lists(v[order], bounds) for k, v in facts.items()})

    return run


def _log_weight(discounts: Discounts, floor: float, seen: list, types, mass, covered):
    """What a context keeps for the unseen, over what the lower order gives them (arrays)."""
    kept = discounts.kept
    free = TAIL * (types - sum(seen[:CUTOFF])) + sum(n * (r - kept[r]) for r, n in enumerate(seen[:CUTOFF], 1))
    return np.log10(free / mass / np.maximum(1 - covered, floor))


def _fit_order(state: DataFrame, known: Unigrams, order: int) -> Order:
    """Both tables of one order. Contexts in one slice have their weight from their bucket; those in several add up their slices first."""
    spark, rows = state.sparkSession, _requests(state, known, order, training=True).drop("slab", "bucket")
    facts = ", ".join(f"{c} array<long>" for c in [*SEEN, "mass"])
    schema = f"part int, bucket long, contexts array<long>, slices array<int>, ways array<int>, sizes array<int>, words array<{known.id_type}>, counts array<{known.count_type}>, {facts}, covered array<double>"
    total = lambda c: F.sum(F.aggregate(c, F.lit(0).cast("long"), lambda a, b: a + b))
    with _lean(spark):
        counts, seen = written_and_measured(rows.groupBy("part").applyInArrow(_merged(known), schema), f"counts_{order}", **{c: total(c) for c in SEEN})
    discounts = good_turing(np.array([seen[c] or 0 for c in SEEN]))
    # what is left to a bigram's unseen words holds at least the unknown ones
    floor = known.unknown if order == 2 else 1e-12

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            one = _flat(table, "ways") == 1
            value = {c: _flat(table, c)[one] for c in ["contexts", "sizes", *SEEN, "mass", "covered"]}
            starts = np.concatenate([[0], np.cumsum(one)])[np.concatenate([[0], np.cumsum(_lengths(table, "ways"))])]
            weight = _log_weight(discounts, floor, [value[c] for c in SEEN], value["sizes"], value["mass"], value["covered"])
            yield pa.RecordBatch.from_pydict({
                "part": batch.column("part"), "bucket": batch.column("bucket"), "contexts": _lists(value["contexts"], starts),
                "slices": _lists(np.zeros(len(weight), np.int32), starts), "mass": _lists(value["mass"], starts), "log_weight": _lists(weight, starts),
            })

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            weight = _log_weight(discounts, floor, [value[c] for c in SEEN], value["sizes"], value["mass"], value["covered"])
            ways = value["ways"].astype(np.int64)
            of = np.repeat(np.arange(len(ways)), ways)
            piece, each = _ragged(np.zeros(len(ways), np.int64), ways), np.arange(len(of) + 1)
            bucket = known.bucket_of(value["contexts"][of], piece)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(known.part(bucket)), "bucket": pa.array(bucket), "contexts": _lists(value["contexts"][of], each),
                "slices": _lists(piece.astype(np.int32), each), "mass": _lists(value["mass"][of], each), "log_weight": _lists(weight[of], each),
            })

    weights = "part int, bucket long, contexts array<long>, slices array<int>, mass array<long>, log_weight array<double>"
    parts = ["sizes", *SEEN, "mass", "covered"]
    inside = counts.select("part", "bucket", "contexts", "ways", *parts).mapInArrow(whole, weights)
    several = counts.select(F.inline(F.arrays_zip("contexts", "ways", *parts))).where("ways > 1")
    added = several.groupBy("contexts").agg(F.first("ways").alias("ways"), *[F.sum(c).alias(c) for c in parts])
    with _lean(spark):
        return Order(counts, written(inside.unionByName(added.mapInArrow(sliced, weights)), f"backoff_{order}"), discounts)


def _look_up(asked: pa.Table, table: pa.Table, known: Unigrams) -> pa.Table:
    """Answer one part's requests: the training count of each n-gram, and mass and weight of its context (0 where it was never seen)."""
    is_weight = table.column("log_weight").is_valid().to_numpy()
    weights, stored = table.filter(pa.array(is_weight)), table.filter(pa.array(~is_weight))
    context, piece = _flat(asked, "contexts"), _flat(asked, "slices").astype(np.int64)
    own_context, own_piece = _flat(weights, "contexts"), _flat(weights, "slices").astype(np.int64)
    contexts, most = np.unique(own_context), int(max(own_piece.max(initial=0), piece.max(initial=0))) + 1
    row = _row_keys(context, piece, contexts, most)
    mass, weight = np.zeros(len(row), np.int64), np.zeros(len(row))
    if len(own_context) and len(row):
        of = _row_keys(own_context, own_piece, contexts, most)
        by = np.argsort(of)
        at = by[np.minimum(np.searchsorted(of, row, sorter=by), len(by) - 1)]
        hit = (of[at] == row) & (row >= 0)
        mass[hit], weight[hit] = _flat(weights, "mass")[at[hit]], _flat(weights, "log_weight")[at[hit]]
    word = _flat(asked, "words").astype(np.int64)
    counts = np.zeros(len(word), np.int64)
    if stored.num_rows and len(word):
        own = _flat(stored, "words").astype(np.int64)
        width = int(max(own.max(), word.max())) + 1
        rows = _row_keys(_flat(stored, "contexts"), _flat(stored, "slices").astype(np.int64), contexts, most)
        own = np.repeat(rows, _flat(stored, "sizes")) * width + own
        by = np.argsort(own, kind="stable")
        own = own[by]
        row = np.repeat(row, _flat(asked, "sizes"))
        want = row * width + word
        at = np.minimum(np.searchsorted(own, want), len(own) - 1)
        hit = (own[at] == want) & (row >= 0)
        counts[hit] = _flat(stored, "counts")[by[at[hit]]]
    starts = lambda c: np.concatenate([[0], np.cumsum(_lengths(asked, c))])
    return pa.table({
        "slab": asked.column("slab"), "bucket": asked.column("bucket"), "counts": _lists(known.counts(counts), starts("words")),
        "mass": _lists(known.counts(mass), starts("contexts")), "log_weight": _lists(weight, starts("contexts")),
    })


def _answers(state: DataFrame, model: Model, order: int) -> DataFrame:
    known, tables = model.unigrams, model.orders[order - 2]
    stored = tables.counts.select("part", "contexts", "slices", "sizes", "words", "counts").unionByName(
        tables.backoff.select("part", "contexts", "slices", "mass", "log_weight"), allowMissingColumns=True
    )
    asked = _requests(state, known, order, training=False)
    schema = f"slab long, bucket long, counts array<{known.count_type}>, mass array<{known.count_type}>, log_weight array<double>"
    with _lean(state.sparkSession):
        return written(asked.groupBy("part").cogroup(stored.groupBy("part")).applyInArrow(_pair(lambda a, t: _look_up(a, t, known)), schema), f"answers_{order}")


def _raised(slab: dict[str, np.ndarray], found: pa.Table, order: int, known: Unigrams, discounts: Discounts) -> np.ndarray:
    """log10 of each token's probability by this order."""
    value = _lower(slab, known).copy()
    g = grams(slab["words"], slab["counts"], slab["codes"], slab["starts"], order)
    if len(g.tokens):
        rows = found.take(pa.array(np.argsort(found.column("bucket").to_numpy())))
        by = _bucketed(known.bucket_of(g.context, g.slice))[0]
        r = np.empty(len(g.word), np.int64)
        r[g.entries(by)] = _flat(rows, "counts")
        mass, weight = np.empty(len(by), np.int64), np.empty(len(by))
        mass[by], weight[by] = _flat(rows, "mass"), _flat(rows, "log_weight")
        sizes = g.sizes()
        seen = np.log10(np.maximum(discounts.of(r), 1e-9)) - np.repeat(np.log10(np.maximum(mass, 1)), sizes)
        r, seen, weight = r[g.entry], seen[g.entry], np.repeat(weight, sizes)[g.entry]
        value[g.tokens] = np.where(r > 0, seen, weight + value[g.tokens])
    return value


def _documents(slab: dict[str, np.ndarray], ids: pa.Array, value: np.ndarray, known: Unigrams) -> dict:
    """Sums per document of a slab."""
    starts, count = slab["starts"][:-1], slab["counts"][slab["codes"]]
    base = np.log10((slab["counts"] + 1) / (known.tokens + known.types + 1))[slab["codes"]]
    n = len(starts)
    return {
        "doc_id": ids, "held_out": pa.array(slab["held"].astype(bool)), "n_tokens": np.diff(slab["starts"]).astype(np.int64),
        "n_known": np.add.reduceat((count > 0).astype(np.int64), starts), "train_tokens": np.full(n, known.tokens),
        "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(value, starts),
    }


def _result_schema(state: DataFrame) -> str:
    id_type = state.schema["ids"].dataType.elementType.simpleString()
    return f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _advance(state: DataFrame, model: Model, order: int, last: bool, keep: bool = True) -> DataFrame:
    """The slabs with each token's probability by this order, or, after the last one, the rows of the documents; without ``keep`` the order's tables are deleted."""
    known, discounts = model.unigrams, model.orders[order - 2].discounts
    answers = _answers(state, model, order)
    if not keep:
        delete_written(model.orders[order - 2].counts)
        delete_written(model.orders[order - 2].backoff)

    def run(row: pa.Table, found: pa.Table) -> pa.Table:
        slab = _slab(row)
        value = _raised(slab, found, order, known, discounts)
        if last:
            return pa.table(_documents(slab, row.column("ids").chunk(0).flatten(), value, known))
        kept = {c: row.column(c) for c in row.schema.names if c != "lower"}
        return pa.table(kept | {"lower": _one(value)})

    fields = {f.name: f.dataType.simpleString() for f in state.schema} | {"lower": "array<double>"}
    schema = _result_schema(state) if last else ", ".join(f"{k} {v}" for k, v in fields.items())
    joined = state.groupBy("slab").cogroup(answers.groupBy("slab")).applyInArrow(_pair(run), schema)
    if last:
        return joined
    with _lean(state.sparkSession):
        return written(joined, f"probabilities_{order}")


def _unigram_rows(state: DataFrame, known: Unigrams) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                slab = _slab(batch, i)
                rows = _documents(slab, batch.column("ids")[i].values, _lower(slab, known), known)
                yield pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in rows.items()})

    return state.mapInArrow(run, _result_schema(state))


def _fitted(cut: DataFrame, order: int) -> tuple[Model, DataFrame]:
    if order < 1:
        raise ValueError("The order must be 1 or more.")
    words = _words(cut)
    numbered = state = _numbered(cut, words)
    orders: list[Order] = []
    for k in range(2, order + 1):
        orders.append(_fit_order(state, words.unigrams, k))
        if k < order:
            state = _advance(state, Model(words.words, words.unigrams, orders), k, last=False)
    return Model(words.words, words.unigrams, orders), numbered


def _scored(state: DataFrame, model: Model, keep: bool = True) -> DataFrame:
    if not model.orders:
        return _unigram_rows(state, model.unigrams)
    for k in range(2, len(model.orders) + 2):
        state = _advance(state, model, k, last=k == len(model.orders) + 1, keep=keep)
    return state


def fit(docs: DataFrame, order: int = 3) -> Model:
    """The model of all rows of ``docs`` (``doc_id, text``), as written tables."""
    return _fitted(_cut(docs, F.lit(False)), order)[0]


def score(docs: DataFrame, model: Model, held_out: Column | None = None) -> DataFrame:
    """Rows of ``docs`` scored by a fitted model, as ``fit_and_score`` gives them; ``held_out`` is only passed on (true where not given)."""
    return _scored(_numbered(_cut(docs, F.lit(True) if held_out is None else held_out), model), model)


def fit_and_score(docs: DataFrame, held_out: Column, order: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``.

    Rows where ``held_out`` is true do not train (null counts as false). Tokens are lower-cased (A-Z) runs of other than ASCII
    white space and one end per document; null and empty texts are an end alone. ``base_score`` is the add-one unigram
    score, ``score`` the model's of the given order, both sums of log10. Repeated rows train each, and score alike; null ids are
    scored like others. No rows give no rows; without a training row every token is of the unknown class, of probability one.
    Extra columns are ignored. Texts are cut into words once for both.
    """
    model, numbered = _fitted(_cut(docs, held_out), order)
    delete_written(model.words)
    return _scored(numbered, model, keep=False)  # nobody else has this model
