import math
import random
import re
from collections import Counter, defaultdict
from itertools import accumulate
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from topicgrove.llm import katz as K
from topicgrove.session import written_dir


def tokens(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def discounts(counter):
    n = Counter(counter.values())
    kept, common = {}, 6 * n[6] / n[1] if n[1] else 1.0
    for r in range(1, 6):
        ratio = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        d = (ratio - common) / (1 - common) if common < 1 else 0.0
        kept[r] = r * d if 0 < d < 1 else r - 0.5
    return lambda r: kept[r] if r <= 5 else r - 0.1


class Model:
    """Katz by its definition, of any order."""

    def __init__(self, texts, order=2):
        self.order, self.uni, self.follow = order, Counter(), {k: defaultdict(Counter) for k in range(2, order + 1)}
        for t in texts:
            found = tokens(t)
            self.uni.update(found)
            for i, w in enumerate(found):
                for k in self.follow:
                    self.follow[k][self.context(found, i, k)][w] += 1
        self.total = sum(self.uni.values())
        self.d = {k: discounts({(v, w): n for v, c in f.items() for w, n in c.items()}) for k, f in self.follow.items()}
        self.d[1] = discounts(self.uni)
        self.unknown = 1 - sum(map(self.d[1], self.uni.values())) / self.total if self.total else 1.0
        self.weights = {}

    @staticmethod
    def context(found, i, k):
        return tuple(found[j] if j >= 0 else "<s>" for j in range(i - k + 1, i))

    def one(self, w):
        return self.d[1](self.uni[w]) / self.total if w in self.uni else self.unknown

    def p(self, context, w):
        k = len(context) + 1
        if k == 1:
            return self.one(w)
        seen = self.follow[k].get(context)
        if not seen:
            return self.p(context[1:], w)
        mass = sum(seen.values())
        if w in seen:
            return self.d[k](seen[w]) / mass
        if context not in self.weights:
            left = 1 - sum(map(self.d[k], seen.values())) / mass
            self.weights[context] = left / (1 - sum(self.p(context[1:], x) for x in seen))
        return self.weights[context] * self.p(context[1:], w)

    def score(self, found):
        return sum(math.log10(self.p(self.context(found, i, self.order), w)) for i, w in enumerate(found))


def corpus(n=150):
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7)) % 80}" for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, "the The THE é É"), (1003, "never seen anywhere"), (1004, "w1 " * 3000)]


def held(i):
    return i % 4 == 1 or i == 1003


def is_held():
    return (F.col("doc_id") % 4 == 1) | (F.col("doc_id") == 1003)


@pytest.mark.parametrize("order, part_tokens, slab", [(1, 2_000_000, 8 << 20), (2, 2_000_000, 8 << 20), (2, 300, 2000), (3, 2_000_000, 8 << 20), (3, 300, 2000), (4, 300, 700)])
def test_equals_the_definition(documents, monkeypatch, order, part_tokens, slab):
    monkeypatch.setattr(K, "PART_TOKENS", part_tokens)
    monkeypatch.setattr(K, "SLAB_BYTES", slab)
    rows = corpus()
    more = [(None, "w1 w2 w3 w1"), (2, "w1 w2"), (3, rows[3][1])]
    found = K.fit_and_score(documents(rows + more), is_held(), order).collect()
    assert len(found) == len(rows) + len(more)
    model = Model([t for i, t in rows if not held(i)] + [t for _, t in more], order)
    texts, checked = dict(rows), 0
    for r in found:
        if r.doc_id is None or r.doc_id == 2:
            continue
        t = tokens(texts[r.doc_id])
        value, base = model.score(t), sum(math.log10((model.uni[w] + 1) / (model.total + len(model.uni) + 1)) for w in t)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(t), model.total)
        assert r.n_known == sum(w in model.uni for w in t)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and abs(r.score - value) < 1e-6 * max(1, abs(value)), r
        checked += 1
    assert checked == len(rows)


def test_fitted_tables_score_other_documents(documents):
    rows = corpus(60)
    model = K.fit(documents([x for x in rows if not held(x[0])]))
    assert len(model.orders) == 2
    by_definition = Model([t for i, t in rows if not held(i)], 3)
    others = [(i, t) for i, t in rows if held(i)] + [(7, "w1 unheard w1 w2")]
    for r in K.score(documents(others), model).collect():
        value = by_definition.score(tokens(dict(others)[r.doc_id]))
        assert r.held_out and abs(r.score - value) < 1e-6 * max(1, abs(value))


@pytest.mark.parametrize("order", [2, 3])
def test_contexts_sum_to_one(documents, order):
    """The stored tables: for each context, what its seen words keep and its weight times the rest make one."""
    rows = corpus(80)
    model = K.fit(documents(rows), order)
    definition = Model([t for _, t in rows], order)
    top = model.orders[-1]
    kept, mass = Counter(), {}
    for r in top.counts.collect():
        ends = list(accumulate(r["sizes"]))
        for c, start, end in zip(r["contexts"], [0, *ends], ends):
            kept[c] += float(top.discounts.of(K.np.array(r["counts"][start:end])).sum())
    for r in top.backoff.collect():
        mass |= dict(zip(r["contexts"], r["mass"]))
    assert set(mass) == set(kept) and len(mass) == len(definition.follow[order])
    assert all(0 < kept[c] < mass[c] for c in mass)
    for context in [*list(definition.follow[order])[:30], ("unseen",) * (order - 1)]:
        assert abs(sum(definition.p(context, w) for w in [*definition.uni, "some unknown word"]) - 1) < 1e-9


def test_no_training_and_no_rows(documents):
    for order in (1, 2, 3):
        rows = K.fit_and_score(documents([(1, "a b"), (2, None)]), F.lit(True), order).collect()
        assert [(r.train_tokens, r.n_known, r.score) for r in rows] == [(0, 0, 0.0)] * 2
        assert K.fit_and_score(documents([]), F.lit(False), order).count() == 0


def test_slabs_stay_small(spark, documents, monkeypatch):
    """An executor holds a slab's row several times, so a code takes 2 bytes where it can, and maps take batches of bounded size."""
    monkeypatch.setattr(K, "SLAB_BYTES", 1 << 19)
    rows = [(i, " ".join(f"w{(i * 31 + j * j) % 997}" for j in range(2000))) for i in range(150)]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, inside = spark.conf.get(key), []
    kept = K.written
    monkeypatch.setattr(K, "written", lambda df, name: inside.append(int(spark.conf.get(key).rstrip("b"))) or kept(df, name))
    cut = K._cut(documents(rows), F.lit(False))
    numbered = K._numbered(cut, K._words(cut))
    for r in numbered.select(F.length("codes").alias("bytes"), F.element_at("starts", -1).alias("tokens")).collect():
        assert r.bytes == 2 * r.tokens
    assert inside and max(inside) <= 8 << 20 and spark.conf.get(key) == before


def test_codes_of_many_words_come_back():
    for n in (1, 1 << 16, (1 << 16) + 1, 1 << 18, 10**9):
        codes = K.np.array([0, n - 1, n // 2, n // 3] * 5 + [0], K.np.int32)
        packed = K._packed(codes, n)[0]
        assert K._codes(packed, 21).tolist() == codes.tolist()
        assert len(packed.as_py()) == 42 + 3 * max(0, (n - 1).bit_length() - 16)


def test_a_finished_model_leaves_no_tables(spark, documents):
    """Its words and counts are deleted as soon as no step reads them, but those of a model that the caller has stay."""
    files = lambda: {str(p) for name in ("counts_2", "backoff_2", "numbered_words") for p in Path(written_dir(spark).removeprefix("file:")).glob(f"*/{name}")}
    before = files()
    assert K.fit_and_score(documents(corpus(40)), is_held()).count() == 45
    assert files() == before
    model = K.fit(documents(corpus(40)), 2)
    assert K.score(documents(corpus(3)), model).count() == K.score(documents(corpus(3)), model).count() == 8
    assert len(files() - before) == 3
