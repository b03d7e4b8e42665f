import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from topicgrove.llm import phrases
from topicgrove.llm.phrases import BidirectionalIndex, collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut"]


def brute(rows, depth=3, least=10, top=2000, percent=50):
    found, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, depth + 1):
                for i in range(len(words) - size + 1):
                    found.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, f in found.items():
        kept = []
        for gram, a in f.items():
            if len(gram) < 2 or a < least:
                continue
            longer = [c for g, c in f.items() if c >= least and len(g) > len(gram) and any(g[i : i + len(gram)] == gram for i in range(len(g) - len(gram) + 1))]
            if any(100 * c >= percent * a for c in longer):
                continue
            cuts = [(1000000 * a * a // (f[gram[:k]] * f[gram[k:]]), k, f[gram[:k]], f[gram[k:]]) for k in range(1, len(gram))]
            score, k, left, right = min(cuts)
            kept.append((" ".join(gram), a, left, right, total[lang], score, k))
        kept.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(kept[:top])]
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r) for r in collocations(docs, **options).select(COLUMNS).collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60), st.integers(2, 4))
def test_index_counts_all_grams(text, depth):
    text = np.array([0, *text], np.int32)
    expected = Counter()
    for size in range(2, depth + 1):
        for i in range(len(text) - size + 1):
            if all(text[i : i + size]):
                expected[tuple(text[i : i + size].tolist())] += 1
    counted = {tuple(w): c for words, counts in BidirectionalIndex(text, 4, depth).grams() for w, c in zip(words.tolist(), counts.tolist())}
    assert counted == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40))
def test_both_directions_find_the_same_intervals(text):
    index = BidirectionalIndex(np.array([0, *text], np.int32), 3, 3)
    two_ways = [{tuple(w): (a, b, c) for w, a, b, c in zip(*(x.tolist() for x in index.extend(index.words(), left)))} for left in (True, False)]
    assert two_ways[0] == two_ways[1]


def make(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x", 2) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, f long, word string, shard long")


@pytest.mark.parametrize("shard, options", [(20, {}), (1 << 20, {"least": 3, "depth": 4, "top": 7, "percent": 80}), (20, {"least": 2, "depth": 2, "top": 3})])
def test_equals_brute_force(spark, monkeypatch, options, shard):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    rng = np.random.default_rng(5)
    words = ["The", "of", "new", "york", "a", "z\x01", "b\xa0c", "é", "ß", "long-word"] + [f"w{i}" for i in range(30)]
    weights = np.array([1 / (i + 1) for i in range(len(words))])
    rows = [(["en", "fr", None, "und", ""][i % 5], " ".join(rng.choice(words, 40, p=weights / weights.sum()))) for i in range(60)]
    rows += [("en", "New York city. new\tyork\ncity  new york, city new york city!" * 3), ("en", None), (None, ""), ("fr", " .,; "), ("en", "a a a a a a a a a a a a a a a a")]
    rows += [("en", "One More Time")] * 12 + [("de", "nur einmal hier")]
    names = {"least": "min_count", "depth": "max_words", "top": "top", "percent": "inside_percent"}
    assert found(make(spark, rows).repartition(3), **{names[k]: v for k, v in options.items()}) == brute(rows, **options)


def test_one_long_text_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WORDS", 50)
    rows = [("en", "alpha beta gamma " * 300 + ". " + "alpha beta " * 20), (None, "x")]
    assert found(make(spark, rows)) == brute(rows)
    assert found(make(spark, [])) == found(make(spark, [("en", None), (None, "a b c")])) == []


def test_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 7 * 10**12 + 3, 9 * 10**12 + 7, 8 * 10**12 + 1
    row = spark.range(1).select(*(F.lit(v).cast("decimal(15,0)").alias(k) for k, v in (("a", a), ("l", left), ("r", right))))
    score = row.selectExpr("(a * a * cast(1000000 as decimal(7,0))) div (l * r) AS score").first().score
    assert score == 1000000 * a * a // (left * right)
