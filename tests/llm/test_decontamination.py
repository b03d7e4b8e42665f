import re

import pytest

from topicgrove.llm import decontamination as D


def words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        for win in [b[i : i + 10] for i in range(max(1, len(b) - 9))] if b else []:
            for s in range(len(w) - len(win) + 1):
                if w[s : s + len(win)] == win:
                    hit.update(range(s, s + len(win)))
                    found |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(found)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog near the old River bank"), (2, "alpha beta"), (10, "alpha beta gamma"),
         (3, None), (4, " .. "), (5, "the the the the the the the the the the the the"), (6, "übergröße ÉTÉ x9"), (1, "alpha beta"), (None, "only here")]
TEXTS = [None, "", "Alpha, BETA! gamma", "the " * 40, "the quick brown fox jumps over the lazy dog near", "quick brown fox jumps over the lazy dog near the old x",
         "übergröße ÉTÉ x9 übergröße été x9", "alpha alpha beta beta", "nothing to see", "dog near the old river bank the quick brown", "only here",
         "pad " * 3000 + "fox jumps over the lazy dog near the old river bank alpha beta"]


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_equals_brute_force(spark, documents, monkeypatch, broadcast):
    monkeypatch.setattr(D, "BROADCAST_BYTES", broadcast)
    docs = documents([(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4]), (2, "alpha beta other"), (2, TEXTS[2])])
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, start int")
    found = D.contamination(docs, items).join(docs.selectExpr("xxhash64(text) text_hash", "text").distinct(), "text_hash").collect()
    assert len(found) == len(TEXTS) + 3
    for r in found:
        assert (r.n_words, r.n_hit, r.items) == brute(r.text, ITEMS), r.text
        assert r.contaminated == (r.n_hit > 0)
    clean = D.decontaminated(docs, items)
    assert sorted(r.text or "" for r in clean.collect()) == sorted(r.text or "" for r in found if not r.n_hit)
    assert clean.columns == docs.columns


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in D.contamination(documents([(1, "a b")]), none).collect()] == [False]
    assert D.contamination(documents([]), none).count() == 0
