import math
import random
from collections import Counter

import pytest

from topicgrove.operators.naming import search
from topicgrove.operators.naming.search import best_title_of_words, ranked_titles
from topicgrove.operators.similar import similar_classes, word_set_classes
from topicgrove.session import written


def _bm25(titles):
    """Scores by word and title, word by word from the definition."""
    texts = {t: t.lower().split() for t in titles if t and t.split()}
    usual = sum(map(len, texts.values())) / len(texts)
    holders = Counter(w for words in texts.values() for w in set(words))
    scores = {}
    for title, words in texts.items():
        for word, times in Counter(words).items():
            rarity = math.log(1 + (len(texts) - holders[word] + 0.5) / (holders[word] + 0.5))
            held_back = 1.2 * (0.25 + 0.75 * len(words) / usual)
            scores[word, title] = rarity * times * 2.2 / (times + held_back)
    return texts, scores


def _titles():
    dice = random.Random(4)
    words = ["of", "the", *"abcdefghijkl"]
    weights = [12, 9, *[3] * 4, *[1] * 8]
    return [" ".join(dice.choices(words, weights, k=dice.randint(1, 9))) for _ in range(150)]


def test_ranked_search_equals_the_definition(spark):
    titles = [*_titles(), None, "", " "]
    texts, scores = _bm25(titles)
    concepts = spark.createDataFrame([(t,) for t in [*titles, *titles[:20]]], "title string")
    dice = random.Random(5)
    asked = {i: dice.choices(["of", "the", "missing", *"abcdefghijkl"], k=dice.randint(1, 6)) for i in range(60)}
    rows = [(i, words) for i, words in asked.items()] + [(90, []), (91, None), (92, ["missing", None])]
    queries = spark.createDataFrame(rows, "query_id long, words array<string>")
    found = {r.query_id: r for r in best_title_of_words(queries, concepts).collect()}
    for i, words in asked.items():
        totals = {t: round(sum(scores.get((w, t), 0.0) for w in set(words)), 8) for t in texts}
        best = max(totals.values())
        if best == 0:
            assert i not in found
            continue
        assert abs(found[i].score - best) < 1e-7 and totals[found[i].title] == best
    assert not {90, 91, 92} & set(found)
    single = {r.word: r for r in ranked_titles(spark.createDataFrame([("of",), ("a",), ("a",), ("missing",), (None,)], "word string"), concepts).collect()}
    assert set(single) == {"of", "a"}
    for word, row in single.items():
        best = max(v for (w, _), v in scores.items() if w == word)
        ties = [t for t in texts if abs(scores.get((word, t), 0.0) - best) < 1e-9]
        assert row.title == min(ties, key=lambda t: (len(texts[t]), t))


def test_titles_that_cannot_win_are_not_looked_up(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(search, "written", lambda df, name: kept.setdefault(name, written(df, name)))
    titles = ["rare gold find"] + [f"gold item number {i} of a longer list" for i in range(60)] + [f"plain line {i}" for i in range(200)]
    concepts = spark.createDataFrame([(t,) for t in titles], "title string")
    queries = spark.createDataFrame([(1, ["gold", "rare", "find", "item"])], "query_id long, words array<string>")
    found = search.best_title_of_words(queries, concepts).collect()
    assert [(r.query_id, r.title) for r in found] == [(1, "rare gold find")]
    assert kept["candidates"].count() == 1


def test_ranked_search_of_an_empty_table(spark):
    concepts = spark.createDataFrame([], "title string")
    assert ranked_titles(spark.createDataFrame([("a",)], "word string"), concepts).count() == 0
    assert best_title_of_words(spark.createDataFrame([(1, ["a"])], "query_id long, words array<string>"), concepts).count() == 0


@pytest.mark.parametrize("percent", [20, 50, 80, 100])
def test_similar_classes_equal_all_pairs(spark, percent):
    dice = random.Random(percent)
    sets = [(i, i % 2, dice.choices(["of", "the", "of", *"abcdefghij"], k=dice.randint(0, 8))) for i in range(120)]
    extra = [(200, 0, None), (201, None, ["a"]), (202, 0, ["a", None, "a"])]
    classes = word_set_classes(spark.createDataFrame([*sets, *extra], "id long, side int, words array<string>"), "side")
    known = {}
    for i, side, words in [*sets, (202, 0, ["a"])]:
        if words:
            known.setdefault((side, frozenset(words)), []).append(i)
    assert {(r.side, frozenset(r.words)): (r.class_id, r.members) for r in classes.collect()} == {k: (min(v), len(v)) for k, v in known.items()}
    expected = set()
    for (side, a), i in known.items():
        for (other_side, b), j in known.items():
            if side == other_side and min(i) < min(j) and 100 * len(a & b) >= percent * len(a | b):
                expected.add((side, min(i), min(j), len(a & b), len(a | b)))
    found = similar_classes(classes, "side", percent).collect()
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_similar_classes_need_a_threshold(spark):
    with pytest.raises(ValueError):
        similar_classes(spark.createDataFrame([], "side int, class_id long, words array<string>"), "side", 0)
