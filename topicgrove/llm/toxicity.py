"""Toxicity by weak supervision.

Many voters look at a document: word lists, words and word beginnings that the labelled sample sets apart, and patterns. A
generative model of their votes, fitted without labels, estimates how often each voter fires on toxic and on other documents and which
voters repeat each other; its posterior becomes the label. A linear classifier over words and word beginnings is then trained
on the posteriors and scores whole texts where they are, without a shuffle.

Voters, model and classifier are fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicgrove.llm.common import bucket_of, labelled_sample, slabs, split_words, texts_of

#: Insults by language.
LEXICONS = {
    "en_person": "idiot moron loser clown imbecile jerk creep fool scumbag".split(),
    "en_contempt": "stupid pathetic worthless disgusting dumb trash scum garbage filth vile".split(),
    "de": "dumm dummkopf idiot trottel abschaum widerlich wertlos erbärmlich müll".split(),
    "fr": "idiot idiote crétin imbécile ordure pathétique minable dégoûtant stupide".split(),
    "es": "idiota estúpido imbécil basura escoria patético inútil asqueroso payaso".split(),
}
#: Sample: documents of each class at most, the longest text taken.
SAMPLE_PER_CLASS, SAMPLE_BYTES = 1500, 32 << 10
BEGINNINGS = (4, 5, 6)
#: A mined cue stands in this many toxic sample documents and is this many times as frequent there.
CUE_DOCUMENTS, CUE_RATIO, CUE_VOTERS = 4, 20.0, 4
#: The classifier's features: how many at most, and in how many sample documents each stands at least.
MOST_FEATURES, FEATURE_DOCUMENTS = 4096, 5
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def cleaned(word: str) -> str:
    """A lower-cased word without the punctuation around it."""
    return word if word.isalpha() else EDGE.sub("", word)


def features_of(word: str) -> list[str]:
    """A word and its beginnings, these marked with a star."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]] if word else []


class Document(NamedTuple):
    words: frozenset[str]
    features: frozenset[str]
    text: str


def read(text: bytes) -> Document:
    lower = text.decode().lower()
    words = frozenset(map(cleaned, lower.split())) - {""}
    return Document(words, frozenset(f for w in words for f in features_of(w)), text.decode())


def mined_cues(documents: list[Document], labels: np.ndarray) -> list[str]:
    """Features far more frequent in toxic documents, best first."""
    toxic, other = Counter(), Counter()
    for d, y in zip(documents, labels):
        (toxic if y else other).update(d.features)
    n_toxic, n_other = max(labels.sum(), 1), max((1 - labels).sum(), 1)
    ratio = {f: (n / n_toxic) / ((other[f] + 0.5) / n_other) for f, n in toxic.items() if n >= CUE_DOCUMENTS}
    return sorted((f for f, r in ratio.items() if r >= CUE_RATIO), key=lambda f: (-toxic[f] * np.log(ratio[f]), f))


Voter = Callable[[Document], bool]


def voters_of(cues: list[str]) -> list[Voter]:
    """Fixed lists, mined words and mined beginnings dealt out to several voters each, and patterns."""
    found: list[Voter] = [lambda d, known=frozenset(words): not known.isdisjoint(d.words) for words in LEXICONS.values()]
    for kind in (lambda c: not c.endswith("*"), lambda c: c.endswith("*")):
        mine = [c for c in cues if kind(c)]
        found += [lambda d, known=frozenset(mine[i::CUE_VOTERS]): not known.isdisjoint(d.features) for i in range(CUE_VOTERS)]
    insults = frozenset(w for words in LEXICONS.values() for w in words)
    insult = "|".join(map(re.escape, sorted(insults)))
    for pattern in (rf"(?i)\b(?:you|your|du|tu|vous|eres)\b\W+(?:\w+\W+){{0,3}}(?:{insult})\b", rf"(?i)\b(?:{insult})\b\W*!", rf"(?i)\b(?:{insult})\b.*\b(?:{insult})\b"):
        found.append(lambda d, p=re.compile(pattern): not insults.isdisjoint(d.words) and p.search(d.text) is not None)
    return found


class LabelModel(NamedTuple):
    prior: float
    rates: np.ndarray  # 2 x voters: how often each fires on other and on toxic documents
    weight: np.ndarray  # what a voter's evidence counts, less where others repeat it


def posterior(model: LabelModel, votes: np.ndarray) -> np.ndarray:
    odds = np.log(model.rates[1] / model.rates[0]) * votes + np.log((1 - model.rates[1]) / (1 - model.rates[0])) * (1 - votes)
    total = np.log(model.prior / (1 - model.prior)) + odds @ model.weight
    return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit_label_model(votes: np.ndarray, rounds: int = 40) -> LabelModel:
    """Expectation maximisation over two hidden classes.

    After the rates, each round estimates the correlation of every pair of voters inside the classes; a voter's evidence is
    divided by one plus its correlations with the others, so that copies of one voter count about once. It starts from
    the rule that a document with any vote is likely toxic.
    """
    n, m = votes.shape
    q = np.where(votes.any(axis=1), 0.9, 0.02) if n else np.zeros(0)
    model = LabelModel(0.5, np.full((2, m), 0.5), np.ones(m))
    for _ in range(rounds):
        classes = np.stack([1 - q, q])
        mass = classes.sum(axis=1)
        rates = np.clip((classes @ votes + [[0.05], [0.5]]) / (mass[:, None] + 1), 1e-4, 1 - 1e-4)
        within = np.zeros((m, m))
        for y in (0, 1):
            centred = votes - rates[y]
            within += (centred * classes[y][:, None]).T @ centred
        spread = np.sqrt(np.maximum(np.diag(within), 1e-9))
        linked = np.maximum(within / np.outer(spread, spread), 0)
        linked = np.where(linked > 0.1, linked, 0)
        np.fill_diagonal(linked, 0)
        model = LabelModel(float(np.clip((mass[1] + 1) / (n + 2), 0.01, 0.99)), rates, 1 / (1 + linked.sum(axis=1)))
        q = posterior(model, votes)
    return model


class Classifier(NamedTuple):
    weights: dict[str, float]
    offset: float


def fit_linear(documents: list[Document], target: np.ndarray, steps: int = 400, rate: float = 0.05, penalty: float = 2e-4) -> Classifier:
    """Logistic regression on present features, by Adam with an L1 penalty, so that most weights are exactly zero."""
    tally: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for d, q in zip(documents, target):
        for f in d.features:
            tally[f][0] += q
            tally[f][1] += 1
    base = target.mean() if len(target) else 0.5
    gain = {f: (q - n * base) ** 2 / n for f, (q, n) in tally.items() if n >= FEATURE_DOCUMENTS}
    index = {f: i for i, f in enumerate(sorted(gain, key=lambda f: (-gain[f], f))[:MOST_FEATURES])}
    rows = [np.array([index[f] for f in d.features if f in index], np.int64) for d in documents]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate([*rows, np.zeros(0, np.int64)])
    n, m = max(len(rows), 1), len(index)
    w, first, second = np.zeros(m + 1), np.zeros(m + 1), np.zeros(m + 1)  # the last is the offset
    w[m] = np.log((base + 0.01) / (1.01 - base))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[m] + np.bincount(row, w[column], minlength=len(rows)), -30, 30)))
        error = (p - target) / n
        g = np.append(np.bincount(column, error[row], minlength=m), error.sum())
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        w[:m] = np.sign(w[:m]) * np.maximum(np.abs(w[:m]) - rate * penalty / (np.sqrt(second[:m] / (1 - 0.99**step)) + 1e-6), 0)
    return Classifier({f: float(w[i]) for f, i in index.items() if w[i]}, float(w[m]))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from rows of ``labels.toxic`` whose crc32(id) mod 5 is not 0; the offset lies halfway between
    classes that weigh alike, as in the sample, and classes that weigh as often as they are labelled.

    Without labelled rows every text scores alike.
    """
    usable = bucket_of(F.col("doc_id"), 5) != 0
    texts, truth = labelled_sample(docs, labels, "toxic", usable, SAMPLE_PER_CLASS, SAMPLE_BYTES)
    documents = [read(t) for t in texts]
    voters = voters_of(mined_cues(documents, truth))
    votes = np.array([[v(d) for v in voters] for d in documents], float).reshape(len(documents), len(voters))
    model = fit_linear(documents, posterior(fit_label_model(votes), votes))
    toxic, other = labels.where(usable).agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    drawn = np.log((truth.sum() + 1) / (len(truth) - truth.sum() + 1))
    return model._replace(offset=model.offset + float(np.log((toxic + 1) / (other + 1)) - drawn) / 2)


def predict(model: Classifier, texts: pa.Array) -> np.ndarray:
    """The probability of label 1 of each text: each feature counts once, however often it stands there."""
    words, starts = split_words(texts)
    odds = np.full(len(texts), model.offset)
    if len(words):
        coded = words.dictionary_encode()
        index = {f: i for i, f in enumerate(model.weights)}
        weights = np.fromiter(model.weights.values(), float, len(index))
        # (word, feature) pairs of words with any weighted feature
        hits = [(i, index[f]) for i, w in enumerate(coded.dictionary.to_pylist()) for f in features_of(cleaned(w.lower())) if f in index]
        if hits:
            word, feature = np.array(hits).T
            first = np.searchsorted(word, np.arange(len(coded.dictionary) + 1))
            codes = coded.indices.to_numpy()
            n = (first[1:] - first[:-1])[codes]
            place = np.flatnonzero(n)
            owner = np.searchsorted(starts, np.repeat(place, n[place]), side="right") - 1
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n[place]) - n[place], n[place])
            pairs = np.unique(owner * len(index) + feature[np.repeat(first[codes[place]], n[place]) + k])
            odds += np.bincount(pairs // len(index), weights[pairs % len(index)], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row ``(doc_id, score, predicted)`` per row of ``docs``.

    Only the text decides. Null and empty texts have no features and get the base score; null ids and repeated rows are
    kept as they are, other columns are ignored, and no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches, limit=8 << 20):
            scores = predict(model, texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
