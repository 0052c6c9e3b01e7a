"""Toxicity: a sparse linear classifier regularised by counterfactual identity swaps.

A text's features are the presence of words, word beginnings and word endings.
Spark counts features over a bounded sample of labelled rows and keeps the most
telling ones; a logistic model with an L1 penalty is fitted to them.  For every
labelled text a counterfactual is made by swapping the identity terms in its
sentences (where a text has none, a neutral mention is added), and the squared
change of the score between text and counterfactual is penalised, so mentioning
a group does not move the score.

Defined cases: NULL or empty text scores the model's intercept; NULL labels and
NULL ids are not learned from; the larger of conflicting labels counts; with no
labels, or labels of one class, every score is the share of label 1 (0 without
labels); repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import Cache, id_remainder, materialise, one_label_per_doc, sample_per_class, text_list, texts_of

#: Bounds of the training sample (rows per class) and of the model (features).
ROWS_PER_CLASS, MAX_FEATURES = 2000, 4000
MIN_DOCS = 3
L1, COUNTERFACTUAL, POSITIVE_WEIGHT, STEPS = 0.0008, 1.0, 1.5, 500
THRESHOLD = 0.5
EDGES = (4, 5, 6)

#: Identity terms by kind; a term's counterfactuals are the others of its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "trans", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "sikh"),
    ("black", "white", "asian", "latino", "indigenous", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "queer"),
    ("immigrant", "refugee", "native", "foreign"),
    ("disabled", "deaf", "blind", "autistic"),
)
SWAP = {t: kind[(k + 1) % len(kind)] for kind in IDENTITY_TERMS for k, t in enumerate(kind)}
MENTIONS = tuple(SWAP)

WORDS = re.compile(r"[^\W\d_]+")
SENTENCES = re.compile(r"(?<=[.!?\n])\s+")


def words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def features(word: str) -> list[str]:
    """The word itself, its beginnings (``abc*``) and endings (``*abc``)."""
    out = [word]
    for n in EDGES:
        if len(word) > n:
            out += [f"{word[:n]}*", f"*{word[-n:]}"]
    return out


def counterfactual(text: str, place: int) -> str:
    """The text with the identity terms of its sentences swapped; a neutral mention is added where there are none."""
    found = WORDS.findall(text.lower())
    if SWAP.keys().isdisjoint(found):
        return f"{text} {MENTIONS[place % len(MENTIONS)]}"
    swap = lambda m: SWAP.get(m.group().lower(), m.group())
    return " ".join(WORDS.sub(swap, s) for s in SENTENCES.split(text))


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def __post_init__(self) -> None:
        self.known = Cache(lambda w: tuple(f for f in features(w) if f in self.weights))

    def __getstate__(self) -> tuple:
        return self.weights, self.bias

    def __setstate__(self, state: tuple) -> None:
        self.weights, self.bias = state
        self.__post_init__()

    def active(self, text: str) -> set[str]:
        """Features of the model that the text has."""
        return set().union(*set(map(self.known.__getitem__, set(words(text)))))

    def score(self, text: str) -> float:
        z = self.bias + sum(sorted(self.weights[f] for f in self.active(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def select_features(sample: DataFrame, n_pos: int, n_all: int, most: int = MAX_FEATURES) -> list[str]:
    """Features of at least MIN_DOCS sampled rows with the largest likelihood-ratio statistic, chosen by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, labels = [], []
            for label, text in zip(batch.column(0).to_pylist(), text_list(batch.column(1))):
                own = {f for w in set(words(text)) for f in features(w)}
                names += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(labels, pa.int32())], names=["feature", "label"])

    counts = (sample.select("label", "text").mapInArrow(run, "feature string, label int").groupBy("feature")
              .agg(F.sum("label").alias("a"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_DOCS))
    share = F.lit(n_pos / n_all)
    a, n = F.col("a"), F.col("n")
    term = lambda got, wanted: F.when(got > 0, got * F.log(got / wanted)).otherwise(0.0)
    g2 = 2 * (term(a, n * share) + term(n - a, n * (1 - share)))
    return [r[0] for r in counts.select("feature", g2.alias("g2")).orderBy(F.desc("g2"), "feature").limit(most).collect()]


def fit_weights(x: list[list[int]], twin: list[list[int]], y: np.ndarray, size: int, prior: float) -> tuple[np.ndarray, float]:
    """Proximal gradient for log loss + COUNTERFACTUAL * mean (score change)^2 + L1; ``prior`` is the share of label 1."""
    n = len(y)
    rows = lambda sets: np.repeat(np.arange(n), [len(s) for s in sets])
    flat = lambda sets: np.fromiter((i for s in sets for i in s), np.int64)
    xr, xc, tr, tc = rows(x), flat(x), rows(twin), flat(twin)
    dot = lambda r, c, w: np.bincount(r, w[c], n)
    back = lambda r, c, g: np.bincount(c, g[r], size)
    # Rows weigh as in all labels, label 1 POSITIVE_WEIGHT times that.
    weight = np.where(y == 1, POSITIVE_WEIGHT * prior / (y == 1).sum(), (1 - prior) / (y == 0).sum()) * n
    start = float(np.log(prior / (1 - prior)))
    w, b, v, vb, t = np.zeros(size), start, np.zeros(size), start, 1.0
    # The step is the inverse of the largest curvature, found by power iteration (the intercept is the last entry).
    u, curve = np.ones(size + 1) / (size + 1) ** 0.5, 1.0
    for _ in range(30):
        s, d = 0.25 * weight * (dot(xr, xc, u[:-1]) + u[-1]) / n, 2 * COUNTERFACTUAL * (dot(xr, xc, u[:-1]) - dot(tr, tc, u[:-1])) / n
        u = np.append(back(xr, xc, s + d) - back(tr, tc, d), s.sum())
        curve = max(float(np.linalg.norm(u)), 1e-9)
        u /= curve
    rate = 0.9 / curve
    for _ in range(STEPS):
        z, zt = dot(xr, xc, v), dot(tr, tc, v)
        g = weight * (1 / (1 + np.exp(-np.clip(z + vb, -40, 40))) - y) / n
        d = 2 * COUNTERFACTUAL * (z - zt) / n
        grad = back(xr, xc, g + d) - back(tr, tc, d)
        new = v - rate * grad
        new = np.sign(new) * np.maximum(np.abs(new) - rate * L1, 0)
        new_b = vb - rate * g.sum()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = ROWS_PER_CLASS) -> ToxicityModel:
    """Learn from labelled rows whose id remainder (mod 5) is not 0."""
    known = one_label_per_doc(labels, label).where(id_remainder("doc_id", 5) != 0)
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    # At most per_class rows of each of two classes: small whatever the corpus.
    sample = materialise(texts_of(docs, sample_per_class(known, per_class), per_class).select("label", "text"), "toxic-sample")
    got = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not got.get(0) or not got.get(1):
        share = totals.get(1, 0) / max(1, sum(totals.values()))
        return ToxicityModel({}, float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))))
    names = select_features(sample, got[1], got[0] + got[1])
    names += sorted({f for t in MENTIONS for f in features(t)} - set(names))
    place = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picker = ToxicityModel(dict.fromkeys(place, 0.0), 0.0)
        index = lambda text: sorted(place[f] for f in picker.active(text))
        for batch in batches:
            texts = text_list(batch.column(1))
            twins = [counterfactual(t, len(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(index, texts), pa.list_(pa.int32())),
                                              pa.array(map(index, twins), pa.list_(pa.int32()))], names=["label", "x", "twin"])

    rows = sample.select("label", "text").mapInArrow(run, "label int, x array<int>, twin array<int>").toArrow().to_pydict()
    order = sorted(range(len(rows["label"])), key=lambda i: (rows["label"][i], rows["x"][i], rows["twin"][i]))
    pick = lambda c: [rows[c][i] for i in order]
    share = min(max(totals[1] / sum(totals.values()), 0.02), 0.98)
    w, b = fit_weights(pick("x"), pick("twin"), np.array(pick("label"), float), len(names), share)
    return ToxicityModel({f: float(w[i]) for f, i in place.items() if w[i]}, b)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in text_list(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()),
                                              pa.array([int(s >= threshold) for s in scores], pa.int32())],
                                             names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
