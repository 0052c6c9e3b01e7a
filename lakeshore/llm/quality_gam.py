"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes about twenty measures.  Boosting goes round the measures in
cycles and fits one shallow tree at a time to a single binned measure; trees
add up to one look-up table per measure.  The strongest pairs of measures on
the residuals then get small two-way tables the same way.  Scoring bins a whole
batch at once and adds table entries.  Measures are taken in the tasks; only
the measures of a bounded sample of labelled rows reach the driver.

Defined cases: NULL or empty text has all measures 0 and gets the score of that
bin; NULL labels and NULL ids are not learned from; the larger of conflicting
labels counts; with labels of one class, or none, every score is that class's
share (0.5 without labels); repeated rows score alike; other columns are
ignored.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import WORD, id_remainder, one_label_per_doc, sample_per_class, text_list, texts_of

#: Bound of the training sample.
ROWS_PER_CLASS = 4000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE, DEPTH = 120, 60, 0.1, 4.0, 2
THRESHOLD = 0.7

MEASURES = ("chars", "words", "word_len", "word_len_sd", "long_words", "upper", "digits", "symbols", "pipes", "exclaims",
            "stops", "commas", "other_ascii", "wide", "types", "hapax", "top_word", "same_next", "pairs", "lines",
            "dup_lines", "line_words", "capital_words", "short_words")


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars.encode("latin-1"))] = 1
    return out


#: ASCII bytes by kind, one column each; bytes of other scripts count in "wide".
KINDS = np.stack([_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789"), _table("#*$%&<>@^~=+_{}[]\\/"), _table("|"),
                  _table("!"), _table(".?"), _table(",;:"), _table("\"'()-`"), np.arange(256) >= 128], axis=1).astype(float)


def measures(text: str) -> list[float]:
    """The values of MEASURES for one text."""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(MEASURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = (np.bincount(raw, minlength=256) @ KINDS) / len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    types = len(counts)
    once = sum(1 for c in counts.values() if c == 1)
    same = sum(map(operator.eq, words, words[1:])) if n > 1 else 0
    pairs = len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1.0
    lines = [x for x in text.split("\n") if x]
    capital = sum(1 for w in words if w[0].isupper())
    return [np.log1p(len(text)), np.log1p(n), lengths.mean(), lengths.std(), (lengths > 12).mean(), *kinds.tolist(),
            types / n, once / n, max(counts.values()) / n, same / n, pairs, np.log1p(len(lines)),
            1 - len(set(lines)) / len(lines) if lines else 0.0, np.log1p(n / max(1, len(lines))), capital / n, (lengths <= 3).mean()]


def _leaves(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """A regression tree over ordered bins: the value of each bin's leaf."""
    value = np.full(len(g), -g.sum() / (h.sum() + RIDGE))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = left_g ** 2 / (left_h + RIDGE) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + RIDGE)
        k = int(gain.argmax()) + 1
        if gain[k - 1] > g.sum() ** 2 / (h.sum() + RIDGE) + 1e-9:
            value = np.concatenate([_leaves(g[:k], h[:k], depth - 1), _leaves(g[k:], h[k:], depth - 1)])
    return value


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The best split of a two-way table into four leaves, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = lambda c: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1],
                       c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
    pg, ph = parts(cg), parts(ch)
    gain = sum(a ** 2 / (b + RIDGE) for a, b in zip(pg, ph))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    leaf = [-a[i, j] / (b[i, j] + RIDGE) for a, b in zip(pg, ph)]
    out = np.empty_like(g)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = leaf
    return out, float(gain[i, j] - g.sum() ** 2 / (h.sum() + RIDGE))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class AdditiveModel:
    intercept: float
    edges: list[np.ndarray]  # per measure
    tables: np.ndarray  # measures x BINS
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]  # PAIR_BINS x PAIR_BINS

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of measures."""
        z = np.full(len(x), self.intercept)
        if self.edges and len(x):
            at = self.bins(x)
            z += self.tables[np.arange(at.shape[1]), at].sum(axis=1)
            coarse = at * PAIR_BINS // BINS
            for (i, j), t in zip(self.pairs, self.pair_tables):
                z += t[coarse[:, i], coarse[:, j]]
        return _sigmoid(z)


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of single measures, then of the strongest pairs."""
    share = float((weight * y).sum() / weight.sum())
    intercept = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    model = AdditiveModel(intercept, edges, np.zeros((x.shape[1], BINS)), [], [])
    at = model.bins(x)
    coarse = at * PAIR_BINS // BINS
    z = np.full(len(y), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(z)
        return weight * (p - y), weight * p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(x.shape[1]):
            g, h = slopes()
            step = RATE * _leaves(np.bincount(at[:, k], g, BINS), np.bincount(at[:, k], h, BINS), DEPTH)
            model.tables[k] += step
            z += step[at[:, k]]
    grid = lambda i, j, v: np.bincount(coarse[:, i] * PAIR_BINS + coarse[:, j], v, PAIR_BINS ** 2).reshape(PAIR_BINS, -1)
    g, h = slopes()
    gains = sorted(((_quadrants(grid(i, j, g), grid(i, j, h))[1], (i, j)) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [p for _, p in gains[:PAIRS]]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = RATE * _quadrants(grid(i, j, g), grid(i, j, h))[0]
            t += step
            z += step[coarse[:, i], coarse[:, j]]
    return model


def measure_rows(rows: DataFrame, keep: str) -> DataFrame:
    """(keep, x) with the measures of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([measures(t) for t in text_list(batch.column(1))],
                                                                        pa.list_(pa.float64()))], names=["key", "x"])

    return rows.select(keep, "text").mapInArrow(run, f"key {rows.schema[keep].dataType.simpleString()}, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = ROWS_PER_CLASS) -> AdditiveModel:
    """Learn from labelled rows whose id remainder (mod 4) is not 2."""
    known = one_label_per_doc(labels, label).where(id_remainder("doc_id", 4) != 2)
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    # At most per_class rows of each of two classes: small whatever the corpus.
    sample = texts_of(docs, sample_per_class(known, per_class), per_class)
    got = measure_rows(sample.select("label", "text"), "label").toArrow().to_pydict()
    y, rows = np.array(got["key"], float), got["x"]
    if not (y == 1).any() or not (y == 0).any():
        share = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
        return AdditiveModel(float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))), [], np.zeros((0, BINS)), [], [])
    order = sorted(range(len(y)), key=lambda i: (y[i], rows[i]))
    x, y = np.array([rows[i] for i in order]), y[order]
    # Rows weigh as in all labels.
    per = {c: totals[c] / sum(totals.values()) * len(y) / (y == c).sum() for c in (0, 1)}
    return train(x, y, np.where(y == 1, per[1], per[0]))


def score(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [measures(t) for t in text_list(batch.column(1))]
            s = model.score(np.array(got).reshape(-1, len(MEASURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()),
                                              pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
