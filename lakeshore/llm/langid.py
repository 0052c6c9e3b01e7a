"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text's letters become byte n-grams, hashed into a fixed number of buckets;
the mean of their embeddings goes through a linear softmax (trained by
stochastic gradient descent in numpy on a bounded sample of rows).  As mean and
linear layer commute, scoring adds rows of one table of bucket logits, so any
text length takes constant memory beyond the text.  A temperature and the
rejection threshold are calibrated on sampled rows that training never saw.

Defined cases: NULL text, or text without a letter: ``und``, score 0, rejected;
NULL lang rows are scored but not learned from; repeated rows score alike; with
nothing to learn from every row is ``und``; other columns are ignored (the
filter keeps them).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import id_remainder, released, sample_per_class, some_texts, text_list, texts_of

UND = "und"
ORDERS = (2, 3, 4, 5)
BUCKETS = 1 << 16
DIM = 16
#: Bound of the training sample: rows per language, passages per row, letters per passage.
ROWS_PER_LANG, PASSAGES, PASSAGE_CHARS = 400, 6, 400
#: Languages learned at most: those with most rows (the model's table has BUCKETS numbers for each).
MAX_LANGS = 1024
EPOCHS, RATE, SEED = 4, 0.6, 7
#: Share of known-language calibration passages that may fall below the rejection threshold, and its ceiling.
REJECT_SHARE, REJECT_CEILING = 0.001, 0.5
#: Bytes hashed at a time.
BLOCK = 1 << 20

LETTERS = re.compile(r"[^\W\d_]+")
#: Numbers that LETTERS takes for letters (such as superscripts, fractions, circled digits), and a table that blanks them.
_NUMBERS = frozenset(c for c in map(chr, range(0x80, 0x20000)) if c.isalnum() and not c.isdecimal() and unicodedata.category(c)[0] != "L")
_BLANK = dict.fromkeys(map(ord, _NUMBERS), " ")


def letters(text: str) -> str:
    """Lower-case letter runs with one space around each."""
    if not (text.isascii() or _NUMBERS.isdisjoint(text)):
        text = text.translate(_BLANK)
    found = LETTERS.findall(text)
    return f" {' '.join(found).lower()} " if found else ""


def buckets(data: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams, a block at a time (blocks overlap, so none is lost)."""
    longest = max(ORDERS)
    for at in range(0, len(data), BLOCK):
        raw = np.frombuffer(data[at:at + BLOCK + longest - 1], np.uint8).astype(np.uint32)
        own = min(BLOCK, len(data) - at)
        h = raw
        for n in range(2, longest + 1):
            if len(h) < 2:
                break
            h = h[:-1] * np.uint32(0x01000193) + raw[n - 1:]
            if n in ORDERS:
                mixed = h[:own] * np.uint32(0x9E3779B1) + np.uint32(n)
                yield ((mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1)).astype(np.uint16)


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # bucket logits, BUCKETS x languages
    bias: np.ndarray
    threshold: float

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, its probability, and whether it is rejected."""
        plain = letters(text)
        if not plain or not self.langs:
            return UND, 0.0, True
        total, n = np.zeros(len(self.langs)), 0
        for at in buckets(plain.encode("utf-8")):
            total += self.table[at].sum(axis=0, dtype=np.float64)
            n += len(at)
        p = _softmax(total / max(1, n) + self.bias)
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def passages(text: str) -> list[bytes]:
    """Up to PASSAGES evenly spaced passages of one to PASSAGE_CHARS letters, from everywhere in the text."""
    plain = letters(text)
    if not plain:
        return []
    step = max(1, -(-len(plain) // PASSAGES))
    sizes = (PASSAGE_CHARS, PASSAGE_CHARS // 2, PASSAGE_CHARS // 8, PASSAGE_CHARS // 32)
    return [plain[at:at + min(step, sizes[k % len(sizes)])].encode("utf-8") for k, at in enumerate(range(0, len(plain), step))]


def train(examples: list[tuple[str, np.ndarray]], held: list[tuple[str, np.ndarray]]) -> LanguageModel:
    """Stochastic gradient descent over (language, bucket numbers); ``held`` calibrates."""
    langs = sorted({lang for lang, _ in examples})
    k = {lang: i for i, lang in enumerate(langs)}
    rng = np.random.default_rng(SEED)
    e = (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
    w, b = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    steps, done = max(1, EPOCHS * len(examples)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            lang, at = examples[i]
            rate = RATE * (1 - done / steps)
            done += 1
            seen, times = np.unique(at, return_counts=True)
            share = (times / len(at)).astype(np.float32)
            hidden = share @ e[seen]
            g = _softmax(hidden @ w + b)
            g[k[lang]] -= 1
            back = w @ g
            w -= rate * np.outer(hidden, g)
            b -= rate * 0.1 * g
            e[seen] -= rate * len(seen) ** 0.5 * share[:, None] * back
    table = e @ w
    scale, threshold = _calibrate(table, b, [(k[lang], at) for lang, at in held if lang in k])
    return LanguageModel(langs, table * np.float32(scale), b * np.float32(scale), threshold)


def _calibrate(table: np.ndarray, bias: np.ndarray, held: list[tuple[int, np.ndarray]]) -> tuple[float, float]:
    """Inverse temperature of least log loss, and the threshold that keeps all but REJECT_SHARE of held passages."""
    if not held:
        return 1.0, 0.0
    z = np.array([table[at].mean(axis=0) + bias for _, at in held])
    y = np.array([i for i, _ in held])
    scales = np.geomspace(0.1, 10, 41)
    loss = [-np.log(_softmax(z * s)[np.arange(len(y)), y] + 1e-12).mean() for s in scales]
    s = float(scales[int(np.argmin(loss))])
    best = _softmax(z * s).max(axis=1)
    return s, min(REJECT_CEILING, float(np.quantile(best, REJECT_SHARE)))


def _known(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder("doc_id", 4) != 2))


def unlearned(docs: DataFrame, max_langs: int = MAX_LANGS) -> DataFrame:
    """(lang, n): the languages beyond the ``max_langs`` with most rows, which ``fit`` leaves out."""
    counts = _known(docs).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    taken = counts.orderBy(F.desc("n"), "lang").limit(max_langs)
    return counts.join(F.broadcast(taken.select("lang")), "lang", "left_anti")


def fit(docs: DataFrame, per_lang: int = ROWS_PER_LANG, max_langs: int = MAX_LANGS) -> LanguageModel:
    """Train on rows with a language whose id remainder (mod 4) is not 2, of the ``max_langs`` languages with most rows."""
    known = _known(docs)
    # The key holds the text's fingerprint, so a repeated id does not take the places of other rows.
    keyed = known.select("doc_id", F.col("lang").alias("label"), F.xxhash64("text").alias("print"), "text")
    chosen = sample_per_class(keyed.drop("text"), per_lang, max_langs, ("doc_id", "print"))
    # At most per_lang rows a language, so small whatever the corpus.
    mine = keyed.withColumnRenamed("label", "lang")
    rows = texts_of(mine, chosen.withColumn("lang", F.col("label")), per_lang)
    rows = rows.select("label", (F.xxhash64("doc_id") % 5 == 0).alias("held"), "text")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(lang, held, np.concatenate(list(buckets(p))).tobytes())
                   for lang, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_list(batch.column(2)))
                   for p in passages(text) if len(p) > 2]
            lang, held, data = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(held, pa.bool_()), pa.array(data, pa.binary())],
                                             names=["label", "held", "at"])

    got = rows.mapInArrow(featurise, "label string, held boolean, at binary").toArrow().to_pydict()
    seen = sorted(zip(got["label"], got["held"], got["at"]))
    part = {h: [(lang, np.frombuffer(at, np.uint16)) for lang, held, at in seen if held == h] for h in (False, True)}
    return train(part[False] or part[True], part[True])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.predict(t) for t in text_list(batch.column(1))]
            lang, score, rejected = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, in one pass and with all their columns."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not model.predict(t)[2] for part in some_texts(batch.column(place)) for t in part], pa.bool_()))

    return docs.mapInArrow(lambda b: released(run(b)), docs.schema)
