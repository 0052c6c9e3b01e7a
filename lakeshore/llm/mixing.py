"""Mixing to target weights with soft domain membership.

A softmax classifier, trained on the labelled table, gives every document
posterior probabilities over the domains (good, poor, toxic).  Document rates r
are then fitted so that the expected token totals of the domains,
sum_i r_i t_i p_id, match their targets in least squares, with 0 <= r_i <=
``max_rate``.  The fit is projected gradient descent run as Spark jobs, with
distances between rates weighed by the documents' tokens: the step is the
inverse of the largest eigenvalue of the domains' Gram matrix sum_i t_i p_i p_i'
(so a plain step never raises the residual), an extrapolated step that raises it
is taken back, and the fit ends when the duality gap, which bounds how far the
squared residual is from the least one, is small.  The first steps are found on a
summary, the token totals of the cells of a grid over the posteriors (at most
CELLS a side, whatever the corpus); then every iteration is one aggregate of a
few sums per domain over all rows, and only these end the fit.  A rate follows
from its posteriors and the list of steps; after every SETTLED steps the rates
are written, so a job applies few.

Targets: the weights times the largest total for which no domain asks for more
tokens than it has, or, with ``anchor``, the total at which that domain stays
whole (another domain that then lacks tokens keeps all it has).

Defined cases: NULL or empty text has 0 tokens and the classifier's posteriors
for an empty text; NULL ids share one draw; NULL labels are not learned from;
without labels every document belongs to the first domain; a domain without
labelled rows is left out and its weight shared by the rest; repeated rows get
equal rates and decisions; other columns are ignored (and kept by ``mix``); an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.llm.common import Cache, materialise, sample_per_class, some_texts, text_list, texts_of, unused
from lakeshore.llm.toxicity import features, select_features, words

DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.90, "poor": 0.07, "toxic": 0.03}
#: Bounds of the training sample (rows per domain) and of the lexical features.
ROWS_PER_DOMAIN, MAX_FEATURES = 1500, 1500
STEPS, SHRINK = 300, 0.02
#: Iterations of the rate fit at most, those on the grid included; it ends when the residual is within CLOSE of the target total of the least one.
ITERATIONS, CLOSE = 700, 1e-3
#: Steps after which the rates so far are written.
SETTLED = 12
#: Cells of the grid over each posterior, and steps taken on it at most.
CELLS, CELL_STEPS = 512, 400

_KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@^~=+_{}[]\\/", b"|", b"!", b".?", b",;:", b"\n"]
_TABLE = np.stack([np.isin(np.arange(256), list(k)) for k in _KINDS], axis=1).astype(float)
#: Bins of each dense measure.
BINS = 16
DENSE = len(_KINDS) + 3


def dense_bins(raw: bytes, n_words: int, n_types: int) -> list[int]:
    """One feature index per dense measure: shares of byte kinds, distinct words, word length, words."""
    if not n_words:
        return [k * BINS for k in range(DENSE)]
    shares = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _TABLE) / len(raw)
    bins = np.where(shares > 0, 15 - np.minimum(14, -2 * np.log2(np.maximum(shares, 1e-9))), 0).astype(int).tolist()
    bins += [int(15 * n_types / n_words), min(15, len(raw) // n_words), min(15, n_words.bit_length())]
    return [k * BINS + max(0, b) for k, b in enumerate(bins)]


@dataclass
class DomainModel:
    domains: tuple[str, ...]
    names: dict[str, int] = field(default_factory=dict)  # lexical feature -> index
    weights: np.ndarray | None = None  # (DENSE * BINS + features) x domains
    bias: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.known = Cache(self._features_of)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def _features_of(self, word: bytes) -> tuple[int, ...]:
        """Lexical features of what stands between two white spaces."""
        found = {f for w in words(word.decode("utf-8", "replace")) for f in features(w)}
        return tuple(DENSE * BINS + self.names[f] for f in found if f in self.names)

    def indices(self, text: str) -> tuple[int, list[int]]:
        """Words of the text and its active features."""
        raw = text.encode("utf-8", "replace")
        split = raw.split()  # bytes split at ASCII white space
        types = set(split)
        lexical = sorted(set().union(*map(self.known.__getitem__, types))) if self.names else []
        return len(split), dense_bins(raw, len(split), len(types)) + lexical

    def posteriors(self, text: str) -> tuple[int, list[float]]:
        n, at = self.indices(text)
        if self.weights is None:
            return n, [1.0] * len(self.domains)
        z = self.weights[at].sum(axis=0) + self.bias
        e = np.exp(z - z.max())
        return n, (e / e.sum()).tolist()


def train(x: list[list[int]], y: np.ndarray, prior: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by full gradient steps with per-feature scaling; rows weigh as in all labels."""
    n, k = len(y), len(prior)
    rows = np.repeat(np.arange(n), [len(r) for r in x])
    cols = np.fromiter((i for r in x for i in r), np.int64, len(rows))
    weight = (prior / np.bincount(y, minlength=k))[y]
    hot = np.eye(k)[y]
    w, b = np.zeros((size, k)), np.log(prior)
    square = np.full((size, k), 1e-8)
    add = lambda values, at, m: np.stack([np.bincount(at, values[:, d], m) for d in range(k)], axis=1)
    for _ in range(STEPS):
        z = add(w[cols], rows, n) + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = weight[:, None] * (p - hot)
        step = add(g[rows], cols, size) + SHRINK / n * w
        square += step ** 2
        w -= 0.2 * step / np.sqrt(square)
        b -= 0.5 * g.sum(axis=0)
    return w, b


def domain_of() -> Column:
    """The domain's place of a labelled row: toxic before poor before good."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)


def fit(docs: DataFrame, labels: DataFrame, per_domain: int = ROWS_PER_DOMAIN) -> DomainModel:
    known = (labels.withColumn("label", domain_of()).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not totals:
        return DomainModel(DOMAINS[:1])
    # At most per_domain rows of each of three domains: small whatever the corpus.
    sample = materialise(texts_of(docs, sample_per_class(known, per_domain), per_domain).select("label", "text"), "mix-sample")
    got = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    present = sorted(got)
    if len(present) < 2:
        return DomainModel(tuple(DOMAINS[d] for d in present) or DOMAINS[:1])
    telling = sample.withColumn("label", (F.col("label") == 2).cast("int"))
    names = select_features(telling, max(1, got.get(2, 0)), sum(got.values()) + 1, MAX_FEATURES) if got.get(2) else []
    model = DomainModel(tuple(DOMAINS[d] for d in present), {f: i for i, f in enumerate(names)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.indices(t)[1] for t in text_list(batch.column(1))],
                                                                        pa.list_(pa.int32()))], names=["label", "x"])

    rows = sample.select("label", "text").mapInArrow(run, "label int, x array<int>").toArrow().to_pydict()
    both = sorted(zip(rows["label"], rows["x"]))
    y = np.array([present.index(label) for label, _ in both])
    prior = np.array([totals[d] for d in present], float)
    model.weights, model.bias = train([x for _, x in both], y, prior / prior.sum(), DENSE * BINS + len(names))
    return model


def posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """doc_id, tokens, p (array over the model's domains) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.posteriors(t) for part in some_texts(batch.column(1)) for t in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in got], pa.int64()),
                                              pa.array([p for _, p in got], pa.list_(pa.float64()))], names=["doc_id", "tokens", "p"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, tokens long, p array<double>")


@dataclass
class Rates:
    """The rates as a function of the posteriors: from r = 1 take the steps (gradient, extrapolation) in order."""

    steps: list[tuple[list[float], float]]
    max_rate: float
    targets: list[float]
    totals: list[float]
    residuals: list[float] = field(default_factory=list)  # half the squared residual after each step

    def of(self, p: list[float]) -> float:
        """The rate of one row."""
        return float(self.of_rows(np.array([p], float))[1][0])

    def of_rows(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates of rows of posteriors before the last step and after it."""
        prev = now = np.ones(len(p))
        for g, beta in self.steps:
            prev, now = now, np.clip(now + beta * (now - prev) - p @ np.array(g), 0.0, self.max_rate)
        return prev, now

    def column(self, p: Column | None = None) -> Column:
        """The rate of a row with the posteriors ``p`` (by default its column p)."""
        steps = self

        @F.pandas_udf("double")
        def rate(values: pd.Series) -> pd.Series:
            return pd.Series(steps.of_rows(np.array(values.tolist(), float).reshape(len(values), -1))[1])

        return rate(F.col("p") if p is None else p) if self.steps else F.lit(1.0)


def _moved(prev: Column, now: Column, steps: list[tuple[list[float], float]], max_rate: float, p: Column) -> Column:
    """struct(prev, r) after the steps: r' = box(r + beta (r - prev) - p . gradient)."""
    start = F.struct(prev.alias("prev"), now.alias("r"))
    if not steps:
        return start
    size = range(len(steps[0][0]))

    def move(at: Column, s: Column) -> Column:
        y = at["r"] + s["beta"] * (at["r"] - at["prev"])
        new = F.greatest(F.lit(0.0), F.least(F.lit(max_rate), y - _dot(p, [s["g"][d] for d in size])))
        return F.struct(at["r"].alias("prev"), new.alias("r"))

    listed = F.array(*(F.struct(F.array(*map(F.lit, g)).alias("g"), F.lit(float(b)).alias("beta")) for g, b in steps))
    return F.aggregate(listed, start, move)


def _dot(p: Column, s: list) -> Column:
    return reduce(lambda a, b: a + b, (p[d] * v for d, v in enumerate(s)))


def target_totals(mass: np.ndarray, domains: tuple[str, ...], weights: dict[str, float], max_rate: float, anchor: str | None) -> np.ndarray:
    """Token totals the domains should have (zeros where nothing can be weighed)."""
    share = np.array([max(0.0, weights.get(d, 0.0)) for d in domains])
    share = np.where(mass > 0, share, 0.0)
    if not share.sum():
        return np.zeros(len(domains))
    share /= share.sum()
    total = min(max_rate * m / s for m, s in zip(mass, share) if s > 0)
    if anchor in domains and share[domains.index(anchor)] > 0:
        total = mass[domains.index(anchor)] / share[domains.index(anchor)]
    return share * total


def cell_steps(rows: DataFrame, targets: np.ndarray, curve: float, max_rate: float, close: float) -> list[tuple[list[float], float]]:
    """Projected gradient steps found on the token totals of the cells of a grid over the posteriors."""
    k = len(targets)
    t, p = F.col("tokens"), F.col("p")
    place = [F.floor(p[d] * CELLS).cast("int").alias(f"c{d}") for d in range(k - 1)]
    sums = [F.sum(t).cast("double").alias("t"), *(F.sum(t * p[d]).alias(f"m{d}") for d in range(k))]
    got = rows.where(t > 0).groupBy(*place).agg(*sums).toArrow()  # a row per cell in use
    total = got.column("t").to_numpy()
    p = np.stack([got.column(f"m{d}").to_numpy() for d in range(k)], axis=1) / total[:, None]
    order = np.lexsort(p.T)
    total, p = total[order], p[order]
    weighed = p * total[:, None]
    error = lambda r: 0.5 * float(np.square(r @ weighed - targets).sum())
    steps: list[tuple[list[float], float]] = []
    prev = now = np.ones(len(total))
    momentum, fresh = 1.0, True
    while len(steps) < CELL_STEPS:
        residual = now @ weighed - targets
        slope = weighed @ residual
        if float((slope * now - np.minimum(0.0, slope * max_rate)).sum()) <= 0.1 * close:
            break
        grow = (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
        beta = 0.0 if fresh else (momentum - 1) / grow
        ahead = now + beta * (now - prev)
        g = (ahead @ weighed - targets) / curve
        new = np.clip(ahead - p @ g, 0.0, max_rate)
        if error(new) > error(now) and not fresh:
            fresh, momentum = True, 1.0
            continue
        steps.append((g.tolist(), beta))
        prev, now, momentum, fresh = now, new, grow, False
    return steps


def _settled(rows: DataFrame, rates: Rates) -> DataFrame:
    """tokens, p, prev, r: the rows with their rates before and after the last step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prev, now = rates.of_rows(np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prev), pa.array(now)], names=["tokens", "p", "prev", "r"])

    return rows.select(F.col("tokens").cast("long"), "p").mapInArrow(run, "tokens long, p array<double>, prev double, r double")


def fit_rates(rows: DataFrame, domains: tuple[str, ...], weights: dict[str, float] = TARGETS, max_rate: float = 1.0,
              anchor: str | None = None) -> Rates:
    """Projected gradient least squares over (tokens, p); see the module's head."""
    k = len(domains)
    t, p = F.col("tokens"), F.col("p")
    pairs = [(d, e) for d in range(k) for e in range(d, k)]
    first = rows.agg(*(F.sum(t * p[d]).alias(f"m{d}") for d in range(k)), *(F.sum(t * p[d] * p[e]).alias(f"h{d}_{e}") for d, e in pairs)).first()
    mass = np.array([first[f"m{d}"] or 0.0 for d in range(k)])
    gram = np.zeros((k, k))
    for d, e in pairs:
        gram[d, e] = gram[e, d] = first[f"h{d}_{e}"] or 0.0
    curve = float(np.linalg.eigvalsh(gram)[-1])
    targets = target_totals(mass, domains, weights, max_rate, anchor)
    rates = Rates([], max_rate, targets.tolist(), mass.tolist())
    if not targets.sum() or curve <= 0:
        return rates
    close = 0.5 * (CLOSE * float(targets.sum())) ** 2
    error = lambda totals: 0.5 * float(np.square(totals - targets).sum())
    now, before, momentum, fresh = mass, mass, 1.0, True
    rates.residuals.append(error(now))
    state, waiting = rows.select("tokens", "p", F.lit(1.0).alias("prev"), F.lit(1.0).alias("r")), []
    rates.steps = cell_steps(rows, targets, curve, max_rate, close)
    if rates.steps:
        state = materialise(_settled(rows, rates), "rates")
        now = np.array([x or 0.0 for x in state.agg(*(F.sum(t * F.col("r") * p[d]) for d in range(k))).first()])
        if error(now) <= rates.residuals[0]:
            before = now
            rates.residuals.append(error(now))
        else:  # the summary misled
            rates.steps, now = [], mass
            state = rows.select("tokens", "p", F.lit(1.0).alias("prev"), F.lit(1.0).alias("r"))
    while len(rates.steps) < ITERATIONS:
        grow = (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
        beta = 0.0 if fresh else (momentum - 1) / grow
        ahead = now + beta * (now - before)
        step = (((ahead - targets) / curve).tolist(), beta)
        moved = state.select("tokens", "p", _moved(F.col("prev"), F.col("r"), [*waiting, step], max_rate, p).alias("m"))
        r, at = F.col("m.r"), F.col("m.prev")
        # The gap of the rates before this step: how much the linearised residual could still fall within the box.
        slope = _dot(p, [float(x) for x in now - targets])
        gap = F.sum(t * (slope * at - F.least(F.lit(0.0), slope * max_rate)))
        got = moved.agg(*(F.sum(t * r * p[d]) for d in range(k)), gap).first()
        new = np.array([x or 0.0 for x in got[:k]])
        if got[k] <= close:
            break
        if error(new) > error(now) and not fresh:
            fresh, momentum = True, 1.0  # taken back; the next step is plain
            continue
        rates.steps.append(step)
        waiting.append(step)
        before, now, momentum, fresh = now, new, grow, False
        rates.residuals.append(error(now))
        if len(waiting) >= SETTLED:
            done = state.select("tokens", "p", _moved(F.col("prev"), F.col("r"), waiting, max_rate, p).alias("m"))
            state, waiting = materialise(done.select("tokens", "p", F.col("m.prev").alias("prev"), F.col("m.r").alias("r")), "rates"), []
    rates.totals = now.tolist()
    return rates


def draw(doc_id: str = "doc_id") -> Column:
    """A number in [0, 1) per id."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("mix")), F.lit(1 << 52)) / F.lit(float(1 << 52))


def rate_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = TARGETS, max_rate: float = 1.0) -> DataFrame:
    """doc_id, tokens, domain, one posterior per domain, rate, copies for every row."""
    model = fit(docs, labels)
    rows = materialise(posteriors(docs, model), "posteriors")
    rates = fit_rates(rows, model.domains, weights, max_rate)
    ps = [(F.col("p")[model.domains.index(d)] if d in model.domains else F.lit(0.0)).alias(f"p_{d}") for d in DOMAINS]
    best = F.array_position(F.col("p"), F.array_max("p")).cast("int")
    rated = rows.withColumn("rate", rates.column())
    return rated.select("doc_id", "tokens", F.element_at(F.array(*map(F.lit, model.domains)), best).alias("domain"), *ps, "rate",
                        F.floor(F.col("rate") + draw()).cast("int").alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = TARGETS, max_rate: float = 1.0,
        anchor: str | None = DOMAINS[0]) -> DataFrame:
    """The rows of ``docs`` as often as their rate says, with all columns.

    The posteriors are written beside the rows, so every text is scored once.
    """
    model = fit(docs, labels)
    place, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.posteriors(t) for part in some_texts(batch.column(place)) for t in part]
            made = pa.StructArray.from_arrays([pa.array([n for n, _ in got], pa.int64()), pa.array([p for _, p in got], pa.list_(pa.float64()))],
                                              names=["tokens", "p"])
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, scored])

    scored, copies = unused(names, "scored"), unused(names, "copies")
    made = T.StructType([T.StructField("tokens", T.LongType()), T.StructField("p", T.ArrayType(T.DoubleType()))])
    rows = materialise(docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(scored, made)])), "scored")
    rates = fit_rates(rows.select(f"{scored}.tokens", f"{scored}.p"), model.domains, weights, max_rate, anchor)
    times = F.floor(rates.column(F.col(f"{scored}.p")) + draw()).cast("int")
    return rows.select(*names, F.explode(F.array_repeat(F.lit(True), times)).alias(copies)).select(*names)
