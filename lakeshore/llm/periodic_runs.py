"""Periodic run detection by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least
EXPONENT periods and LEAST words long, that can't be extended either way.

At each dyadic scale t = 4, 8, 16, ... a synchronising set is chosen from the
text by hashes alone: position i belongs to it when the smallest hash among the
t-word windows starting at i .. i+t is that of i or i+t, windows inside
highly periodic regions (period at most t/4) left aside.  Membership depends on
the 2t words from i (its context) only, and each t positions hold one unless
their 3t - 1 words are highly periodic.  A run of period p, t <= p < 2t, has a
position s in its first t words, and s + p has the same context; nothing
between them has.  So consecutive positions of equal context, t to 2t apart,
propose all periods of the scale, and a proposal is verified by comparing
words both ways from s.  Periods under 4 are taken from the words p apart
directly; together with the runs of smaller scales they are the highly
periodic regions of the larger ones.

Hashes are 64 bits and only propose; the words decide.  Many documents of a
batch are handled in one pass, each ended by a word of its own that equals no
other; a scale looks at documents of at least EXPONENT * t words only.

Defined cases: NULL, empty or blank text has no words and no run; repeated rows
and NULL ids each keep a row; very long texts form a pass of their own; other
columns are ignored (and kept by ``collapse``); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import SPACE

#: Periods and words of a run at least.
EXPONENT, LEAST = 4, 6
#: Smallest scale; smaller periods are compared directly.
FIRST_SCALE = 4
#: Words of a pass (a longer text is a pass of its own).
PASS_WORDS = 300_000
#: Positions compared at a time when a proposal is extended, at first.
STRIDE = 64

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Odd multipliers of the hash.
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    h = (x * _A) ^ ((y + _B) * _B)
    h ^= h >> np.uint64(32)
    h *= _A
    h ^= h >> np.uint64(29)
    return h


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    """x moved by places to the left, zeros behind."""
    out = np.zeros_like(x)
    if by < len(x):
        out[:len(x) - by] = x[by:]
    return out


def _stretches(equal: np.ndarray, period: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the places where EXPONENT - 1 periods or more are equal to what is a period ahead."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    wide = ends - starts >= (EXPONENT - 1) * period
    return [(int(a), int(b - a) + period, period) for a, b in zip(starts[wide], ends[wide])]


def _extend(words: np.ndarray, s: int, p: int) -> tuple[int, int]:
    """The largest [lo, hi) around s in which every word equals the one p ahead."""
    lo, step = s, STRIDE
    while lo:
        a = max(0, lo - step)
        differ = np.flatnonzero(words[a:lo] != words[a + p:lo + p])
        if len(differ):
            lo = a + int(differ[-1]) + 1
            break
        lo, step = a, 2 * step
    hi, step, end = s, STRIDE, len(words) - p
    while hi < end:
        b = min(end, hi + step)
        differ = np.flatnonzero(words[hi:b] != words[hi + p:b + p])
        if len(differ):
            hi += int(differ[0])
            break
        hi, step = b, 2 * step
    return lo, hi


def _proposals(hashes: np.ndarray, t: int, periodic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) pairs of the synchronising set of scale t; ``hashes`` are those of t words."""
    ids = np.where(periodic, _TOP, hashes)
    least, w = ids, 1
    while w < t:
        nxt = np.full_like(least, _TOP)
        nxt[:len(least) - w] = least[w:]
        least = np.minimum(least, nxt)
        w *= 2
    far = np.full_like(ids, _TOP)
    if t < len(ids):
        far[:len(ids) - t] = ids[t:]
    least = np.minimum(least, far)
    chosen = np.flatnonzero(((least == ids) | (least == far)) & (least != _TOP))
    context = _mix(hashes[chosen], _ahead(hashes, t)[chosen])
    order = np.argsort(context, kind="stable")
    at, same = chosen[order], context[order][1:] == context[order][:-1]
    gap = np.diff(at)
    near = same & (gap >= t) & (gap < 2 * t)
    return at[:-1][near], gap[near]


def find_runs(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every stretch of at least EXPONENT periods, sorted.

    ``words`` holds the documents' word numbers, each followed by a number that
    occurs once; ``starts`` and ``lengths`` are theirs.
    """
    found: dict[tuple[int, int], int] = {}

    def add(start: int, length: int, period: int) -> None:
        found[start, length] = min(period, found.get((start, length), period))

    for p in range(1, min(FIRST_SCALE, len(words))):
        for run in _stretches(words[:-p] == words[p:], p):
            add(*run)
    w, begin, size = words, starts, lengths
    hashes = _mix(w.astype(np.uint64), np.zeros(1, np.uint64))
    t = 1
    while len(w):
        # Hashes of t words; documents too short for the scale leave.
        hashes = _mix(hashes, _ahead(hashes, t))
        t *= 2
        if t < FIRST_SCALE:
            continue
        stay = size >= EXPONENT * t
        if not stay.all():
            held = np.repeat(stay, size + 1)
            w, hashes, begin, size = w[held], hashes[held], begin[stay], size[stay]
            if not len(w):
                break
        local = np.concatenate(([0], np.cumsum(size + 1)[:-1]))  # where the documents now start
        mark = np.zeros(len(w) + 1, np.int32)
        for (start, length), p in found.items():
            if p * EXPONENT <= t <= length:
                k = int(np.searchsorted(begin, start, "right")) - 1
                if k >= 0 and start < begin[k] + size[k]:
                    a = int(local[k] + start - begin[k])
                    mark[a] += 1
                    mark[a + length - t + 1] -= 1
        at, period = _proposals(hashes, t, np.cumsum(mark[:-1]) > 0)
        order = np.lexsort((at, period))
        last, done = 0, -1
        for s, p in zip(at[order].tolist(), period[order].tolist()):
            if p == last and s < done:
                continue  # inside the stretch just compared
            lo, hi = _extend(w, s, p)
            last, done = p, hi
            if hi - lo >= (EXPONENT - 1) * p:
                k = int(np.searchsorted(local, lo, "right")) - 1
                add(int(begin[k] + lo - local[k]), hi - lo + p, p)
    return sorted((a, n, p) for (a, n), p in found.items())


def _passes(texts: list[bytes | None]) -> Iterator[tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]]:
    """(words of each text, runs of each text), some texts at a time."""
    group: list[list[bytes]] = []
    held = 0
    for text in texts:
        words = (text or b"").split()  # bytes split at ASCII white space
        if group and held + len(words) > PASS_WORDS:
            yield group, _runs_of(group)
            group, held = [], 0
        group.append(words)
        held += len(words)
    if group:
        yield group, _runs_of(group)


def _runs_of(group: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    number: dict[bytes, int] = {}
    ids: list[int] = []
    for k, words in enumerate(group):
        ids += [number.setdefault(w, len(number)) for w in words]
        ids.append(-1 - k)
    lengths = np.array([len(words) for words in group], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in group]
    for start, length, period in find_runs(np.array(ids, np.int64), starts, lengths):
        if length >= LEAST:
            k = int(np.searchsorted(starts, start, "right")) - 1
            out[k].append((start - int(starts[k]), length, period))
    return out


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _each(docs: DataFrame, columns: list[str], schema: str, result: Callable) -> DataFrame:
    """``columns`` of ``docs`` followed by ``result(words, runs)`` columns for each row's text."""
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<struct<start:long,length:long,period:long>>": pa.list_(pa.struct(
        [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for group, runs in _passes(batch.column(len(columns)).cast(pa.binary()).to_pylist()):
                rows = [result(w, r) for w, r in zip(group, runs)]
                part = batch.slice(done, len(group))
                done += len(group)
                made = [pa.array(c, kinds[f.split(" ", 1)[1]]) for c, f in zip(zip(*rows), schema.split(", "))]
                yield pa.RecordBatch.from_arrays([*part.columns[:len(columns)], *made], names=columns + names)

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*columns, "text").mapInArrow(run, f"{kept}, {schema}")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run's start, length, period, exponent_milli, runs_sha256, collapsed_sha256 per row."""

    def result(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
        listed = sorted((a, n, p) for a, n, p in runs)
        listed.sort(key=lambda r: (r[0], r[2]))
        best = min(listed, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{a},{n},{p}\n" for a, n, p in listed)
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return (len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(),
                hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest())

    return _each(docs, ["doc_id"], "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string", result)


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, period: one row per run."""
    found = _each(docs, ["doc_id"], "runs array<struct<start:long,length:long,period:long>>",
                  lambda words, found: ([{"start": a, "length": n, "period": p} for a, n, p in found],))
    return found.select("doc_id", F.inline("runs"))


def collapse(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each text with its runs cut to one period (words joined by one space; texts without runs as they are)."""
    place = docs.columns.index("text")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            out: list[bytes | None] = []
            for group, found in _passes(texts):
                for words, r in zip(group, found):
                    out.append(b" ".join(kept_words(words, r)) if r else texts[len(out)])
            columns = list(batch.columns)
            columns[place] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def plant_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text: every tenth row (by crc32 of its id) with a tail that repeats, as the registered query asks for.

    With h = crc32(doc_id) and g = h div 10, rows with h mod 10 = 0 get word
    a + (i - a) mod p in place i from a = g mod n on, p = 1 + (n - a) div (3 + g mod 8).
    A NULL id is left as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), f"[{SPACE}]+"), "")
    # The generator keeps the words from being split again for every use.
    once = F.inline(F.array(F.struct(F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))))
    n = F.size("w")
    picked = docs.select("doc_id", "text", once).withColumn("a", F.when(n > 0, F.col("g") % n))
    picked = picked.select("*", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p")))
    moved = F.transform(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1), lambda i: F.get(F.col("w"), place(i).cast("int")))
    return picked.select("doc_id", F.when(n > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))
