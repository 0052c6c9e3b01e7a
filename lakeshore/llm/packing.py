"""Order-preserving packing of documents into token windows by dynamic programming.

Documents stay in input order.  Each task reads its partition as a stream and
holds one segment of tokens; a dynamic program over the segment's possible cuts
(document ends, sentence ends, and a grid inside longer sentences) minimises padding plus a penalty per truncated document.  The best
predecessor of a cut lies in a sliding range, so a monotone queue finds it in
amortised constant time.  All but the last window of a segment are committed;
the rest is carried into the next segment.  Nothing is shuffled.

Defined cases: NULL or empty text is the end id alone; a NULL doc_id is kept as
NULL; repeated rows are packed each on its own; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import text_list
from lakeshore.llm.tokens import TOKENIZER_DIR, byte_bpe

WINDOW = 2048
END_ID = 1
#: Costs in padded tokens: a cut at a sentence end, a cut inside a sentence, and a window as such.
SENTENCE_CUT, HARD_CUT, PER_WINDOW = 12.0, 128.0, 4.0
#: Tokens planned at a time.
SEGMENT = 1 << 18
#: Distance of the possible cuts inside a sentence.
GRID = 128

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long, padding long")


def padding(n: int, window: int = WINDOW) -> int:
    """Padded tokens of a window holding ``n``: none at a power of two."""
    return 0 if n & (n - 1) == 0 else window - n


def plan_cuts(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Indices into ``places`` of the cheapest cuts.

    ``places`` ascends from 0 in steps of at most ``window``; ``penalty`` is the
    cost of cutting there.  Cost of a window: its padding, the penalty of its
    end, PER_WINDOW.  f(j) = min over i of f(i) + cost(i, j); for plain windows
    f(i) + places[i] is what a predecessor costs, kept ascending in the queue.
    """
    n = len(places)
    ends, starts = [], []
    size = 1
    while size <= window:
        at = np.searchsorted(places, places - size)
        hit = np.flatnonzero(places >= size)
        hit = hit[places[at[hit]] == places[hit] - size]
        ends.append(hit)
        starts.append(at[hit])
        size *= 2
    end = np.concatenate(ends)
    # Windows of an exact size that end at j: before[first[j]:first[j + 1]].
    before = np.concatenate(starts)[np.argsort(end, kind="stable")].tolist()
    first = np.concatenate([[0], np.cumsum(np.bincount(end, minlength=n))]).tolist()
    where, fine = places.tolist(), (penalty + PER_WINDOW).tolist()
    f, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])
    for j in range(1, n):
        here = where[j]
        low = here - window
        while queue[0][2] < low:
            queue.popleft()
        best, i, _ = queue[0]
        best -= low
        a, b = first[j], first[j + 1]
        if a < b:
            for k in before[a:b]:
                if f[k] < best:
                    best, i = f[k], k
        best += fine[j]
        f[j], back[j] = best, i
        entry = best + here
        while queue and queue[-1][0] >= entry:
            queue.pop()
        queue.append((entry, j, here))
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def _candidates(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a segment and their penalties; the segment's two ends are free."""
    cost = np.full(len(ids) + 1, np.inf)
    cost[1:][sentence_end[ids]] = SENTENCE_CUT
    cost[doc_ends] = 0.0
    cost[[0, len(ids)]] = 0.0
    places = np.flatnonzero(np.isfinite(cost))
    for k in np.flatnonzero(np.diff(places) > min(GRID, window)).tolist():
        inside = np.arange(places[k] + min(GRID, window), places[k + 1], min(GRID, window))
        cost[inside] = HARD_CUT
    places = np.flatnonzero(np.isfinite(cost))
    return places, cost[places]


class Packer:
    """Plans one partition's stream of documents."""

    def __init__(self, sentence_end: np.ndarray, first_sequence: int, window: int = WINDOW, segment: int = SEGMENT) -> None:
        self.ends, self.sequence, self.window, self.segment = sentence_end, first_sequence, window, segment
        self.docs: list[tuple] = []  # (doc_id, start of this part, tokens of the document, ids)
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        for at in range(0, len(ids), self.segment):
            part = ids[at:at + self.segment]
            self.docs.append((doc_id, at, len(ids), part))
            self.held += len(part)
            if self.held >= self.segment:
                yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        ids = np.concatenate([d[3] for d in self.docs])
        ends = np.cumsum([len(d[3]) for d in self.docs])
        real = np.array([e for e, d in zip(ends.tolist(), self.docs) if d[1] + len(d[3]) == d[2]], int)
        places, cost = _candidates(ids, real, self.ends, self.window)
        cuts = [0, *places[plan_cuts(places, cost, self.window)].tolist()]
        if not last and len(cuts) > 2:
            cuts.pop()
        begins = [0, *ends.tolist()]
        k = 0
        for low, high in zip(cuts, cuts[1:]):
            at = low
            while at < high:
                while begins[k + 1] <= at:
                    k += 1
                to = min(high, begins[k + 1])
                doc_id, start, total, _ = self.docs[k]
                yield (doc_id, start + at - begins[k], to - at, zlib.crc32(ids[at:to].tobytes()), total, self.sequence,
                       at - low, high - low, padding(high - low, self.window))
                at = to
            self.sequence += 1
        done, rest = cuts[-1], []
        for b, e, (doc_id, start, total, part) in zip(begins, begins[1:], self.docs):
            if e > done:
                skip = max(0, done - b)
                rest.append((doc_id, start + skip, total, part[skip:]))
        self.docs, self.held = rest, len(ids) - done


def pack(docs: DataFrame, tokenizer_dir: str = TOKENIZER_DIR, window: int = WINDOW) -> DataFrame:
    """Pieces of the packed documents; a sequence's id is its partition (high bits) and place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_dir)
        packer = Packer(bpe.sentence_end, TaskContext.get().partitionId() << 36, window)
        end = np.array([END_ID], "<u4")
        arrow = _arrow()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), text_list(batch.column(1))):
                rows += packer.add(doc_id, np.concatenate([bpe.ids(text), end]))
            yield _batch(rows, arrow)
        yield _batch(list(packer.flush(True)), arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def _arrow() -> pa.Schema:
    return pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)
