"""Size-aware heavy-light join: documents whose five-word shingle sets have a Jaccard similarity of at least 0.8.

Every set is ordered by one global order, rare shingles first (``heavy_tokens``).
Linked sets share tokens near the front of that order, and how this is used
depends on the size of the set:

* small sets enumerate all subsets of a fixed size of their front; two linked
  small sets have such a subset in common;
* large sets put their front into inverted lists, which are scanned; small sets
  within reach of a large one enter the lists too.

The boundary is the size at which the rows enumerated and scanned, estimated
from the sizes and list lengths of the whole corpus, are fewest.

A list is scanned as a star: every member is compared with the member whose
list token comes earliest, the most central one.  The components of the
confirmed links then leave few lists with members of different components, and
in these every remaining pair that the sizes and positions allow is compared.
No link between components can be missed, while a group of thousands of copies
costs thousands of comparisons, not millions.  Equal sets are one node from the
start.  Comparisons are exact, over the whole texts.

Which shingles are heavy only changes the order, never the result, so that table
may be bounded: it holds the MAX_HEAVY most frequent shingles.

Defined cases: NULL text, or text without words, has an empty set and is linked
with nothing; fewer than five words form one shingle; NULL ids are allowed (a
component's id is its smallest known id); repeated rows are members of one
component; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeshore.llm.common import materialise, released, small_batches, some_texts, text_list, unused
from lakeshore.llm.components import components

WORDS = 5
#: Similarity as a fraction: 4/5.
NUM, DEN = 4, 5
#: Size of the subsets that small sets enumerate.
SUBSET = 3
#: What comparing a candidate costs, in rows of a list (its text is moved and read).
COMPARE = 16.0
#: Sizes considered for the boundary between small and large.
MAX_BOUNDARY = 48
#: A shingle in more rows than this is heavy; at most MAX_HEAVY are kept (a broadcast of 12 bytes each).
HEAVY, MAX_HEAVY = 6, 1 << 20
#: Bits of the filter of wanted ids that is broadcast (8 MB whatever the corpus).
FILTER_BITS = 1 << 26
#: Rows emitted at a time by a task.
OUT_ROWS = 400_000

_M = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 3, 1 << 64) for k in range(WORDS)], np.uint64)
_S = [np.uint64(x) for x in (33, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> _S[0])) * _S[1]
    h = (h ^ (h >> _S[0])) * _S[2]
    return h ^ (h >> _S[0])


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of the text's shingles (A-Z lower-cased, ASCII white space between words)."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < WORDS:
        return mix((h * _M[:len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - WORDS + 1
    out = h[:n] * _M[0]
    for k in range(1, WORDS):
        out += h[k:k + n] * _M[k]
    return np.unique(mix(out))


def node_of(tokens: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def least_overlap(n: int) -> int:
    """Tokens that a set of n shares with any linked set."""
    return -(-NUM * n // DEN)


def linked(n: int, m: int, both: int) -> bool:
    return DEN * both >= NUM * (n + m - both) and both > 0


# -- sizes and frequencies ---------------------------------------------------------------------------------------------


def text_print() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("print")


def read_sets(docs: DataFrame, ranges: int) -> DataFrame:
    """One pass over the texts.  Rows of sets (doc_id, print, n, node) and rows of shingle counts (part, short, times).

    ``print`` is a fingerprint of the text: with the id it tells rows apart.

    A shingle is known by its range and 32 further bits; a task counts before it sends.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("print", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("part", pa.int32()), ("short", pa.binary()), ("times", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints, at = batch.column(0), batch.column(2), 0
            for texts in some_texts(batch.column(1), 2000):
                sets = [shingles(t) for t in texts]
                sizes, nodes = [len(s) for s in sets], [node_of(s) if len(s) else None for s in sets]
                part, short = _short(np.concatenate(sets) if sets else np.empty(0, np.uint64), ranges)
                both, times = np.unique((part.astype(np.uint64) << np.uint64(32)) | short, return_counts=True)
                part, edge = np.unique((both >> np.uint64(32)).astype(np.int32), return_index=True)
                edge = [*edge.tolist(), len(both)]
                low, times = both.astype(np.uint32), np.minimum(times, 0xFFFF).astype(np.uint16)
                mine = prints.slice(at, len(sets))
                columns = (pa.concat_arrays([mine, pa.nulls(len(part), mine.type)]), pa.array([*sizes, *[None] * len(part)], pa.int32()), pa.array([*nodes, *[None] * len(part)], pa.int64()),
                           pa.array([*[None] * len(sets), *part.tolist()], pa.int32()),
                           pa.array([*[None] * len(sets), *(low[i:j].tobytes() for i, j in zip(edge, edge[1:]))], pa.binary()),
                           pa.array([*[None] * len(sets), *(times[i:j].tobytes() for i, j in zip(edge, edge[1:]))], pa.binary()))
                own = ids.slice(at, len(sets))
                own = pa.concat_arrays([own, pa.nulls(len(part), own.type)])
                at += len(sets)
                yield pa.RecordBatch.from_arrays([own, *columns], names=["doc_id", *schema.names])

    rows = docs.select("doc_id", "text", text_print())
    return rows.mapInArrow(lambda b: released(run(b)), f"doc_id {kind}, print long, n int, node long, part int, short binary, times binary")


def _short(tokens: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range and 32-bit name of shingles."""
    return ((tokens >> np.uint64(32)) % np.uint64(ranges)).astype(np.int32), tokens & np.uint64(0xFFFFFFFF)


def token_counts(read: DataFrame) -> DataFrame:
    """Heavy shingles (part, short, times), and per range the rows and squared rows of the light lists."""

    def run(table: pa.Table) -> pa.Table:
        short = np.concatenate([np.frombuffer(b, np.uint32) for b in table.column("short").to_pylist()])
        times = np.concatenate([np.frombuffer(b, np.uint16) for b in table.column("times").to_pylist()])
        short, back = np.unique(short, return_inverse=True)
        total = np.bincount(back, times).astype(np.int64)
        heavy = total > HEAVY
        n, light = int(heavy.sum()), total[~heavy]
        part = table.column("part")[0].as_py()
        return pa.table({"part": pa.array([part] * (n + 1), pa.int32()), "short": pa.array([*short[heavy].tolist(), None], pa.int64()),
                         "times": pa.array([*total[heavy].tolist(), None], pa.int64()),
                         "light": pa.array([*[0] * n, int(light.sum())], pa.int64()),
                         "squares": pa.array([*[0] * n, int((light ** 2).sum())], pa.int64())})

    parts = read.where(F.col("part").isNotNull()).select("part", "short", "times")
    return parts.groupBy("part").applyInArrow(run, "part int, short long, times long, light long, squares long")


def heavy_tokens(counts: DataFrame) -> np.ndarray:
    """Names (part << 32 | short) of at most MAX_HEAVY heavy shingles, most frequent last."""
    heavy = counts.where(F.col("short").isNotNull())
    steps = heavy.groupBy(F.floor(F.log2("times") * 8).cast("int").alias("s")).count().collect()
    held, least = 0, 1 << 30
    for s, c in sorted(((r[0], r[1]) for r in steps), reverse=True):
        if held + c > MAX_HEAVY:
            break
        held, least = held + c, s
    if not held:
        return np.empty(0, np.uint64)
    got = heavy.where(F.floor(F.log2("times") * 8) >= least).select("part", "short", "times").toArrow()
    names = (got.column("part").to_numpy().astype(np.uint64) << np.uint64(32)) | got.column("short").to_numpy().astype(np.uint64)
    return names[np.lexsort((names, got.column("times").to_numpy()))]


def choose_boundary(sizes: dict[int, int], scan: float) -> int:
    """The largest size that counts as small, by the rows enumerated, listed and compared.

    ``sizes`` has the number of sets of each size up to beyond MAX_BOUNDARY / 0.8;
    ``scan`` is the mean number of other rows in the list of a light shingle, each
    a candidate; a shared subset that its positions allow is hardly ever more than a link.
    """
    def front(n: int) -> int:
        return n - least_overlap(n)

    def cost(boundary: int) -> float:
        small = sum(c * comb(front(n) + SUBSET, SUBSET) for n, c in sizes.items() if NUM <= n <= boundary)
        return small + sum(c * (front(n) + 1) * (1 + COMPARE * scan) for n, c in sizes.items() if n >= NUM and DEN * n > NUM * boundary)

    return min([0, *range(NUM, MAX_BOUNDARY + 1)], key=lambda b: (cost(b), b))


# -- keys --------------------------------------------------------------------------------------------------------------


class Fronts:
    """Keys of a set: subsets if it is small, list tokens if it is large or within reach of a large one."""

    def __init__(self, heavy: np.ndarray, ranges: int, boundary: int) -> None:
        order = np.argsort(heavy, kind="stable")
        self.names, self.rank = heavy[order], order.astype(np.uint64)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.names & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        self.ranges, self.boundary = ranges, boundary

    def ordered(self, tokens: np.ndarray) -> np.ndarray:
        """Tokens in the global order: light ones by value, then heavy ones by frequency."""
        level = tokens >> np.uint64(1)
        if len(self.names):
            part, short = _short(tokens, self.ranges)
            hit = np.flatnonzero(self.maybe[(short & np.uint64((1 << 22) - 1)).astype(np.int64)])
            if len(hit):
                names = (part[hit].astype(np.uint64) << np.uint64(32)) | short[hit]
                at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
                real = self.names[at] == names
                level[hit[real]] = (np.uint64(1) << np.uint64(63)) | self.rank[at[real]]
        return tokens[np.argsort(level, kind="stable")]

    def keys(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and, for each, the most tokens shared with a set whose first common tokens these are (an upper bound of the overlap)."""
        n = len(tokens)
        if n < NUM:  # linked with equal sets only, which are one node
            return np.empty(0, np.uint64), np.empty(0, np.int32)
        ranked = self.ordered(tokens)
        front = n - least_overlap(n)
        keys, reach = [], []
        if n <= self.boundary:
            chosen = np.array(list(combinations(range(front + SUBSET), SUBSET)))
            subsets = np.sort(ranked[chosen], axis=1)
            keys.append(mix((subsets * _M[:SUBSET]).sum(axis=1) + np.uint64(1)))
            # Linked sets meet at their first three common tokens; what else they share stands after the last of these.
            reach.append((SUBSET + n - 1 - chosen[:, -1]).astype(np.int32))
        if DEN * n > NUM * self.boundary:
            keys.append(ranked[:front + 1])
            reach.append(np.arange(n, n - front - 1, -1, dtype=np.int32))
        return np.concatenate(keys), np.concatenate(reach)


def list_rows(docs: DataFrame, fronts: Fronts) -> DataFrame:
    """(key, node, n, reach): every key of every set."""
    return _listed(docs, docs.sparkSession.sparkContext.broadcast(fronts))


def _listed(docs: DataFrame, shared: Broadcast) -> DataFrame:

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            keys, nodes, sizes, reach, held = [], [], [], [], 0
            for text in chain(chain.from_iterable(some_texts(batch.column(0))), [None]):
                if text is not None:
                    tokens = shingles(text)
                    k, r = known.keys(tokens)
                    if len(k):
                        keys.append(k.view(np.int64))
                        reach.append(r)
                        nodes.append(np.full(len(k), node_of(tokens), np.int64))
                        sizes.append(np.full(len(k), len(tokens), np.int32))
                        held += len(k)
                if held and (text is None or held >= OUT_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, sizes, reach)],
                                                     names=["key", "node", "n", "reach"])
                    keys, nodes, sizes, reach, held = [], [], [], [], 0

    return docs.select("text").mapInArrow(lambda b: released(run(b)), "key long, node long, n int, reach int")


# -- candidates and comparisons ------------------------------------------------------------------------------------------


def _possible(n: str, m: str, reach_n: str, reach_m: str) -> F.Column:
    """Sizes and positions still allow the similarity: DEN * o >= NUM * (n + m - o) for o = the smaller reach."""
    return (NUM + DEN) * F.least(reach_n, reach_m) >= NUM * (F.col(n) + F.col(m))


def star_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): every member of a list with the list's most central member."""
    centre = lists.groupBy("key").agg(F.min(F.struct((F.col("n") - F.col("reach")).alias("place"), "node", "n", "reach")).alias("c"))
    centre = centre.select("key", F.col("c.node").alias("a"), F.col("c.n").alias("m"), F.col("c.reach").alias("reach_m"))
    pairs = lists.join(centre, "key").where((F.col("node") != F.col("a")) & _possible("n", "m", "reach", "reach_m"))
    return pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def remaining_pairs(lists: DataFrame, roots: DataFrame, tested: DataFrame) -> DataFrame:
    """(a, b): all pairs of list members in different components that sizes and positions allow, but for those tested.

    A member whose reach does not even suffice for the list's smallest set, and a
    list left with one component, drop out before any pair is made.
    """
    named = lists.join(roots, "node", "left").select("key", "node", "n", "reach", F.coalesce("root", "node").alias("comp"))
    least = lists.groupBy("key").agg(F.min("n").alias("least"))
    able = named.join(least, "key").where((NUM + DEN) * F.col("reach") >= NUM * (F.col("n") + F.col("least"))).drop("least")
    able = materialise(able, "able")
    mixed = able.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    left = materialise(able.join(mixed, "key").distinct(), "left")
    other = left.select("key", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "reach", "comp")))
    pairs = left.join(other, "key").where((F.col("node") < F.col("node2")) & (F.col("comp") != F.col("comp2"))
                                          & _possible("n", "n2", "reach", "reach2"))
    return pairs.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")


def _wanted(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` that may have a key of ``keys`` (doc_id, print), by a filter of FILTER_BITS bits.

    Spares the shuffle of texts that no pair needs; the join that follows is exact.
    """
    bit = F.pmod(F.xxhash64("doc_id", "print"), F.lit(FILTER_BITS)) + 1
    bits = keys.select(bit.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("_bits"))
    # At most FILTER_BITS / 32768 rows of 4 KB.
    marked = docs.select("doc_id", "text", text_print()).select("*", bit.alias("_h")).withColumn("_bucket", F.bitmap_bucket_number("_h"))
    place = F.bitmap_bit_position("_h")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (place % 8).cast("int")) == 1
    return marked.join(F.broadcast(bits), "_bucket").where(hit).select("doc_id", "print", "text")


def confirm(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, by comparing the whole sets.

    One row stands for each set: of those with the smallest id the one with the
    smallest fingerprint, and of rows equal in both one text, so an id that
    repeats brings each pair of texts once.
    """
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    where = sets.where("n > 0").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "print")).alias("row"))
    where = materialise(where.join(nodes, "node").select("node", "row.doc_id", "row.print"), "where")
    texts = _wanted(docs, where).groupBy("doc_id", "print").agg(F.first("text").alias("text"))
    named = where.join(texts, where["doc_id"].eqNullSafe(texts["doc_id"]) & (where["print"] == texts["print"])).select("node", "text")
    first = pairs.join(named.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(named.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 500):
                for a, b, x, y in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)):
                    s, last = (last[1], last) if last[0] == (a, x) else (t := shingles(x or ""), ((a, x), t))
                    t = shingles(y or "")
                    # Fingerprints of texts that clash would bring another set along; it is no pair.
                    if node_of(s) == a and node_of(t) == b and linked(len(s), len(t), len(np.intersect1d(s, t, assume_unique=True))):
                        out.append((a, b))
            a, b = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return both.mapInArrow(lambda b: released(run(b)), "a long, b long").distinct()


def named_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, node (the shared name of equal sets), comp (one node of the component) for every row; NULL names for empty sets."""
    with small_batches(docs.sparkSession):
        return _named_sets(docs)


def _named_sets(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = materialise(read_sets(docs, ranges), "sets")
    sets = read.where(F.col("part").isNull()).select("doc_id", "print", "n", "node")
    counts = materialise(token_counts(read), "counts")
    light = counts.agg(F.sum("light"), F.sum("squares")).first()
    most = MAX_BOUNDARY * DEN // NUM + 1
    sizes = {r[0]: r[1] for r in sets.where(F.col("n") <= most).groupBy("n").count().collect()}
    boundary = choose_boundary(sizes, (light[1] or 0) / max(1, light[0] or 0) - 1 if light[0] else 0.0)
    fronts = spark.sparkContext.broadcast(Fronts(heavy_tokens(counts), ranges, boundary))
    rows = _listed(docs, fronts)
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    lists = materialise(rows.join(shared, "key"), "lists")
    fronts.unpersist()  # the lists are written; a lost executor would fetch it again

    tested = materialise(star_pairs(lists), "stars")
    links = materialise(confirm(docs, sets, tested), "links")
    roots = components(links)
    more = materialise(remaining_pairs(lists, roots, tested), "pairs")
    links = links.unionAll(materialise(confirm(docs, sets, more), "links"))
    roots = components(links)

    named = sets.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))
    return materialise(named.select("doc_id", "n", "node", "comp"), "named")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, set_id (the shared name of equal sets) for every row."""
    named = named_sets(docs)
    first = named.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    full = named.where("n > 0").join(first, "comp").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id",
                                                           F.col("node").alias("set_id"))
    empty = named.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                        F.lit(None).cast("long").alias("set_id"))
    return full.unionByName(empty)


def with_sets(docs: DataFrame, name: str) -> DataFrame:
    """All columns, and ``name``: the name of the row's set (NULL if empty)."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (shingles(t) for part in some_texts(batch.column(place)) for t in part)
            nodes = pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], names=[*batch.schema.names, name])

    return docs.mapInArrow(lambda b: released(run(b)), StructType([*docs.schema.fields, StructField(name, LongType())]))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns, and every row without a set.

    The row with the smallest known id stays; of several sets with that id the
    smallest named, and of repeated (id, set) rows the first by its columns.
    """
    full = named_sets(docs).where("n > 0")
    first = full.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "node")).alias("c"))
    stays = F.col("doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("node") == F.col("c.node"))
    fate = full.groupBy("doc_id", "node", "comp").agg(F.count(F.lit(1)).alias("times")).join(first, "comp")
    fate = materialise(fate.select("doc_id", "node", stays.alias("stays"), "times").where("not stays or times > 1"), "fate")
    again = materialise(fate.where("stays").select("doc_id", "node"), "again")

    name = unused(docs.columns, "_set")

    def same(rows: DataFrame, other: DataFrame):
        return rows["doc_id"].eqNullSafe(other["doc_id"]) & (rows[name] == other["node"])

    every = with_sets(docs, name)
    once = every.join(fate, same(every, fate), "left_anti")
    # Repeated rows: only texts under their ids are read as sets again.
    ids = again.select("doc_id").distinct()
    some = with_sets(docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi"), name)
    place = unused(some.columns, "_place")
    rank = F.row_number().over(Window.partitionBy("doc_id", name).orderBy("text", F.to_json(F.struct(*docs.columns))))
    one = some.join(again, same(some, again), "left_semi").withColumn(place, rank).where(F.col(place) == 1).drop(place)
    return once.unionByName(one).select(*docs.columns)
