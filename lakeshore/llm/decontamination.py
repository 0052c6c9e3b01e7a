"""Benchmark decontamination by a broadcast hash set of n-grams (DataFrame functions only).

A benchmark item's windows are its runs of WINDOW consecutive normalised words
(an item with fewer words is one window).  Of a window that occurs in a document
the first block of B words that starts at a multiple of B, with
B = (window words + 1) / 2, lies wholly inside it.  So a document is scanned
only at its own multiples of B: the hash of each such block is looked up in a
broadcast table of the blocks of all windows, and a match is verified by
comparing all words of the window with the document's.  Every occurrence is
found exactly once.  The scan reads each text once and moves only hits and one
marker row per document; texts are neither shuffled nor written.

The block table's bytes are measured.  Beyond BROADCAST_BYTES it is dealt to
several tables, each under the bound, and the documents are scanned once per
table (documents are then written once, to fix their row numbers).

Defined cases: NULL or empty text has no words and no hits; items without words
have no windows; rows with the same item_id are one item, NULL ids are one item
listed as empty text; repeated rows and NULL doc_ids keep a row each; an empty
table on either side gives documents without hits, or no rows; other columns
are ignored (and kept by ``drop_spans`` and ``drop_documents``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import materialise, unused

#: Consecutive words of a window.
WINDOW = 10
#: What stands between two words: every ASCII character but a-z and 0-9 (A-Z are lower-cased before).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Most bytes of one broadcast table of blocks.
BROADCAST_BYTES = 64 << 20
#: Bytes of a block's row besides its words, as counted against the bound.
ROW_BYTES = 128


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, gram): the distinct windows of each item, as arrays of words."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("w"))
    words = words.where(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))))
    return words.select("item", "w", start.alias("at")).select("item", F.slice("w", F.col("at"), size).alias("gram")).distinct()


def _block(length):
    """Words of a block of a window of so many words (a number or a column)."""
    return F.floor((length + 1) / 2).cast("int") if isinstance(length, Column) else (length + 1) // 2


def _hash_at(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(words, at + k) for k in range(size)))


def block_table(grams: DataFrame, lengths: list[int]) -> DataFrame:
    """(h, shift, gram_id, gram): each block of each window that can be the first one on the grid, ``shift`` words into it."""
    sides = []
    for size in lengths:
        b = _block(size)
        of_size = grams.where(F.size("gram") == size).select("gram_id", "gram", F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("shift"))
        sides.append(of_size.select(_hash_at(F.col("gram"), F.col("shift"), b).alias("h"), "shift", "gram_id", "gram"))
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return out


def _blocks_of(words: Column, sizes: list[int]) -> Column:
    """array<struct<j, h>>: the document's blocks on the grid, and a marker (j = -1 - words)."""
    n = F.size(words)
    none = F.array().cast("array<struct<j:int,h:bigint>>")

    def grid(b: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.floor(n / b).cast("int") - 1),
                           lambda k: F.struct((k * b).alias("j"), _hash_at(words, k * b, b).alias("h")))
        return F.when(n >= b, each).otherwise(none)

    return F.concat(F.array(F.struct((-1 - n).alias("j"), F.lit(0).cast("bigint").alias("h"))), *map(grid, sizes))


def _scan(base: DataFrame, rid: str, table: DataFrame | None, sizes: list[int]) -> DataFrame:
    """(rid, doc_id, n_words, start, length, gram_id): a marker row (start NULL) for each document, and its verified hits."""
    split = base.select(F.col(rid).alias("rid"), "doc_id", words_of(F.col("text")).alias("w"))
    none = F.lit(None).cast("bigint")
    if table is None:
        return split.select("rid", "doc_id", F.size("w").alias("n_words"), F.lit(None).cast("int").alias("start"),
                            F.lit(None).cast("int").alias("length"), none.alias("gram_id"))
    marker = table.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("shift"), F.lit(-1).cast("bigint").alias("gram_id"),
                                                F.array().cast("array<string>").alias("gram"))
    rows = split.select("rid", "doc_id", "w", F.explode(_blocks_of(F.col("w"), sizes)).alias("b"))
    rows = rows.select("rid", "doc_id", "w", F.col("b.j").alias("j"), F.col("b.h").alias("h"))
    start, size = F.col("j") - F.col("shift"), F.size("gram")
    verified = (F.col("gram_id") >= 0) & (start >= 0) & (F.slice(F.col("w"), F.greatest(start, F.lit(0)) + 1, F.greatest(size, F.lit(1))) == F.col("gram"))
    found = rows.join(F.broadcast(table.unionByName(marker).withColumnRenamed("h", "bh")),
                      (F.col("h") == F.col("bh")) & F.when(F.col("j") < 0, F.col("gram_id") < 0).otherwise(verified))
    hit = F.col("j") >= 0
    return found.select("rid", "doc_id", F.when(~hit, -1 - F.col("j")).alias("n_words"), F.when(hit, start).cast("int").alias("start"),
                        F.when(hit, size).alias("length"), F.when(hit, F.col("gram_id")).alias("gram_id"))


def find_hits(docs: DataFrame, rid: str, benchmark: DataFrame, size: int = WINDOW, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(marker and hit rows, (gram_id, item) pairs), both written; ``docs`` has row numbers in ``rid``."""
    pairs = materialise(windows(benchmark, size), "bench-windows")
    grams = materialise(pairs.select("gram").distinct().select(F.monotonically_increasing_id().alias("gram_id"), "gram"), "bench-grams")
    per_length = grams.groupBy(F.size("gram").alias("n")).agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.octet_length(F.array_join("gram", " "))).alias("bytes")).collect()  # a row per window length
    lengths = sorted(r["n"] for r in per_length)
    total = sum(_block(r["n"]) * (r["bytes"] + ROW_BYTES * r["c"]) for r in per_length)
    parts = max(1, -(-total // limit))
    sizes = sorted({_block(n) for n in lengths})
    if parts == 1:
        hits = materialise(_scan(docs, rid, block_table(grams, lengths) if lengths else None, sizes), "hits")
    else:
        docs = materialise(docs.select(rid, "doc_id", "text"), "numbered")
        part = lambda k: grams.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == k)
        for k in range(parts):
            found = _scan(docs, rid, block_table(part(k), lengths), sizes)
            found = materialise(found if k == 0 else found.where(F.col("gram_id").isNotNull()), "hits")
            hits = found if k == 0 else hits.unionByName(found)
    items = pairs.join(grams, "gram").select("gram_id", "item")
    return hits, materialise(items, "bench-items")


def _covered(spans: Column) -> Column:
    """Words in the union of (start, length) spans, by one fold over the sorted spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["length"]
        return F.struct((acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], s["start"]))).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["n"])


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    rid = unused(docs.columns, "row_number")
    return docs.withColumn(rid, F.monotonically_increasing_id()), rid


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    base, rid = _numbered(docs)
    hits, items = find_hits(base, rid, benchmark, size, limit)
    hit = F.col("start").isNotNull()
    span = F.when(hit, F.struct("start", "length"))
    per_doc = hits.groupBy("rid").agg(F.max(F.struct(F.coalesce("n_words", F.lit(-1)).alias("n"), F.col("doc_id").alias("id"))).alias("m"),
                                      F.collect_set(span).alias("spans"))
    named = hits.where(hit).select("rid", "gram_id").distinct().join(items, "gram_id").select("rid", "item").distinct()
    per_doc_items = named.groupBy("rid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = per_doc.join(per_doc_items, "rid", "left")
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return out.select(F.col("m.id").alias("doc_id"), F.col("m.n").cast("bigint").alias("n_words"), _covered(F.col("spans")).cast("bigint").alias("n_hit"),
                      F.size(listed).cast("bigint").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
                      (F.size("spans") > 0).alias("contaminated"))


def _spans(docs: DataFrame, benchmark: DataFrame, size: int) -> tuple[DataFrame, str, DataFrame]:
    """(written documents with row numbers, the number's name, (rid, hit_spans) of the contaminated ones)."""
    base, rid = _numbered(docs)
    base = materialise(base, "numbered")
    hits, _ = find_hits(base, rid, benchmark, size)
    spans = hits.where(F.col("start").isNotNull()).groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("hit_spans"))
    return base, rid, spans.withColumnRenamed("rid", rid)


def drop_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit."""
    base, rid, spans = _spans(docs, benchmark, size)
    return base.join(spans.select(rid), rid, "left_anti").select(docs.columns)


def drop_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """All rows of ``docs``, the hit words (with what stands before each) cut out of ``text``."""
    base, rid, spans = _spans(docs, benchmark, size)
    name = unused(base.columns, "hit_spans")
    hit = base.join(spans.withColumnRenamed("hit_spans", name), rid, "left")
    # Cut positions in the text: split() at the gaps and at the words gives both lists in turn.
    text, inside = F.col("text"), r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    gaps = F.split(text, inside)
    words = F.array_remove(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")
    merged = F.aggregate(F.col(name), F.array().cast("array<struct<start:int,end:int>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                                                    F.greatest(F.element_at(acc, -1)["end"], s["start"] + s["length"]).alias("end"))))
    ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), (s["start"] + s["length"]).alias("end"))))))
    part = lambda a, b: F.array_join(F.transform(
        F.sequence(a, b - 1), lambda i: F.concat(F.get(gaps, i), F.get(words, i))), "")
    bounds = F.concat(F.array(F.lit(0)), F.flatten(F.transform(merged, lambda s: F.array(s["start"], s["end"]))), F.array(F.size(words)))
    pieces = F.transform(F.sequence(F.lit(0), F.size(bounds) - 1, F.lit(2)), lambda k: F.when(
        F.get(bounds, k) < F.get(bounds, k + 1), part(F.get(bounds, k), F.get(bounds, k + 1))).otherwise(F.lit("")))
    cut = F.concat(F.array_join(pieces, ""), F.element_at(gaps, -1))
    return hit.withColumn("text", F.when(F.col(name).isNull(), text).otherwise(cut)).select(docs.columns)
