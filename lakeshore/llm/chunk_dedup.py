"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text without its white space is cut where its own content says so (a run of
letters of one class, between 1,024 and 4,096 characters), so equal texts give
equal chunks wherever they stand.  Chunks are deduplicated to identifiers, each
verified by three independent fingerprints (SHA-256, xxHash64, length); a
document becomes its recipe, the ordered list of identifiers, and two documents
are equal when their recipes are.  Texts are read once and never shuffled: only
fingerprints move.  The group's figures are partial aggregates joined back, so
a group holding a third of all rows is never gathered in a task.

Defined cases: NULL text counts as empty; all empty texts are one group; among
equal texts with equally many code points the smallest doc_id stays (NULL ids
last); of repeated (doc_id, text) rows exactly one stays; other columns of the
input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import SPACE, materialise, unused

#: A chunk ends after nine letters of this class, at least MIN and at most MAX characters long.
BOUNDARY = "[acegikmoqsuwy13579]{9}"
MIN_CHARS, MAX_CHARS = 1024, 4096
CHUNK = rf"(?s).{{{MIN_CHARS},{MAX_CHARS}}}?(?<={BOUNDARY})|.{{1,{MAX_CHARS}}}"


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row per chunk of each row: (rid, doc_id, n_chars, text_sha, pos, digest, weak, len).

    A row without characters keeps one row with NULL chunk columns.  ``rid`` is
    fixed by the write that follows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    norm = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"),
                       F.char_length(text).alias("n_chars"),
                       F.regexp_replace(text, f"[{SPACE}]+", "").alias("norm"))
    cut = norm.select("rid", "doc_id", "n_chars", F.unhex(F.sha2("norm", 256)).alias("text_sha"),
                      F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0)).alias("chunks"))
    rows = cut.select("rid", "doc_id", "n_chars", "text_sha", F.posexplode_outer("chunks").alias("pos", "chunk"))
    return rows.select("rid", "doc_id", "n_chars", "text_sha", "pos",
                       F.unhex(F.sha2("chunk", 256)).alias("digest"),
                       F.when(F.col("chunk").isNotNull(), F.xxhash64("chunk")).alias("weak"),
                       F.char_length("chunk").alias("len"))


def recipes(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, n_chars, text_sha, recipe): the ordered list of verified chunk identifiers of each row."""
    chunks = materialise(chunk_table(docs), "chunks")
    key = ["digest", "weak", "len"]
    # One identifier per distinct content: the place where it first occurs.
    dictionary = (chunks.where(F.col("digest").isNotNull()).groupBy(*key)
                  .agg(F.min(F.struct("rid", "pos")).alias("chunk_id")))
    named = chunks.join(dictionary, key, "left")
    whole = named.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.first("text_sha").alias("text_sha"),
        F.array_sort(F.collect_list(F.when(F.col("chunk_id").isNotNull(), F.struct("pos", "chunk_id")))).alias("list"))
    return whole.withColumn("recipe", F.transform("list", lambda x: x["chunk_id"])).drop("list")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialise(recipes(docs), "recipes")
    rank = F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"),
                    F.col("doc_id").alias("c"), F.col("rid").alias("d"))
    groups = rows.groupBy("recipe", "text_sha").agg(F.count(F.lit(1)).alias("group_size"), F.min(rank).alias("best"))
    joined = rows.join(groups, ["recipe", "text_sha"])
    return joined.select("doc_id", F.col("best.c").alias("keep_id"), "group_size",
                         (F.col("rid") == F.col("best.d")).alias("kept"),
                         F.lower(F.hex("text_sha")).alias("text_sha256"), F.col("n_chars").alias("n_text_chars"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    Rows are told apart by (doc_id, text fingerprint, length); where even these
    repeat, one row stays.
    """
    key = [unused(docs.columns, name) for name in ("copy_id", "copy_sha", "copy_len")]
    kept, rows = unused(docs.columns, "copy_kept"), unused(docs.columns, "copy_rows")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    groups = materialise(exact_groups(docs), "groups").select(name.alias(key[0]), F.col("text_sha256").alias(key[1]),
                                                              F.col("n_text_chars").alias(key[2]), F.col("kept").alias(kept))
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.select("*", name.alias(key[0]), F.sha2(F.regexp_replace(text, f"[{SPACE}]+", ""), 256).alias(key[1]),
                         F.char_length(text).alias(key[2]))
    per_key = groups.groupBy(*key).agg(F.max(kept).alias(kept), F.count(F.lit(1)).alias(rows))
    out = marked.join(per_key.where(kept).drop(kept), key)
    once = out.where(F.col(rows) == 1).select(docs.columns)
    repeated = out.where(F.col(rows) > 1).dropDuplicates(key).select(docs.columns)
    return once.unionByName(repeated)
