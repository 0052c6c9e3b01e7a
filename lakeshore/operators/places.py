"""Rows picked by their place in the files they were read from.

What decides about a row (its keys) is shuffled with the row's place, the file's
fingerprint and the row's number in it; the decision comes back as bitmaps of
32,768 rows each, and the rows, however wide, are filtered where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE, ROW = "_file", "_row"
#: Bitmaps (4 KB each) up to which they are broadcast; with more of them the rows are joined by a shuffle.
BROADCAST_BITMAPS = 32_768


def placed(read: DataFrame) -> DataFrame:
    """The columns of ``read``, which comes straight from Parquet files, and FILE and ROW."""
    return read.select("*", F.xxhash64("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def bitmaps(places: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(``by``..., FILE, _chunk, _bits) of rows with FILE and ROW."""
    at = F.col(ROW) + 1
    return places.groupBy(*by, FILE, F.bitmap_bucket_number(at).alias("_chunk")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits"))


def _marked(rows: DataFrame, bits: DataFrame, n: int, how: str) -> tuple[DataFrame, Column]:
    chunked = rows.withColumn("_chunk", F.bitmap_bucket_number(F.col(ROW) + 1))
    place = F.bitmap_bit_position(F.col(ROW) + 1)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (place % 8).cast("int")) == 1
    return chunked.join(F.broadcast(bits) if n <= BROADCAST_BITMAPS else bits, [FILE, "_chunk"], how), hit


def at_places(rows: DataFrame, bits: DataFrame, n: int) -> DataFrame:
    """The placed ``rows`` that ``bits`` (of ``n`` bitmaps) mark."""
    marked, hit = _marked(rows, bits, n, "inner")
    return marked.where(hit).select(*rows.columns)


def but_places(rows: DataFrame, bits: DataFrame, n: int) -> DataFrame:
    """The placed ``rows`` that ``bits`` (of ``n`` bitmaps) don't mark."""
    marked, hit = _marked(rows, bits, n, "left")
    return marked.where(~F.coalesce(hit, F.lit(False))).select(*rows.columns)
