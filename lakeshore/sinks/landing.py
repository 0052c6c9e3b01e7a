"""Landing raw files: order documents as JSON, log lines as text, under dated folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land_order_documents(docs: DataFrame, path: str, record_dt) -> None:
    """Write documents as JSON lines under ``year=YYYY/record_dt=YYYY-MM-DD/``.

    The files are gzipped (readers go by their ending).  Each output line is one order object; the reader accepts this and the
    one-array-per-file form alike.  Re-landing a day replaces that day only.
    """
    day = F.lit(record_dt).cast("date")
    out = docs.select("*", F.year(day).cast("string").alias("year"),
                      F.date_format(day, "yyyy-MM-dd").alias("record_dt"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
        .partitionBy("year", "record_dt").json(path))


def land_log_lines(lines: DataFrame, path: str, record_dt, line_col: str = "value") -> None:
    """Write text lines under ``year=YYYY/record_dt=YYYY-MM-DD/``."""
    day = F.lit(record_dt).cast("date")
    out = lines.select(F.col(line_col).alias("value"), F.year(day).cast("string").alias("year"),
                       F.date_format(day, "yyyy-MM-dd").alias("record_dt"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "record_dt").text(path))
