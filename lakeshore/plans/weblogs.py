"""Web logs: text line -> bronze (parsed fields) -> silver (typed, enriched)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.logline import (
    CORRUPT_COL,
    parse_log_line,
    parse_log_timestamp,
    request_action,
    request_product_id,
)
from lakeshore.functions.useragent import device_label
from lakeshore.operators.geo import geo_lookup
from lakeshore.schemas import LOG_LINE_FIELDS, LOGS_COLUMNS


def _lit_or(value, default: Column) -> Column:
    if value is None:
        return default
    return value if isinstance(value, Column) else F.lit(value)


def parse_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines -> ten string fields + ``_corrupt_record`` (+ any other input columns); blank lines give no row.

    The parse is materialised once through a generator (``inline`` of a
    one-element array): without that barrier, predicate pushdown and the
    null filters inferred for joins copy the whole ``from_csv`` call into
    every filter conjunct, parsing each line several times.
    """
    others = [c for c in lines.columns if c != line_col]
    return lines.where(F.col(line_col).rlike(r"\S")).select(*others, F.inline(F.array(parse_log_line(F.col(line_col)))))


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT_COL).isNotNull()).select(F.col(CORRUPT_COL).alias("value"))


QUARANTINED = "_quarantined"


def bronze_logs(parsed: DataFrame, as_of=None, load_ts=None, keep_quarantine: bool = False) -> DataFrame:
    """Bronze: date and time tokens joined, load year and load timestamp stamped.

    ``as_of`` (a date) gives ``year``; default the current date.  With
    ``keep_quarantine`` every parsed line is kept and flagged: ``_corrupt_record``
    holds the text of a bad line and ``_quarantined`` marks it (the streaming
    bronze table partitions on it); otherwise pass good lines only.
    """
    year = F.year(_lit_or(as_of, F.current_date()).cast("date"))
    created = _lit_or(load_ts, F.current_timestamp()).cast("timestamp")
    extra = [F.col(CORRUPT_COL), F.col(CORRUPT_COL).isNotNull().alias(QUARANTINED)] if keep_quarantine else []
    return parsed.select(
        *LOG_LINE_FIELDS,
        year.cast("int").alias("year"),
        F.concat_ws(" ", "request_data", "request_time").alias("request_timestamp"),
        created.alias("created_dt"),
        *extra)


def silver_logs(bronze: DataFrame, geo_ranges: DataFrame) -> DataFrame:
    """Silver: timestamp parsed, device label, action and product from the path, country by IP.

    All column expressions; the only join is the bucketed range join to the
    (bounded) geo table.  Works on a stream as well as a batch.
    """
    df = bronze.select(
        "ip_address", "request", "status_code", "year",
        device_label(F.col("user_agent")).alias("user_agent"),
        parse_log_timestamp(F.col("request_timestamp")).alias("request_timestamp"),
        request_product_id(F.col("request")).alias("product_id"),
        request_action(F.col("request")).alias("action"))
    df = geo_lookup(df, geo_ranges, ip_col="ip_address", out_col="country")
    return df.select(*LOGS_COLUMNS)


def logs_from_lines(lines: DataFrame, geo_ranges: DataFrame, as_of=None, load_ts=None) -> DataFrame:
    """Whole batch path: lines -> silver logs (bad lines dropped; see ``bad_lines``)."""
    return silver_logs(bronze_logs(good_lines(parse_lines(lines)), as_of, load_ts), geo_ranges)
