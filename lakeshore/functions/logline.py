"""Combined-log lines: format, parse, and the fields the silver table derives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeshore.schemas import LOG_LINE_FIELDS

# The line layout and the bracketed time format of the logs.
# ip - user [dd/MM/yyyy HH:mm:ss] "GET /{action}/{product_id}" status bytes - "agent"
LOG_LINE_FORMAT = '%s - %s %s "GET /%s/%s" %s %s - "%s"'
# Brackets are quoted: bare [ ] mean "optional section" to Spark's parser.
LOG_TIME_PATTERN = "'['dd/MM/yyyy HH:mm:ss']'"

CORRUPT_COL = "_corrupt_record"
_PARSE_DDL = ", ".join(f"{c} string" for c in LOG_LINE_FIELDS) + f", {CORRUPT_COL} string"
_PARSE_OPTS = {
    "sep": " ",
    "quote": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COL,
}


def format_log_line(ip, user, ts, action, product_id, status, nbytes, agent) -> Column:
    """Build one log line from columns (``ts`` is a timestamp column)."""
    when = F.date_format(ts, LOG_TIME_PATTERN)
    return F.format_string(LOG_LINE_FORMAT, ip, user, when, action, product_id,
                           status, nbytes, agent)


def parse_log_line(line) -> Column:
    """Line -> struct of the ten log fields plus ``_corrupt_record``.

    ``_corrupt_record`` is set (to the line) when the line does not split into
    the ten fields; quarantine on it.  Options are passed, so the optimizer
    does not prune the parse schema, and the flag stays exact whatever the
    downstream projection.
    """
    col = F.col(line) if isinstance(line, str) else line
    return F.from_csv(col, _PARSE_DDL, _PARSE_OPTS)


def parse_log_timestamp(c) -> Column:
    """``'[04/11/2022 10:11:12]'`` -> timestamp; malformed -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(col, F.lit(LOG_TIME_PATTERN))


def request_action(request) -> Column:
    """``'GET /product/123'`` -> ``'product'``; no ``/`` -> NULL."""
    col = F.col(request) if isinstance(request, str) else request
    return F.get(F.split(col, "/"), F.lit(1))


def request_product_id(request) -> Column:
    """Third path part, only when the request names a product (login -> NULL)."""
    col = F.col(request) if isinstance(request, str) else request
    return F.when(col.contains("product"), F.get(F.split(col, "/"), F.lit(2)))
