"""Quarantine with reasons, and replay of corrected records.

Every record is tagged, in the pass that parses it, with the list of all rules
it violates.  Records without a reason go on; the others are kept in a merged
table, one row per record text, until a corrected text has been replayed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.functions.ip import ipv4_to_long
from lakeshore.functions.logline import CORRUPT_COL, parse_log_timestamp
from lakeshore.operators.upsert import has_table, merge_into, read_table
from lakeshore.plans.weblogs import parse_lines
from lakeshore.schemas import ORDER_DOC

REASONS, RECORD = "_reasons", "record_id"
OPEN, REPLAYED = "open", "replayed"


def _reasons(rules: dict[str, Column]) -> Column:
    """Names of the rules that hold (NULL does not), in the order given."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))


def tag_log_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Parsed log lines with their text (``line_col``) and ``_reasons``; blank lines give no row.

    ``bad_line``: not ten fields (no other rule is looked at then); ``bad_time``,
    ``bad_address`` (neither IPv4 nor written like IPv6), ``bad_status`` (not
    three digits).
    """
    parsed = parse_lines(lines.withColumn("_text", F.col(line_col)), line_col).withColumnRenamed("_text", line_col)
    whole = F.col(CORRUPT_COL).isNull()
    when = parse_log_timestamp(F.concat_ws(" ", "request_data", "request_time"))
    address = ipv4_to_long("ip_address").isNotNull() | F.contains("ip_address", F.lit(":"))
    rules = {"bad_line": ~whole, "bad_time": whole & when.isNull(),
             "bad_address": whole & ~F.coalesce(address, F.lit(False)),
             "bad_status": whole & ~F.coalesce(F.col("status_code").rlike("^[0-9]{3}$"), F.lit(False))}
    return parsed.withColumn(REASONS, _reasons(rules))


def tag_order_lines(lines: DataFrame, load_date=None, line_col: str = "value", schema: T.StructType = ORDER_DOC) -> DataFrame:
    """Order documents of landed lines with their text (``value``) and ``_reasons``; other columns stay.

    A line is a JSON array of documents or one document, as in
    ``files.parse_order_lines``; blank lines give no row.  ``bad_json``: no JSON
    object (no other rule is looked at then); ``no_key``; ``bad_field:<name>``:
    a value that does not convert to the field's type; ``bad_time``: no order
    time can be read; ``repeated_item``: two items of one product.
    """
    others = [c for c in lines.columns if c != line_col]
    text = F.trim(F.col(line_col))
    documents = F.coalesce(F.when(text.startswith("["), F.from_json(text, "array<string>")), F.array(text))
    parsed = lines.where(text != "").select(*others, F.inline(F.transform(documents, lambda e: F.struct(
        e.alias("value"), F.from_json(e, schema).alias("s"), F.from_json(e, "map<string,string>").alias("m")))))
    whole = F.col("m").isNotNull()
    products = F.filter(F.transform(F.col("s.items"), lambda i: i["product_id"]), lambda p: p.isNotNull())
    rules = {"bad_json": ~whole, "no_key": whole & F.col("s.order_id").isNull()}
    rules |= {f"bad_field:{c}": whole & F.col("m")[c].isNotNull() & F.col("s")[c].isNull() for c in schema.names}
    rules["bad_time"] = whole & F.try_to_timestamp(F.col("s.order_dt")).isNull()
    rules["repeated_item"] = whole & (F.size(F.array_distinct(products)) < F.size(products))
    stamp = F.current_date() if load_date is None else F.lit(load_date).cast("date")
    extra = F.map_filter("m", lambda k, v: ~k.isin(*schema.names))
    return parsed.select(*others, "value", *[F.col("s")[c].alias(c) for c in schema.names],
                         F.when(F.size(extra) > 0, F.to_json(extra)).alias("_rescued_data"),
                         stamp.alias("record_timestamp"), _reasons(rules).alias(REASONS))


def clean(tagged: DataFrame) -> DataFrame:
    """The records that violate no rule."""
    return tagged.where(F.size(REASONS) == 0).drop(REASONS, "value")


def record_id(value: str | Column = "value") -> Column:
    """The identity of a record: the hash of its text."""
    return F.sha2(value, 256)


def keep_quarantined(spark: SparkSession, path: str, tagged: DataFrame, batch_id: int | str) -> None:
    """Keep the records that violate a rule in the quarantine table at ``path``.

    One row per record text: ``record_id``, ``value``, ``reasons``, ``status``
    and ``replayed_in``.  A text that was replayed before stays so when the source sends it again.
    """
    bad = tagged.where(F.size(REASONS) > 0).select(
        record_id().alias(RECORD), "value", F.col(REASONS).alias("reasons"), F.lit(OPEN).alias("status"),
        F.lit(None).cast("string").alias("replayed_in"))
    if has_table(spark, path):
        done = read_table(spark, path, [RECORD]).where(F.col("status") == REPLAYED)
        bad = bad.join(done.select(RECORD), RECORD, "left_anti")
    merge_into(spark, path, bad, [RECORD], f"in-{batch_id}", order_by=["value"], count_changes=False)


def replay_orders(spark: SparkSession, path: str, corrections: DataFrame, table_path: str, keys: Sequence[str], batch_id: int | str,
                  load_date=None, order_by: Sequence[str | Column] = ("record_timestamp",)) -> None:
    """Merge corrected order records into the table at ``table_path``, each record once.

    ``corrections``: (``record_id`` of the quarantined text, ``value`` the new
    text).  Records that are not in quarantine, or were replayed by an earlier
    batch, are passed over.  A correction that still violates a rule leaves its
    record open, with the rules it violates now.  Several corrections of one
    record in a batch are all tagged, and one that violates a rule holds the record back.
    A batch repeated under its id leaves the same tables.
    """
    kept = read_table(spark, path, [RECORD])
    mine = kept.where((F.col("status") == OPEN) | (F.col("replayed_in") == F.lit(str(batch_id))))
    sent = corrections.select(RECORD, "value").join(mine.select(RECORD), RECORD, "left_semi")
    # Parsed once for the reasons and both merges.
    tagged = tag_order_lines(sent, load_date).persist()
    try:
        violated = (tagged.select(RECORD, F.explode_outer(REASONS).alias("r")).groupBy(RECORD)
                          .agg(F.array_sort(F.collect_set("r")).alias("reasons")))
        good = tagged.join(violated.where(F.size("reasons") == 0), RECORD, "left_semi")
        merge_into(spark, table_path, clean(good).drop(RECORD), keys, f"replay-{batch_id}", order_by=order_by, count_changes=False)
        fixed = F.size("reasons") == 0
        rows = mine.select(RECORD, "value", F.col("reasons").alias("_before")).join(violated, RECORD).select(
            RECORD, "value", F.when(fixed, F.col("_before")).otherwise(F.col("reasons")).alias("reasons"),
            F.when(fixed, REPLAYED).otherwise(OPEN).alias("status"), F.when(fixed, F.lit(str(batch_id))).alias("replayed_in"))
        merge_into(spark, path, rows, [RECORD], f"replay-{batch_id}", order_by=["value"], count_changes=False)
    finally:
        tagged.unpersist()
