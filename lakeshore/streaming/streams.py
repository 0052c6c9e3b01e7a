"""Structured Streaming jobs: landed files -> bronze -> silver.

* Triggers: ``availableNow`` drains what is there in bounded micro-batches
  and stops (the original's once / available-now jobs); ``processingTime``
  keeps running.  ``maxFilesPerTrigger`` bounds a micro-batch (on the reader).
* Progress lives in ``checkpointLocation``; a restarted query reads no file
  twice.  The orders stream needs ``foreachBatch`` (for the merges), which is
  at-least-once, so every write inside it is keyed by the batch id (overwrite
  of that batch's folder, or an idempotent merge): a replayed batch replaces
  its own output.  Both log tables use the exactly-once file sink.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeshore.functions.logline import CORRUPT_COL
from lakeshore.operators.changes import CHANGE_TYPE
from lakeshore.operators.quality import run_suite
from lakeshore.operators.upsert import DELETED, merge_into, read_table
from lakeshore.plans.orders import change_marks, item_changes, latest_items
from lakeshore.plans.suites import ORDERS_RAW_SUITE, ORDERS_SUITE
from lakeshore.plans.weblogs import QUARANTINED, bronze_logs, parse_lines, silver_logs
from lakeshore.schemas import KEYS, LOGS_COLUMNS, LOGS_RAW, ORDERS_COLUMNS, ORDERS_RAW
from lakeshore.sinks.partitioned import ROWS_PER_FILE, write_bounded
from lakeshore.sinks.snapshots import list_snapshots
from lakeshore.sources.files import parse_order_lines, text_files



def _trigger(writer, trigger: str | dict):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    if isinstance(trigger, dict):
        return writer.trigger(**trigger)
    return writer.trigger(processingTime=trigger)


def _write_batch_folder(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(os.path.join(root, f"batch={batch_id}"))


# --- orders ----------------------------------------------------------------------

def orders_batch(df: DataFrame, batch_id: int, bronze_path: str, silver_path: str, quarantine_path: str,
                 load_date=None, load_ts=None, dq_path: str | None = None,
                 fail_on_error: bool = False, changes_path: str | None = None) -> None:
    """One micro-batch of landed order lines: bronze upsert, quarantine, silver upsert.

    Silver is computed from the batch's own upserted documents, not by
    re-streaming the rewritten bronze table.  With ``dq_path`` the raw suite
    runs on the batch's bronze rows before silver is written (a failing suite
    stops the batch when ``fail_on_error``) and the silver suite after; results
    go to the history under run id ``batch-<id>``.  ``changes_path`` receives
    the row-level change feed of the bronze table.
    """
    spark = df.sparkSession
    # Of an order's documents in a batch: the latest load date, then order time, then any status before "pending".
    newest_order = ["record_timestamp", "order_dt", F.col("status").eqNullSafe("pending").asc()]
    lines = _spread(df)
    # The lines are parsed in the pass that writes bronze, which counts the bad ones on its way.
    seen = Observation()
    good = parse_order_lines(lines, load_date, seen=seen).orders.drop("_bad_fields")
    applied = merge_into(spark, bronze_path, good, KEYS["orders_raw"], batch_id,
                         order_by=newest_order, changes_path=changes_path, count_changes=bool(changes_path))
    counts = seen.get
    if any(counts.get(k) != 0 for k in ("bad_records", "bad_fields")):
        _quarantine(lines, quarantine_path, batch_id, load_date)
    run_id = f"batch-{batch_id}"
    if dq_path:
        raw_dq = run_suite(applied, ORDERS_RAW_SUITE, run_id, fail_on_error=False)
        _save_dq(raw_dq, dq_path, ORDERS_RAW_SUITE.name, run_id, fail_on_error)
    merged = merge_into(spark, silver_path, latest_items(applied, load_ts), KEYS["orders"], batch_id,
                        count_changes=False, one_per_key=True)
    if dq_path:
        _save_dq(run_suite(merged, ORDERS_SUITE, run_id), dq_path, ORDERS_SUITE.name, run_id, False)


def _spread(lines: DataFrame) -> DataFrame:
    """A batch's lines dealt to all cores: a landed file that can't be split is one task, a bounded batch a few files."""
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines if lines.rdd.getNumPartitions() >= cores else lines.repartition(cores, F.xxhash64("value"))


def _quarantine(lines: DataFrame, quarantine_path: str, batch_id: int, load_date) -> None:
    """Write a batch's bad records and field errors, in folders only for what there is."""
    troubled = parse_order_lines(lines, load_date).troubled.persist()
    try:
        for name, rows in (("lines", troubled.where("_bad").select("value")), ("fields", troubled.where("NOT _bad").select("order_id", "_bad_fields"))):
            if not rows.isEmpty():
                _write_batch_folder(rows, os.path.join(quarantine_path, name), batch_id)
    finally:
        troubled.unpersist()


def _save_dq(results: DataFrame, dq_path: str, suite: str, run_id: str, fail_on_error: bool) -> None:
    # One folder per (suite, run id), overwritten on a replay; results are a few rows.
    folder = os.path.join(dq_path, f"suite={suite}", f"run_id={run_id}")
    rows = results.drop("suite", "run_id").coalesce(1)
    rows.write.mode("overwrite").parquet(folder)
    if fail_on_error:
        written = results.sparkSession.read.schema(rows.schema).parquet(folder)
        bad = written.where(~F.col("success")).select("rule", "columns").collect()  # <= #rules rows
        if bad:
            raise AssertionError(f"quality gate failed for {run_id}: {[tuple(r) for r in bad]}")


def start_orders_stream(spark: SparkSession, landing_path: str, bronze_path: str, silver_path: str,
                        checkpoint: str, quarantine_path: str, load_date=None, load_ts=None,
                        trigger: str | dict = "availableNow", max_files_per_trigger: int | None = None,
                        dq_path: str | None = None,
                        fail_on_error: bool = False, changes_path: str | None = None) -> StreamingQuery:
    lines = text_files(spark, landing_path, stream=True, max_files_per_trigger=max_files_per_trigger)

    def fn(df, batch_id):
        orders_batch(df, batch_id, bronze_path, silver_path, quarantine_path, load_date, load_ts,
                     dq_path, fail_on_error, changes_path)

    w = lines.writeStream.foreachBatch(fn).outputMode("update").option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def orders_changes_batch(df: DataFrame, batch_id: int, silver_path: str, load_ts=None, changes_path: str | None = None) -> None:
    """One micro-batch of the bronze change feed applied to silver, deletions included."""
    marks = change_marks(df).persist()
    try:
        merge_into(df.sparkSession, silver_path, item_changes(df, load_ts, marks), KEYS["orders"], batch_id,
                   order_by=[F.col(DELETED).asc()], delete_when=F.col(DELETED), new_columns="drop",
                   changes_path=changes_path, count_changes=False, one_per_key=True)
    finally:
        marks.unpersist()


def start_silver_from_changes_stream(spark: SparkSession, changes_path: str, silver_path: str, checkpoint: str,
                                     load_ts=None, trigger: str | dict = "availableNow",
                                     max_files_per_trigger: int | None = None,
                                     silver_changes_path: str | None = None) -> StreamingQuery:
    """Silver orders kept by the change feed of the bronze table (``merge_into(..., changes_path=)``).

    The feed's files are read in the order they were written, so a micro-batch
    holds no older version than the one before it; versions that meet in one
    micro-batch are put in order there (``plans.orders.item_changes``).  Within
    a version the images that go are written before those that come, so a
    micro-batch that ends between them leaves the items to the next one.  A
    replayed micro-batch replaces its own folder.
    """
    schema = T.StructType([*ORDERS_RAW.fields, T.StructField(CHANGE_TYPE, T.StringType()), T.StructField("version", T.LongType())])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    fn = lambda df, batch_id: orders_changes_batch(df, batch_id, silver_path, load_ts, silver_changes_path)
    w = reader.parquet(changes_path).writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


# --- logs --------------------------------------------------------------------------

BRONZE_LOGS_SCHEMA = T.StructType(LOGS_RAW.fields + [
    T.StructField(CORRUPT_COL, T.StringType()), T.StructField(QUARANTINED, T.BooleanType())])


def start_bronze_logs_stream(spark: SparkSession, landing_path: str, bronze_path: str, checkpoint: str,
                             as_of=None, load_ts=None, trigger: str | dict = "availableNow",
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Landed log lines -> ``logs_raw`` with the exactly-once file sink.

    Partitioned by (year, ``_quarantined``): bad lines stay in the same query
    and the same commit as the good ones, under ``_quarantined=true``; readers
    of good rows prune that partition.  No per-batch folders, so a trigger
    every second does not multiply directories.
    """
    lines = text_files(spark, landing_path, stream=True, max_files_per_trigger=max_files_per_trigger)
    rows = bronze_logs(parse_lines(lines), as_of, load_ts, keep_quarantine=True)
    w = (rows.writeStream.format("parquet").outputMode("append")
             .partitionBy("year", QUARANTINED).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start(bronze_path)


def read_bronze_logs(spark: SparkSession, bronze_path: str, quarantined: bool = False) -> DataFrame:
    """Good bronze rows (or, with ``quarantined=True``, the quarantined lines)."""
    df = spark.read.schema(BRONZE_LOGS_SCHEMA).parquet(bronze_path).where(F.col(QUARANTINED) == quarantined)
    return df.select(F.col(CORRUPT_COL).alias("value")) if quarantined else df.drop(CORRUPT_COL, QUARANTINED)


def _bronze_logs_stream(spark: SparkSession, bronze_path: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE_LOGS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(bronze_path).where(~F.col(QUARANTINED)).drop(CORRUPT_COL, QUARANTINED)


def start_silver_logs_stream(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str,
                             geo_ranges: DataFrame, trigger: str | dict = "availableNow",
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Bronze table stream -> silver logs, appended by the file sink partitioned by country.

    The file sink is exactly-once (its metadata log names the committed files).
    The geo table joins as a stream-static left join (broadcast when small).
    """
    silver = silver_logs(_bronze_logs_stream(spark, bronze_path, max_files_per_trigger), geo_ranges)
    w = (silver.writeStream.format("parquet").outputMode("append").partitionBy("country")
               .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start(silver_path)


SILVER_LOGS_SCHEMA = T.StructType([
    T.StructField("ip_address", T.StringType()), T.StructField("request", T.StringType()),
    T.StructField("status_code", T.StringType()), T.StructField("user_agent", T.StringType()),
    T.StructField("request_timestamp", T.TimestampType()), T.StructField("year", T.IntegerType()),
    T.StructField("product_id", T.StringType()), T.StructField("action", T.StringType()),
    T.StructField("country", T.StringType())])


def start_bounded_logs_stream(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str,
                              geo_ranges: DataFrame, rows_per_file: int = ROWS_PER_FILE, trigger: str | dict = "availableNow",
                              max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Silver logs partitioned by country, with files sized by each micro-batch's own rows per country.

    A micro-batch writes the folder ``batch=<id>`` as a whole, so a replay
    replaces it; ``read_bounded_logs`` reads the folders that are complete.
    Meant for large micro-batches (``availableNow``): each adds one file or more
    per country.
    """
    def fn(df, batch_id):
        # The counts and the rows come from one parse of the batch.
        rows = silver_logs(df, geo_ranges).persist()
        try:
            write_bounded(rows, os.path.join(silver_path, f"batch={batch_id}"), ["country"], rows_per_file, mode="overwrite")
        finally:
            rows.unpersist()

    stream = _bronze_logs_stream(spark, bronze_path, max_files_per_trigger)
    return _trigger(stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint), trigger).start()


def read_bounded_logs(spark: SparkSession, silver_path: str) -> DataFrame:
    """The rows of all complete micro-batches of ``start_bounded_logs_stream``."""
    folders = list_snapshots(spark, silver_path, "batch=")
    if not folders:
        return spark.createDataFrame([], SILVER_LOGS_SCHEMA).select(*LOGS_COLUMNS)
    return spark.read.schema(SILVER_LOGS_SCHEMA).option("basePath", silver_path).parquet(*folders).select(*LOGS_COLUMNS)


def read_silver_logs(spark: SparkSession, silver_path: str) -> DataFrame:
    return spark.read.schema(SILVER_LOGS_SCHEMA).parquet(silver_path).select(*LOGS_COLUMNS)


# --- reports kept by a stream --------------------------------------------------------

#: The text that names a group of a kept report, NULL groups included.
GROUP = "_group"


def start_counts_stream(rows: DataFrame, by: str, count_name: str, report_path: str, checkpoint: str,
                        trigger: str | dict = "availableNow") -> StreamingQuery:
    """Counts of a stream's rows per value of ``by``, kept in a merged table at ``report_path``.

    A stateful aggregation in update mode: the state store under ``checkpoint``
    holds one count per value, a micro-batch reads its own rows only and merges
    the counts that changed.  A replayed micro-batch starts from the state before
    it and replaces its own folder, so no row counts twice.  As in the reports,
    rows where ``by`` is NULL make a group whose count is 0.
    """
    counts = rows.groupBy(by).agg(F.count(by).alias(count_name))

    def fn(df, batch_id):
        group = F.coalesce(F.concat(F.lit("="), F.col(by)), F.lit("NULL")).alias(GROUP)
        merge_into(df.sparkSession, report_path, df.select(group, by, count_name), [GROUP], batch_id,
                   order_by=[count_name], count_changes=False)

    w = counts.writeStream.outputMode("update").foreachBatch(fn).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_login_countries_stream(spark: SparkSession, silver_path: str, report_path: str, checkpoint: str,
                                 trigger: str | dict = "availableNow", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Logins per country, kept from the silver log table as it grows."""
    reader = spark.readStream.schema(SILVER_LOGS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    logins = reader.parquet(silver_path).where(F.col("action") == "login")
    return start_counts_stream(logins, "country", "number_of_users", report_path, checkpoint, trigger)


def read_login_countries(spark: SparkSession, report_path: str, k: int = 10) -> DataFrame:
    """The report ``reports.top_login_countries``, from the kept counts."""
    kept = read_table(spark, report_path, [GROUP])
    return (kept.orderBy(F.col("number_of_users").desc(), F.col("country").asc_nulls_last())
                .limit(k).select("number_of_users", "country"))


def read_silver_orders(spark: SparkSession, silver_path: str) -> DataFrame:
    return read_table(spark, silver_path, KEYS["orders"]).select(*ORDERS_COLUMNS)


def run_to_end(q: StreamingQuery) -> None:
    """Wait for an ``availableNow`` / ``once`` query and surface its failure."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
