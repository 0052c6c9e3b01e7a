"""The pipeline's jobs over a lake (what the original ran as scheduled notebooks).

Order of a day: ``orders_job`` (landed documents -> bronze -> quality gate ->
silver), ``weblogs_job`` (landed lines -> bronze -> silver by country),
``dimension_job`` per dimension, then the reports over ``register_views``.
Each job is restartable: streams resume from their checkpoints, merges are
idempotent per batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.catalog import Lake
from lakeshore.operators.upsert import has_table, read_table
from lakeshore.plans import dimensions, reports
from lakeshore.schemas import KEYS
from lakeshore.sinks.snapshots import path_exists
from lakeshore.streaming import streams


def orders_job(spark: SparkSession, lake: Lake, load_date=None, load_ts=None,
               trigger: str | dict = "availableNow", max_files_per_trigger: int | None = None,
               fail_on_error: bool = False):
    """Drain landed order documents into ``orders_raw`` and ``orders`` (stops when drained
    with the default trigger; returns the running query otherwise)."""
    q = streams.start_orders_stream(
        spark, lake.landing("orders"), lake.table("orders_raw"), lake.table("orders"),
        lake.checkpoint("orders"), lake.quarantine("orders"), load_date=load_date, load_ts=load_ts,
        trigger=trigger, max_files_per_trigger=max_files_per_trigger,
        dq_path=lake.quality(), fail_on_error=fail_on_error, changes_path=lake.changes("orders_raw"))
    if trigger in ("availableNow", "once"):
        streams.run_to_end(q)
    return q


def weblogs_job(spark: SparkSession, lake: Lake, geo_ranges: DataFrame, as_of=None, load_ts=None,
                trigger: str | dict = "availableNow", max_files_per_trigger: int | None = None):
    """Drain landed log files into ``logs_raw``, then ``logs_raw`` into ``logs``."""
    bronze = streams.start_bronze_logs_stream(
        spark, lake.landing("combined_log"), lake.table("logs_raw"), lake.checkpoint("logs_raw"),
        as_of=as_of, load_ts=load_ts, trigger=trigger, max_files_per_trigger=max_files_per_trigger)
    if trigger not in ("availableNow", "once"):
        silver = streams.start_silver_logs_stream(spark, lake.table("logs_raw"), lake.table("logs"),
                                                  lake.checkpoint("logs"), geo_ranges, trigger=trigger,
                                                  max_files_per_trigger=max_files_per_trigger)
        return bronze, silver
    streams.run_to_end(bronze)
    if path_exists(spark, lake.table("logs_raw")):
        streams.run_to_end(streams.start_silver_logs_stream(
            spark, lake.table("logs_raw"), lake.table("logs"), lake.checkpoint("logs"), geo_ranges,
            trigger=trigger, max_files_per_trigger=max_files_per_trigger))
    return None


def dimension_job(spark: SparkSession, lake: Lake, name: str, new_records: DataFrame, run_dt: str) -> DataFrame:
    """Restore-or-read, merge the day's records, back up; the change feed goes to the lake."""
    return dimensions.daily_dimension_job(spark, name, lake.table(name), lake.backup(name), new_records,
                                          run_dt, changes_path=lake.changes(name))


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Temp views named after the tables (``logs``, ``products``, ``orders``, ...) for SQL users."""
    done = []
    for name in ["companies", "customers", "products", "orders_raw", "orders"]:
        if has_table(spark, lake.table(name)):
            read_table(spark, lake.table(name), KEYS[name]).createOrReplaceTempView(name)
            done.append(name)
    if path_exists(spark, lake.table("logs")):
        streams.read_silver_logs(spark, lake.table("logs")).createOrReplaceTempView("logs")
        done.append("logs")
    if path_exists(spark, lake.table("logs_raw")):
        streams.read_bronze_logs(spark, lake.table("logs_raw")).createOrReplaceTempView("logs_raw")
        done.append("logs_raw")
    return done


# Tables each report reads.
REPORT_TABLES = {
    "top_login_countries": ("logs",),
    "top_products_in_top_country": ("logs", "products"),
    "main_devices": ("logs",),
    "monthly_sales_last_year": ("orders",),
}


def reports_job(spark: SparkSession, lake: Lake, as_of: str) -> dict[str, DataFrame]:
    """The marketing / sales reports over the registered views; a report whose
    tables do not exist yet is left out."""
    present = set(register_views(spark, lake))
    build = {
        "top_login_countries": reports.top_login_countries,
        "top_products_in_top_country": reports.top_products_in_top_country,
        "main_devices": reports.main_devices,
        "monthly_sales_last_year": lambda orders: reports.monthly_sales_last_year(orders, as_of=as_of),
    }
    return {name: build[name](*map(spark.table, tables)) for name, tables in REPORT_TABLES.items() if present.issuperset(tables)}


def logs_by_country(spark: SparkSession, lake: Lake, country: str) -> DataFrame:
    """Silver logs of one country: a partition read (the table is partitioned by country)."""
    return streams.read_silver_logs(spark, lake.table("logs")).where(F.col("country") == country)
