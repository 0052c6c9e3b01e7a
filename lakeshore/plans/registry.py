"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

The model tables are derived from the driver tables (``lakeshore.sources.driver``),
so each query's work grows with the tables it reads.  Fixed run parameters
(load date, load timestamp, sales cut-off) are the driver module's constants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.functions.logline import CORRUPT_COL
from lakeshore.functions.useragent import device_label
from lakeshore.operators.changes import table_changes, table_history
from lakeshore.operators.dedupe import dedupe_latest
from lakeshore.operators.geo import geo_lookup
from lakeshore.operators.quality import run_suite
from lakeshore.operators.sample import hash_fraction, hash_sample_n
from lakeshore.operators.upsert import upsert
from lakeshore.plans import dimensions, monitor, orders, reports, weblogs
from lakeshore.plans.suites import ORDERS_RAW_SUITE, ORDERS_SUITE
from lakeshore.schemas import KEYS
from lakeshore.sources import driver as d

RUN_ID = "20221114"
SAMPLE_FRACTION = 0.3
SAMPLE_SEED = 42
SAMPLE_N = 5
LOG_ROWS_PER_FILE = 100


# --- shared derivations --------------------------------------------------------

def bronze_logs(spark: SparkSession, sf: str) -> DataFrame:
    parsed = weblogs.parse_lines(d.log_lines(spark, sf))
    return weblogs.bronze_logs(weblogs.good_lines(parsed), as_of=d.LOAD_DATE,
                               load_ts=F.expr(f"TIMESTAMP '{d.LOAD_TS}'"))


def silver_logs(spark: SparkSession, sf: str) -> DataFrame:
    return weblogs.silver_logs(bronze_logs(spark, sf), d.geo_ranges(spark, sf))


def silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    return orders.silver_orders(d.orders_raw(spark, sf), load_ts=F.expr(f"TIMESTAMP '{d.LOAD_TS}'"))


def changed_orders_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The next day's re-sent documents: pending orders come back finished."""
    pending = [k for k, v in d.STATUS_NAMES.items() if v == "pending"][0]
    raw = d.order_documents(spark, sf, status_code=pending).select(
        "*", F.lit(None).cast("string").alias("_rescued_data"),
        F.lit(d.LOAD_DATE).cast("date").alias("record_timestamp"))
    return (raw.where(F.col("status") == "pending")
               .withColumn("status", F.lit("finished"))
               .withColumn("record_timestamp", F.date_add(F.col("record_timestamp"), 1)))


# --- reports -------------------------------------------------------------------

def q_top_login_countries(spark, sf):
    return reports.top_login_countries(silver_logs(spark, sf))


def q_top_products_in_top_country(spark, sf):
    return reports.top_products_in_top_country(silver_logs(spark, sf), d.products(spark, sf))


def q_main_devices(spark, sf):
    return reports.main_devices(silver_logs(spark, sf))


def q_monthly_sales_last_year(spark, sf):
    return reports.monthly_sales_last_year(silver_orders(spark, sf), as_of=d.SALES_AS_OF)


def q_monthly_sales_by_order(spark, sf):
    return reports.monthly_sales_by_order(silver_orders(spark, sf), as_of=d.SALES_AS_OF)


# --- silver / bronze -------------------------------------------------------------

def q_silver_orders(spark, sf):
    return silver_orders(spark, sf)


def q_order_documents(spark, sf):
    return orders.document_totals(d.order_documents(spark, sf))


def q_bronze_logs(spark, sf):
    return bronze_logs(spark, sf)


def q_silver_logs(spark, sf):
    return silver_logs(spark, sf)


def q_geo_lookup(spark, sf):
    b = bronze_logs(spark, sf).select("ip_address")
    return geo_lookup(b, d.geo_ranges(spark, sf), ip_col="ip_address", out_col="country")


def q_device_label(spark, sf):
    b = bronze_logs(spark, sf)
    return (b.groupBy("user_agent").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("user_agent").alias("agent"), device_label("user_agent").alias("device"), "n"))


def q_log_quarantine(spark, sf):
    """Good / bad line counts of the log parse (bad lines go to quarantine)."""
    parsed = weblogs.parse_lines(d.log_lines(spark, sf))
    return parsed.agg(F.count_if(F.col(CORRUPT_COL).isNull()).alias("good_lines"),
                      F.count_if(F.col(CORRUPT_COL).isNotNull()).alias("bad_lines"))


def q_rescued_data(spark, sf):
    """Order documents as the source system serialises them, with a field the stored
    schema does not know (the order priority), parsed by the landing parser: the
    field lands in ``_rescued_data``, nothing is quarantined."""
    from lakeshore.sources.files import parse_order_lines

    docs = d.order_documents_with_priority(spark, sf)
    lines = docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))
    parsed = parse_order_lines(lines, load_date=d.LOAD_DATE)
    return parsed.orders.select("order_id", "_rescued_data",
                                F.size("_bad_fields").alias("n_bad_fields"))


# --- keyed writes -----------------------------------------------------------------

def q_dedupe_latest(spark, sf):
    return dedupe_latest(d.company_changes(spark, sf), KEYS["companies"], ["updated_dt"])


def q_upsert_companies(spark, sf):
    return dimensions.upsert_dimension("companies", d.companies(spark, sf), d.company_changes(spark, sf))


def q_upsert_customers(spark, sf):
    return dimensions.upsert_dimension("customers", d.customers(spark, sf), d.customer_changes(spark, sf))


def q_upsert_products(spark, sf):
    return dimensions.upsert_dimension("products", d.products(spark, sf), d.product_changes(spark, sf))


def q_upsert_orders_raw(spark, sf):
    # The re-sent documents are a pipeline of their own and too many to
    # broadcast: the single-pass merge evaluates them once.
    new = upsert(d.orders_raw(spark, sf), changed_orders_raw(spark, sf), KEYS["orders_raw"],
                 order_by=["record_timestamp"], how="full")
    return new.select("customer_birth_day", "customer_document_number", "customer_name", "order_dt",
                      "order_id", "status", "total_price", "record_timestamp",
                      F.size("items").alias("n_items"))


def q_upsert_order_items(spark, sf):
    # Day 1 loads the table (latest per key), day 2 merges the re-sent orders.  Both
    # sides are dealt by the whole key, into partitions that the input's size sets, so
    # the keep-latest windows and the single-pass full-outer merge need no further exchange.
    dealt = lambda df: df.repartition(d.document_partitions(spark, sf), *KEYS["orders"])
    target = dedupe_latest(dealt(silver_orders(spark, sf)), KEYS["orders"], ["record_timestamp"])
    day2 = orders.silver_orders(changed_orders_raw(spark, sf),
                                load_ts=F.expr(f"TIMESTAMP '{d.LOAD_TS}' + INTERVAL 1 DAY"))
    return upsert(target, dealt(day2), KEYS["orders"], order_by=["record_timestamp"], how="full")


def q_table_changes(spark, sf):
    old = d.companies(spark, sf)
    new = q_upsert_companies(spark, sf)
    return table_changes(old, new, KEYS["companies"])


def q_table_history(spark, sf):
    """Version 1 creates the companies table, version 2 applies the day's records."""
    v1 = d.companies(spark, sf)
    v2 = q_upsert_companies(spark, sf)
    empty = v1.limit(0)
    ch = (table_changes(empty, v1, KEYS["companies"]).withColumn("version", F.lit(1))
          .unionByName(table_changes(v1, v2, KEYS["companies"]).withColumn("version", F.lit(2))))
    return table_history(ch)


def q_orphan_products(spark, sf):
    return dimensions.orphan_products(d.products(spark, sf), d.companies(spark, sf))


def q_orphan_summary(spark, sf):
    """Order items whose product is missing from the products table, summarised in one pass."""
    items = silver_orders(spark, sf).select("product_id")
    prods = d.products(spark, sf).select("product_id", F.lit(True).alias("_hit"))
    j = items.join(prods, "product_id", "left")
    return j.agg(F.count(F.lit(1)).alias("child_rows"),
                 F.count_if(F.col("_hit").isNull()).alias("orphan_rows"))


# --- quality ---------------------------------------------------------------------

def q_dq_orders_raw(spark, sf):
    return run_suite(d.orders_raw(spark, sf), ORDERS_RAW_SUITE, RUN_ID)


def q_dq_orders(spark, sf):
    return run_suite(silver_orders(spark, sf), ORDERS_SUITE, RUN_ID)


# --- sampling, monitor --------------------------------------------------------------

def q_hash_sample(spark, sf):
    return hash_fraction(d.products(spark, sf), SAMPLE_FRACTION, ["product_id"], SAMPLE_SEED,
                         method="arith")


def q_hash_sample_n(spark, sf):
    return hash_sample_n(d.customers(spark, sf), SAMPLE_N, ["document_number"], SAMPLE_SEED,
                         method="arith")


def q_job_runs_view(spark, sf):
    return monitor.flat_job_runs_view(d.job_runs(spark, sf), run_type="JOB_RUN")


def q_submit_runs_view(spark, sf):
    return monitor.flat_job_runs_view(d.job_runs(spark, sf), run_type="SUBMIT_RUN")


# --- streaming (stream = batch) ------------------------------------------------------

def _run_dir(spark: SparkSession, name: str) -> str:
    import uuid

    from lakeshore.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def q_stream_silver_logs(spark, sf):
    """Land the log lines as files, drain them through the bronze and silver streams,
    read the silver table back.  Must equal the batch ``silver_logs``."""
    import os

    from lakeshore.sinks.landing import land_log_lines
    from lakeshore.streaming import streams

    root = _run_dir(spark, "stream_logs")
    land = os.path.join(root, "landing")
    land_log_lines(d.log_lines(spark, sf), land, d.LOAD_DATE)
    bronze, silver = os.path.join(root, "bronze"), os.path.join(root, "silver")
    streams.run_to_end(streams.start_bronze_logs_stream(
        spark, land, bronze, os.path.join(root, "ck_bronze"),
        as_of=d.LOAD_DATE, load_ts=F.expr(f"TIMESTAMP '{d.LOAD_TS}'"), max_files_per_trigger=2))
    streams.run_to_end(streams.start_silver_logs_stream(
        spark, bronze, silver, os.path.join(root, "ck_silver"), d.geo_ranges(spark, sf),
        max_files_per_trigger=2))
    return streams.read_silver_logs(spark, silver)


def q_stream_orders(spark, sf):
    """Land the order documents as JSON, drain them through the orders stream
    (bronze upsert + silver upsert per micro-batch), read silver back.
    Equals the batch silver orders kept latest per (order_id, product_id)."""
    import os

    from lakeshore.sinks.landing import land_order_documents
    from lakeshore.streaming import streams

    root = _run_dir(spark, "stream_orders")
    land = os.path.join(root, "landing")
    land_order_documents(d.order_documents(spark, sf), land, d.LOAD_DATE)
    silver = os.path.join(root, "silver")
    streams.run_to_end(streams.start_orders_stream(
        spark, land, os.path.join(root, "bronze"), silver, os.path.join(root, "ck"),
        os.path.join(root, "quarantine"), load_date=d.LOAD_DATE,
        load_ts=F.expr(f"TIMESTAMP '{d.LOAD_TS}'"), max_files_per_trigger=4))
    return streams.read_silver_orders(spark, silver)


def q_merge_change_feed(spark, sf):
    """The companies table kept by merges: day 1 loads it, day 2 merges the day's
    records; the change feed written by the day-2 merge must equal the diff of the two full snapshots."""
    import os

    from lakeshore.operators.upsert import merge_into, read_changes

    root = _run_dir(spark, "merge_feed")
    table, feed = os.path.join(root, "companies"), os.path.join(root, "changes")
    merge_into(spark, table, d.companies(spark, sf), KEYS["companies"], batch_id=1, changes_path=feed)
    merge_into(spark, table, d.company_changes(spark, sf), KEYS["companies"], batch_id=2, changes_path=feed)
    return read_changes(spark, feed).where(F.col("version") == 2).select("cuit", "name", "updated_dt",
                                                                         "_change_type")


def q_orders_raw_changes(spark, sf):
    """The change feed of the order documents (items are maps): day 1 loads them, day 2
    merges the re-sent ones."""
    import os

    from lakeshore.operators.upsert import merge_into, read_changes

    root = _run_dir(spark, "orders_raw_feed")
    table, feed = os.path.join(root, "orders_raw"), os.path.join(root, "changes")
    merge_into(spark, table, d.orders_raw(spark, sf), KEYS["orders_raw"], batch_id=1, order_by=["record_timestamp"])
    merge_into(spark, table, changed_orders_raw(spark, sf), KEYS["orders_raw"], batch_id=2,
               order_by=["record_timestamp"], changes_path=feed)
    return read_changes(spark, feed).select("order_id", "status", "record_timestamp", "total_price",
                                            F.size("items").alias("n_items"), "_change_type")


# --- versions, change feeds, evolution ---------------------------------------------------

def _staged(df: DataFrame, root: str, name: str) -> DataFrame:
    """``df`` written once under the run's folder and read back."""
    import os

    path = os.path.join(root, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _companies_over_three_days(spark: SparkSession, sf: str) -> str:
    """The companies table: loaded (version 1), the day's records merged (2), written out
    as a snapshot (3), and on the third day closures and renames merged (4)."""
    import os

    from lakeshore.operators.upsert import merge_into, write_snapshot

    path = os.path.join(_run_dir(spark, "versions"), "companies")
    keys = KEYS["companies"]
    merge_into(spark, path, d.companies(spark, sf), keys, batch_id=1, committed_at="2022-11-13 21:00:00")
    merge_into(spark, path, d.company_changes(spark, sf), keys, batch_id=2, committed_at="2022-11-14 21:00:00")
    write_snapshot(spark, path, keys, committed_at="2022-11-14 23:00:00")
    merge_into(spark, path, d.closed_companies(spark, sf), keys, batch_id=3, delete_when=F.col("closed"), new_columns="drop",
               committed_at="2022-11-15 21:00:00")
    return path


def q_table_as_of(spark, sf):
    """A merged table read as of versions 1 and 2, as of a time after its snapshot, and now."""
    from lakeshore.operators.upsert import read_table

    path, keys = _companies_over_three_days(spark, sf), KEYS["companies"]
    reads = {"version 1": {"version": 1}, "version 2": {"version": 2}, "2022-11-15 09:00:00": {"as_of": "2022-11-15 09:00:00"}, "now": {}}
    parts = [read_table(spark, path, keys, **how).withColumn("as_of", F.lit(label)) for label, how in reads.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_commit_history(spark, sf):
    """The commit records of the same table."""
    from lakeshore.operators.upsert import commit_history

    return commit_history(spark, _companies_over_three_days(spark, sf)).select(
        "version", "operation", "committed_at", "num_source_rows", "num_inserted", "num_updated", "num_deleted")


def q_stream_orders_from_changes(spark, sf):
    """Silver orders kept by the change feed of the order documents.

    Day 1 loads the orders that are not late.  Day 2 re-sends the pending ones
    as finished, some items fewer, brings the late ones and deletes the
    cancelled ones.  The feed both merges wrote is drained by the stream, one
    file a micro-batch at the least; silver must equal the one computed from the
    documents that remain.
    """
    import os

    from lakeshore.operators.upsert import merge_into
    from lakeshore.streaming import streams

    root = _run_dir(spark, "orders_from_changes")
    docs = _staged(d.orders_raw(spark, sf), root, "documents")
    late = F.col("order_id").cast("bigint") % 10 == d.LATE_ORDER_DIGIT
    day1 = docs.where(~late)
    enough = lambda m: m["amount"].cast("int") >= d.RESENT_LEAST_AMOUNT
    resent = day1.where(F.col("status") == "pending").withColumn("status", F.lit("finished")).withColumn("items", F.filter("items", enough))
    day2 = resent.unionByName(docs.where(late)).unionByName(day1.where(F.col("status") == "cancelled").withColumn("status", F.lit("purged")))
    bronze, feed, silver = (os.path.join(root, x) for x in ("orders_raw", "changes", "orders"))
    for n, day in ((1, day1), (2, day2)):
        merge_into(spark, bronze, day, KEYS["orders_raw"], batch_id=n, order_by=["record_timestamp"], changes_path=feed,
                   delete_when=F.col("status") == "purged", count_changes=False)
        streams.run_to_end(streams.start_silver_from_changes_stream(
            spark, feed, silver, os.path.join(root, "ck"), load_ts=F.expr(f"TIMESTAMP '{d.LOAD_TS}'"), max_files_per_trigger=100))
    return streams.read_silver_orders(spark, silver)


def _two_days_of_documents(spark: SparkSession, sf: str, root: str) -> dict[int, DataFrame]:
    """Landed lines: day 1 without, day 2 (the late orders) with a field the schema does not know."""
    docs = _staged(d.order_documents_with_priority(spark, sf), root, "documents")
    late = F.col("order_id").cast("bigint") % 10 == d.LATE_ORDER_DIGIT
    line = lambda df: df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    return {1: line(docs.where(~late).drop("priority")), 2: line(docs.where(late))}


def q_schema_versions(spark, sf):
    """The stored schema's versions after a two-day load whose second day brings a new field."""
    import os

    from lakeshore.schemas import ORDER_DOC
    from lakeshore.sources import schema_history

    root = _run_dir(spark, "schema_versions")
    path = os.path.join(root, "history")
    for lines in _two_days_of_documents(spark, sf, root).values():
        schema_history.evolve(spark, path, lines, ORDER_DOC)
    return schema_history.schema_versions(spark, path)


def q_orders_after_drift(spark, sf):
    """Order documents loaded over those two days into a merged table that takes the new column in."""
    import os

    from lakeshore.operators.upsert import merge_into, read_table
    from lakeshore.schemas import ORDER_DOC
    from lakeshore.sources import schema_history

    root = _run_dir(spark, "orders_after_drift")
    path, history = os.path.join(root, "orders_raw"), os.path.join(root, "history")
    for day, lines in _two_days_of_documents(spark, sf, root).items():
        version, parsed = schema_history.load_orders(spark, history, lines, ORDER_DOC, d.LOAD_DATE)
        rows = parsed.orders.drop("_bad_fields").withColumn("schema_version", F.lit(version))
        merge_into(spark, path, rows, KEYS["orders_raw"], batch_id=day, order_by=["record_timestamp"], new_columns="add", count_changes=False)
    return read_table(spark, path, KEYS["orders_raw"]).select("order_id", "status", "total_price", "priority", "_rescued_data", "schema_version")


# --- look-up tables ----------------------------------------------------------------------

def q_geo_lookup_nested(spark, sf):
    """Country of every visitor's address (IPv4 and IPv6) by the most specific of nested networks."""
    from lakeshore.operators.networks import lookup, networks, segments

    root = _run_dir(spark, "networks")
    table = _staged(segments(networks(d.country_networks(spark, sf))), root, "segments")
    return lookup(d.visitor_addresses(spark, sf), table)


def q_device_rules(spark, sf):
    """Devices of the visitors' agents by a table of about a thousand rules."""
    from lakeshore.operators.device_rules import with_device

    labelled = with_device(d.visitor_agents(spark, sf), d.device_rules(spark, sf))
    return labelled.groupBy("device").agg(F.count(F.lit(1)).alias("n"))


# --- quarantine, ledgers, a day with a restore, kept reports ----------------------------------

def q_quarantine_reasons(spark, sf):
    """Damaged log lines, tagged with every rule they violate."""
    from lakeshore.sources.quarantine import REASONS, tag_log_lines

    tagged = tag_log_lines(d.damaged_log_lines(spark, sf))
    return tagged.groupBy(F.concat_ws("+", REASONS).alias("reasons")).agg(F.count(F.lit(1)).alias("n_lines"))


def _orders_with_replay(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Damaged documents loaded on one day, corrections for them replayed on the two days after, sent twice."""
    import os

    from lakeshore.operators.upsert import merge_into
    from lakeshore.sources import quarantine as q

    root = _run_dir(spark, "replay")
    # The documents are staged, the longer lines made from them; a text is kept where it goes to quarantine.
    lines = d.lines_of(_staged(d.order_documents(spark, sf), root, "documents"))
    table, kept = os.path.join(root, "orders_raw"), os.path.join(root, "quarantine")
    tagged = q.tag_order_lines(lines.select(F.col("damaged").alias("value")), d.LOAD_DATE)
    tagged = _staged(tagged.withColumn("value", F.when(F.size(q.REASONS) > 0, F.col("value"))), root, "tagged")
    merge_into(spark, table, q.clean(tagged), KEYS["orders_raw"], batch_id=1, order_by=["record_timestamp"], count_changes=False)
    q.keep_quarantined(spark, kept, tagged, batch_id=1)
    corrections = _staged(lines.where(F.col("damaged") != F.col("value")).select(q.record_id("damaged").alias(q.RECORD), "value"), root, "corrections")
    for day in (15, 16):
        q.replay_orders(spark, kept, corrections, table, KEYS["orders_raw"], batch_id=day, load_date=f"2022-11-{day}")
    return table, kept


def q_orders_after_replay(spark, sf):
    """Order documents after the replay: corrected ones bear the date of the first replay only."""
    from lakeshore.operators.upsert import read_table

    table, _ = _orders_with_replay(spark, sf)
    return read_table(spark, table, KEYS["orders_raw"]).select("order_id", "order_dt", "status", "total_price", "record_timestamp",
                                                               F.size("items").alias("n_items"))


def q_quarantine_after_replay(spark, sf):
    """The quarantine table after the replay, by reasons and status."""
    from lakeshore.operators.upsert import read_table
    from lakeshore.sources.quarantine import RECORD

    _, kept = _orders_with_replay(spark, sf)
    return (read_table(spark, kept, [RECORD]).groupBy(F.concat_ws("+", "reasons").alias("reasons"), "status", "replayed_in")
            .agg(F.count(F.lit(1)).alias("n_records")))


def q_orphan_ledger(spark, sf):
    """Products without their company over three loads: late companies, late products, products that change company."""
    import os

    from lakeshore.operators.referential import update_ledger

    path = os.path.join(_run_dir(spark, "orphans"), "ledger")
    companies, loads = d.late_companies(spark, sf), d.product_loads(spark, sf)
    for day, load in loads.items():
        ledger = update_ledger(spark, path, load, companies[min(day, 2)], "product_id", "cuit",
                               loaded_at=f"2022-11-{12 + day} 21:00:00", batch_id=day)
    return ledger


def q_dq_history(spark, sf):
    """Column profiles of three batches kept as sketches, each compared with the batch before.

    The counts are exact; whether the distinct and median estimates drifted is
    read off the sketches (thresholds well over their error).
    """
    import os

    from lakeshore.operators.quality import drift, profile, read_profiles, save_profile

    path = os.path.join(_run_dir(spark, "dq_history"), "profiles")
    for run_id, batch in d.line_item_batches(spark, sf).items():
        save_profile(profile(batch, ["product_id", "amount", "price", "line"]), path, run_id)
    return drift(read_profiles(spark, path)).drop("distinct_estimate", "median_estimate")


def q_products_after_restore(spark, sf):
    """Two days of the products job; the table is lost in between and restored from the first day's backup.

    Returns both days' backups.
    """
    import os

    from lakeshore.sinks.snapshots import read_snapshot

    root = _run_dir(spark, "restore")
    backups = os.path.join(root, "backups")
    days = {"2022-11-13": ("table", d.products(spark, sf)), "2022-11-14": ("table_after_loss", d.product_changes(spark, sf))}
    parts = []
    for day, (place, records) in days.items():
        dimensions.daily_dimension_job(spark, "products", os.path.join(root, place), backups, records, day)
        parts.append(read_snapshot(spark, backups, day).withColumn("run_dt", F.lit(day)))
    return parts[0].unionByName(parts[1])


def q_stream_top_login_countries(spark, sf):
    """The login report kept by a stream over the silver log table, which grows while the stream is down."""
    import os

    from lakeshore.streaming import streams

    root = _run_dir(spark, "kept_report")
    logs = _staged(silver_logs(spark, sf), root, "logs")
    silver, report = os.path.join(root, "silver"), os.path.join(root, "report")
    early = F.second("request_timestamp") < 30
    for part in (early, ~F.coalesce(early, F.lit(False))):
        logs.where(part).write.mode("append").parquet(silver)
        streams.run_to_end(streams.start_login_countries_stream(spark, silver, report, os.path.join(root, "ck")))
    return streams.read_login_countries(spark, report)


# --- small operators ----------------------------------------------------------------------------

def q_silver_log_files(spark, sf):
    """Rows and files per country of silver logs written with a bound on the rows of a file."""
    import os

    from lakeshore.sinks.partitioned import SLACK, write_bounded
    from lakeshore.streaming.streams import SILVER_LOGS_SCHEMA

    root = _run_dir(spark, "log_files")
    path = os.path.join(root, "by_country")
    write_bounded(_staged(silver_logs(spark, sf), root, "logs"), path, ["country"], LOG_ROWS_PER_FILE)
    files = (spark.read.schema(SILVER_LOGS_SCHEMA).parquet(path)
             .groupBy("country", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n")))
    return files.groupBy("country").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"),
                                        (F.max("n") <= int(SLACK * LOG_ROWS_PER_FILE)).alias("bounded"))


def q_upsert_landed_companies(spark, sf):
    """A day's company records landed as JSON, read under the stored schema and merged."""
    import os

    from lakeshore.sources.files import read_records

    path = os.path.join(_run_dir(spark, "records"), "companies")
    d.company_changes(spark, sf).write.json(path)
    return dimensions.upsert_dimension("companies", d.companies(spark, sf), read_records(spark, path, "companies"))


def q_job_runs_listing(spark, sf):
    """The monitor's table of all runs, from landed listings of the jobs service."""
    import os

    from lakeshore.sources.files import read_job_runs

    path = os.path.join(_run_dir(spark, "listings"), "job_runs")
    d.job_run_pages(spark, sf).write.json(path)
    return monitor.flat_job_runs_view(read_job_runs(spark, path, multi_line=False), run_type=None)


def q_sql_top_products(spark, sf):
    """The products report as a SQL user writes it, over the views of a lake."""
    from lakeshore.catalog import Lake
    from lakeshore.operators.upsert import merge_into
    from lakeshore.plans import jobs

    lake = Lake(_run_dir(spark, "views"))
    silver_logs(spark, sf).write.partitionBy("country").parquet(lake.table("logs"))
    merge_into(spark, lake.table("products"), d.products(spark, sf), KEYS["products"], batch_id=1, count_changes=False)
    jobs.register_views(spark, lake)
    return spark.sql("""
        WITH top AS (SELECT country FROM logs WHERE action = 'login' GROUP BY country
                     ORDER BY count(country) DESC, country NULLS LAST LIMIT 1),
        viewed AS (SELECT l.product_id, count(*) AS c FROM logs l JOIN top ON l.country = top.country
                   WHERE l.action = 'product' GROUP BY l.product_id)
        SELECT c, v.product_id, p.name AS product_name
        FROM viewed v JOIN products p ON p.product_id = try_cast(v.product_id AS BIGINT)
        ORDER BY c DESC, v.product_id, product_name NULLS LAST LIMIT 5""")


def q_rename_one_company(spark, sf):
    """The companies table after the daily change of one record."""
    companies = d.companies(spark, sf)
    return dimensions.upsert_dimension("companies", companies, dimensions.rename_one(companies, "cuit", ts=d.CHANGE_UPDATED_TS))


def q_order_item_ids(spark, sf):
    """Row ids of the order items, from their keys."""
    from lakeshore.functions.ids import key_id

    return silver_orders(spark, sf).select("order_id", "product_id", key_id("order_id", "product_id").alias("item_id"))


def q_daily_cancelled_orders(spark, sf):
    """Cancelled orders per day, days without any included."""
    return reports.daily_orders(silver_orders(spark, sf), status="cancelled")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_login_countries": q_top_login_countries,
    "top_products_in_top_country": q_top_products_in_top_country,
    "main_devices": q_main_devices,
    "monthly_sales_last_year": q_monthly_sales_last_year,
    "monthly_sales_by_order": q_monthly_sales_by_order,
    "silver_orders": q_silver_orders,
    "order_documents": q_order_documents,
    "bronze_logs": q_bronze_logs,
    "silver_logs": q_silver_logs,
    "geo_lookup": q_geo_lookup,
    "device_label": q_device_label,
    "log_quarantine": q_log_quarantine,
    "rescued_data": q_rescued_data,
    "dedupe_latest": q_dedupe_latest,
    "upsert_companies": q_upsert_companies,
    "upsert_customers": q_upsert_customers,
    "upsert_products": q_upsert_products,
    "upsert_orders_raw": q_upsert_orders_raw,
    "upsert_order_items": q_upsert_order_items,
    "table_changes": q_table_changes,
    "table_history": q_table_history,
    "merge_change_feed": q_merge_change_feed,
    "orders_raw_changes": q_orders_raw_changes,
    "orphan_products": q_orphan_products,
    "orphan_summary": q_orphan_summary,
    "dq_orders_raw": q_dq_orders_raw,
    "dq_orders": q_dq_orders,
    "hash_sample": q_hash_sample,
    "hash_sample_n": q_hash_sample_n,
    "job_runs_view": q_job_runs_view,
    "submit_runs_view": q_submit_runs_view,
    "stream_silver_logs": q_stream_silver_logs,
    "stream_orders": q_stream_orders,
    "table_as_of": q_table_as_of,
    "commit_history": q_commit_history,
    "stream_orders_from_changes": q_stream_orders_from_changes,
    "schema_versions": q_schema_versions,
    "orders_after_drift": q_orders_after_drift,
    "geo_lookup_nested": q_geo_lookup_nested,
    "device_rules": q_device_rules,
    "quarantine_reasons": q_quarantine_reasons,
    "orders_after_replay": q_orders_after_replay,
    "quarantine_after_replay": q_quarantine_after_replay,
    "orphan_ledger": q_orphan_ledger,
    "dq_history": q_dq_history,
    "products_after_restore": q_products_after_restore,
    "stream_top_login_countries": q_stream_top_login_countries,
    "silver_log_files": q_silver_log_files,
    "upsert_landed_companies": q_upsert_landed_companies,
    "job_runs_listing": q_job_runs_listing,
    "sql_top_products": q_sql_top_products,
    "rename_one_company": q_rename_one_company,
    "order_item_ids": q_order_item_ids,
    "daily_cancelled_orders": q_daily_cancelled_orders,
}
