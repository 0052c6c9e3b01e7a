"""Daily dimension maintenance: companies, customers, products."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators.referential import orphans
from lakeshore.operators.upsert import has_table, merge_into, read_table, upsert
from lakeshore.schemas import KEYS
from lakeshore.sinks.snapshots import backup_snapshot, latest_snapshot


def upsert_dimension(name: str, target: DataFrame, changes: DataFrame,
                     null_keys: str = "quarantine") -> DataFrame:
    """New contents of dimension ``name`` after applying a day's records (latest per key wins)."""
    return upsert(target, changes, KEYS[name], order_by=["updated_dt"], null_keys=null_keys)


def rename_one(target: DataFrame, key: str, new_name: str = "New Name!!", ts=None) -> DataFrame:
    """The original's daily 'update one record': the smallest key gets a new name.

    Ordered by key first so the picked row repeats (``limit`` alone does not).
    """
    stamp = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    return (target.orderBy(key).limit(1)
                  .withColumn("name", F.lit(new_name)).withColumn("updated_dt", stamp))


def orphan_products(products: DataFrame, companies: DataFrame) -> DataFrame:
    """Products whose company (``cuit``) is not in the companies table."""
    return orphans(products, companies, ["cuit"])


def read_or_restore(spark: SparkSession, table_path: str, backup_path: str, keys: list[str]) -> DataFrame:
    """Read the keyed table; if it is missing, merge the newest backup snapshot into it first."""
    if not has_table(spark, table_path):
        snap = latest_snapshot(spark, backup_path)
        if snap is None:
            raise FileNotFoundError(f"neither {table_path} nor a snapshot under {backup_path}")
        merge_into(spark, table_path, spark.read.parquet(snap), keys, batch_id=f"restore-{os.path.basename(snap)}",
                   null_keys="insert")
    return read_table(spark, table_path, keys)


def daily_dimension_job(spark: SparkSession, name: str, table_path: str, backup_root: str,
                        new_records: DataFrame, run_dt: str, null_keys: str = "quarantine",
                        changes_path: str | None = None) -> DataFrame:
    """One day of a dimension: restore the table if it is missing, merge the day's records
    (latest per key wins), write the dated backup.  Returns the records applied.

    Re-running the same ``run_dt`` is safe: the day's batch and the day's
    snapshot are replaced, not appended.
    """
    keys = KEYS[name]
    if latest_snapshot(spark, backup_root) is not None:
        read_or_restore(spark, table_path, backup_root, keys)
    applied = merge_into(spark, table_path, new_records, keys, batch_id=run_dt, order_by=["updated_dt"],
                         null_keys=null_keys, changes_path=changes_path)
    backup_snapshot(read_table(spark, table_path, keys), backup_root, run_dt)
    return applied
