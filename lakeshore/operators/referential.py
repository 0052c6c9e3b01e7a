"""Referential checks: child rows whose foreign key has no parent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators.dedupe import dedupe_latest
from lakeshore.operators.upsert import has_table, merge_into, read_table

OPEN, RESOLVED = "open", "resolved"


def orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
            parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``child`` with no matching ``parent`` (anti join; NULL keys count as orphans)."""
    parent_keys = list(parent_keys or child_keys)
    # distinct: a hot parent key collapses map-side to one row per task, and the
    # output is already hash-partitioned by the keys for the anti join.
    p = parent.select(*[F.col(pk).alias(ck) for pk, ck in zip(parent_keys, child_keys)]).distinct()
    return child.join(p, list(child_keys), "left_anti")


def update_ledger(spark: SparkSession, path: str, children: DataFrame, parents: DataFrame, child_key: str, foreign_key: str,
                  loaded_at, batch_id: int | str, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Bring the ledger of orphans at ``path`` up to date with one load; returns the whole ledger.

    ``children`` are the load's new or changed child rows (the newest by
    ``order_by`` counts), ``parents`` the parent table after the load, its key
    named as the child's ``foreign_key``.  Only those children and the orphans
    still open are checked; pass the whole child table to find the children of
    parents that went away.

    One row per child that ever was an orphan: ``child_key``, ``foreign_key``,
    ``status``, ``opened_at``, ``closed_at``.  A late parent, or a child that now
    names an existing one, closes the row, which keeps the key that was missing.
    An orphan that names another missing parent stays open since its first load;
    one that was closed and is an orphan again opens anew.  A NULL foreign key
    is an orphan; children without a key are left out.  A load repeated
    under its ``batch_id`` and ``loaded_at`` leaves the same ledger.
    """
    at = F.lit(loaded_at).cast("timestamp")
    load = dedupe_latest(children.where(F.col(child_key).isNotNull()), [child_key], order_by)
    load = load.select(child_key, foreign_key, F.lit(True).alias("_loaded"))
    if has_table(spark, path):
        ledger = read_table(spark, path, [child_key])
        # Rows this very load closed before are looked at again when it is repeated.
        known = ledger.where((F.col("status") == OPEN) | (F.col("closed_at") == at))
        known = known.select(child_key, F.col(foreign_key).alias("_missing"), "opened_at")
        watched = load.join(known, child_key, "full_outer")
    else:
        watched = load.select("*", F.col(foreign_key).alias("_missing"), F.lit(None).cast("timestamp").alias("opened_at"))
    watched = watched.withColumn(foreign_key, F.when(F.col("_loaded"), F.col(foreign_key)).otherwise(F.col("_missing")))
    there = parents.select(foreign_key).distinct().withColumn("_found", F.lit(True))
    found = F.coalesce(F.col("_found"), F.lit(False))
    rows = watched.join(there, foreign_key, "left").where(~found | F.col("opened_at").isNotNull()).select(
        child_key, F.when(found, F.col("_missing")).otherwise(F.col(foreign_key)).alias(foreign_key),
        F.when(found, RESOLVED).otherwise(OPEN).alias("status"),
        F.coalesce("opened_at", at).alias("opened_at"), F.when(found, at).alias("closed_at"))
    merge_into(spark, path, rows, [child_key], batch_id, order_by=["opened_at"], count_changes=False)
    return read_table(spark, path, [child_key])
