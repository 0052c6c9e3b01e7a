"""Table backups as dated snapshots, and restore from the newest one.

A backup writes the whole table under ``<root>/run_dt=<date>/``; re-running the
same day replaces that snapshot (no repeats piling up), and a restore reads
exactly one snapshot, the newest complete one.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def backup_snapshot(df: DataFrame, root: str, run_dt: str) -> str:
    out = os.path.join(root, f"run_dt={run_dt}")
    df.write.mode("overwrite").parquet(out)
    return out


def list_snapshots(spark: SparkSession, root: str, prefix: str = "run_dt=") -> list[str]:
    """Complete snapshot folders (with a ``_SUCCESS`` marker), oldest first by name."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(name)
    return [os.path.join(root, n) for n in sorted(out)]


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    snaps = list_snapshots(spark, root)
    return snaps[-1] if snaps else None


def read_snapshot(spark: SparkSession, root: str, run_dt: str) -> DataFrame:
    """The table as it was backed up on ``run_dt`` (time travel by date)."""
    return spark.read.parquet(os.path.join(root, f"run_dt={run_dt}"))


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
