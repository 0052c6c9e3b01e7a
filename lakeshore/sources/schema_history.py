"""Versions of a source's stored schema, with additive evolution.

A history folder holds one version of the schema per folder ``version=<n>``
(one row per column).  Version 1 is the schema the source starts with; when
landed documents carry keys the latest version lacks, a version with those
columns appended (as text, by name) is added.  A version is never changed, so
what was loaded under one can be read under it again: keys outside it go to
``_rescued_data`` as before.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeshore.sources.files import order_elements, parse_order_lines, schema_drift

HISTORY_COLUMNS = "position int, column string, type string, added boolean"


def schema_versions(spark: SparkSession, path: str) -> DataFrame:
    """version, position, column, type, added (new in that version): every version whole."""
    return spark.read.schema(f"{HISTORY_COLUMNS}, version int").json(path).select("version", "position", "column", "type", "added")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "version=*", "_SUCCESS"))
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    return sorted(int(st.getPath().getParent().getName().split("=")[1]) for st in found)


def schema_at(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, T.StructType]:
    """(number, schema) of a version, by default the latest."""
    there = _numbers(spark, path)
    if not there or (version is not None and version not in there):
        raise ValueError(f"no schema version {version or ''} at {path}; known: {there}")
    n = there[-1] if version is None else version
    rows = spark.read.schema(HISTORY_COLUMNS).json(os.path.join(path, f"version={n}")).orderBy("position").collect()  # a row per column
    return n, T.StructType.fromDDL(", ".join(f"`{r['column']}` {r['type']}" for r in rows))


def add_version(spark: SparkSession, path: str, schema: T.StructType, new: list[str]) -> int:
    """Write the next version; ``new`` names the columns it adds."""
    n = max(_numbers(spark, path), default=0) + 1
    rows = [(i, f.name, f.dataType.simpleString(), f.name in new) for i, f in enumerate(schema.fields)]
    spark.createDataFrame(rows, HISTORY_COLUMNS).coalesce(1).write.mode("overwrite").json(os.path.join(path, f"version={n}"))
    return n


def evolve(spark: SparkSession, path: str, lines: DataFrame, first: T.StructType) -> tuple[int, T.StructType]:
    """The version to load these landed lines under: the latest, or a new one if they have keys it lacks.

    The keys are found in one pass over the lines, which parses nothing else, and counted per key; what comes
    to the driver is the list of unknown keys.
    """
    if not _numbers(spark, path):
        add_version(spark, path, first, first.names)
    n, schema = schema_at(spark, path)
    unknown = sorted(r["key"] for r in schema_drift(order_elements(lines), schema=schema).collect())
    if not unknown:
        return n, schema
    wider = T.StructType([*schema.fields, *[T.StructField(k, T.StringType()) for k in unknown]])
    return add_version(spark, path, wider, unknown), wider


def load_orders(spark: SparkSession, path: str, lines: DataFrame, first: T.StructType, load_date=None):
    """Landed lines parsed under the version they need: (version, ``files.ParsedOrders``)."""
    n, schema = evolve(spark, path, lines, first)
    return n, parse_order_lines(lines, load_date, schema=schema)


def load_orders_under(spark: SparkSession, path: str, version: int, lines: DataFrame, load_date=None):
    """Landed lines parsed under an earlier version, as they were loaded then."""
    return parse_order_lines(lines, load_date, schema=schema_at(spark, path, version)[1])

