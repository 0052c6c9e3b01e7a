"""Row-level change feed and table history between two table versions.

Delta's change-data feed is re-aimed as a diff of two snapshots: a full outer
join on the key, NULL-safe comparison of the other columns.  One shuffle on the
key; the output carries only changed rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGE_TYPE = "_change_type"
INSERT, DELETE = "insert", "delete"
UPDATE_PRE, UPDATE_POST = "update_preimage", "update_postimage"


def comparable(value: Column, kind: T.DataType) -> Column:
    """``value`` with every map in it as an array of entries sorted by key (maps can't be compared)."""
    if isinstance(kind, T.MapType):
        # Sorted by key alone: the value may hold maps.
        keys = F.array_sort(F.map_keys(value))
        return F.transform(keys, lambda k: F.struct(k.alias("key"), comparable(F.element_at(value, k), kind.valueType).alias("value")))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: comparable(x, kind.elementType)) if _has_map(kind.elementType) else value
    if isinstance(kind, T.StructType) and _has_map(kind):
        # A NULL struct stays NULL.
        return F.when(value.isNotNull(), F.struct(*[comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]))
    return value


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def table_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows with ``_change_type`` in insert / delete / update_preimage / update_postimage.

    Unchanged rows produce nothing.  Key columns must not be NULL (rows with a
    NULL key part cannot be matched and show as delete + insert).
    """
    keys = list(keys)
    values = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*values).alias("_o"), F.lit(True).alias("_in_o"))
    n = new.select(*keys, F.struct(*[F.col(c) for c in values]).alias("_n"), F.lit(True).alias("_in_n"))
    j = o.join(n, keys, "full_outer")
    image_of = old.select(F.struct(*values)).schema[0].dataType
    same = comparable(F.col("_o"), image_of).eqNullSafe(comparable(F.col("_n"), image_of))
    kind = (F.when(F.col("_in_o").isNull(), F.array(F.lit(INSERT)))
             .when(F.col("_in_n").isNull(), F.array(F.lit(DELETE)))
             .when(~same, F.array(F.lit(UPDATE_PRE), F.lit(UPDATE_POST))))
    j = j.where(kind.isNotNull()).select(*keys, "_o", "_n", F.explode(kind).alias(CHANGE_TYPE))
    image = F.when(F.col(CHANGE_TYPE).isin(DELETE, UPDATE_PRE), F.col("_o")).otherwise(F.col("_n"))
    return j.select(*keys, *[image.getField(c).alias(c) for c in values], CHANGE_TYPE)


def table_history(changes: DataFrame, version_col: str = "version") -> DataFrame:
    """Per version: rows inserted, updated, deleted (from a change feed with a version column)."""
    ct = F.col(CHANGE_TYPE)
    return changes.groupBy(version_col).agg(
        F.count_if(ct == INSERT).alias("num_inserted"),
        F.count_if(ct == UPDATE_POST).alias("num_updated"),
        F.count_if(ct == DELETE).alias("num_deleted"))
