"""Keep the latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def _order(order_by: Sequence[str | Column]) -> list[Column]:
    out = []
    for c in order_by:
        out.append(F.col(c).desc_nulls_last() if isinstance(c, str) else c)
    return out


def tie_break_columns(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> list[str]:
    """The columns that break ties where none are named: the others that can be ordered."""
    ordered = {c for c in order_by if isinstance(c, str)}
    return [f.name for f in df.schema.fields if f.name not in keys and f.name not in ordered and _orderable(f.dataType)]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ("updated_dt",),
                  tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``order_by`` (strings sort descending).

    Ties are broken by the remaining columns in descending order, so the result
    never depends on input order.  The window shuffles once on the key; a hot
    key only sorts its own rows inside its task (no collect).
    """
    keys = list(keys)
    if tie_break is None:
        tie_break = tie_break_columns(df, keys, order_by)
    w = Window.partitionBy(*keys).orderBy(*_order(order_by), *[F.col(c).desc_nulls_last() for c in tie_break])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
