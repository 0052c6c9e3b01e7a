"""Declarative data-quality rules, evaluated in one aggregation pass.

A suite is a list of rules; running it on a DataFrame scans once, computes
every rule's counters with ``count_if`` inside a single (partial + final)
aggregate, and unpivots them into one result row per rule:
``(run_id, suite, rule_index, rule, columns, total, failed, not_evaluated, success)``.
Failed rules do not raise unless ``fail_on_error`` is set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("suite", T.StringType()),
    T.StructField("rule_index", T.IntegerType()),
    T.StructField("rule", T.StringType()),
    T.StructField("columns", T.StringType()),
    T.StructField("total", T.LongType()),
    T.StructField("failed", T.LongType()),
    T.StructField("not_evaluated", T.LongType()),
    T.StructField("success", T.BooleanType()),
])


@dataclass(frozen=True)
class Rule:
    kind: str                       # not_null | pair_greater | max_between
    columns: tuple[str, ...]
    params: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def name(self) -> str:
        return {
            "not_null": "expect_column_values_to_not_be_null",
            "pair_greater": "expect_column_pair_values_a_to_be_greater_than_b",
            "max_between": "expect_column_max_to_be_between",
        }[self.kind]


def not_null(column: str) -> Rule:
    return Rule("not_null", (column,))


def pair_greater(a: str, b: str, or_equal: bool = False) -> Rule:
    return Rule("pair_greater", (a, b), {"or_equal": or_equal})


def max_between(column: str, min_value=None, max_value=None) -> Rule:
    return Rule("max_between", (column,), {"min": min_value, "max": max_value})


@dataclass
class Suite:
    name: str
    rules: list[Rule]


def _aligned(df: DataFrame, a: str, b: str) -> tuple[Column, Column]:
    """Compare across types like the original: a string side is cast to the other
    side's type, leniently (a value that does not convert is 'not evaluated')."""
    ta, tb = df.schema[a].dataType, df.schema[b].dataType
    ca, cb = F.col(a), F.col(b)
    if ta != tb:
        if isinstance(ta, T.StringType):
            ca = ca.try_cast(tb)
        elif isinstance(tb, T.StringType):
            cb = cb.try_cast(ta)
    return ca, cb


def _counters(df: DataFrame, rule: Rule, i: int) -> list[Column]:
    if rule.kind == "not_null":
        c = F.col(rule.columns[0])
        return [F.count_if(c.isNull()).alias(f"f{i}"), F.lit(0).cast("bigint").alias(f"n{i}")]
    if rule.kind == "pair_greater":
        a, b = _aligned(df, *rule.columns)
        cmp = (a >= b) if rule.params.get("or_equal") else (a > b)
        return [F.count_if(~cmp).alias(f"f{i}"), F.count_if(cmp.isNull()).alias(f"n{i}")]
    if rule.kind == "max_between":
        m = F.max(F.col(rule.columns[0]))
        ok = F.lit(True)
        if rule.params.get("min") is not None:
            ok = ok & (m >= F.lit(rule.params["min"]))
        if rule.params.get("max") is not None:
            ok = ok & (m <= F.lit(rule.params["max"]))
        return [F.when(~ok, 1).otherwise(0).cast("bigint").alias(f"f{i}"),
                F.when(m.isNull(), 1).otherwise(0).cast("bigint").alias(f"n{i}")]
    raise ValueError(f"unknown rule kind {rule.kind}")


def run_suite(df: DataFrame, suite: Suite, run_id: str, fail_on_error: bool = False) -> DataFrame:
    """One result row per rule; one pass over ``df``."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, r in enumerate(suite.rules):
        aggs += _counters(df, r, i)
    wide = df.agg(*aggs)
    rows = []
    for i, r in enumerate(suite.rules):
        total = F.lit(1).cast("bigint") if r.kind == "max_between" else F.col("_total")
        rows.append(F.struct(
            F.lit(i).alias("rule_index"), F.lit(r.name).alias("rule"),
            F.lit(",".join(r.columns)).alias("columns"), total.alias("total"),
            F.col(f"f{i}").alias("failed"), F.col(f"n{i}").alias("not_evaluated")))
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select(
        F.lit(run_id).alias("run_id"), F.lit(suite.name).alias("suite"), "r.rule_index", "r.rule",
        "r.columns", "r.total", "r.failed", "r.not_evaluated",
        ((F.col("r.failed") == 0) & (F.col("r.not_evaluated") == 0)).alias("success"))
    if fail_on_error:
        bad = out.where(~F.col("success")).select("rule", "columns").collect()  # <= #rules rows
        if bad:
            raise AssertionError(f"suite {suite.name} failed: {[tuple(r) for r in bad]}")
    return out


def save_results(results: DataFrame, path: str) -> None:
    """Append a suite run to the result history (partitioned by run)."""
    results.write.mode("append").partitionBy("run_id").parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The result history, typed (run ids stay strings)."""
    return spark.read.schema(RESULT_SCHEMA).parquet(path)


# --- column profiles ------------------------------------------------------------------

PROFILE_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("total", T.LongType()), T.StructField("nulls", T.LongType()),
    T.StructField("distinct_sketch", T.BinaryType()), T.StructField("quantile_sketch", T.BinaryType()),
])
#: Sketch sizes: distinct counts within about 3 % (two standard errors at 2^12 buckets), ranks within about 1.7 %.
DISTINCT_BITS, QUANTILE_SIZE = 12, 200


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column (PROFILE_SCHEMA): rows, NULLs and mergeable sketches, in one pass over ``df``.

    Distinct values are sketched for every column (compared as text), quantiles
    for numbers; a column of another kind, or without values, has a NULL quantile
    sketch.  NaN counts as NULL in the quantiles.
    """
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(columns):
        aggs += [F.count(F.col(c)).alias(f"n{i}"), F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_BITS).alias(f"d{i}")]
        if isinstance(df.schema[c].dataType, T.NumericType):
            number = F.col(c).cast("double")
            aggs += [F.kll_sketch_agg_double(F.when(~F.isnan(number), number), QUANTILE_SIZE).alias(f"q{i}"),
                     F.count_if(~F.isnan(number)).alias(f"m{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col("total"), (F.col("total") - F.col(f"n{i}")).alias("nulls"),
                     F.col(f"d{i}").alias("distinct_sketch"),
                     (F.when(F.col(f"m{i}") > 0, F.col(f"q{i}")) if f"q{i}" in wide.columns else F.lit(None).cast("binary"))
                     .alias("quantile_sketch")) for i, c in enumerate(columns)]
    return wide.select(F.inline(F.array(*rows)))


def save_profile(profiled: DataFrame, path: str, run_id: str) -> None:
    """Keep a run's profile in the history at ``path``; the same run id replaces its own."""
    profiled.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """The profile history, with the run id as text."""
    return spark.read.schema(T.StructType([*PROFILE_SCHEMA.fields, T.StructField("run_id", T.StringType())])).parquet(path)


def merged_profile(profiles: DataFrame) -> DataFrame:
    """The profile of all runs together, per column, from their sketches alone."""
    return profiles.groupBy("column").agg(
        F.sum("total").alias("total"), F.sum("nulls").alias("nulls"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.when(F.count("quantile_sketch") > 0, F.kll_merge_agg_double("quantile_sketch")).alias("quantile_sketch"))


def drift(profiles: DataFrame, null_share: float = 0.05, distinct_ratio: float = 0.25, median_ratio: float = 0.25) -> DataFrame:
    """Each run's columns compared with the run before (by run id).

    ``null_drift``: the share of NULLs moved by more than ``null_share``;
    ``distinct_drift`` and ``median_drift``: the estimate moved by more than that
    part of the earlier one's size.  A column's first run, and values one of the
    two runs lacks, give NULL.  Keep the ratios well over the sketches' errors.
    The history has a row per run and column, so its windows are small.
    """
    before = Window.partitionBy("column").orderBy("run_id")
    median = F.when(F.col("quantile_sketch").isNotNull(), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(0.5)))
    share = F.try_divide(F.col("nulls").cast("double"), F.col("total"))
    measured = profiles.select("run_id", "column", "total", "nulls", share.alias("_share"),
                               F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), median.alias("median_estimate"))
    moved = lambda c: F.abs(F.col(c) - F.lag(c).over(before))
    part = lambda c, ratio: moved(c) > ratio * F.abs(F.lag(c).over(before))
    return measured.select("run_id", "column", "total", "nulls", "distinct_estimate", "median_estimate",
                           (moved("_share") > null_share).alias("null_drift"),
                           part("distinct_estimate", distinct_ratio).alias("distinct_drift"),
                           part("median_estimate", median_ratio).alias("median_drift"))
