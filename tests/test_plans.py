"""Plan shapes the design relies on."""

import os

from pyspark.sql import functions as F

from lakeshore.operators.dedupe import dedupe_latest
from lakeshore.plans import reports


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_and_pushed_filters(spark, tmp_dir):
    path = os.path.join(tmp_dir, "logs")
    rows = [("A", "login", None, "u"), ("A", "product", "1", "u"), ("B", "login", None, "u"),
            ("A", "login", None, "u")]
    (spark.createDataFrame(rows, "country string, action string, product_id string, user_agent string")
          .write.partitionBy("country").parquet(path))
    logs = spark.read.parquet(path)
    q = reports.top_login_countries(logs)
    p = plan(q)
    assert "PushedFilters: [IsNotNull(action), EqualTo(action,login)]" in p
    assert "TakeOrderedAndProject" in p
    # ReadSchema is pruned to the columns the report needs
    assert "ReadSchema: struct<action:string>" in p
    # the top country from the subquery becomes a partition filter
    prods = spark.createDataFrame([(1, "one")], "product_id bigint, name string")
    q2 = reports.top_products_in_top_country(logs, prods)
    assert [tuple(r) for r in q2.collect()] == [(1, "1", "one")]
    q2.collect()
    assert "PartitionFilters: [isnotnull(country" in plan(q2)


def test_dedupe_pre_limits_before_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("updated_dt"))
    out = dedupe_latest(df, ["k"])
    assert "WindowGroupLimit" in plan(out)
    assert sorted(r.updated_dt for r in out.collect()) == list(range(990, 1000))


def test_no_forced_shuffle_of_the_driver_tables(spark):
    from lakeshore.plans import registry

    for name in ("order_documents", "upsert_orders_raw", "bronze_logs"):
        assert "RoundRobin" not in plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_dedupe_with_a_key_holding_a_third_of_rows(spark):
    n = 30000
    df = spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("updated_dt"))
    out = dedupe_latest(df, ["k"])
    hot = out.where("k = -1").collect()
    assert [r.updated_dt for r in hot] == [n - 3]          # the newest of the hot key's 10,000 rows
    assert out.count() == 1 + (n - n // 3)
    assert "WindowGroupLimit" in plan(out)
