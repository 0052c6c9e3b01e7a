"""Files per folder of partitioned writes; days without orders; listings read by line."""

import json
import os

from pyspark.sql import functions as F

from lakeshore.operators.geo import ranges_from_cidr_blocks
from lakeshore.plans.reports import daily_orders
from lakeshore.sinks.partitioned import FILES_PER_TASK, SLACK, file_slots, write_bounded
from lakeshore.sources.files import read_job_runs
from lakeshore.streaming import streams

LINE = '{ip} - ann [04/11/2022 10:{m:02d}:{s:02d}] "GET /product/{n}" 200 12 - "curl"'


def files(spark, path, by):
    rows = spark.read.parquet(path)
    return {r[by]: (r.n_files, r.most) for r in rows.groupBy(by, F.col("_metadata.file_path")).count().groupBy(by)
            .agg(F.count(F.lit(1)).alias("n_files"), F.max("count").alias("most")).collect()}


def test_a_hot_country_is_split_and_rare_ones_make_one_file(spark, tmp_dir):
    n = 30_000
    country = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 997 == 1, None).otherwise(F.concat(F.lit("c"), F.col("id") % 40))
    rows = spark.range(0, n, 1, 24).select("id", country.alias("country"), F.lit("x").alias("_slot_n"))
    path = os.path.join(tmp_dir, "logs")
    write_bounded(rows, path, ["country"], 1000)
    want = {r.country: -(-r["count"] // 1000) for r in rows.groupBy("country").count().collect()}
    got = files(spark, path, "country")
    assert {c: f for c, (f, _) in got.items()} == want
    assert want["hot"] == 10 and want[None] == 1 and max(most for _, most in got.values()) <= SLACK * 1000
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(n))


def test_many_small_files_come_from_few_tasks(spark, tmp_dir):
    n = 30_000
    country = (F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 997 == 1, None).when(F.col("id") % 5 == 0, "twins")
                .otherwise(F.concat(F.lit("c"), F.col("id") % 40)))
    rows = spark.range(0, n, 1, 24).select(F.when(F.col("id") % 5 == 0, 7).otherwise(F.col("id")).alias("id"), country.alias("country"),
                                           F.create_map(F.lit("x"), F.col("id") % 2).alias("m"), F.lit("x").alias("_slot_n"))
    path = os.path.join(tmp_dir, "logs")
    write_bounded(rows, path, ["country"], 20)
    assert files(spark, path, "country") == {r.country: (-(-r["count"] // 20), min(20, r["count"])) for r in rows.groupBy("country").count().collect()}
    written = spark.read.parquet(path)
    text = lambda df: sorted(df.select(F.to_json(F.struct("country", "id", "m", "_slot_n")).alias("t")).toPandas()["t"])
    assert text(written) == text(rows)
    # Files are named by their task: about n / 20 of them by n / 20 / FILES_PER_TASK tasks, and a few for the rows over.
    tasks = {os.path.basename(r.f).split("-")[1] for r in written.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert len(tasks) <= n // 20 // FILES_PER_TASK + 5


def test_slots_do_not_overlap(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 2500, "a").when(F.col("id") < 4000, "b").otherwise((F.col("id") % 7).cast("string")).alias("k"))
    got = {r.k: r for r in file_slots(rows, ["k"], 1000).collect()}
    own = [s for k in "ab" for s in range(got[k].slot, got[k].slot + got[k].n_files)]
    assert sorted(own) == list(range(5)) and (got["a"].n_files, got["b"].n_files) == (3, 2)
    assert {got[str(k)].slot for k in range(7)} == {5} and all(got[str(k)].n_files == 1 for k in range(7))


def test_equal_rows_and_no_rows(spark, tmp_dir):
    same, none = os.path.join(tmp_dir, "same"), os.path.join(tmp_dir, "none")
    rows = spark.range(1000).select(F.lit("a").alias("k"), F.lit(1).alias("v"), F.create_map(F.lit("x"), F.lit(2)).alias("m"))
    write_bounded(rows, same, ["k"], 100)
    assert spark.read.parquet(same).count() == 1000 and files(spark, same, "k")["a"] == (7, 150)
    write_bounded(rows.limit(0), none, ["k"], 100)
    assert not [f for f in os.listdir(none) if f.endswith(".parquet") or f.startswith("k=")]


def test_stream_restart_and_unfinished_batch(spark, tmp_dir):
    land, bronze, silver = (os.path.join(tmp_dir, x) for x in ("land", "bronze", "silver"))
    geo = ranges_from_cidr_blocks(spark.createDataFrame([("1.0.0.0/8", 1)], "network string, geoname_id long"),
                                  spark.createDataFrame([(1, "Here")], "geoname_id long, country_name string"))

    def day(k, n):
        os.makedirs(os.path.join(land, f"record_dt={k}"))
        with open(os.path.join(land, f"record_dt={k}", "log"), "w") as f:
            f.writelines(LINE.format(ip="1.2.3.4" if i % 3 else "9.9.9.9", m=i // 60 % 60, s=i % 60, n=i) + "\n" for i in range(n))
        streams.run_to_end(streams.start_bronze_logs_stream(spark, land, bronze, os.path.join(tmp_dir, "ck1"), as_of="2022-11-14"))
        streams.run_to_end(streams.start_bounded_logs_stream(spark, bronze, silver, os.path.join(tmp_dir, "ck2"), geo, rows_per_file=100))

    assert streams.read_bounded_logs(spark, silver).count() == 0
    day("2022-11-13", 600)
    day("2022-11-14", 60)
    got = streams.read_bounded_logs(spark, silver)
    assert {r.country: r["count"] for r in got.groupBy("country").count().collect()} == {"Here": 440, None: 220}
    assert len(os.listdir(os.path.join(silver, "batch=0", "country=Here"))) >= 4
    os.remove(os.path.join(silver, "batch=1", "_SUCCESS"))
    assert streams.read_bounded_logs(spark, silver).count() == 600


def test_days_without_orders(spark):
    items = spark.createDataFrame([("a", "2022-01-30", "finished"), ("a", "2022-01-30", "finished"), ("b", "2022-02-02", "finished"),
                                   ("c", "2022-03-09", "pending"), ("d", None, "finished")], "order_id string, d string, status string")
    items = items.withColumn("order_dt", F.to_date("d"))
    got = {str(r.day): r.n_orders for r in daily_orders(items, "finished").collect()}
    assert got == {"2022-01-30": 1, "2022-01-31": 0, "2022-02-01": 0, "2022-02-02": 1}
    assert daily_orders(items, "lost").collect() == []


def test_listings_by_line(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "runs.json"), "w") as f:
        for ids in ([1, 2], [], [3]):
            f.write(json.dumps({"runs": [{"job_id": 7, "run_id": i} for i in ids]}) + "\n")
    assert sorted(r.run_id for r in read_job_runs(spark, tmp_dir, multi_line=False).collect()) == [1, 2, 3]
