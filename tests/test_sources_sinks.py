import datetime
import json
import os

from pyspark.sql import functions as F

from lakeshore.functions.fmt import date_range_rows, epoch_ms_to_string
from lakeshore.operators.quality import Suite, not_null, read_results, run_suite, save_results
from lakeshore.operators.sample import bernoulli, hash_fraction, hash_sample_n
from lakeshore.plans import monitor, reports, weblogs
from lakeshore.sinks.landing import land_log_lines, land_order_documents
from lakeshore.sources.files import (parse_order_lines, read_job_runs, read_order_documents, read_records,
                                     schema_drift, text_files)


def test_job_run_listing_and_view(spark, tmp_dir):
    runs = {"runs": [
        {"job_id": 1, "run_id": 10, "number_in_job": 1, "state": {"life_cycle_state": "TERMINATED",
         "state_message": ""}, "start_time": 1668420000123, "setup_duration": "0", "creator_user_name": "a@x",
         "run_name": "orders", "run_page_url": "https://x/run/10", "run_type": "JOB_RUN"},
        {"job_id": 2, "run_id": 11, "number_in_job": 1, "state": {"life_cycle_state": "RUNNING",
         "state_message": "busy"}, "start_time": 1668420001000, "setup_duration": "0", "creator_user_name": "b@x",
         "run_name": "adhoc", "run_page_url": "https://x/run/11", "run_type": "SUBMIT_RUN"}]}
    p = os.path.join(tmp_dir, "runs")
    os.makedirs(p)
    with open(os.path.join(p, "list.json"), "w") as f:
        json.dump(runs, f, indent=2)
    df = read_job_runs(spark, p)
    assert df.count() == 2
    v = monitor.job_runs_view(df).collect()
    assert len(v) == 1 and v[0].run_id == 10 and "start_time" not in v[0].asDict()
    assert v[0].run_start_time == "14-11-2022 10:00:00"
    assert v[0].table_row_tag.startswith('<tr role="row" class="even"><td>1</td><td><a href="https://x/run/10"')
    assert "<td>TERMINATED</td>" in v[0].table_row_tag
    assert monitor.job_runs_view(df, run_type="SUBMIT_RUN").count() == 1
    assert monitor.job_runs_view(df, run_type=None).count() == 2


def test_epoch_and_date_list(spark):
    df = spark.createDataFrame([(0, datetime.date(2021, 1, 1), datetime.date(2021, 1, 4))],
                               "ms bigint, s date, e date")
    r = df.select(epoch_ms_to_string("ms").alias("t"), date_range_rows("s", "e").alias("d")).first()
    assert r.t == "01-01-1970 00:00:00"
    assert r.d == [datetime.date(2021, 1, 1), datetime.date(2021, 1, 2), datetime.date(2021, 1, 3)]
    n = spark.createDataFrame([(datetime.date(2021, 1, 1), datetime.date(2022, 11, 9))], "s date, e date")
    assert n.select(F.explode(date_range_rows("s", "e"))).count() == 677


def test_schema_drift(spark):
    docs = spark.createDataFrame([('{"order_id":"a","zz":1}',), ('{"order_id":"b","zz":2,"yy":3}',)], "_doc string")
    got = {r.key: r["count"] for r in schema_drift(docs).collect()}
    assert got == {"zz": 2, "yy": 1}


def test_landing_roundtrip(spark, tmp_dir):
    lines = [('{"order_id":"a","items":[{"product_id":"1","amount":"2"}],"total_price":"3"}',)]
    docs = parse_order_lines(spark.createDataFrame(lines, "value string"), "2022-11-14").orders.drop(
        "_bad_fields", "_rescued_data", "record_timestamp")
    land = os.path.join(tmp_dir, "orders")
    land_order_documents(docs, land, "2022-11-14")
    assert os.path.isdir(os.path.join(land, "year=2022", "record_dt=2022-11-14"))
    back = read_order_documents(spark, land, "2022-11-14").orders.first()
    assert back.order_id == "a" and back.items == [{"product_id": "1", "amount": "2"}]
    logs = os.path.join(tmp_dir, "logs")
    land_log_lines(spark.createDataFrame([("x y",)], "value string"), logs, "2022-11-04")
    assert [r.value for r in text_files(spark, logs).collect()] == ["x y"]


def test_report_over_a_view(spark):
    logs = spark.createDataFrame([("A", "login", None, "u1"), ("A", "login", None, "u1"),
                                  ("B", "login", None, "u2")],
                                 "country string, action string, product_id string, user_agent string")
    logs.createOrReplaceTempView("logs")
    a = [tuple(r) for r in reports.top_login_countries(spark.table("logs")).collect()]
    b = [tuple(r) for r in reports.top_login_countries(logs).collect()]
    assert a == b == [(2, "A"), (1, "B")]


def test_samples_repeatable(spark):
    df = spark.range(0, 10000).withColumnRenamed("id", "k")
    a = hash_fraction(df, 0.3, ["k"], seed=1)
    b = hash_fraction(df, 0.3, ["k"], seed=1)
    assert a.count() == b.count() and 2500 < a.count() < 3500
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in b.collect())
    assert 2500 < hash_fraction(df, 0.3, ["k"], 1, method="arith").count() < 3500
    assert [r.k for r in hash_sample_n(df, 3, ["k"], 7).collect()] == [r.k for r in hash_sample_n(df, 3, ["k"], 7).collect()]
    assert hash_sample_n(df, 3, ["k"], 7).count() == 3
    assert 2500 < bernoulli(df, 0.3, seed=3).count() < 3500


def test_quality_history(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    path = os.path.join(tmp_dir, "dq")
    for run in ["20221113", "20221114"]:
        save_results(run_suite(df, Suite("s", [not_null("a")]), run), path)
    hist = read_results(spark, path)
    assert sorted(r.run_id for r in hist.collect()) == ["20221113", "20221114"]


def test_logs_from_lines_plan_is_python_free(spark):
    lines = spark.createDataFrame([('1.0.0.1 - u [04/11/2022 10:11:12] "GET /login/1" 200 5 - "curl/7"',)],
                                  "value string")
    geo = spark.createDataFrame([(16777216, 16777300, "X")], "ip_from bigint, ip_to bigint, country string")
    out = weblogs.logs_from_lines(lines, geo, as_of="2022-11-14")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert plan.count("from_csv") == 1      # the line is parsed once
    assert out.first().country == "X"


def test_read_records_uses_table_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "new_companies")
    os.makedirs(p)
    with open(os.path.join(p, "a.json"), "w") as f:
        f.write('{"name": "Acme", "updated_dt": "2022-11-14T10:00:00Z", "cuit": 30712345678}\n')
    df = read_records(spark, p, "companies")
    assert df.columns == ["cuit", "name", "updated_dt"]
    r = df.first()
    assert r.cuit == 30712345678 and r.updated_dt == datetime.datetime(2022, 11, 14, 10, 0)


def test_append_table_keeps_earlier_rows(spark, tmp_dir):
    from lakeshore.sinks.snapshots import append_table

    path = os.path.join(tmp_dir, "t")
    for day in ("a", "b"):
        append_table(spark.createDataFrame([(1, day)], "k int, day string"), path, partition_by=["day"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (1, "b")]
