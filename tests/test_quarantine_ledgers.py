"""Quarantine reasons and replay, the orphan ledger, kept reports, column profiles."""

import datetime
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import quality
from lakeshore.operators.referential import update_ledger
from lakeshore.operators.upsert import read_table
from lakeshore.schemas import KEYS
from lakeshore.sources import quarantine as q
from lakeshore.streaming import streams

LINE = '1.2.3.4 - ann [04/11/2022 10:11:12] "GET /product/7" 200 12 - "curl"'


def test_log_reasons(spark):
    lines = [LINE, LINE.replace("/11/", "/13/"), LINE.replace("1.2.3.4", "1.2.3.999"), LINE.replace("1.2.3.4", "2001:db8::1"),
             LINE.replace("/11/", "/13/").replace(" 200 ", " OK "), "not a line", "", None]
    got = q.tag_log_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {r.value: r[q.REASONS] for r in got.collect()} == {
        lines[0]: [], lines[1]: ["bad_time"], lines[2]: ["bad_address"], lines[3]: [], lines[4]: ["bad_time", "bad_status"],
        lines[5]: ["bad_line"]}


def order(oid, **other):
    return {"order_id": oid, "status": "finished", "order_dt": "2022-11-14 10:11:12", "items": [{"product_id": "1"}, {"product_id": "2"}],
            "total_price": "2.50"} | other


def tag(spark, *texts):
    return q.tag_order_lines(spark.createDataFrame([(t,) for t in texts], "value string"), "2022-11-14")


def test_order_reasons(spark):
    good, late = order("a", colour="red"), order("b", order_dt="soon")
    both = order("c", order_dt=None, items=[{"product_id": "1"}, {"product_id": "1"}], customer_birth_day="x")
    texts = [json.dumps([good, late]), json.dumps(both), json.dumps(order(None)), '{"order_id": "d"', "[1, 2", "7", " ", None]
    got = tag(spark, *texts).collect()
    assert sorted((r.order_id or "", r.value if r.order_id is None and not r.value.startswith('{"order_id": null') else "", r[q.REASONS]) for r in got) == sorted([
        ("a", "", []), ("b", "", ["bad_time"]), ("c", "", ["bad_field:customer_birth_day", "bad_time", "repeated_item"]),
        ("", "", ["no_key"]), ("", '{"order_id": "d"', ["bad_json"]), ("", "[1, 2", ["bad_json"]), ("", "7", ["bad_json"])])
    assert [json.loads(r._rescued_data) for r in got if r._rescued_data] == [{"colour": "red"}]


def test_replay_merges_each_record_once(spark, tmp_dir):
    kept, table = os.path.join(tmp_dir, "quarantine"), os.path.join(tmp_dir, "orders_raw")
    bad = {k: json.dumps(order(k, order_dt="soon")) for k in "abc"}
    rid = lambda t: spark.createDataFrame([(t,)], "value string").select(q.record_id()).first()[0]
    q.keep_quarantined(spark, kept, tag(spark, *bad.values(), bad["a"]), 1)
    fixed = lambda *ks: spark.createDataFrame([(rid(bad[k]), json.dumps(order(k, **v))) for k, v in ks], "record_id string, value string")
    ledger = lambda: {json.loads(r.value)["order_id"]: (r.status, r.replayed_in, list(r.reasons)) for r in read_table(spark, kept, [q.RECORD]).collect()}
    orders = lambda: {r.order_id: (r.status, str(r.record_timestamp)) for r in read_table(spark, table, KEYS["orders_raw"]).collect()}
    assert ledger() == {k: ("open", None, ["bad_time"]) for k in "abc"}
    # a is corrected, b's correction is still wrong, a correction of a record that isn't in quarantine is passed over
    first = fixed(("a", {}), ("b", {"items": [{"product_id": "1"}] * 2})).union(
        spark.createDataFrame([("no such record", json.dumps(order("z")))], "record_id string, value string"))
    for _ in range(2):      # the batch is repeated
        q.replay_orders(spark, kept, first, table, KEYS["orders_raw"], 2, "2022-11-15")
        assert orders() == {"a": ("finished", "2022-11-15")}
        assert ledger() == {"a": ("replayed", "2", ["bad_time"]), "b": ("open", None, ["repeated_item"]), "c": ("open", None, ["bad_time"])}
    # the damaged file is sent again, and so is a's correction with another status
    q.keep_quarantined(spark, kept, tag(spark, *bad.values()), 3)
    q.replay_orders(spark, kept, fixed(("a", {"status": "changed"}), ("c", {})), table, KEYS["orders_raw"], 4, "2022-11-16")
    assert orders() == {"a": ("finished", "2022-11-15"), "c": ("finished", "2022-11-16")}
    assert {k: v[0] for k, v in ledger().items()} == {"a": "replayed", "b": "open", "c": "replayed"}


def test_orphan_ledger_against_a_model(spark, tmp_dir):
    rng = random.Random(5)
    path = os.path.join(tmp_dir, "ledger")
    parents, model, current = set(), {}, {}
    for day in range(1, 6):
        at = datetime.datetime(2022, 11, day)
        parents = (parents | {rng.randrange(12) for _ in range(3)}) - {rng.randrange(12)}
        load = {rng.randrange(30): rng.choice([None, *range(12)]) for _ in range(8)}
        current |= load
        for child in set(load) | {c for c, v in model.items() if v[3] is None}:
            fk, was = current[child], model.get(child)
            is_open = was is not None and was[3] is None
            if fk not in parents:
                model[child] = (fk, "open", was[2] if is_open else at, None)
            elif is_open:
                model[child] = (was[0], "resolved", was[2], at)
        rows = [(c, fk, 2) for c, fk in load.items()] + [(c, 99, 1) for c in load] + [(None, 99, 1)]
        children = spark.createDataFrame(rows, "child long, parent long, n int")
        there = spark.createDataFrame([(p,) for p in parents for _ in range(2)] + [(None,)], "parent long")
        for _ in range(2):      # every load is repeated
            ledger = update_ledger(spark, path, children, there, "child", "parent", at, day, ["n"])
            assert {r.child: tuple(r)[1:] for r in ledger.collect()} == model
    assert {v[1] for v in model.values()} == {"open", "resolved"}


def test_orphan_ledger_empty_tables(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ledger")
    none = spark.createDataFrame([], "child long, parent long")
    assert update_ledger(spark, path, none, none.select("parent"), "child", "parent", "2022-11-14", 1).count() == 0
    some = spark.createDataFrame([(1, 2)], "child long, parent long")
    assert update_ledger(spark, path, some, none.select("parent"), "child", "parent", "2022-11-15", 2).first().status == "open"


def test_kept_report_counts_once_across_restarts(spark, tmp_dir):
    silver, report, ck = (os.path.join(tmp_dir, x) for x in ("silver", "report", "ck"))

    def add_and_drain(rows):
        df = spark.createDataFrame([(c, a) for c, a in rows], "country string, action string")
        df.write.mode("append").parquet(silver)
        streams.run_to_end(streams.start_login_countries_stream(spark, silver, report, ck, max_files_per_trigger=1))
        return [(r.country, r.number_of_users) for r in streams.read_login_countries(spark, report).collect()]

    assert add_and_drain([("AR", "login"), ("AR", "product"), ("BR", "login"), (None, "login")]) == [("AR", 1), ("BR", 1), (None, 0)]
    assert add_and_drain([("BR", "login"), ("", "login"), (None, "login")]) == [("BR", 2), ("", 1), ("AR", 1), (None, 0)]
    assert add_and_drain([]) == [("BR", 2), ("", 1), ("AR", 1), (None, 0)]


def test_profiles_merge_within_their_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "profiles")
    for run, (lo, hi) in enumerate([(0, 20000), (10000, 40000)]):
        batch = spark.range(lo, hi).select("id", F.when(F.col("id") % 4 > 0, F.col("id")).alias("part"), F.lit("x").alias("text"))
        quality.save_profile(quality.profile(batch, ["id", "part", "text"]), path, f"r{run}")
    both = quality.merged_profile(quality.read_profiles(spark, path)).select(
        "column", "total", "nulls", F.hll_sketch_estimate("distinct_sketch").alias("n"),
        F.when(F.col("quantile_sketch").isNotNull(), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(0.5))).alias("m"))
    got = {r.column: r for r in both.collect()}
    assert (got["id"].total, got["id"].nulls, got["part"].nulls) == (50000, 0, 12500)
    assert abs(got["id"].n - 40000) < 0.04 * 40000 and abs(got["part"].n - 30000) < 0.04 * 30000 and got["text"].n == 1
    # half of the 50,000 rows are at most 17,500: ranks within 2 % are 1,000 rows, which is at most 1,000 ids here
    assert abs(got["id"].m - 17500) < 1000 and got["text"].m is None


def test_drift_and_empty_profiles(spark, tmp_dir):
    path = os.path.join(tmp_dir, "profiles")
    rows = {"a": [(1.0, "x"), (2.0, "y")], "b": [(float("nan"), "x"), (10.0, None)], "c": []}
    for run, data in rows.items():
        quality.save_profile(quality.profile(spark.createDataFrame(data, "v double, t string"), ["v", "t"]), path, run)
    quality.save_profile(quality.profile(spark.createDataFrame(rows["a"], "v double, t string"), ["v", "t"]), path, "a")
    got = {(r.run_id, r.column): (r.total, r.nulls, r.null_drift, r.distinct_drift, r.median_drift)
           for r in quality.drift(quality.read_profiles(spark, path)).collect()}
    assert got == {
        ("a", "v"): (2, 0, None, None, None), ("b", "v"): (2, 0, False, False, True), ("c", "v"): (0, 0, None, True, None),
        ("a", "t"): (2, 0, None, None, None), ("b", "t"): (2, 1, True, True, None), ("c", "t"): (0, 0, None, True, None)}


@pytest.mark.parametrize("value", ["[]", "[null]", "null"])
def test_order_lines_without_documents(spark, value):
    assert [r[q.REASONS] for r in tag(spark, value).collect()] in ([], [["bad_json"]])
