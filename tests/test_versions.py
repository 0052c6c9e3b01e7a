"""Merged tables: tombstones, versions, times, commit records, added columns; silver kept by the change feed."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lakeshore.operators.upsert import commit_history, merge_into, read_changes, read_table, write_snapshot
from lakeshore.plans.orders import item_changes
from lakeshore.schemas import KEYS, ORDERS_RAW
from lakeshore.streaming import streams

DDL = "k long, v string, t int"


def batch(spark, rows, ddl=DDL + ", gone boolean"):
    return spark.createDataFrame(rows, ddl)


def merge(spark, path, rows, n, **how):
    return merge_into(spark, path, batch(spark, rows), ["k"], n, order_by=["t"], delete_when=F.col("gone"), new_columns="drop", **how)


def contents(spark, path, **how):
    return {r.k: r.v for r in read_table(spark, path, ["k"], **how).collect()}


def test_versions_times_and_records_follow_a_dict(spark, tmp_dir):
    """Random batches with deletions, a replay and snapshots, against a dict per version."""
    rng = random.Random(4)
    path, state, at_version = os.path.join(tmp_dir, "t"), {}, {}
    first = [(k, "first", 0) for k in range(12)]
    merge_into(spark, path, spark.createDataFrame(first, DDL), ["k"], 0, order_by=["t"], committed_at="2022-11-01 00:00:00")
    state = {k: "first" for k, _, _ in first}
    at_version[1] = (dict(state), (12, 12, 0, 0))
    version = 1
    for day in range(2, 8):
        rows = [(rng.randrange(16), f"day {day} row {i}", i, rng.random() < 0.4) for i in range(8)] + [(None, "no key", 1, False)]
        last = {k: (v, gone) for k, v, _, gone in sorted(rows[:-1], key=lambda r: r[2])}
        counts = (len(last), sum(k not in state and not g for k, (_, g) in last.items()),
                  sum(k in state and not g for k, (_, g) in last.items()), sum(k in state and g for k, (_, g) in last.items()))
        merge(spark, path, rows, day, committed_at=f"2022-11-{day:02d} 00:00:00")
        for k, (v, gone) in last.items():
            state.pop(k, None) if gone else state.update({k: v})
        version += 1
        at_version[version] = (dict(state), counts)
        if day == 4:
            write_snapshot(spark, path, ["k"], keep=3, committed_at="2022-11-04 12:00:00")
            version += 1
            at_version[version] = (dict(state), (None, 0, 0, 0))
    merge(spark, path, rows, day, committed_at="2022-11-20 00:00:00")       # the last batch again: the same contents
    assert contents(spark, path) == state
    for v, (want, _) in at_version.items():
        assert contents(spark, path, version=v) == want, v
    assert contents(spark, path, as_of="2022-11-04 11:59:59") == at_version[4][0]
    assert contents(spark, path, as_of="2022-11-06 18:00:00") == at_version[7][0]
    got = {r.version: (r.num_source_rows, r.num_inserted, r.num_updated, r.num_deleted) for r in commit_history(spark, path).collect()}
    assert {v: got[v] for v in at_version} == {v: c for v, (_, c) in at_version.items()} and len(got) == version + 1
    for how in ({"version": 99}, {"version": 0}, {"as_of": "2020-01-01"}, {"version": 1, "as_of": "2022-11-06"}):
        with pytest.raises(ValueError):
            read_table(spark, path, ["k"], **how)


def test_deleted_folders_end_their_versions_but_not_their_records(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    for day in range(6):
        merge(spark, path, [(day, "x", 1, False), (0, "y", 1, day == 5)], day, snapshot_after=2)
    assert contents(spark, path) == {k: "x" for k in range(1, 6)}
    versions = sorted(r.version for r in commit_history(spark, path).collect())
    oldest = min(int(n.split("=")[1]) for n in os.listdir(path))
    assert versions[0] == 1 < oldest and versions == list(range(1, versions[-1] + 1))
    with pytest.raises(ValueError):
        read_table(spark, path, ["k"], version=oldest - 1)
    assert contents(spark, path, version=oldest)[0] == "y"


def test_a_missing_record_is_written_by_the_next_merge(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    merge(spark, path, [(1, "a", 1, False)], 1)
    os.remove(os.path.join(tmp_dir, "_commits", "t", "version=1", "_SUCCESS"))    # died before its record
    merge(spark, path, [(2, "b", 1, False)], 2)
    got = {r.version: (r.batch, r.operation, r.num_inserted) for r in commit_history(spark, path).collect()}
    assert got == {1: ("1", "MERGE", None), 2: ("2", "MERGE", 1)}


def test_added_columns_and_refused_ones(spark, tmp_dir):
    path, feed = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "feed")
    wide = spark.createDataFrame([(2, "b2", 1, 7.5), (3, "c", 1, None)], DDL + ", price double")
    merge_into(spark, path, spark.createDataFrame([(1, "a", 0), (2, "b", 0)], DDL), ["k"], 1, order_by=["t"], changes_path=feed)
    with pytest.raises(ValueError, match="price"):
        merge_into(spark, path, wide, ["k"], 2, order_by=["t"])
    with pytest.raises(ValueError, match="'v'"):
        merge_into(spark, path, spark.createDataFrame([(1, 5, 0)], "k long, v long, t int"), ["k"], 2, order_by=["t"], new_columns="add")
    merge_into(spark, path, wide, ["k"], 2, order_by=["t"], new_columns="add", changes_path=feed)
    merge_into(spark, path, spark.createDataFrame([(4, "d", 2)], DDL), ["k"], 3, order_by=["t"], new_columns="add")
    rows = lambda **how: sorted(tuple(r) for r in read_table(spark, path, ["k"], **how).collect())
    assert rows() == [(1, "a", 0, None), (2, "b2", 1, 7.5), (3, "c", 1, None), (4, "d", 2, None)]
    assert rows(version=1) == [(1, "a", 0), (2, "b", 0)]
    assert {r.version: r.new_columns for r in commit_history(spark, path).collect()} == {1: [], 2: ["price"], 3: []}
    write_snapshot(spark, path, ["k"])
    assert read_table(spark, path, ["k"]).columns == ["k", "v", "t", "price"]
    pre = spark.read.schema(wide.schema.add("_change_type", "string")).parquet(os.path.join(feed, "version=2")).where("_change_type = 'update_preimage'")
    assert [(r.k, r.price) for r in pre.collect()] == [(2, None)]


# --- silver from the change feed -------------------------------------------------------

def doc(oid, items, status="finished"):
    maps = [{"cuit": "7", "name": "w", "price": "1.5", "price_default": "1.0", "product_id": str(p), "amount": str(a)} for p, a in items]
    return ("1990-01-01", "77", "Ann", maps, "2022-11-14 10:00:00", oid, status, "20.5")


def documents(spark, rows):
    doc_fields = [f for f in ORDERS_RAW.fields if f.name not in ("_rescued_data", "record_timestamp")]
    assert [f.name for f in doc_fields] == ["customer_birth_day", "customer_document_number", "customer_name", "items", "order_dt", "order_id",
                                            "status", "total_price"]
    ddl = ", ".join(f"{f.name} {'string' if f.name == 'customer_birth_day' else f.dataType.simpleString()}" for f in doc_fields)
    df = spark.createDataFrame(rows, ddl).withColumn("customer_birth_day", F.col("customer_birth_day").cast("date"))
    return df.select("*", F.lit(None).cast("string").alias("_rescued_data"), F.lit("2022-11-14").cast("date").alias("record_timestamp"))


def test_silver_follows_inserts_updates_and_deletes_of_documents(spark, tmp_dir):
    bronze, feed, silver, ck = (os.path.join(tmp_dir, x) for x in ("bronze", "feed", "silver", "ck"))
    days = [[doc("a", [(1, 1), (2, 2)]), doc("b", [(1, 5)]), doc("c", [])],
            [doc("a", [(2, 9), (3, 3)]), doc("b", [], "purged"), doc("d", [(4, 1), (4, 2)]), doc("c", [(8, 8)])],
            [doc("a", [(1, 7)]), doc("d", [(4, 1)], "purged"), doc("b", [(6, 6)]), doc("nope", [], "purged")]]
    want = [{("a", 1): 1, ("a", 2): 2, ("b", 1): 5}, {("a", 2): 9, ("a", 3): 3, ("d", 4): 2, ("c", 8): 8},
            {("a", 1): 7, ("b", 6): 6, ("c", 8): 8}]

    def load(n):
        merge_into(spark, bronze, documents(spark, days[n]), KEYS["orders_raw"], n, order_by=["record_timestamp"], changes_path=feed,
                   delete_when=F.col("status") == "purged")

    def drain(to=silver, checkpoint=ck):
        streams.run_to_end(streams.start_silver_from_changes_stream(spark, feed, to, checkpoint, load_ts="2022-11-14 21:00:00", max_files_per_trigger=1))
        return {(r.order_id, r.product_id): r.amount for r in streams.read_silver_orders(spark, to).collect()}

    load(0)
    assert drain() == want[0]
    assert drain() == want[0]                        # restart: nothing is read twice
    load(1)
    load(2)
    assert drain() == want[2]
    assert drain(os.path.join(tmp_dir, "other"), os.path.join(tmp_dir, "ck2")) == want[2]       # the whole feed at once
    # A micro-batch that holds all versions gives the same.
    changes = read_changes(spark, feed)
    net = {(r.order_id, r.product_id): r.amount for r in item_changes(changes, "2022-11-14 21:00:00").where("NOT _deleted").collect()}
    assert net == want[2]
    assert read_table(spark, bronze, KEYS["orders_raw"], version=2).where("order_id = 'b'").count() == 0
