"""Merges and documents at size: what is shuffled, and into how many partitions."""

import os

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import upsert as u
from lakeshore.operators.changes import CHANGE_TYPE, DELETE, INSERT, UPDATE_POST, UPDATE_PRE
from lakeshore.operators.dedupe import dedupe_latest
from lakeshore.plans import registry
from lakeshore.plans.orders import item_changes, latest_items, silver_orders
from lakeshore.schemas import KEYS, ORDERS_RAW
from lakeshore.sources import driver as d


def _tables(spark, root):
    put = lambda df, name: df.coalesce(1).write.parquet(os.path.join(root, f"{name}.parquet"))
    n = F.col("id")
    put(spark.range(40).select(n.alias("o_orderkey"), (n % 5).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (n % 3 + 1).cast("int")).alias("o_orderstatus"),
                               F.lit("2001-01-02").cast("timestamp").alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority")), "orders")
    put(spark.range(120).select((n % 39).alias("l_orderkey"), (n % 7).alias("l_partkey"), (n % 4).cast("int").alias("l_linenumber"),
                                (n % 20).cast("double").alias("l_quantity")), "lineitem")
    put(spark.range(4).select(n.alias("c_custkey"), F.lit("c").alias("c_name")), "customer")
    put(spark.range(7).select(n.alias("p_partkey"), F.lit("p").alias("p_name"), (n + 900.5).alias("p_retailprice")), "part")
    put(spark.range(3).select(n.alias("s_suppkey")), "supplier")
    return root


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_input(spark, tmp_dir, monkeypatch):
    sf = _tables(spark, tmp_dir)
    monkeypatch.setattr(d, "DOCUMENT_PARTITION_BYTES", 100)
    n = d.document_partitions(spark, sf)
    assert n > 8
    for name in ("upsert_orders_raw", "upsert_order_items"):
        df = registry.QUERIES[name](spark, sf)
        assert f", {n}), REPARTITION_BY_NUM" in _plan(df), name
        assert "ENSURE_REQUIREMENTS" not in _plan(df).split("FullOuter")[0].split("SortMergeJoin")[-1]


def test_documents_keep_their_partitioning(spark, tmp_dir, monkeypatch):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(d, "DOCUMENT_PARTITION_BYTES", 100)
    docs = d.order_documents(spark, _tables(spark, tmp_dir))
    plans = [_plan(docs), _plan(dedupe_latest(docs, ["order_id"], ["order_dt"]))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plans[0].count("Exchange hashpartitioning") == plans[1].count("Exchange hashpartitioning")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merge_shuffles_keys_only(spark, tmp_dir, monkeypatch):
    path, calls = os.path.join(tmp_dir, "t"), []
    real = u.dedupe_latest
    monkeypatch.setattr(u, "dedupe_latest", lambda *a, **k: calls.append(1) or real(*a, **k))
    rows = lambda *r: spark.createDataFrame(r, "k string, v int, updated_dt int")
    u.merge_into(spark, path, rows(("a", 1, 1), ("b", 2, 1), (None, 0, 1)), ["k"], 1)
    u.merge_into(spark, path, rows(("c", 3, 1), ("d", 4, 1)), ["k"], 2)
    assert not calls
    # No key is in two batches: the rows are read as they are.
    read = u.read_table(spark, path, ["k"])
    assert "Exchange" not in _plan(read) and "Join" not in _plan(read)
    u.merge_into(spark, path, rows(("c", 5, 2), ("c", 6, 3), ("c", 4, 3), ("e", 7, 1)), ["k"], 3)
    assert calls and _rows(u.read_table(spark, path, ["k"])) == [("a", 1, 1), ("b", 2, 1), ("c", 6, 3), ("d", 4, 1), ("e", 7, 1)]
    monkeypatch.setattr(u, "BROADCAST_KEYS", 0)
    u.merge_into(spark, path, rows(("a", 8, 2), ("a", 9, 3)), ["k"], 4)
    assert _rows(u.read_table(spark, path, ["k"])) == [("a", 9, 3), ("b", 2, 1), ("c", 6, 3), ("d", 4, 1), ("e", 7, 1)]
    assert not [x for x in os.listdir(path) if x.startswith(u.REPEATS)]


def test_items_of_a_document_are_kept_latest_in_it(spark, tmp_dir):
    docs = registry.d.orders_raw(spark, _tables(spark, tmp_dir))
    when = F.lit("2022-11-14 21:00:03").cast("timestamp")
    assert _rows(latest_items(docs, when)) == _rows(dedupe_latest(silver_orders(docs, when), KEYS["orders"], ["record_timestamp"]))


def test_repeated_items_are_put_in_order_without_a_shuffle(spark):
    item = lambda pid, amount, price, cuit="1": {"product_id": pid, "amount": amount, "price": price, "price_default": "1", "cuit": cuit, "name": "n"}
    orders = [("a", [item("1", "2", "5"), item(" 1", "3", "4"), item("2", "9", "1"), item("01", None, "8"), item(None, "1", "1"), item("x", "4", "1")]),
              ("b", [item("1", "2", "5"), item("1", "2", "7"), item("1", "2", None), item("3", "NaN", "NaN"), item("3", "1", "1", None)]),
              ("c", [item("1", "2", "5"), item("2", "2", "5")]), ("d", []), ("e", None), ("f", [item("7", "1", "1"), item("7", "1", "1")])]
    docs = spark.createDataFrame([(o, i, "finished", "2022-11-14") for o, i in orders],
                                 "order_id string, items array<map<string,string>>, status string, order_dt string").selectExpr(
        "*", "date'1990-01-01' customer_birth_day", "'7' customer_document_number", "'Ann' customer_name", "'1' total_price", "date'2022-11-14' record_timestamp")
    when = F.lit("2022-11-14 21:00:03").cast("timestamp")
    for order_by in (["record_timestamp"], ["item_price"], [F.col("item_price").asc()]):
        got = latest_items(docs, when, order_by)
        assert _rows(got) == _rows(dedupe_latest(silver_orders(docs, when), KEYS["orders"], order_by))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("Window" in plan) == (not isinstance(order_by[0], str))


def test_snapshots_shuffle_no_whole_rows(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    put = lambda n, *r: u.merge_into(spark, path, spark.createDataFrame(r, "k string, v int, updated_dt int, gone boolean"), ["k"], n,
                                     delete_when=F.col("gone"), new_columns="drop", null_keys="insert", count_changes=False)
    put(1, ("a", 1, 1, False), ("b", 2, 1, False), ("d", 7, 1, False), (None, 0, 1, False))
    put(2, ("b", 3, 2, False), ("d", 7, 2, True))
    put(3, ("b", 4, 3, False), ("c", 5, 3, False))
    monkeypatch.setattr(u, "_over", lambda *a: pytest.fail("whole rows are put in order"))
    u.write_snapshot(spark, path, ["k"])
    rows = spark.read.parquet(os.path.join(path, f"{u.SEQ}=4", f"{u.SNAPSHOT}=4"))
    assert sorted(((r.k, r.v) for r in rows.collect()), key=str) == [("a", 1), ("b", 4), ("c", 5), (None, 0)]


def test_staged_lines_are_not_kept_twice(spark, tmp_dir, monkeypatch):
    seen = {}
    real = registry._staged
    monkeypatch.setattr(registry, "_staged", lambda df, root, name: seen.setdefault(name, real(df, root, name)))
    out = registry.q_orders_after_replay(spark, _tables(spark, tmp_dir))
    assert out.count() > 0 and "value" not in seen["documents"].columns
    assert seen["tagged"].where((F.size("_reasons") == 0) & F.col("value").isNotNull()).count() == 0


def test_feed_and_reads_pick_rows_by_place(spark, tmp_dir, monkeypatch):
    path, feed, compared = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "feed"), []
    real = u.table_changes
    monkeypatch.setattr(u, "table_changes", lambda old, new, keys: compared.extend(r.k for r in new.collect()) or real(old, new, keys))
    monkeypatch.setattr(u, "BROADCAST_KEYS", 0)
    put = lambda n, *r: u.merge_into(spark, path, spark.createDataFrame(r, "k string, v int, m map<string,int>, updated_dt int, gone boolean"), ["k"], n,
                                     changes_path=feed, delete_when=F.col("gone"))
    put(1, *[(k, 1, {"x": 1}, 1, False) for k in "abcdf"])
    put(2, ("a", 2, {"x": 1}, 1, False), ("b", 1, {"x": 1}, 1, False), ("c", 1, {"x": 2}, 1, False), ("d", 1, None, 1, True),
        ("e", 1, {"x": 1}, 1, False), ("z", 1, None, 1, True))
    # Whole rows are compared only where the hashes don't show a change.
    assert sorted(compared) == ["b", "c"]
    got = u.read_changes(spark, feed).where("version = 2").select("k", "v", "m", CHANGE_TYPE, F.col("_metadata.file_modification_time").alias("at")).collect()
    assert sorted((r.k, r[CHANGE_TYPE], r.v, r.m["x"]) for r in got) == [
        ("a", UPDATE_POST, 2, 1), ("a", UPDATE_PRE, 1, 1), ("c", UPDATE_POST, 1, 2), ("c", UPDATE_PRE, 1, 1), ("d", DELETE, 1, 1), ("e", INSERT, 1, 1)]
    goes = lambda r: r[CHANGE_TYPE] in (DELETE, UPDATE_PRE)
    assert max(r["at"] for r in got if goes(r)) <= min(r["at"] for r in got if not goes(r))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    read = u.read_table(spark, path, ["k"])
    plan = _plan(read)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plan
    assert sorted((r.k, r.v, r.m["x"]) for r in read.collect()) == [("a", 2, 1), ("b", 1, 1), ("c", 1, 2), ("e", 1, 1), ("f", 1, 1)]


def _changes(spark, *rows):
    """Changes (order id, product ids, kind, version) of documents."""
    full = [(None, None, None, [{"product_id": p, "amount": str(v)} for p in products], None, k, None, None, None, None, kind, v)
            for k, products, kind, v in rows]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ORDERS_RAW.fields)
    return spark.createDataFrame(full, f"{ddl}, {CHANGE_TYPE} string, version long")


def test_items_of_changes_are_told_apart_by_ids(spark):
    simple = [("a", ["1", "2", "3"], UPDATE_PRE, 2), ("a", ["2", "4"], UPDATE_POST, 2), ("b", ["1"], INSERT, 2), ("c", ["1", "x"], DELETE, 2), ("d", [], INSERT, 2)]
    others = [("e", ["1"], INSERT, 1), ("e", ["1"], UPDATE_PRE, 2), ("e", ["2"], UPDATE_POST, 2), ("f", ["1", "1"], INSERT, 2),
              ("g", ["1", "2"], INSERT, 1), ("g", ["1", "2"], DELETE, 2), (None, ["1"], INSERT, 2), ("h", ["1"], DELETE, 1), ("h", ["1", "2"], INSERT, 2)]
    assert "Window" not in _plan(item_changes(_changes(spark, *simple)))
    for rows in (simple, others, simple + others):
        changes = _changes(spark, *rows)
        gone = F.col(CHANGE_TYPE).isin(DELETE, UPDATE_PRE)
        items = silver_orders(changes.select("*", gone.alias("_deleted")), keep=["version", "_deleted"])
        want = dedupe_latest(items, KEYS["orders"], ["version", F.col("_deleted").asc()])
        last = lambda df: sorted((r.order_id, r.product_id, r._deleted, None if r._deleted else r.amount)
                                 for r in df.where("order_id IS NOT NULL AND product_id IS NOT NULL").collect())
        assert last(item_changes(changes)) == last(want)
