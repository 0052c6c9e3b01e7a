import datetime
import os

from pyspark.sql import functions as F

from lakeshore.operators.changes import table_changes, table_history
from lakeshore.operators.dedupe import dedupe_latest
from lakeshore.operators.upsert import merge_into, null_key_rows, read_table, upsert
from lakeshore.sinks.snapshots import backup_snapshot, latest_snapshot
from lakeshore.plans.dimensions import daily_dimension_job, orphan_products, read_or_restore, rename_one
from lakeshore.sinks.snapshots import read_snapshot

DDL = "cuit bigint, name string, updated_dt timestamp"
T0 = datetime.datetime(2022, 11, 13)
T1 = datetime.datetime(2022, 11, 14)
T2 = datetime.datetime(2022, 11, 15)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_update_and_insert_repeatable(spark):
    tgt = spark.createDataFrame([(1, "a", T0), (2, "b", T0)], DDL)
    src = spark.createDataFrame([(2, "b2", T1), (3, "c", T1)], DDL)
    once = upsert(tgt, src, ["cuit"])
    assert rows(once) == [(1, "a", T0), (2, "b2", T1), (3, "c", T1)]
    assert rows(upsert(once, src, ["cuit"])) == rows(once)


def test_upsert_repeated_key_keeps_newest(spark):
    tgt = spark.createDataFrame([(1, "a", T0)], DDL)
    src = spark.createDataFrame([(1, "older", T1), (1, "newer", T2)], DDL)
    assert rows(upsert(tgt, src, ["cuit"])) == [(1, "newer", T2)]


def test_upsert_null_keys(spark):
    tgt = spark.createDataFrame([(1, "a", T0)], DDL)
    src = spark.createDataFrame([(None, "x", T1)], DDL)
    assert rows(upsert(tgt, src, ["cuit"])) == [(1, "a", T0)]
    assert null_key_rows(src, ["cuit"]).count() == 1
    once = upsert(tgt, src, ["cuit"], null_keys="insert")
    assert len(rows(once)) == 2
    # MERGE never matches NULL keys, so a replay inserts them again
    assert len(rows(upsert(once, src, ["cuit"], null_keys="insert"))) == 3


def test_dedupe_latest_multi_key(spark):
    df = spark.createDataFrame([(1, "n", "2000-01-01", "AR", T0), (1, "n", "2000-01-01", "BR", T1),
                                (2, "m", "2000-01-01", "AR", T0)],
                               "document_number bigint, name string, birth_day string, country string, "
                               "updated_dt timestamp")
    got = rows(dedupe_latest(df, ["document_number", "name", "birth_day"]))
    assert [g[3] for g in got] == ["BR", "AR"]


def test_merge_into_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "companies")
    base = spark.range(0, 200).select(F.col("id").alias("cuit"), F.concat(F.lit("c"), F.col("id").cast("string"))
                                      .alias("name"), F.lit(T0).cast("timestamp").alias("updated_dt"))
    merge_into(spark, path, base, ["cuit"], batch_id=0)
    src = spark.createDataFrame([(5, "five", T1), (500, "new", T1), (None, "no key", T1)], DDL)
    merge_into(spark, path, src, ["cuit"], batch_id=1, null_keys="insert")
    first = rows(read_table(spark, path, ["cuit"]))
    merge_into(spark, path, src, ["cuit"], batch_id=1, null_keys="insert")   # replay of the same batch
    assert rows(read_table(spark, path, ["cuit"])) == first
    assert len(first) == 202
    assert (5, "five", T1) in first and (500, "new", T1) in first and (None, "no key", T1) in first


def test_snapshots_keep_the_contents_and_older_readers(spark, tmp_dir):
    from lakeshore.operators.upsert import write_snapshot

    path = os.path.join(tmp_dir, "t")
    for day in range(7):
        batch = [(day, f"day {day}", T0), (100, f"shared {day}", T1), (None, "no key", T0)]
        merge_into(spark, path, spark.createDataFrame(batch, DDL), ["cuit"], batch_id=day, null_keys="insert",
                   snapshot_after=2)
    want = sorted([(d, f"day {d}", T0) for d in range(7)] + [(100, "shared 6", T1)] + [(None, "no key", T0)] * 7, key=repr)
    reader = read_table(spark, path, ["cuit"])
    write_snapshot(spark, path, ["cuit"])
    assert rows(reader) == rows(read_table(spark, path, ["cuit"])) == want
    seq = sorted(os.listdir(path), key=lambda n: int(n.split("=")[1]))
    assert len(seq) <= 5 and os.listdir(os.path.join(path, seq[-1]))[0].startswith("_snapshot=")


def test_change_feed_of_a_table_with_maps(spark, tmp_dir):
    from lakeshore.operators.upsert import read_changes

    ddl = "order_id string, items array<map<string,string>>, note struct<m: map<string,int>>, updated_dt timestamp"
    day1 = [("a", [{"x": "1", "y": "2"}], ({"k": 1},), T0), ("b", [{"x": "1"}], None, T0), ("c", None, None, T0)]
    day2 = [("a", [{"y": "2", "x": "1"}], ({"k": 1},), T0), ("b", [{"x": "2"}], None, T0), ("d", [], None, T0)]
    path, feed = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "feed")
    for n, day in enumerate((day1, day2)):
        merge_into(spark, path, spark.createDataFrame(day, ddl), ["order_id"], batch_id=n, changes_path=feed)
    got = read_changes(spark, feed).where("version = 1")
    assert got.schema["items"].dataType.simpleString() == "array<map<string,string>>"
    assert sorted((r.order_id, r._change_type) for r in got.collect()) == [
        ("b", "update_postimage"), ("b", "update_preimage"), ("d", "insert")]
    gone = table_changes(spark.createDataFrame(day1, ddl), spark.createDataFrame(day2, ddl), ["order_id"])
    assert [r.order_id for r in gone.where("_change_type = 'delete'").collect()] == ["c"]


def test_change_feed_and_history(spark):
    old = spark.createDataFrame([(1, "a", T0), (2, "b", T0)], DDL)
    new = spark.createDataFrame([(1, "a", T0), (2, "b2", T1), (3, "c", T1)], DDL)
    ch = table_changes(old, new, ["cuit"])
    got = sorted((r.cuit, r.name, r._change_type) for r in ch.collect())
    assert got == [(2, "b", "update_preimage"), (2, "b2", "update_postimage"), (3, "c", "insert")]
    h = table_history(ch.withColumn("version", F.lit(2))).first()
    assert (h.num_inserted, h.num_updated, h.num_deleted) == (1, 1, 0)
    gone = table_changes(new, old, ["cuit"]).where("_change_type = 'delete'").collect()
    assert [r.cuit for r in gone] == [3]


def test_backup_restore_and_rename(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", T0), (2, "b", T0)], DDL)
    root = os.path.join(tmp_dir, "backup")
    backup_snapshot(df, root, "2022-11-13")
    backup_snapshot(df.where("cuit = 1"), root, "2022-11-14")
    backup_snapshot(df.where("cuit = 1"), root, "2022-11-14")   # same day again: replaced, not appended
    assert latest_snapshot(spark, root).endswith("run_dt=2022-11-14")
    restored = read_or_restore(spark, os.path.join(tmp_dir, "table"), root, ["cuit"])
    assert rows(restored) == [(1, "a", T0)]
    merge_into(spark, os.path.join(tmp_dir, "table"), df.where("cuit = 2"), ["cuit"], 1)   # restored tables can be merged into
    assert rows(read_table(spark, os.path.join(tmp_dir, "table"), ["cuit"])) == rows(df)
    r = rename_one(df, "cuit", ts=T1).collect()
    assert [(x.cuit, x.name) for x in r] == [(1, "New Name!!")]


def test_orphan_products(spark):
    p = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "product_id bigint, cuit bigint")
    c = spark.createDataFrame([(10, "x")], "cuit bigint, name string")
    assert sorted(r.product_id for r in orphan_products(p, c).collect()) == [2, 3]


def test_daily_dimension_job_restores_merges_and_backs_up(spark, tmp_dir):
    table, backup = os.path.join(tmp_dir, "companies"), os.path.join(tmp_dir, "backup")
    backup_snapshot(spark.createDataFrame([(1, "a", T0), (2, "b", T0)], DDL), backup, "2022-11-13")
    day = spark.createDataFrame([(2, "old", T0), (2, "b2", T1), (3, "c", T1)], DDL)
    daily_dimension_job(spark, "companies", table, backup, day, "2022-11-14")
    want = [(1, "a", T0), (2, "b2", T1), (3, "c", T1)]
    assert rows(read_table(spark, table, ["cuit"])) == want
    assert rows(read_snapshot(spark, backup, "2022-11-14")) == want
    daily_dimension_job(spark, "companies", table, backup, day, "2022-11-14")   # rerun the day
    assert rows(read_table(spark, table, ["cuit"])) == want
    assert rows(read_snapshot(spark, backup, "2022-11-13")) == [(1, "a", T0), (2, "b", T0)]


def test_merge_change_feed_covers_touched_buckets(spark, tmp_dir):
    from lakeshore.operators.upsert import read_changes

    path, feed = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "feed")
    base = spark.createDataFrame([(i, f"c{i}", T0) for i in range(50)], DDL)
    merge_into(spark, path, base, ["cuit"], batch_id=1, changes_path=feed)
    day = spark.createDataFrame([(5, "five", T1), (7, "c7", T0), (99, "new", T1)], DDL)
    merge_into(spark, path, day, ["cuit"], batch_id=2, changes_path=feed)
    merge_into(spark, path, day, ["cuit"], batch_id=2, changes_path=feed)   # replay keeps the feed
    ch = read_changes(spark, feed)
    v2 = sorted((r.cuit, r.name, r._change_type) for r in ch.where("version = 2").collect())
    assert v2 == [(5, "c5", "update_preimage"), (5, "five", "update_postimage"), (99, "new", "insert")]
    assert ch.where("version = 1 AND _change_type = 'insert'").count() == 50
    h = {r.version: (r.num_inserted, r.num_updated) for r in table_history(ch).collect()}
    assert h == {1: (50, 0), 2: (1, 1)}


def test_full_outer_upsert_equals_anti_join_upsert(spark):
    tgt = spark.createDataFrame([(1, "a", T0), (2, "b", T0), (None, "n", T0)], DDL)
    src = spark.createDataFrame([(2, "b1", T1), (2, "b2", T2), (3, "c", T1), (None, "x", T1)], DDL)
    for nk in ("quarantine", "insert"):
        a = upsert(tgt, src, ["cuit"], null_keys=nk, how="anti")
        f = upsert(tgt, src, ["cuit"], null_keys=nk, how="full")
        assert f.columns == tgt.columns
        assert rows(a) == rows(f)
    assert rows(upsert(tgt, src, ["cuit"], how="full")) == [
        (1, "a", T0), (2, "b2", T2), (3, "c", T1), (None, "n", T0)]


def test_an_unfinished_merge_leaves_the_table_as_it_was(spark, tmp_dir):
    from pathlib import Path

    base = spark.createDataFrame([(i, f"c{i}", T0) for i in range(40)], DDL)
    day = spark.createDataFrame([(3, "three", T1), (100, "new", T1)], DDL)
    path, feed = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "feed")
    merge_into(spark, path, base, ["cuit"], batch_id=1)
    merge_into(spark, path, day, ["cuit"], batch_id=2)
    want = rows(read_table(spark, path, ["cuit"]))
    [marker] = Path(path).glob("_seq=*/_batch=2/_SUCCESS")
    marker.unlink()                                                   # the write did not finish
    assert rows(read_table(spark, path, ["cuit"])) == rows(base)
    merge_into(spark, path, day, ["cuit"], batch_id=2, changes_path=feed)     # the replay
    assert rows(read_table(spark, path, ["cuit"])) == want
    # A merge that died between its rows and its feed: the feed leaves the batch's own rows out.
    other = os.path.join(tmp_dir, "other")
    merge_into(spark, path, day, ["cuit"], batch_id=2, changes_path=other)
    kinds = lambda p: sorted((r.cuit, r._change_type) for r in spark.read.parquet(p).collect())
    assert kinds(feed) == kinds(other) == [(3, "update_postimage"), (3, "update_preimage"), (100, "insert")]


def test_first_merge_without_rows(spark, tmp_dir):
    empty = spark.createDataFrame([], "k long, v string, updated_dt int")
    assert merge_into(spark, f"{tmp_dir}/t", empty, ["k"], 1).count() == 0
    merge_into(spark, f"{tmp_dir}/t", spark.createDataFrame([(1, "a", 1)], empty.schema), ["k"], 2)
    assert read_table(spark, f"{tmp_dir}/t", ["k"]).count() == 1
