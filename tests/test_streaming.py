import json
import os

from pyspark.sql import functions as F

from lakeshore.operators.quality import read_results
from lakeshore.sources.files import read_order_documents, text_files
from lakeshore.operators.upsert import read_table
from lakeshore.schemas import KEYS
from lakeshore.streaming import streams


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def doc(oid, pid, amount=1):
    return {"order_id": oid, "status": "finished", "order_dt": "2022-11-14 10:11:12", "total_price": 20.5,
            "customer_name": "Ann", "customer_birth_day": "1990-01-01", "customer_document_number": 77,
            "items": [{"cuit": 7, "name": "w", "price": 10.25, "price_default": 9.0, "product_id": pid,
                       "amount": amount}]}


def test_mixed_folder_layouts(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land")
    write(os.path.join(land, "year=2022/record_dt=2022-11-13/a.json"), json.dumps([doc("a", 1)]))
    write(os.path.join(land, "record_dt=2022-11-14/b.json"), json.dumps([doc("b", 2)]))
    p = read_order_documents(spark, land, load_date="2022-11-14")
    assert sorted(r.order_id for r in p.orders.collect()) == ["a", "b"]
    assert "year" not in p.orders.columns and "record_dt" not in p.orders.columns
    assert text_files(spark, land).count() == 2


def test_orders_stream_restart_reads_no_file_twice(spark, tmp_dir):
    land, ck = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "ck")
    bronze, silver, quar = (os.path.join(tmp_dir, x) for x in ("bronze", "silver", "quarantine"))
    write(os.path.join(land, "record_dt=2022-11-13/1.json"), json.dumps([doc("a", 1), doc("b", 2)]))
    write(os.path.join(land, "record_dt=2022-11-13/2.json"), '{"order_id": brok\n')

    dq = os.path.join(tmp_dir, "dq")

    def drain():
        streams.run_to_end(streams.start_orders_stream(
            spark, land, bronze, silver, ck, quar, load_date="2022-11-14",
            load_ts="2022-11-14 21:00:00", max_files_per_trigger=1, dq_path=dq))

    drain()
    first = sorted(tuple(r) for r in streams.read_silver_orders(spark, silver).collect())
    assert len(first) == 2
    drain()                                    # restart on the same checkpoint: nothing new
    assert sorted(tuple(r) for r in streams.read_silver_orders(spark, silver).collect()) == first
    # a new file updates order a (new amount) and adds c
    write(os.path.join(land, "record_dt=2022-11-14/3.json"), json.dumps([doc("a", 1, amount=5), doc("c", 3), doc("c", 3) | {"status": "pending"}]))
    drain()
    got = {(r.order_id, r.product_id): r.amount for r in streams.read_silver_orders(spark, silver).collect()}
    assert got == {("a", 1): 5, ("b", 2): 1, ("c", 3): 1}
    bad = spark.read.parquet(os.path.join(quar, "lines")).collect()
    assert [r.value for r in bad] == ['{"order_id": brok']
    hist = read_results(spark, dq)
    assert {r.suite for r in hist.collect()} == {"transactional_orders_raw", "transactional_orders_processed"}
    assert hist.where("rule = 'expect_column_values_to_not_be_null' AND columns = 'order_id'").count() >= 2
    raw = read_table(spark, bronze, KEYS["orders_raw"])
    assert raw.where("order_id = 'c'").first().status == "finished"      # of one load: any status before pending
    assert raw.count() == 3 and raw.where(F.col("order_id") == "a").first().record_timestamp is not None


def test_a_landed_file_is_parsed_on_all_cores_and_bad_input_set_apart(spark, tmp_dir):
    land, quar = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "quarantine")
    lines = [json.dumps([doc(f"o{i}", i)]) for i in range(200)]
    write(os.path.join(land, "1.json"), "\n".join(lines))
    write(os.path.join(land, "2.json"), "\n".join([
        "", "  ", "no json", "[oops", json.dumps([doc("x", 1), [1]]), json.dumps(doc("y", 1) | {"items": "oops"}), "[null]"]))

    def batch(name, n):
        bronze = os.path.join(tmp_dir, "bronze")
        streams.orders_batch(text_files(spark, os.path.join(land, name)), n, bronze, os.path.join(tmp_dir, "silver"), quar, load_date="2022-11-14")
        return [f for f in os.listdir(os.path.join(bronze, f"_seq={n + 1}", f"_batch={n}")) if f.endswith(".parquet")]

    assert len(batch("1.json", 0)) > 1 and not os.path.exists(quar)
    batch("2.json", 1)
    read = lambda kind: spark.read.parquet(os.path.join(quar, kind, "batch=1"))
    assert sorted((r.value for r in read("lines").collect()), key=str) == sorted(["no json", "[oops", "[1]", None], key=str)
    assert [(r.order_id, r._bad_fields) for r in read("fields").collect()] == [("y", ["items"])]
    assert streams.read_silver_orders(spark, os.path.join(tmp_dir, "silver")).count() == 201


def test_logs_streams_partition_by_country(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land")
    lines = [
        '1.0.0.1 - u [04/11/2022 10:11:12] "GET /login/1" 200 5 - "curl/7.88.1"',
        '9.9.9.9 - u [04/11/2022 10:11:13] "GET /product/2" 200 5 - "curl/7.88.1"',
        'short line',
    ]
    write(os.path.join(land, "year=2022/record_dt=2022-11-04.txt"), "\n".join(lines) + "\n")
    bronze, silver = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    geo = spark.createDataFrame([(16777216, 16777216 + 255, "X")], "ip_from bigint, ip_to bigint, country string")
    for _ in range(2):   # second run: restart, nothing re-read
        streams.run_to_end(streams.start_bronze_logs_stream(
            spark, land, bronze, os.path.join(tmp_dir, "ckb"), as_of="2022-11-14"))
        streams.run_to_end(streams.start_silver_logs_stream(spark, bronze, silver, os.path.join(tmp_dir, "cks"), geo))
    out = {r.ip_address: (r.country, r.action, r.product_id, r.year)
           for r in streams.read_silver_logs(spark, silver).collect()}
    assert out == {"1.0.0.1": ("X", "login", None, 2022), "9.9.9.9": (None, "product", "2", 2022)}
    assert os.path.isdir(os.path.join(silver, "country=X"))
    assert [r.value for r in streams.read_bronze_logs(spark, bronze, quarantined=True).collect()] == ["short line"]
    assert streams.read_bronze_logs(spark, bronze).count() == 2
    assert os.path.isdir(os.path.join(bronze, "year=2022", "_quarantined=false"))
