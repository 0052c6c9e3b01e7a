import datetime

from pyspark.sql import functions as F

from lakeshore.plans import orders
from lakeshore.schemas import ORDERS_RAW
from lakeshore.sources.files import parse_order_lines


def raw(spark, rows):
    return spark.createDataFrame(rows, ORDERS_RAW)


def item(pid, amount, price="10.0", name="p"):
    return {"cuit": "7", "name": name, "price": price, "price_default": "9.0", "product_id": str(pid),
            "amount": str(amount)}


def order(oid, items, doc="123", total="40.0"):
    return (datetime.date(1990, 1, 1), doc, "Ann", items, "2022-11-14 10:11:12", oid, "finished", total, None,
            datetime.date(2022, 11, 14))


def test_two_items_share_order_total(spark):
    df = orders.silver_orders(raw(spark, [order("a", [item(1, 3), item(2, 1)])]), load_ts="2022-11-14 00:00:00")
    rows = df.orderBy("product_id").collect()
    assert len(rows) == 2
    assert {r.order_total_price for r in rows} == {40.0}
    assert rows[0].customer_name == "Ann" and rows[0].order_dt == datetime.date(2022, 11, 14)
    assert rows[0].amount == 3 and rows[0].product_id == 1


def test_empty_and_null_items_dropped_and_counted(spark):
    r = raw(spark, [order("a", []), order("b", None)])
    assert orders.silver_orders(r).count() == 0
    assert sorted(x.order_id for x in orders.dropped_orders(r).collect()) == ["a", "b"]


def test_bad_number_and_decimal_amount_are_null(spark):
    r = raw(spark, [order("a", [item(1, "3.0")], doc="zz")])
    row = orders.silver_orders(r).first()
    assert row.customer_document_number is None and row.amount is None


def test_reference_compat_customer_name(spark):
    r = raw(spark, [order("a", [item(1, 1, name="Widget")])])
    assert orders.silver_orders(r, reference_compat=True).first().customer_name == "Widget"
    assert orders.silver_orders(r, with_product_name=True).first().product_name == "Widget"


def test_json_array_with_one_bad_field_and_broken_line(spark):
    lines = spark.createDataFrame([
        ('[{"order_id":"a","items":[{"product_id":"1","amount":2}],"total_price":5}, '
         '{"order_id":"b","items":"oops"}]',),
        ('{"order_id": brok',),
        ('{"order_id":"c","zz":7,"items":[]}',)], "value string")
    p = parse_order_lines(lines, load_date="2022-11-14")
    got = {r.order_id: r for r in p.orders.collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"].items == [{"product_id": "1", "amount": "2"}] and got["a"].total_price == "5"
    assert got["b"].items is None and got["b"]._bad_fields == ["items"]
    assert got["a"]._bad_fields == []
    assert got["c"]._rescued_data == '{"zz":"7"}'
    assert [r.value for r in p.bad_records.collect()] == ['{"order_id": brok']


def test_document_totals(spark):
    r = raw(spark, [order("a", [item(1, 3, price="10.50"), item(2, 1, price="2.25")], total="33.75")])
    row = orders.document_totals(r).first()
    assert row.n_items == 2 and str(row.items_total) == "33.75" and str(row.total_price) == "33.75"


def test_silver_plan_has_no_python(spark):
    r = raw(spark, [order("a", [item(1, 3)])])
    plan = orders.silver_orders(r)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEval" not in plan
    assert F is not None
