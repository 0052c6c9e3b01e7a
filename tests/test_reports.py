import datetime

from pyspark.sql import functions as F

from lakeshore.operators.geo import geo_lookup
from lakeshore.plans import reports

LOGS = "country string, action string, product_id string, user_agent string"


def test_null_country_counts_zero_and_tie_break(spark):
    logs = spark.createDataFrame([
        (None, "login", None, "x"), (None, "login", None, "x"),
        ("B", "login", None, "y"), ("A", "login", None, "y"), ("C", "product", "1", "y")], LOGS)
    got = [tuple(r) for r in reports.top_login_countries(logs, k=2).collect()]
    assert got == [(1, "A"), (1, "B")]          # tie at the cut: smaller key kept
    allc = {r.country: r.number_of_users for r in reports.top_login_countries(logs).collect()}
    assert allc[None] == 0


def test_top_products_junk_id_and_subquery(spark):
    logs = spark.createDataFrame([
        ("A", "login", None, "x"), ("A", "product", "1", "x"), ("A", "product", "1", "x"),
        ("A", "product", "zz", "x"), ("B", "product", "2", "x")], LOGS)
    prods = spark.createDataFrame([(1, "one"), (2, "two")], "product_id bigint, name string")
    got = [tuple(r) for r in reports.top_products_in_top_country(logs, prods).collect()]
    assert got == [(2, "1", "one")]


def test_monthly_sales(spark):
    o = spark.createDataFrame([
        (datetime.date(2001, 7, 3), "a", 10.0), (datetime.date(2001, 7, 3), "a", 10.0),
        (datetime.date(2001, 7, 9), "b", 20.0), (datetime.date(1999, 1, 1), "c", 99.0)],
        "order_dt date, order_id string, order_total_price double")
    items = [tuple(r) for r in reports.monthly_sales_last_year(o, as_of="2001-08-01").collect()]
    by_order = [tuple(r) for r in reports.monthly_sales_by_order(o, as_of="2001-08-01").collect()]
    assert [(m, n, str(p)) for m, n, p in items] == [(7, 3, "13.33")]
    assert [(m, n, str(p)) for m, n, p in by_order] == [(7, 2, "15.00")]


def test_geo_range_join(spark):
    ranges = spark.createDataFrame([(16777216, 16777216 + 0x2FFFF, "X"), (33554432, 33554432 + 10, "Y")],
                                   "ip_from bigint, ip_to bigint, country string")
    ips = spark.createDataFrame([("1.0.0.1",), ("1.2.255.255",), ("1.3.0.0",), ("2.0.0.10",), ("2.0.0.11",),
                                 ("junk",), (None,)], "ip_address string")
    out = geo_lookup(ips, ranges)
    got = dict((r.ip_address, r.country) for r in out.collect())
    assert got == {"1.0.0.1": "X", "1.2.255.255": "X", "1.3.0.0": None, "2.0.0.10": "Y", "2.0.0.11": None,
                   "junk": None, None: None}
    assert out.count() == 7
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_geo_shuffle_fallback_with_a_hot_ip(spark):
    ranges = spark.createDataFrame([(16777216, 16777216 + 0x2FFFF, "X"), (33554432, 33554432 + 10, "Y")],
                                   "ip_from bigint, ip_to bigint, country string")
    hot = [("1.0.0.1",)] * 30
    cold = [("1.1.0.5",), ("2.0.0.3",), ("2.0.0.99",), ("junk",)] * 15
    ips = spark.createDataFrame(hot + cold, "ip_address string")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = geo_lookup(ips, ranges)      # no auto broadcast: shuffle join
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
        got = {}
        for r in out.collect():
            got[(r.ip_address, r.country)] = got.get((r.ip_address, r.country), 0) + 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert got == {("1.0.0.1", "X"): 30, ("1.1.0.5", "X"): 15, ("2.0.0.3", "Y"): 15, ("2.0.0.99", None): 15,
                   ("junk", None): 15}



def test_ranges_from_cidr_blocks(spark):
    from lakeshore.operators.geo import ranges_from_cidr_blocks

    blocks = spark.createDataFrame([("1.0.0.0/24", 10), ("1.0.2.0/23", 20), ("8.8.8.8/32", 30), ("bad/99", 10)],
                                   "network string, geoname_id bigint")
    locs = spark.createDataFrame([(10, "Australia"), (20, "China")], "geoname_id bigint, country_name string")
    r = sorted(tuple(x) for x in ranges_from_cidr_blocks(blocks, locs).collect())
    assert r == [(16777216, 16777471, "Australia"), (16777728, 16778239, "China"), (134744072, 134744072, None)]
    ips = spark.createDataFrame([("1.0.0.7",), ("1.0.3.200",), ("1.0.1.1",)], "ip_address string")
    got = {x.ip_address: x.country for x in geo_lookup(ips, ranges_from_cidr_blocks(blocks, locs)).collect()}
    assert got == {"1.0.0.7": "Australia", "1.0.3.200": "China", "1.0.1.1": None}



def test_top_products_pct(spark):
    logs = spark.createDataFrame([
        ("A", "login", None, "x"), ("A", "product", "1", "x"), ("A", "product", "1", "x"),
        ("A", "product", "2", "x"), ("A", "product", "3", "x"), ("B", "product", "2", "x")], LOGS)
    prods = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "product_id bigint, name string")
    got = [tuple(r) for r in reports.top_products_in_top_country(logs, prods, k=2, with_pct=True).collect()]
    assert got == [(2, "1", "one", 50.0), (1, "2", "two", 25.0)]


def test_monthly_means_of_bad_and_negative_totals(spark):
    from lakeshore.functions.casts import to_double

    texts = [("2022-10-01", "NaN"), ("2022-10-02", "Infinity"), ("2022-10-03", "10.01"), ("2022-10-04", "x"),
             ("2022-09-01", "-1.01"), ("2022-08-01", "NaN"), ("2022-07-01", "1e300")]
    rows = spark.createDataFrame(texts, "order_dt string, total string").select(
        F.col("order_dt").cast("date").alias("order_dt"), to_double("total").alias("order_total_price"))
    got = {r.month: (r.total_orders, r.total_price and str(r.total_price))
           for r in reports.monthly_sales_last_year(rows, as_of="2022-11-14").collect()}
    assert got == {7: (1, None), 8: (1, None), 9: (1, "-1.01"), 10: (4, "10.01")}


def test_blank_log_lines_give_no_row(spark):
    from lakeshore.plans.weblogs import parse_lines

    lines = spark.createDataFrame([("",), ("  \t",), (None,), ("broken",)], "value string")
    assert [r._corrupt_record for r in parse_lines(lines).collect()] == ["broken"]


def test_pixel_models_stay_apart(spark):
    from lakeshore.functions.useragent import device_label

    agents = spark.createDataFrame([(f"Mozilla/5.0 (Linux; Android 12; {m}) AppleWebKit",) for m in
                                    ("Pixel 6", "Pixel 6a", "Pixel 6 Pro", "Pixel 7 Build/X")], "ua string")
    assert [r[0] for r in agents.select(device_label("ua")).collect()] == [
        "Pixel 6 Google Pixel 6", "Pixel 6a Google Pixel 6a", "Pixel 6 Pro Google Pixel 6 Pro", "Pixel 7 Google Pixel 7"]
