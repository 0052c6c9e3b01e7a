import datetime

from pyspark.sql import functions as F

from lakeshore.functions import casts, ip, logline, useragent
from lakeshore.plans import weblogs


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("x")).first().x


def test_lenient_casts(spark):
    assert one(spark, casts.to_bigint("v"), "zz") is None
    assert one(spark, casts.to_int("v"), "3.0") is None
    assert one(spark, casts.to_int("v"), "3") == 3
    assert one(spark, casts.to_date("v"), "2022-11-14 10:11:12") == datetime.date(2022, 11, 14)
    assert one(spark, casts.to_date("v"), "2022") == datetime.date(2022, 1, 1)
    assert one(spark, casts.safe_get(F.split("v", "/"), 2), "GET") is None


def test_parse_good_log_line(spark):
    line = '1.2.3.4 - bob [04/11/2022 10:11:12] "GET /product/123" 200 55555 - "Moz (X11; like)"'
    df = weblogs.parse_lines(spark.createDataFrame([(line,)], "value string"))
    r = df.first()
    assert r._corrupt_record is None
    assert (r.ip_address, r.username, r.request, r.status_code, r.user_agent) == (
        "1.2.3.4", "bob", "GET /product/123", "200", "Moz (X11; like)")
    b = weblogs.bronze_logs(weblogs.good_lines(df), as_of="2022-11-14", load_ts="2022-11-14 00:00:00")
    s = b.select(logline.parse_log_timestamp("request_timestamp").alias("t"),
                 logline.request_action("request").alias("a"),
                 logline.request_product_id("request").alias("p"), "year").first()
    assert s.t == datetime.datetime(2022, 11, 4, 10, 11, 12)
    assert (s.a, s.p, s.year) == ("product", "123", 2022)


def test_short_line_is_quarantined_even_when_pruned(spark):
    df = weblogs.parse_lines(spark.createDataFrame([("short line",)], "value string"))
    # only the flag is selected: the parse schema must not be pruned away
    assert df.select("_corrupt_record").first()[0] == "short line"
    assert weblogs.good_lines(df).count() == 0
    assert weblogs.bad_lines(df).count() == 1


def test_login_bad_timestamp_and_no_slash(spark):
    df = spark.createDataFrame([("GET /login/9", "[99/99/2022 00:00:00]"), ("GET", "[01/01/2022 00:00:00]")],
                               "request string, ts string")
    rows = df.select(logline.request_action("request").alias("a"), logline.request_product_id("request").alias("p"),
                     logline.parse_log_timestamp("ts").alias("t")).collect()
    assert (rows[0].a, rows[0].p, rows[0].t) == ("login", None, None)
    assert (rows[1].a, rows[1].p) == (None, None)


def test_format_then_parse_roundtrip(spark):
    df = spark.createDataFrame([("9.8.7.6", "u1", datetime.datetime(2024, 1, 2, 3, 4, 5), "product", "77", "500",
                                 "12", "curl/7.88.1")],
                               "ip string, u string, ts timestamp, a string, p string, s string, b string, ag string")
    line = df.select(logline.format_log_line("ip", "u", "ts", "a", "p", "s", "b", "ag").alias("value"))
    r = weblogs.parse_lines(line).first()
    assert r._corrupt_record is None and r.request == "GET /product/77" and r.user_agent == "curl/7.88.1"


def test_ipv4_to_long(spark):
    assert one(spark, ip.ipv4_to_long("v"), "1.2.3.4") == 16909060
    for junk in ["junk", "1.2.3", "256.1.1.1", "::1", None]:
        assert one(spark, ip.ipv4_to_long("v"), junk) is None


def test_device_label(spark):
    ua = spark.createDataFrame([
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_1 like Mac OS X)",),
        ("Mozilla/5.0 (Linux; Android 13; SM-S901B) Mobile",),
        ("curl/7.88.1",), (None,)], "ua string")
    got = [r.d for r in ua.select(useragent.device_label("ua").alias("d")).collect()]
    assert got == ["iPhone Apple iPhone", "Samsung SM-S901B Samsung SM-S901B", "Other None None", None]


def test_key_id_is_stable_and_separates_parts(spark):
    from lakeshore.functions.ids import key_id

    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", None), ("a", "")], "x string, y string")
    ids = [r.k for r in df.select(key_id("x", "y").alias("k")).collect()]
    assert len(set(ids)) == 4 and all(len(i) == 64 for i in ids)
    again = [r.k for r in df.select(key_id("x", "y").alias("k")).collect()]
    assert ids == again
