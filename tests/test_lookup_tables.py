"""Nested networks and device rules as tables, against brute force."""

import ipaddress
import os
import random

from pyspark.sql import functions as F

from lakeshore.functions.ip import with_ip_key
from lakeshore.operators.device_rules import RULE_COLUMNS, label_agents, with_device
from lakeshore.operators.geo import geo_lookup
from lakeshore.operators.networks import lookup, networks, segments, sweep

ADDRESSES = ["0.0.0.0", "1.2.3.4", "255.255.255.255", "::", "::1", "1::", "2001:db8::a:0:1", "2001:DB8:0:0:0:0:0:1", "::ffff:1.2.3.4", "fe80::1",
             "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "64:ff9b::10.0.0.1", "1:2:3:4:5:6:1.2.3.4"]
JUNK = ["", "-", "1.2.3", "1.2.3.256", "1.2.3.4.5", ":", ":::", "1::2::3", "1:2:3", "1:2:3:4:5:6:7:8:9", "12345::", "g::", "::1.2.3.999",
        "1:2:3:4:5:6:7:8::", "fe80::1%eth0", " 1.2.3.4", "1.2.3.4::", None]


def number(text):
    a = ipaddress.ip_address(text)
    return int(a) + (0xFFFF << 32 if a.version == 4 else 0)


def test_ip_keys(spark):
    df = spark.createDataFrame([(a, 1) for a in ADDRESSES + JUNK], "ip string, k_v4 int")
    got = with_ip_key(df, "ip", "k")
    assert got.columns == ["ip", "k_v4", "k"]
    keys = {r.ip: r.k for r in got.collect()}
    assert {a: int.from_bytes(keys[a], "big") for a in ADDRESSES} == {a: number(a) for a in ADDRESSES}
    assert all(keys[j] is None for j in JUNK)


def brute(table, at):
    held = [(b - a, -a, v is None, v or "", v) for a, b, v in table if a <= at <= b]
    return min(held)[-1] if held else None


def test_sweep_equals_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        table = []
        for _ in range(rng.randrange(12)):
            a = rng.randrange(60)
            table.append((a, a + rng.choice([0, 1, 3, 10, 40]), rng.choice(["x", "y", None])))
        got = sweep(table, 5, 50)
        flat = {p: v for a, b, v in got for p in range(a, b + 1)}
        assert len(flat) == sum(b - a + 1 for a, b, _ in got)                 # disjoint
        assert flat == {p: brute(table, p) for p in range(5, 51) if any(a <= p <= b for a, b, _ in table)}


def test_lookup_in_nested_networks_equals_brute_force(spark, tmp_dir):
    rng = random.Random(3)
    nets = ["0.0.0.0/0", "10.0.0.0/8", "10.0.0.0/9", "10.1.0.0/16", "10.1.2.0/24", "10.1.2.3", "10.1.2.3/32", "10.1.2.128/25", "11.0.0.0/7",
            "2000::/3", "2001:db8::/32", "2001:db8:8000::/33", "2001:db8::1", "2001:db8:0:1::/64", "::/0", "::ffff:10.2.0.0/112"]
    nets += [f"{rng.randrange(9, 13)}.{rng.randrange(4)}.{rng.randrange(4)}.0/{rng.choice([14, 17, 22, 24, 26])}" for _ in range(60)]
    nets += [f"2001:db8:{rng.randrange(4):x}:{rng.randrange(4):x}::/{rng.choice([30, 40, 48, 56, 63, 64])}" for _ in range(40)]
    rows = [(n, None if i % 11 == 3 else f"c{i % 7}") for i, n in enumerate(nets)]
    bad = [("10.0.0.0/33", "no"), ("x/8", "no"), (None, "no"), ("1.2.3.0/24/1", "no")]
    table = []
    for n, v in rows:
        net = ipaddress.ip_network(n, strict=False)
        head = 0xFFFF << 32 if net.version == 4 else 0
        table.append((int(net[0]) + head, int(net[-1]) + head, v))
    ips = ADDRESSES + JUNK + [f"{rng.randrange(8, 14)}.{rng.randrange(5)}.{rng.randrange(5)}.{rng.randrange(256)}" for _ in range(300)]
    ips += [f"2001:db8:{rng.randrange(5):x}:{rng.randrange(5):x}::{rng.randrange(3):x}" for _ in range(200)] + ["10.1.2.3"] * 3
    visits = spark.createDataFrame([(i, ip, "old") for i, ip in enumerate(ips)], "id long, ip_address string, country string").repartition(4)
    found = networks(spark.createDataFrame(rows + bad, "network string, country string"))
    path = os.path.join(tmp_dir, "segments")
    segments(found).write.parquet(path)
    got = lookup(visits, spark.read.parquet(path))
    assert got.columns == ["id", "ip_address", "country"]
    want = {i: None if ip in JUNK else brute(table, number(ip)) for i, ip in enumerate(ips)}
    assert {r.id: r.country for r in got.collect()} == want and got.count() == len(ips)
    assert sum(v is not None for v in want.values()) > 400
    empty = spark.createDataFrame([], "network string, country string")
    assert lookup(visits, segments(networks(empty))).where("country IS NOT NULL").count() == 0


def test_junk_addresses_of_a_shuffled_lookup_are_spread(spark):
    """Lines with one and the same junk address do not share a bucket."""
    lines = spark.range(4000).select(F.when(F.col("id") >= 0, "-").otherwise("1.1.1.1").alias("ip_address"), F.col("id").cast("string").alias("request"))
    ranges = spark.createDataFrame([(1, 2, "X")], "ip_from bigint, ip_to bigint, country string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = geo_lookup(lines, ranges).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1500


# --- device rules ------------------------------------------------------------------------

RULES = [
    (5, "iphone", "iPhone", "iPhone", "Apple", "iPhone"),
    (3, "ipad", "iPad", "iPad", "Apple", "iPad"),
    (10, "android", r"Android [0-9.]+; (SM-[A-Z0-9]+)", "Samsung {1}", "Samsung", "{1} / {1}"),
    (20, "android", "Android", "Generic Smartphone", "Generic", "Smartphone"),
    (1, None, "(?i)(bot|crawler)", "Spider", "Spider", "{1}"),
    (20, "ANDROID", "Androi", "A smaller pattern", "of one", "priority"),
    (0, "curl", "nothing like it", "x", "y", "z"),
    (0, "iphone", None, "x", "y", "z"),
]
AGENTS = ["Mozilla (iPhone; CPU)", "iPad and iPhone", "x Android 13; SM-S901B) y", "Android 12; Pixel", "Googlebot/2.1 Android 9; SM-1", "curl/7", "", None,
          "xiPhone"]


def test_device_rules(spark):
    rules = spark.createDataFrame(RULES, RULE_COLUMNS)
    agents = spark.createDataFrame([(a, i) for i, a in enumerate(AGENTS + AGENTS[:4])], "user_agent string, device int")
    want = {AGENTS[0]: "iPhone Apple iPhone", AGENTS[1]: "iPad Apple iPad", AGENTS[2]: "Samsung SM-S901B Samsung SM-S901B / SM-S901B",
            AGENTS[3]: "A smaller pattern of one priority", AGENTS[4]: "Spider Spider bot", AGENTS[5]: "Other None None", "": "Other None None",
            AGENTS[8]: "Other None None"}
    assert {r.agent: r.device for r in label_agents(agents, rules).collect()} == want
    got = with_device(agents, rules)
    assert got.columns == ["user_agent", "device"] and got.count() == len(agents.collect())
    assert all(r.device == want.get(r.user_agent) for r in got.collect())
    none = label_agents(agents, rules.limit(0)).collect()
    assert {r.device for r in none} == {"Other None None"} and label_agents(agents.limit(0), rules).count() == 0


def test_device_rules_try_only_candidates(spark):
    """Of many rules an agent meets those of its own tokens."""
    rules = spark.range(1000).select(F.col("id").cast("int").alias("priority"), F.format_string("m%d", "id").alias("token"),
                                     F.format_string("Build/(m%d)", "id").alias("pattern"), F.lit("F").alias("family"), F.lit("B").alias("brand"),
                                     F.lit("{1}").alias("model"))
    agents = spark.range(3000).select(F.format_string("Phone Build/m%d x", F.col("id") % 1500).alias("user_agent"))
    labels = label_agents(agents, rules)
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "[token#" in plan
    got = {r.agent: r.device for r in labels.collect()}
    assert len(got) == 1500 and all(got[f"Phone Build/m{i} x"] == (f"F B m{i}" if i < 1000 else "Other None None") for i in range(1500))
