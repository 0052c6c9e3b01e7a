"""Model tables derived from the driver's parquet tables.

The shop model (companies, customers, products, order documents, log lines,
job runs) is derived from the TPC-H-like tables so every query's work grows
with them.  Each mapping is plain column arithmetic, so the same rows can be
rebuilt in SQL by another engine (see ``lakeshore.plans.oracle``).

Mappings (a row of the driver table -> a row of the model table):

* companies   <- supplier                : cuit = s_suppkey
* customers   <- customer JOIN nation    : document_number = c_custkey, country = n_name
* products    <- part                    : cuit = p_partkey mod #suppliers
* order docs  <- orders LEFT JOIN (lineitem JOIN products) JOIN customer
* log lines   <- events                  : action, product and status from the event
* geo ranges  <- nation                  : one IPv4 range per nation, with gaps
* job runs    <- events                  : one run per event
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.functions.logline import format_log_line
from lakeshore.session import partitions_for, path_bytes

# Fixed values of the derivation (part of the model, shared with the SQL oracles).
BASE_UPDATED_TS = "2022-11-13 00:00:00"
CHANGE_UPDATED_TS = "2022-11-14 10:00:00"
EARLIER_CHANGE_TS = "2022-11-14 09:00:00"
LOAD_TS = "2022-11-14 21:00:03"
LOAD_DATE = "2022-11-14"
SALES_AS_OF = "2001-08-01"
BIRTH_DAY_ZERO = "1950-01-01"
BIRTH_DAY_SPAN = 18000
NEW_COMPANY_CUIT_OFFSET = 30000000000
CLOSED_UPDATED_TS = "2022-11-15 10:00:00"
# Suppliers with an account from .. to are closed on the third day.
CLOSED_ACCOUNTS = (3000, 5000)
# Orders whose key ends in this digit arrive a day late; re-sent orders keep items of this amount or more.
LATE_ORDER_DIGIT = 3
RESENT_LEAST_AMOUNT = 10
# Log lines and order documents whose key these divide are damaged on their way in.
DAMAGE = {"time": 11, "cut": 13, "address": 17, "status": 19}
# Products whose key ends in this digit arrive a day late.
LATE_PRODUCT_DIGIT = 3
# Companies with a lower balance come late or never.
PROMPT_BALANCE = 3000
# First octet of an event's IP cycles over 27 blocks; nations own blocks 1..25
# up to x.191.255.255, so blocks 26, 27 and x.192+ are gaps (unknown country).
IP_BLOCKS = 27
NATION_RANGE_SIZE = 0xC00000

# Bytes of the order tables' files that one task nests (about 600,000 items).
DOCUMENT_PARTITION_BYTES = 12 << 20

# Order status codes of the driver data -> shop statuses.
STATUS_NAMES = {"F": "finished", "O": "pending", "P": "cancelled"}

# The user agents the log lines carry, picked by event_id mod 9.
USER_AGENTS = [
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Linux; Android 13; SM-S901B) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/112.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 12; Pixel 6) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/111.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/112.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 13_3) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.4 Safari/605.1.15",
    "Mozilla/5.0 (iPad; CPU OS 15_7 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/15.6 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/112.0",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "curl/7.88.1",
]

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _ts(text: str) -> Column:
    return F.expr(f"TIMESTAMP '{text}'")


def _supplier_count(spark: SparkSession, sf_dir: str) -> Column:
    # Scalar subquery: evaluated once, a metadata-sized aggregate.
    return table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()


def _part_count(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()


# --- dimensions ------------------------------------------------------------

def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast("bigint").alias("cuit"),
                    F.col("s_name").alias("name"),
                    _ts(BASE_UPDATED_TS).alias("updated_dt"))


def company_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's company records: renames sent twice (older and newer) and new companies.

    Accounts under 2,000 are renamed (two versions, the newer must win);
    accounts over 9,000 open a sister company under a new key.
    """
    s = table(spark, sf_dir, "supplier")
    renamed_new = s.where(F.col("s_acctbal") < 2000).select(
        F.col("s_suppkey").cast("bigint").alias("cuit"),
        F.lit("New Name!!").alias("name"), _ts(CHANGE_UPDATED_TS).alias("updated_dt"))
    renamed_old = s.where(F.col("s_acctbal") < 2000).select(
        F.col("s_suppkey").cast("bigint").alias("cuit"),
        F.concat(F.col("s_name"), F.lit(" Ltd")).alias("name"),
        _ts(EARLIER_CHANGE_TS).alias("updated_dt"))
    new = s.where(F.col("s_acctbal") > 9000).select(
        (F.col("s_suppkey").cast("bigint") + NEW_COMPANY_CUIT_OFFSET).alias("cuit"),
        F.concat(F.col("s_name"), F.lit(" Holdings")).alias("name"),
        _ts(CHANGE_UPDATED_TS).alias("updated_dt"))
    return renamed_new.unionByName(renamed_old).unionByName(new)


def closed_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third day's records: companies that close, and one new line for each that was renamed the day before."""
    s = table(spark, sf_dir, "supplier")
    closed = F.col("s_acctbal").between(*CLOSED_ACCOUNTS)
    return s.where(closed | (F.col("s_acctbal") < 2000)).select(
        F.col("s_suppkey").cast("bigint").alias("cuit"),
        F.when(closed, F.col("s_name")).otherwise(F.concat(F.col("s_name"), F.lit(" Group"))).alias("name"),
        _ts(CLOSED_UPDATED_TS).alias("updated_dt"), closed.alias("closed"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    # No hint: nation is tiny, and Spark broadcasts it from its measured size.
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.date_add(F.lit(BIRTH_DAY_ZERO).cast("date"),
                   (F.col("c_custkey") % BIRTH_DAY_SPAN).cast("int")).alias("birth_day"),
        F.col("n_name").alias("country"),
        F.col("c_custkey").cast("bigint").alias("document_number"),
        F.col("c_name").alias("name"),
        _ts(BASE_UPDATED_TS).alias("updated_dt"))


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt (negative balance) move to the next nation's country."""
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    n = table(spark, sf_dir, "nation")
    j = c.join(n, (c.c_nationkey + 1) % 25 == n.n_nationkey, "left")
    return j.select(
        F.date_add(F.lit(BIRTH_DAY_ZERO).cast("date"),
                   (F.col("c_custkey") % BIRTH_DAY_SPAN).cast("int")).alias("birth_day"),
        F.col("n_name").alias("country"),
        F.col("c_custkey").cast("bigint").alias("document_number"),
        F.col("c_name").alias("name"),
        _ts(CHANGE_UPDATED_TS).alias("updated_dt"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        (F.col("p_partkey") % _supplier_count(spark, sf_dir)).cast("bigint").alias("cuit"),
        F.col("p_name").alias("name"),
        F.round(F.col("p_retailprice") * 1.1, 2).alias("price"),
        F.col("p_retailprice").alias("price_default"),
        F.col("p_partkey").cast("bigint").alias("product_id"),
        _ts(BASE_UPDATED_TS).alias("updated_dt"))


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large parts (size over 45) get a 10% price rise on the change day."""
    p = table(spark, sf_dir, "part").where(F.col("p_size") > 45)
    return p.select(
        (F.col("p_partkey") % _supplier_count(spark, sf_dir)).cast("bigint").alias("cuit"),
        F.col("p_name").alias("name"),
        F.round(F.round(F.col("p_retailprice") * 1.1, 2) * 1.1, 2).alias("price"),
        F.col("p_retailprice").alias("price_default"),
        F.col("p_partkey").cast("bigint").alias("product_id"),
        _ts(CHANGE_UPDATED_TS).alias("updated_dt"))


# --- order documents -------------------------------------------------------

def order_items_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its product record (the flat form of the documents)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    prod = products(spark, sf_dir).drop("updated_dt")
    return li.join(prod, li.l_partkey == prod.product_id, "inner")


def document_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of the documents, by the size of their tables, so that a task's share stays the same."""
    size = sum(path_bytes(spark, os.path.join(sf_dir, f"{t}.parquet")) for t in ("orders", "lineitem"))
    return partitions_for(spark, size, DOCUMENT_PARTITION_BYTES)


def order_documents(spark: SparkSession, sf_dir: str, status_code: str | None = None,
                    with_priority: bool = False) -> DataFrame:
    """Nested order documents (schema ``ORDER_DOC``): one row per order, items as maps.

    Items are grouped per order key (a group is one order's items), totals are
    summed exactly in decimal.  Orders without items keep an empty list.
    ``status_code`` keeps only orders of that driver status; their line items
    are semi-joined to those orders before grouping, so no other order's items
    are nested.  ``with_priority`` adds the order priority as one more field.

    The items are shuffled once, flat and by ``order_id``, and nested where they
    arrive: the documents leave partitioned by ``order_id``, so keep-latest
    windows and joins on it move them no more.
    """
    n = document_partitions(spark, sf_dir)
    it = (order_items_flat(spark, sf_dir)
          .select(F.col("l_orderkey").cast("string").alias("_oid"), F.col("l_linenumber").alias("_ln"), F.col("product_id").alias("_pid"),
                  "cuit", "name", "price", "price_default", F.col("l_quantity").cast("int").alias("amount"))
          .repartition(n, "_oid"))
    o = table(spark, sf_dir, "orders")
    if status_code is not None:
        o = o.where(F.col("o_orderstatus") == status_code)
        it = it.join(o.select(F.col("o_orderkey").cast("string").alias("_ok")), F.col("_oid") == F.col("_ok"), "left_semi")
    # Collected as they are and made text afterwards: the lists are sorted as structs of text.
    text = lambda x: F.struct(x["_ln"].alias("_ln"), x["_pid"].alias("_pid"), x["cuit"].cast("string").alias("cuit"), x["name"].alias("name"),
                              *[x[k].cast("string").alias(k) for k in ("price", "price_default")],
                              x["_pid"].cast("string").alias("product_id"), x["amount"].cast("string").alias("amount"))
    per_order = it.groupBy("_oid").agg(
        F.collect_list(F.struct("_ln", "_pid", "cuit", "name", "price", "price_default", "amount")).alias("_items"),
        F.sum(F.col("price").cast("decimal(15,2)") * F.col("amount")).alias("_total"))
    # Sort structs of primitive fields (maps are not orderable), then make the maps.
    fields = ("cuit", "name", "price", "price_default", "product_id", "amount")
    as_map = lambda x: F.create_map(*[e for k in fields for e in (F.lit(k), x.getField(k))])
    per_order = per_order.select("_oid", F.transform(F.sort_array(F.transform("_items", text)), as_map).alias("items"), "_total")

    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    status = F.create_map(*[x for kv in STATUS_NAMES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    # The customers join the orders while these are narrow.
    o = o.join(c, o.o_custkey == c.c_custkey, "left").withColumn("order_id", F.col("o_orderkey").cast("string"))
    j = o.join(per_order, F.col("order_id") == F.col("_oid"), "left")
    return j.select(
        F.date_add(F.lit(BIRTH_DAY_ZERO).cast("date"),
                   (F.col("c_custkey") % BIRTH_DAY_SPAN).cast("int")).alias("customer_birth_day"),
        F.col("c_custkey").cast("string").alias("customer_document_number"),
        F.col("c_name").alias("customer_name"),
        F.coalesce(F.col("items"), F.array().cast("array<map<string,string>>")).alias("items"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_dt"),
        "order_id",
        status[F.col("o_orderstatus")].alias("status"),
        F.coalesce(F.col("_total"), F.lit(0).cast("decimal(15,2)")).cast("string").alias("total_price"),
        *([F.col("o_orderpriority").alias("priority")] if with_priority else []))


def order_documents_with_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carrying one more field, ``priority``, than the stored schema."""
    return order_documents(spark, sf_dir, with_priority=True)


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze orders as the file stream would have loaded them."""
    return order_documents(spark, sf_dir).select(
        "*", F.lit(None).cast("string").alias("_rescued_data"),
        F.lit(LOAD_DATE).cast("date").alias("record_timestamp"))


# --- web logs --------------------------------------------------------------

def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One combined-log text line (``value``) per ``event_id``.

    signup -> login request; view/click/purchase -> product request;
    error -> product request answered 500.
    """
    e = table(spark, sf_dir, "events")
    ip = F.concat_ws(".",
                     (F.col("user_id") % IP_BLOCKS + 1).cast("string"),
                     (F.col("user_id") * 37 % 256).cast("string"),
                     (F.col("event_id") % 256).cast("string"),
                     (F.col("event_id") * 13 % 256).cast("string"))
    action = F.when(F.col("event_type") == "signup", "login").otherwise("product")
    status = F.when(F.col("event_type") == "error", "500").otherwise("200")
    product = (F.col("event_id") % _part_count(spark, sf_dir)).cast("string")
    agent = F.element_at(F.array(*[F.lit(a) for a in USER_AGENTS]),
                         (F.col("event_id") % len(USER_AGENTS) + 1).cast("int"))
    nbytes = (F.col("event_id") * 7919 % 65536).cast("string")
    line = format_log_line(ip, F.concat(F.lit("user"), F.col("user_id").cast("string")),
                           F.col("ts"), action, product, status, nbytes, agent)
    return e.select("event_id", line.alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' log lines (column ``value``), like a landed log file."""
    return event_log_lines(spark, sf_dir).select("value")


def damaged_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log lines with a month 13, a missing end, no address or no status number where DAMAGE says so."""
    lines, value = event_log_lines(spark, sf_dir), F.col("value")
    for kind, pattern, new in (("time", r"\[(\d\d)/\d\d/", "[$1/13/"), ("address", r"^\S+", "-"),
                               ("status", r'" \d{3} ', '" OK '), ("cut", r' - "[^"]*"$', "")):
        value = F.when(F.col("event_id") % DAMAGE[kind] == 0, F.regexp_replace(value, pattern, new)).otherwise(value)
    return lines.select(value.alias("value"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lines_of`` all order documents."""
    return lines_of(order_documents(spark, sf_dir))


def lines_of(docs: DataFrame) -> DataFrame:
    """(order_id, value, damaged): order documents as JSON lines, and as they came in: with an unreadable
    time or without their end where DAMAGE says so."""
    key = F.col("order_id").cast("bigint")
    struct = lambda when: F.to_json(F.struct(*[when if c == "order_dt" else F.col(c) for c in docs.columns]))
    late = F.when(key % DAMAGE["time"] == 0, F.concat(F.lit("day "), "order_dt")).otherwise(F.col("order_dt")).alias("order_dt")
    out = docs.select("order_id", struct(F.col("order_dt")).alias("value"), struct(late).alias("damaged"))
    cut = F.when(key % DAMAGE["cut"] == 0, F.expr("left(damaged, length(damaged) - 9)")).otherwise(F.col("damaged"))
    return out.withColumn("damaged", cut)


def line_item_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Line items as three days' batches: the second day with prices three times as high and a third of the
    quantities missing, the third with few products."""
    li = table(spark, sf_dir, "lineitem")
    day = F.pmod(F.col("l_orderkey"), F.lit(3))
    first = li.select(day.alias("day"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("double").alias("amount"),
                      F.col("l_extendedprice").cast("double").alias("price"), F.col("l_linenumber").alias("line"))
    missing = F.pmod(F.col("product_id"), F.lit(3)) == 0
    return {"20221113": first.where("day = 0"),
            "20221114": first.where("day = 1").withColumn("price", F.col("price") * 3).withColumn("amount", F.when(~missing, F.col("amount"))),
            "20221115": first.where("day = 2").withColumn("product_id", F.col("product_id") % 20)}


def late_companies(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """The companies there on days 1 and 2: those with a low balance come on day 2 if their key is odd, else never."""
    s = table(spark, sf_dir, "supplier")
    prompt = F.col("s_acctbal") >= PROMPT_BALANCE
    there = {1: prompt, 2: prompt | (F.col("s_suppkey") % 2 == 1)}
    return {day: s.where(w).select(F.col("s_suppkey").cast("bigint").alias("cuit")) for day, w in there.items()}


def product_loads(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """(product_id, cuit) as loaded on days 1 and 2 (late products) and 3 (large parts move to the next company)."""
    p = table(spark, sf_dir, "part")
    key, n = F.col("p_partkey").cast("bigint"), _supplier_count(spark, sf_dir)
    late = key % 10 == LATE_PRODUCT_DIGIT
    load = lambda df, cuit: df.select(key.alias("product_id"), cuit.alias("cuit"))
    return {1: load(p.where(~late), key % n), 2: load(p.where(late), key % n),
            3: load(p.where(F.col("p_size") > 45), (key + 1) % n)}


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IPv4 ranges -> country: nation k owns (k+1).0.0.0 - (k+1).191.255.255."""
    n = table(spark, sf_dir, "nation")
    lo = (F.col("n_nationkey").cast("bigint") + 1) * 16777216
    return n.select(lo.alias("ip_from"), (lo + NATION_RANGE_SIZE - 1).alias("ip_to"),
                    F.col("n_name").alias("country"))


def country_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(network, country): networks inside networks, IPv4 and IPv6.

    Regions own a /5 and a /40, nations two neighbouring IPv4 networks (the range of
    ``geo_ranges``) and a /48 in them, suppliers a /20 and customers a /24 and a
    /64 inside a nation's, each for the country after their own.
    """
    nation = table(spark, sf_dir, "nation")
    k, name = F.col("n_nationkey"), F.col("n_name")
    net = lambda template, *cols: F.format_string(template, *[c.cast("bigint") for c in cols])
    region = table(spark, sf_dir, "region").withColumn("k", F.col("r_regionkey"))
    rows = [region.select(net("%d.0.0.0/5", F.col("k") * 8), F.col("r_name")),
            region.select(net("2001:db8:%x00::/40", F.col("k")), F.col("r_name")),
            nation.select(net("%d.0.0.0/9", k + 1), name), nation.select(net("%d.128.0.0/10", k + 1), name),
            nation.select(net("2001:db8:%x::/48", k), name)]
    after = nation.select(((k + 24) % 25).alias("before"), name.alias("next_name"))
    s = table(spark, sf_dir, "supplier").join(after, F.col("s_nationkey") == F.col("before"))
    rows.append(s.select(net("%d.%d.%d.0/20", F.col("s_nationkey") + 1, F.col("s_suppkey") * 11 % 256, F.col("s_suppkey") % 16 * 16),
                         F.col("next_name")))
    c = table(spark, sf_dir, "customer").join(after, F.col("c_nationkey") == F.col("before"))
    key = F.col("c_custkey")
    rows.append(c.select(net("%d.%d.%d.0/24", F.col("c_nationkey") + 1, key * 37 % 256, key * 7 % 256), F.col("next_name")))
    rows.append(c.select(net("2001:db8:%x:%x::/64", F.col("c_nationkey"), key % 64), F.col("next_name")))
    out = rows[0].toDF("network", "country")
    for r in rows[1:]:
        out = out.unionByName(r.toDF("network", "country"))
    return out


def visitor_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, ip_address): the log lines' addresses, every third of them IPv6, every 50th none."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    n, u = F.col("event_id"), F.col("user_id")
    v4 = F.format_string("%d.%d.%d.%d", u % IP_BLOCKS + 1, u * 37 % 256, n % 256, n * 13 % 256)
    v6 = F.format_string("2001:db8:%x:%x::%x", u % IP_BLOCKS, n % 96, n % 65536)
    return e.select("event_id", F.when(n % 50 == 0, F.lit("-")).when(n % 3 == 1, v6).otherwise(v4).alias("ip_address"))


def device_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device rules (``operators.device_rules.RULE_COLUMNS``): one per brand and size up to 40, one per brand, one for tablets."""
    p = table(spark, sf_dir, "part").select(F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("b"), F.col("p_size").cast("int").alias("z"))
    code = F.concat(F.lit("BR"), "b", F.lit("S"), "z")
    brand, number = F.concat(F.lit("Brand"), "b"), F.col("b").cast("int")
    devices = p.where(F.col("z") <= 40).distinct().select(
        (1000 + number * 100 + F.col("z")).alias("priority"), F.lower(code).alias("token"),
        F.concat(F.lit("Android [0-9]+; ("), code, F.lit(") Build")).alias("pattern"), F.lit("Phone {1}").alias("family"),
        brand.alias("brand"), F.lit("{1}").alias("model"))
    brands = p.select("b").distinct().select(
        (100000 + number).alias("priority"), F.lower(brand).alias("token"), F.concat(brand, F.lit("/[0-9.]+")).alias("pattern"),
        F.concat(F.lit("Generic "), brand).alias("family"), brand.alias("brand"), F.lit("Smartphone").alias("model"))
    tablets = spark.range(1).select(F.lit(1).alias("priority"), F.lit(None).cast("string").alias("token"), F.lit("Build/T").alias("pattern"),
                                    F.lit("Tablet").alias("family"), F.lit("Generic").alias("brand"), F.lit("Tablet").alias("model"))
    return devices.unionByName(brands).unionByName(tablets)


def visitor_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, user_agent): agents that name a part's brand and size; every seventh is a command line tool."""
    e, n = table(spark, sf_dir, "events").select("event_id"), F.col("event_id")
    p = table(spark, sf_dir, "part").select("p_partkey", F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("b"), "p_size")
    j = e.join(p, n % _part_count(spark, sf_dir) == F.col("p_partkey"))
    agent = F.format_string("Mozilla/5.0 (Linux; Android %d; BR%sS%d Build/%s) Brand%s/4.2 Mobile Safari/537.36",
                            10 + n % 3, "b", "p_size", F.element_at(F.array(*map(F.lit, "ABCT")), (n % 4 + 1).cast("int")), "b")
    return j.select("event_id", F.when(n % 7 == 0, F.lit("curl/7.88.1")).otherwise(agent).alias("user_agent"))


# --- job runs --------------------------------------------------------------

def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job runs (schema ``JOB_RUN``) derived from events: a job per user, a run per event."""
    e = table(spark, sf_dir, "events")
    failed = F.col("event_type") == "error"
    state = F.struct(
        F.when(failed, "INTERNAL_ERROR").otherwise("TERMINATED").alias("life_cycle_state"),
        F.when(failed, F.concat(F.lit("Run failed with value "), F.col("value").cast("string")))
        .otherwise(F.lit("")).alias("state_message"))
    return e.select(
        F.col("user_id").cast("bigint").alias("job_id"),
        F.col("event_id").cast("bigint").alias("run_id"),
        (F.col("event_id") % 100).cast("bigint").alias("number_in_job"),
        state.alias("state"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("start_time"),
        F.lit("0").alias("setup_duration"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@shop.example"))
        .alias("creator_user_name"),
        F.concat(F.col("event_type"), F.lit("_job")).alias("run_name"),
        F.concat(F.lit("https://jobs.shop.example/#job/"), F.col("user_id").cast("string"),
                 F.lit("/run/"), F.col("event_id").cast("string")).alias("run_page_url"),
        F.when(F.col("event_type").isin("purchase", "signup"), "SUBMIT_RUN")
        .otherwise("JOB_RUN").alias("run_type"))


def job_run_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs as listings of up to 25 (column ``runs``), as the jobs service answers page by page."""
    runs = job_runs(spark, sf_dir)
    return (runs.groupBy(F.floor(F.col("run_id") / 25).alias("page"))
                .agg(F.collect_list(F.struct(*runs.columns)).alias("runs")).select("runs"))
