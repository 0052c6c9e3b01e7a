"""Reference answers in plain SQL (DuckDB dialect) for the registered queries.

Each string runs on the driver tables registered as views.  The model tables
are rebuilt here directly from the driver columns (the log fields, for
instance, are computed from the events, not parsed back from text), so an
oracle checks the Spark path end to end rather than repeating it.
"""

from __future__ import annotations

from lakeshore.operators.sample import ARITH_MOD, ARITH_MULT
from lakeshore.plans import registry as r
from lakeshore.sources import driver as d

_TS0 = f"TIMESTAMP '{d.BASE_UPDATED_TS}'"
_TS1 = f"TIMESTAMP '{d.CHANGE_UPDATED_TS}'"
_TS1E = f"TIMESTAMP '{d.EARLIER_CHANGE_TS}'"
_LOAD_TS = f"TIMESTAMP '{d.LOAD_TS}'"
_BDAY = f"DATE '{d.BIRTH_DAY_ZERO}' + CAST(c_custkey % {d.BIRTH_DAY_SPAN} AS INTEGER)"
_STATUS = ("CASE o_orderstatus " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in d.STATUS_NAMES.items())
           + " END")
_AGENTS = "[" + ", ".join("'" + a + "'" for a in d.USER_AGENTS) + "]"

# What each agent of the log lines is, in the order of the agents.
_DEVICES = ["iPhone Apple iPhone", "Samsung SM-S901B Samsung SM-S901B", "Pixel 6 Google Pixel 6", "Other None None", "Mac Apple Mac",
            "iPad Apple iPad", "Other None None", "Spider Spider Desktop", "Other None None"]
_DEVICE = "[" + ", ".join(f"'{x}'" for x in _DEVICES) + f"][list_position({_AGENTS}, agent)]"

COMPANIES = f"SELECT CAST(s_suppkey AS BIGINT) AS cuit, s_name AS name, {_TS0} AS updated_dt FROM supplier"

COMPANY_CHANGES = f"""
SELECT CAST(s_suppkey AS BIGINT) AS cuit, 'New Name!!' AS name, {_TS1} AS updated_dt FROM supplier WHERE s_acctbal < 2000
UNION ALL SELECT CAST(s_suppkey AS BIGINT), s_name || ' Ltd', {_TS1E} FROM supplier WHERE s_acctbal < 2000
UNION ALL SELECT CAST(s_suppkey AS BIGINT) + {d.NEW_COMPANY_CUIT_OFFSET}, s_name || ' Holdings', {_TS1}
  FROM supplier WHERE s_acctbal > 9000"""

CUSTOMERS = f"""
SELECT {_BDAY} AS birth_day, n_name AS country, CAST(c_custkey AS BIGINT) AS document_number,
       c_name AS name, {_TS0} AS updated_dt
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

CUSTOMER_CHANGES = f"""
SELECT {_BDAY} AS birth_day, n_name AS country, CAST(c_custkey AS BIGINT) AS document_number,
       c_name AS name, {_TS1} AS updated_dt
FROM customer LEFT JOIN nation ON (c_nationkey + 1) % 25 = n_nationkey WHERE c_acctbal < 0"""

PRODUCTS = f"""
SELECT CAST(p_partkey % (SELECT count(*) FROM supplier) AS BIGINT) AS cuit, p_name AS name,
       round(p_retailprice * 1.1, 2) AS price, p_retailprice AS price_default,
       CAST(p_partkey AS BIGINT) AS product_id, {_TS0} AS updated_dt FROM part"""

PRODUCT_CHANGES = f"""
SELECT CAST(p_partkey % (SELECT count(*) FROM supplier) AS BIGINT) AS cuit, p_name AS name,
       round(round(p_retailprice * 1.1, 2) * 1.1, 2) AS price, p_retailprice AS price_default,
       CAST(p_partkey AS BIGINT) AS product_id, {_TS1} AS updated_dt FROM part WHERE p_size > 45"""

# Per-order item aggregates (flat form of the documents).
ORDER_ITEMS_AGG = """
SELECT l_orderkey, count(*) AS n_items,
       SUM(CAST(round(p_retailprice * 1.1, 2) AS DECIMAL(15,2)) * CAST(l_quantity AS INTEGER)) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""

# Bronze orders without the nested items (n_items stands in for them).
ORDERS_RAW = f"""
SELECT {_BDAY} AS customer_birth_day, CAST(c_custkey AS VARCHAR) AS customer_document_number,
       c_name AS customer_name, CAST(coalesce(i.n_items, 0) AS INTEGER) AS items,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_dt, CAST(o_orderkey AS VARCHAR) AS order_id,
       {_STATUS} AS status, CAST(coalesce(i.total, 0) AS DECIMAL(38,2)) AS total_dec,
       CAST(CAST(coalesce(i.total, 0) AS DECIMAL(38,2)) AS VARCHAR) AS total_price,
       CAST(NULL AS VARCHAR) AS _rescued_data, DATE '{d.LOAD_DATE}' AS record_timestamp
FROM orders o LEFT JOIN ({ORDER_ITEMS_AGG}) i ON o.o_orderkey = i.l_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""


def _silver_orders(load_ts: str = _LOAD_TS, status_filter: str = "", status_expr: str = _STATUS) -> str:
    return f"""
SELECT {_BDAY} AS customer_birth_day, CAST(c_custkey AS BIGINT) AS customer_document_number,
       c_name AS customer_name, CAST(o_orderdate AS DATE) AS order_dt, CAST(o_orderkey AS VARCHAR) AS order_id,
       {status_expr} AS status, CAST(t.total AS DOUBLE) AS order_total_price, {load_ts} AS record_timestamp,
       CAST(l_quantity AS INTEGER) AS amount, CAST(p_partkey % (SELECT count(*) FROM supplier) AS BIGINT) AS cuit,
       p_retailprice AS item_price_default, round(p_retailprice * 1.1, 2) AS item_price,
       CAST(p_partkey AS BIGINT) AS product_id
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
JOIN ({ORDER_ITEMS_AGG}) t ON t.l_orderkey = o.o_orderkey
{status_filter}"""


SILVER_ORDERS = _silver_orders()

_EVENTS_FIELDS = f"""
SELECT event_id, ts, user_id, event_type,
       user_id % {d.IP_BLOCKS} + 1 AS o1, user_id * 37 % 256 AS o2, event_id % 256 AS o3, event_id * 13 % 256 AS o4,
       CASE WHEN event_type = 'signup' THEN 'login' ELSE 'product' END AS action,
       CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) AS pid,
       CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status_code,
       CAST(event_id * 7919 % 65536 AS VARCHAR) AS bytes,
       ({_AGENTS})[event_id % {len(d.USER_AGENTS)} + 1] AS agent
FROM events"""

LOG_FIELDS = f"""
SELECT *, CAST(o1 AS VARCHAR) || '.' || CAST(o2 AS VARCHAR) || '.' || CAST(o3 AS VARCHAR) || '.' || CAST(o4 AS VARCHAR)
         AS ip_address,
       CAST(o1 AS BIGINT) * 16777216 + o2 * 65536 + o3 * 256 + o4 AS ipn,
       'GET /' || action || '/' || pid AS request
FROM ({_EVENTS_FIELDS})"""

GEO = f"""
SELECT CAST(n_nationkey + 1 AS BIGINT) * 16777216 AS ip_from,
       CAST(n_nationkey + 1 AS BIGINT) * 16777216 + {d.NATION_RANGE_SIZE - 1} AS ip_to, n_name AS country
FROM nation"""

BRONZE_LOGS = f"""
SELECT ip_address, '-' AS client_identity, 'user' || CAST(user_id AS VARCHAR) AS username,
       strftime(ts, '[%d/%m/%Y') AS request_data, strftime(ts, '%H:%M:%S]') AS request_time, request,
       status_code, bytes, '-' AS referer, agent AS user_agent, CAST(year(DATE '{d.LOAD_DATE}') AS INTEGER) AS year,
       strftime(ts, '[%d/%m/%Y %H:%M:%S]') AS request_timestamp, {_LOAD_TS} AS created_dt
FROM ({LOG_FIELDS})"""

SILVER_LOGS = f"""
SELECT ip_address, request, g.country, status_code, {_DEVICE} AS user_agent,
       date_trunc('second', ts) AS request_timestamp, CAST(year(DATE '{d.LOAD_DATE}') AS INTEGER) AS year,
       CASE WHEN request LIKE '%product%' THEN pid END AS product_id, action
FROM ({LOG_FIELDS}) l LEFT JOIN ({GEO}) g ON l.ipn BETWEEN g.ip_from AND g.ip_to"""


def _dedupe(src: str, keys: list[str], order: list[str], tie: list[str]) -> str:
    order_sql = ", ".join([f"{c} DESC NULLS LAST" for c in order + tie])
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order_sql}) AS _rn
  FROM ({src}) WHERE {not_null}) WHERE _rn = 1"""


def _upsert(target: str, source: str, keys: list[str], order: list[str], tie: list[str]) -> str:
    match = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return f"""
WITH t AS ({target}), s AS ({_dedupe(source, keys, order, tie)})
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {match})
UNION ALL SELECT * FROM s"""


UPSERT_COMPANIES = _upsert(COMPANIES, COMPANY_CHANGES, ["cuit"], ["updated_dt"], ["name"])

_ORDERS_RAW_COLS = ("customer_birth_day, customer_document_number, customer_name, order_dt, order_id, "
                    "status, total_price, record_timestamp, items AS n_items")
_ITEM_TIE = ["customer_birth_day", "customer_document_number", "customer_name", "order_dt", "status",
             "order_total_price", "amount", "cuit", "item_price_default", "item_price"]


def _changes(old: str, new: str, key: str, values: list[str]) -> str:
    cols_o = ", ".join(f"o.{c}" for c in [key] + values)
    cols_n = ", ".join(f"n.{c}" for c in [key] + values)
    differ = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in values)
    return f"""
WITH old AS ({old}), new AS ({new})
SELECT {cols_n}, 'insert' AS _change_type FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.{key} = n.{key})
UNION ALL SELECT {cols_o}, 'delete' FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.{key} = o.{key})
UNION ALL SELECT {cols_o}, 'update_preimage' FROM old o JOIN new n ON o.{key} = n.{key} WHERE {differ}
UNION ALL SELECT {cols_n}, 'update_postimage' FROM old o JOIN new n ON o.{key} = n.{key} WHERE {differ}"""


def _arith_hash(col: str, seed: int) -> str:
    k = f"(({col} % {ARITH_MOD}) + {ARITH_MOD}) % {ARITH_MOD}"
    return f"((({k}) * {ARITH_MULT} + {seed}) % {ARITH_MOD} + {ARITH_MOD}) % {ARITH_MOD}"


def _money_avg(col: str) -> str:
    cents = f"SUM(CAST(round({col} * 100) AS BIGINT))"
    n = f"COUNT({col})"
    return f"CAST(CAST(({cents} * 2 + {n}) // ({n} * 2) AS DOUBLE) / 100 AS DECIMAL(18,2))"


# The order suites' rules, by hand.
_NOT_NULL_ORDER = [("customer_birth_day", "customer_birth_day IS NULL"), ("customer_document_number", "customer_document_number IS NULL"),
                   ("customer_name", "customer_name IS NULL")]


def _checked(rows: str, suite: str, not_null: list[tuple[str, str]], greater: list[tuple[str, str, str]]) -> str:
    rules = [("expect_column_values_to_not_be_null", c, bad, "false") for c, bad in not_null]
    rules += [("expect_column_pair_values_a_to_be_greater_than_b", f"{a},{b}", f"{left} <= {b}", f"{left} IS NULL OR {b} IS NULL")
              for a, b, left in greater]
    return f"WITH checked AS ({rows})" + "\nUNION ALL ".join(
        f"""
SELECT '{r.RUN_ID}' AS run_id, '{suite}' AS suite, CAST({i} AS INTEGER) AS rule_index, '{rule}' AS rule, '{columns}' AS "columns",
       count(*) AS total, count(*) FILTER (WHERE {bad}) AS failed, count(*) FILTER (WHERE {unknown}) AS not_evaluated,
       count(*) FILTER (WHERE {bad}) + count(*) FILTER (WHERE {unknown}) = 0 AS success FROM checked"""
        for i, (rule, columns, bad, unknown) in enumerate(rules))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    logs = f"({SILVER_LOGS})"
    q["top_login_countries"] = f"""
SELECT COUNT(country) AS number_of_users, country FROM {logs} WHERE action = 'login'
GROUP BY country ORDER BY number_of_users DESC, country ASC NULLS LAST LIMIT 10"""
    q["top_products_in_top_country"] = f"""
WITH logs AS {logs},
logins AS (SELECT country, row_number() OVER (ORDER BY count(country) DESC, country NULLS LAST) AS place
           FROM logs WHERE action = 'login' GROUP BY country),
views AS (SELECT v.product_id, count(*) AS c FROM logs v JOIN logins w ON v.country = w.country AND w.place = 1
          WHERE v.action = 'product' AND v.product_id IS NOT NULL GROUP BY v.product_id),
ranked AS (SELECT c, v.product_id, p.name AS product_name,
                  row_number() OVER (ORDER BY c DESC, v.product_id, p.name NULLS LAST) AS place
           FROM views v JOIN ({PRODUCTS}) p ON p.product_id = TRY_CAST(v.product_id AS BIGINT))
SELECT c, product_id, product_name FROM ranked WHERE place <= 5"""
    q["main_devices"] = f"""
SELECT COUNT(user_agent) AS device_number, user_agent FROM {logs} GROUP BY user_agent
ORDER BY device_number DESC, user_agent ASC NULLS LAST LIMIT 5"""
    cutoff = f"DATE '{d.SALES_AS_OF}' - INTERVAL 12 MONTH"
    q["monthly_sales_last_year"] = f"""
SELECT CAST(month(order_dt) AS INTEGER) AS month, COUNT(*) AS total_orders,
       {_money_avg('order_total_price')} AS total_price
FROM ({SILVER_ORDERS}) WHERE order_dt > {cutoff} GROUP BY 1 ORDER BY 1"""
    q["monthly_sales_by_order"] = f"""
WITH per_order AS (SELECT order_id, max(order_dt) AS order_dt, max(order_total_price) AS order_total_price
                   FROM ({SILVER_ORDERS}) WHERE order_dt > {cutoff} GROUP BY order_id)
SELECT CAST(month(order_dt) AS INTEGER) AS month, COUNT(*) AS total_orders,
       {_money_avg('order_total_price')} AS total_price FROM per_order GROUP BY 1 ORDER BY 1"""
    q["silver_orders"] = SILVER_ORDERS
    q["order_documents"] = f"""
SELECT order_id, status, items AS n_items, CAST(total_dec AS DECIMAL(18,2)) AS items_total,
       CAST(total_dec AS DECIMAL(18,2)) AS total_price FROM ({ORDERS_RAW})"""
    q["bronze_logs"] = BRONZE_LOGS
    q["silver_logs"] = SILVER_LOGS
    q["geo_lookup"] = f"""
SELECT ip_address, g.country FROM ({LOG_FIELDS}) l LEFT JOIN ({GEO}) g ON l.ipn BETWEEN g.ip_from AND g.ip_to"""
    q["device_label"] = f"""
SELECT agent, {_DEVICE} AS device, count(*) AS n FROM ({_EVENTS_FIELDS}) GROUP BY agent"""
    q["rescued_data"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '{"priority":"' || o_orderpriority || '"}' AS _rescued_data,
       CAST(0 AS INTEGER) AS n_bad_fields FROM orders"""
    q["log_quarantine"] = "SELECT count(*) AS good_lines, CAST(0 AS BIGINT) AS bad_lines FROM events"
    q["dedupe_latest"] = _dedupe(COMPANY_CHANGES, ["cuit"], ["updated_dt"], ["name"])
    q["upsert_companies"] = UPSERT_COMPANIES
    q["upsert_customers"] = _upsert(CUSTOMERS, CUSTOMER_CHANGES, ["document_number", "name", "birth_day"],
                                    ["updated_dt"], ["country"])
    q["upsert_products"] = _upsert(PRODUCTS, PRODUCT_CHANGES, ["product_id"], ["updated_dt"],
                                   ["cuit", "name", "price", "price_default"])
    raw_t = f"SELECT {_ORDERS_RAW_COLS} FROM ({ORDERS_RAW})"
    raw_s = (f"SELECT customer_birth_day, customer_document_number, customer_name, order_dt, order_id, "
             f"'finished' AS status, total_price, record_timestamp + 1 AS record_timestamp, items AS n_items "
             f"FROM ({ORDERS_RAW}) WHERE status = 'pending'")
    q["upsert_orders_raw"] = _upsert(raw_t, raw_s, ["order_id"], ["record_timestamp"],
                                     ["customer_birth_day", "customer_document_number", "customer_name",
                                      "order_dt", "status", "total_price"])
    day1 = _dedupe(SILVER_ORDERS, ["order_id", "product_id"], ["record_timestamp"], _ITEM_TIE)
    day2 = _silver_orders(load_ts=f"({_LOAD_TS} + INTERVAL 1 DAY)", status_filter="WHERE o_orderstatus = 'O'",
                          status_expr="'finished'")
    q["upsert_order_items"] = _upsert(day1, day2, ["order_id", "product_id"], ["record_timestamp"], _ITEM_TIE)
    q["table_changes"] = _changes(COMPANIES, UPSERT_COMPANIES, "cuit", ["name", "updated_dt"])
    q["orders_raw_changes"] = f"""
WITH resent AS (SELECT order_id, total_price, items AS n_items, record_timestamp AS day FROM ({ORDERS_RAW}) WHERE status = 'pending')
SELECT order_id, 'pending' AS status, day AS record_timestamp, total_price, n_items, 'update_preimage' AS _change_type FROM resent
UNION ALL
SELECT order_id, 'finished', CAST(day + 1 AS DATE), total_price, n_items, 'update_postimage' FROM resent"""
    q["merge_change_feed"] = q["table_changes"]
    q["table_history"] = f"""
WITH v1 AS ({COMPANIES}), ch AS ({_changes(COMPANIES, UPSERT_COMPANIES, "cuit", ["name", "updated_dt"])})
SELECT CAST(1 AS INTEGER) AS version, (SELECT count(*) FROM v1) AS num_inserted, CAST(0 AS BIGINT) AS num_updated,
       CAST(0 AS BIGINT) AS num_deleted
UNION ALL
SELECT CAST(2 AS INTEGER), count(*) FILTER (WHERE _change_type = 'insert'),
       count(*) FILTER (WHERE _change_type = 'update_postimage'), count(*) FILTER (WHERE _change_type = 'delete')
FROM ch"""
    q["orphan_products"] = f"""
WITH p AS ({PRODUCTS}), c AS ({COMPANIES})
SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.cuit = p.cuit)"""
    q["orphan_summary"] = f"""
SELECT count(*) AS child_rows, count(*) FILTER (WHERE p.product_id IS NULL) AS orphan_rows
FROM ({SILVER_ORDERS}) so LEFT JOIN ({PRODUCTS}) p ON so.product_id = p.product_id"""
    q["dq_orders_raw"] = _checked(f"SELECT * FROM ({ORDERS_RAW})", "transactional_orders_raw", [
        *_NOT_NULL_ORDER, ("items", "items IS NULL"), ("order_dt", "order_dt IS NULL"), ("order_id", "order_id IS NULL"),
        ("status", "status IS NULL"), ("total_price", "total_price IS NULL"), ("record_timestamp", "record_timestamp IS NULL")], [])
    q["dq_orders"] = _checked(SILVER_ORDERS, "transactional_orders_processed", [
        *_NOT_NULL_ORDER, ("product_id", "product_id IS NULL"), ("order_dt", "order_dt IS NULL"), ("order_id", "order_id IS NULL"),
        ("status", "status IS NULL"), ("order_total_price", "order_total_price IS NULL"), ("record_timestamp", "record_timestamp IS NULL")],
        [("order_total_price", "item_price_default", "order_total_price"), ("item_price", "item_price_default", "item_price"),
         ("order_id", "product_id", "TRY_CAST(order_id AS BIGINT)")])
    q["hash_sample"] = f"""
SELECT * FROM ({PRODUCTS})
WHERE {_arith_hash('product_id', r.SAMPLE_SEED)} < {int(r.SAMPLE_FRACTION * ARITH_MOD)}"""
    q["hash_sample_n"] = f"""
SELECT * FROM ({CUSTOMERS}) ORDER BY {_arith_hash('document_number', r.SAMPLE_SEED)}, document_number
LIMIT {r.SAMPLE_N}"""
    state = "CASE WHEN event_type = 'error' THEN 'INTERNAL_ERROR' ELSE 'TERMINATED' END"
    msg = "CASE WHEN event_type = 'error' THEN 'Run failed with value ' || CAST(value AS VARCHAR) ELSE '' END"
    q["job_runs_view"] = f"""
WITH runs AS (
  SELECT CAST(user_id AS BIGINT) AS job_id, CAST(event_id AS BIGINT) AS run_id,
         CAST(event_id % 100 AS BIGINT) AS number_in_job, '0' AS setup_duration,
         'user' || CAST(user_id AS VARCHAR) || '@shop.example' AS creator_user_name,
         event_type || '_job' AS run_name,
         'https://jobs.shop.example/#job/' || CAST(user_id AS VARCHAR) || '/run/' || CAST(event_id AS VARCHAR)
           AS run_page_url,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'SUBMIT_RUN' ELSE 'JOB_RUN' END AS run_type,
         strftime(ts, '%d-%m-%Y %H:%M:%S') AS run_start_time, {state} AS life_cycle_state, {msg} AS state_message
  FROM events)
SELECT job_id, run_id, number_in_job, setup_duration, creator_user_name, run_name, run_page_url, run_type,
       run_start_time,
       '<tr role="row" class="even"><td>' || CAST(job_id AS VARCHAR) || '</td><td><a href="' || run_page_url
       || '" target="_blank" style>' || CAST(run_id AS VARCHAR) || '</a></td><td>' || run_name || '</td><td>'
       || run_start_time || '</td><td>' || creator_user_name || '</td><td>' || life_cycle_state || '</td><td>'
       || state_message || '</td></tr>' AS table_row_tag,
       life_cycle_state, state_message
FROM runs WHERE run_type = 'JOB_RUN'"""
    q["submit_runs_view"] = q["job_runs_view"].replace("WHERE run_type = 'JOB_RUN'", "WHERE run_type = 'SUBMIT_RUN'")
    q["stream_silver_logs"] = SILVER_LOGS
    lo, hi = d.CLOSED_ACCOUNTS
    closed_ts = f"TIMESTAMP '{d.CLOSED_UPDATED_TS}'"
    v2 = f"SELECT cuit, name, updated_dt FROM ({UPSERT_COMPANIES})"
    v4 = f"""
SELECT v.cuit, v.name, v.updated_dt FROM ({v2}) v LEFT JOIN supplier ON v.cuit = s_suppkey
WHERE s_suppkey IS NULL OR (s_acctbal >= 2000 AND NOT s_acctbal BETWEEN {lo} AND {hi})
UNION ALL SELECT CAST(s_suppkey AS BIGINT), s_name || ' Group', {closed_ts} FROM supplier WHERE s_acctbal < 2000"""
    reads = {"version 1": COMPANIES, "version 2": v2, "2022-11-15 09:00:00": v2, "now": v4}
    q["table_as_of"] = "\nUNION ALL ".join(f"SELECT cuit, name, updated_dt, '{label}' AS as_of FROM ({sql})" for label, sql in reads.items())
    small, big, gone = (f"(SELECT count(*) FROM supplier WHERE {w})" for w in ("s_acctbal < 2000", "s_acctbal > 9000", f"s_acctbal BETWEEN {lo} AND {hi}"))
    q["commit_history"] = f"""
SELECT v AS version, op AS operation, CAST(done AS TIMESTAMP) AS committed_at, n AS num_source_rows, i AS num_inserted,
       u AS num_updated, x AS num_deleted
FROM (VALUES (1::BIGINT, 'MERGE', '2022-11-13 21:00:00', (SELECT count(*) FROM supplier), (SELECT count(*) FROM supplier), 0::BIGINT, 0::BIGINT),
             (2, 'MERGE', '2022-11-14 21:00:00', {small} + {big}, {big}, {small}, 0),
             (3, 'SNAPSHOT', '2022-11-14 23:00:00', NULL, 0, 0, 0),
             (4, 'MERGE', '2022-11-15 21:00:00', {small} + {gone}, 0, {small}, {gone})) AS t(v, op, done, n, i, u, x)"""
    late = f"o_orderkey % 10 = {d.LATE_ORDER_DIGIT}"
    pending = [k for k, v in d.STATUS_NAMES.items() if v == "pending"][0]
    cancelled = [k for k, v in d.STATUS_NAMES.items() if v == "cancelled"][0]
    final = _silver_orders(status_filter=f"""WHERE {late} OR (o_orderstatus = '{pending}' AND CAST(l_quantity AS INTEGER) >= {d.RESENT_LEAST_AMOUNT})
   OR o_orderstatus NOT IN ('{pending}', '{cancelled}')""", status_expr=f"CASE WHEN o_orderstatus = '{pending}' AND NOT {late} THEN 'finished' ELSE {_STATUS} END")
    q["stream_orders_from_changes"] = _dedupe(final, ["order_id", "product_id"], ["record_timestamp"], _ITEM_TIE)
    first = [("customer_birth_day", "date"), ("customer_document_number", "string"), ("customer_name", "string"),
             ("items", "array<map<string,string>>"), ("order_dt", "string"), ("order_id", "string"), ("status", "string"), ("total_price", "string")]
    listed = [(1, i, c, t, True) for i, (c, t) in enumerate(first)]
    listed += [(2, i, c, t, False) for i, (c, t) in enumerate(first)] + [(2, len(first), "priority", "string", True)]
    q["schema_versions"] = "SELECT * FROM (VALUES " + ", ".join(
        f"({v}::INTEGER, {i}::INTEGER, '{c}', '{t}', {a})" for v, i, c, t, a in listed) + ") AS t(version, position, \"column\", type, added)"
    q["orders_after_drift"] = f"""
SELECT order_id, status, total_price, CASE WHEN {late} THEN o_orderpriority END AS priority, CAST(NULL AS VARCHAR) AS _rescued_data,
       CASE WHEN {late} THEN 2::INTEGER ELSE 1::INTEGER END AS schema_version
FROM ({ORDERS_RAW}) r JOIN orders ON r.order_id = CAST(o_orderkey AS VARCHAR)"""
    # Networks as (first address, bits) numbers; the address space is IPv6's, IPv4 at ::ffff:0:0.
    v4_at, v6_at = "(65535::HUGEINT * 4294967296)", "(536939960::HUGEINT * 79228162514264337593543950336)"
    group = lambda n: f"({2 ** n}::HUGEINT)"
    after = "(SELECT (n_nationkey + 24) % 25 AS k, n_name FROM nation)"
    q["geo_lookup_nested"] = f"""
WITH net AS (
  SELECT {v4_at} + r_regionkey * 8 * 16777216 AS a, 32 - 5 AS free, r_name AS country FROM region
  UNION ALL SELECT {v6_at} + r_regionkey * 256 * {group(80)}, 128 - 40, r_name FROM region
  UNION ALL SELECT {v4_at} + (n_nationkey + 1) * 16777216, 32 - 9, n_name FROM nation
  UNION ALL SELECT {v4_at} + (n_nationkey + 1) * 16777216 + 128 * 65536, 32 - 10, n_name FROM nation
  UNION ALL SELECT {v6_at} + n_nationkey * {group(80)}, 128 - 48, n_name FROM nation
  UNION ALL SELECT {v4_at} + (s_nationkey + 1) * 16777216 + (s_suppkey * 11 % 256) * 65536 + s_suppkey % 16 * 16 * 256, 32 - 20, n_name
            FROM supplier JOIN {after} ON k = s_nationkey
  UNION ALL SELECT {v4_at} + (c_nationkey + 1) * 16777216 + (c_custkey * 37 % 256) * 65536 + (c_custkey * 7 % 256) * 256, 32 - 24, n_name
            FROM customer JOIN {after} ON k = c_nationkey
  UNION ALL SELECT {v6_at} + c_nationkey * {group(80)} + (c_custkey % 64) * {group(64)}, 128 - 64, n_name
            FROM customer JOIN {after} ON k = c_nationkey
), range AS (SELECT DISTINCT a, a + (2::HUGEINT ** free)::HUGEINT - 1 AS b, free, country FROM net),
visit AS (
  SELECT event_id, CASE WHEN event_id % 50 = 0 THEN '-' WHEN event_id % 3 = 1
      THEN printf('2001:db8:%x:%x::%x', user_id % {d.IP_BLOCKS}, event_id % 96, event_id % 65536)
      ELSE printf('%d.%d.%d.%d', user_id % {d.IP_BLOCKS} + 1, user_id * 37 % 256, event_id % 256, event_id * 13 % 256) END AS ip_address,
    CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 3 = 1
      THEN {v6_at} + (user_id % {d.IP_BLOCKS}) * {group(80)} + (event_id % 96) * {group(64)} + event_id % 65536
      ELSE {v4_at} + (user_id % {d.IP_BLOCKS} + 1) * 16777216 + (user_id * 37 % 256) * 65536 + (event_id % 256) * 256 + event_id * 13 % 256 END AS ip
  FROM events
), best AS (SELECT event_id, arg_min(country, (free, country)) AS country FROM visit JOIN range ON ip BETWEEN a AND b GROUP BY event_id)
SELECT v.event_id, v.ip_address, best.country FROM visit v LEFT JOIN best ON best.event_id = v.event_id"""
    q["device_rules"] = """
SELECT device, count(*) AS n FROM (
  SELECT CASE WHEN event_id % 7 = 0 THEN 'Other None None' WHEN event_id % 4 = 3 THEN 'Tablet Generic Tablet'
              WHEN p_size <= 40 THEN printf('Phone BR%sS%d Brand%s BR%sS%d', b, p_size, b, b, p_size)
              ELSE printf('Generic Brand%s Brand%s Smartphone', b, b) END AS device
  FROM events JOIN (SELECT *, replace(p_brand, 'Brand#', '') AS b FROM part) ON p_partkey = event_id % (SELECT count(*) FROM part))
GROUP BY device"""
    hit = {k: f"event_id % {n} = 0" for k, n in d.DAMAGE.items()}
    q["quarantine_reasons"] = f"""
SELECT reasons, count(*) AS n_lines FROM (
  SELECT CASE WHEN {hit['cut']} THEN 'bad_line' ELSE concat_ws('+', CASE WHEN {hit['time']} THEN 'bad_time' END,
    CASE WHEN {hit['address']} THEN 'bad_address' END, CASE WHEN {hit['status']} THEN 'bad_status' END) END AS reasons FROM events)
GROUP BY reasons"""
    twice = """(SELECT DISTINCT l_orderkey FROM (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey
               GROUP BY l_orderkey, l_partkey HAVING count(*) > 1))"""
    broken = {k: f"CAST(order_id AS BIGINT) % {d.DAMAGE[k]} = 0" for k in ("time", "cut")}
    damaged = f"({broken['time']} OR {broken['cut']})"
    repeated = f"CAST(order_id AS BIGINT) IN {twice}"
    # Documents with a repeated item stay in quarantine; the others come through, damaged ones a day later.
    q["orders_after_replay"] = f"""
SELECT order_id, order_dt, status, total_price, CASE WHEN {damaged} THEN DATE '2022-11-15' ELSE record_timestamp END AS record_timestamp,
       items AS n_items FROM ({ORDERS_RAW}) WHERE NOT {repeated}"""
    q["quarantine_after_replay"] = f"""
SELECT reasons, status, CASE WHEN status = 'replayed' THEN '15' END AS replayed_in, count(*) AS n_records FROM (
  SELECT CASE WHEN {damaged} AND NOT {repeated} THEN 'replayed' ELSE 'open' END AS status,
         CASE WHEN {repeated} AND {damaged} THEN 'repeated_item' WHEN {broken['cut']} THEN 'bad_json'
              ELSE concat_ws('+', CASE WHEN {broken['time']} THEN 'bad_time' END, CASE WHEN {repeated} THEN 'repeated_item' END) END AS reasons
  FROM ({ORDERS_RAW}) WHERE {damaged} OR {repeated})
GROUP BY reasons, status"""
    q["orphan_ledger"] = f"""
WITH n AS (SELECT count(*) AS s FROM supplier),
company AS (SELECT s_suppkey AS k, CASE WHEN s_acctbal >= {d.PROMPT_BALANCE} THEN 1 WHEN s_suppkey % 2 = 1 THEN 2 END AS came FROM supplier),
item AS (SELECT p_partkey AS k, p_size > 45 AS moves, CASE WHEN p_partkey % 10 = {d.LATE_PRODUCT_DIGIT} THEN 2 ELSE 1 END AS day,
                p_partkey % s AS c1, (p_partkey + 1) % s AS c2 FROM part, n),
seen AS (SELECT i.*, coalesce(a.came, 9) AS came1, coalesce(b.came, 9) AS came2
         FROM item i LEFT JOIN company a ON a.k = c1 LEFT JOIN company b ON b.k = c2),
-- after day 2: opened on the day of arrival, closed on day 2 if the company came then
two AS (SELECT *, CASE WHEN came1 > day THEN day END AS o, CASE WHEN came1 = 2 AND day = 1 THEN 2 END AS x FROM seen),
three AS (SELECT k, CASE WHEN NOT moves OR came2 < 9 THEN c1 ELSE c2 END AS c,
                 CASE WHEN moves AND came2 = 9 AND (o IS NULL OR x IS NOT NULL) THEN 3 ELSE o END AS o,
                 CASE WHEN NOT moves THEN x WHEN came2 = 9 THEN NULL WHEN x IS NOT NULL THEN x ELSE 3 END AS x FROM two)
SELECT CAST(k AS BIGINT) AS product_id, CAST(c AS BIGINT) AS cuit, CASE WHEN x IS NULL THEN 'open' ELSE 'resolved' END AS status,
       TIMESTAMP '2022-11-12 21:00:00' + to_days(CAST(o AS INTEGER)) AS opened_at,
       TIMESTAMP '2022-11-12 21:00:00' + to_days(CAST(x AS INTEGER)) AS closed_at
FROM three WHERE o IS NOT NULL"""
    q["dq_history"] = """
WITH item AS (SELECT l_orderkey % 3 AS day, l_partkey AS p, CAST(l_quantity AS DOUBLE) AS amount, CAST(l_extendedprice AS DOUBLE) AS price,
                     l_linenumber AS line FROM lineitem),
batch AS (SELECT CAST(20221113 + day AS VARCHAR) AS run_id, CASE WHEN day = 2 THEN p % 20 ELSE p END AS product_id,
                 CASE WHEN day = 1 AND p % 3 = 0 THEN NULL ELSE amount END AS amount,
                 CASE WHEN day = 1 THEN price * 3 ELSE price END AS price, line FROM item),
long AS (SELECT run_id, 'product_id' AS c, CAST(product_id AS DOUBLE) AS v FROM batch
         UNION ALL SELECT run_id, 'amount', amount FROM batch UNION ALL SELECT run_id, 'price', price FROM batch
         UNION ALL SELECT run_id, 'line', CAST(line AS DOUBLE) FROM batch),
measured AS (SELECT run_id, c, count(*) AS total, count(*) - count(v) AS nulls, count(DISTINCT v) AS n, median(v) AS m FROM long GROUP BY run_id, c),
paired AS (SELECT *, lag(total) OVER w AS total0, lag(nulls) OVER w AS nulls0, lag(n) OVER w AS n0, lag(m) OVER w AS m0
           FROM measured WINDOW w AS (PARTITION BY c ORDER BY run_id))
SELECT run_id, c AS "column", total, nulls, abs(nulls / total - nulls0 / total0) > 0.05 AS null_drift,
       abs(n - n0) > 0.25 * n0 AS distinct_drift, abs(m - m0) > 0.25 * abs(m0) AS median_drift
FROM paired"""
    q["products_after_restore"] = f"""
SELECT *, '2022-11-13' AS run_dt FROM ({PRODUCTS})
UNION ALL SELECT *, '2022-11-14' FROM ({_upsert(PRODUCTS, PRODUCT_CHANGES, ["product_id"], ["updated_dt"], ["name"])})"""
    q["stream_top_login_countries"] = q["top_login_countries"]
    q["stream_orders"] = _dedupe(SILVER_ORDERS, ["order_id", "product_id"], ["record_timestamp"], _ITEM_TIE)
    q["silver_log_files"] = f"""
SELECT country, count(*) AS n_rows, CAST(ceil(count(*) / {r.LOG_ROWS_PER_FILE}) AS BIGINT) AS n_files, true AS bounded
FROM {logs} GROUP BY country"""
    q["upsert_landed_companies"] = UPSERT_COMPANIES
    q["job_runs_listing"] = q["job_runs_view"].replace("WHERE run_type = 'JOB_RUN'", "")
    q["sql_top_products"] = q["top_products_in_top_country"]
    q["rename_one_company"] = f"""
SELECT cuit, CASE WHEN first THEN 'New Name!!' ELSE name END AS name, CASE WHEN first THEN {_TS1} ELSE updated_dt END AS updated_dt
FROM (SELECT *, cuit = min(cuit) OVER () AS first FROM ({COMPANIES}))"""
    q["order_item_ids"] = f"""
SELECT order_id, product_id, sha256(order_id || chr(31) || CAST(product_id AS VARCHAR)) AS item_id FROM ({SILVER_ORDERS})"""
    q["daily_cancelled_orders"] = f"""
WITH o AS (SELECT order_dt AS day, count(DISTINCT order_id) AS n FROM ({SILVER_ORDERS}) WHERE status = 'cancelled' GROUP BY order_dt),
spine AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM o)
SELECT day, coalesce(n, 0) AS n_orders FROM spine LEFT JOIN o USING (day)"""
    return q
