"""Table schemas and keys: the one place readers, writers and tests take them from."""

from __future__ import annotations

from pyspark.sql import types as T

# --- raw landing -----------------------------------------------------------

# One order document as the source system writes it (items are product
# records; numbers inside the map arrive as strings).
ORDER_DOC = T.StructType([
    T.StructField("customer_birth_day", T.DateType()),
    T.StructField("customer_document_number", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("items", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("order_dt", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_price", T.StringType()),
])
ORDER_DOC_FIELDS = [f.name for f in ORDER_DOC.fields]
ORDER_ITEM_KEYS = ["cuit", "name", "price", "price_default", "product_id", "amount"]

# Bronze orders: the document plus rescued unknown keys and the load date.
ORDERS_RAW = T.StructType(ORDER_DOC.fields + [
    T.StructField("_rescued_data", T.StringType()),
    T.StructField("record_timestamp", T.DateType()),
])

# A combined-log line has ten space-separated tokens, quotes kept together.
LOG_LINE_FIELDS = [
    "ip_address", "client_identity", "username", "request_data", "request_time",
    "request", "status_code", "bytes", "referer", "user_agent",
]
LOG_LINE = T.StructType([T.StructField(c, T.StringType()) for c in LOG_LINE_FIELDS])

LOGS_RAW = T.StructType(LOG_LINE.fields + [
    T.StructField("year", T.IntegerType()),
    T.StructField("request_timestamp", T.StringType()),
    T.StructField("created_dt", T.TimestampType()),
])

# --- silver ----------------------------------------------------------------

ORDERS = T.StructType([
    T.StructField("customer_birth_day", T.DateType()),
    T.StructField("customer_document_number", T.LongType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("order_dt", T.DateType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("order_total_price", T.DoubleType()),
    T.StructField("record_timestamp", T.TimestampType()),
    T.StructField("amount", T.IntegerType()),
    T.StructField("cuit", T.LongType()),
    T.StructField("item_price_default", T.DoubleType()),
    T.StructField("item_price", T.DoubleType()),
    T.StructField("product_id", T.LongType()),
])
ORDERS_COLUMNS = [f.name for f in ORDERS.fields]

LOGS_COLUMNS = [
    "ip_address", "request", "country", "status_code", "user_agent",
    "request_timestamp", "year", "product_id", "action",
]

# --- dimensions ------------------------------------------------------------

COMPANIES = T.StructType([
    T.StructField("cuit", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("updated_dt", T.TimestampType()),
])
CUSTOMERS = T.StructType([
    T.StructField("birth_day", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("document_number", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("updated_dt", T.TimestampType()),
])
PRODUCTS = T.StructType([
    T.StructField("cuit", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("price_default", T.DoubleType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("updated_dt", T.TimestampType()),
])

# --- job monitor -------------------------------------------------------------

JOB_RUN = T.StructType([
    T.StructField("job_id", T.LongType()),
    T.StructField("run_id", T.LongType()),
    T.StructField("number_in_job", T.LongType()),
    T.StructField("state", T.StructType([
        T.StructField("life_cycle_state", T.StringType()),
        T.StructField("state_message", T.StringType()),
    ])),
    T.StructField("start_time", T.LongType()),
    T.StructField("setup_duration", T.StringType()),
    T.StructField("creator_user_name", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("run_page_url", T.StringType()),
    T.StructField("run_type", T.StringType()),
])
JOB_RUNS_LISTING = T.StructType([T.StructField("runs", T.ArrayType(JOB_RUN))])

# --- keys ------------------------------------------------------------------

# Table name -> key columns used by upserts and change feeds.
KEYS: dict[str, list[str]] = {
    "companies": ["cuit"],
    "customers": ["document_number", "name", "birth_day"],
    "products": ["product_id"],
    "orders_raw": ["order_id"],
    "orders": ["order_id", "product_id"],
}

SCHEMAS: dict[str, T.StructType] = {
    "companies": COMPANIES,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders_raw": ORDERS_RAW,
    "orders": ORDERS,
    "logs_raw": LOGS_RAW,
}
