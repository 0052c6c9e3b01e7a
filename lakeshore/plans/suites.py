"""The quality suites on the two order tables."""

from __future__ import annotations

from lakeshore.operators.quality import Suite, not_null, pair_greater

ORDERS_RAW_SUITE = Suite("transactional_orders_raw", [
    not_null(c) for c in [
        "customer_birth_day", "customer_document_number", "customer_name", "items",
        "order_dt", "order_id", "status", "total_price", "record_timestamp"]
])

ORDERS_SUITE = Suite("transactional_orders_processed", [
    *[not_null(c) for c in [
        "customer_birth_day", "customer_document_number", "customer_name", "product_id",
        "order_dt", "order_id", "status", "order_total_price", "record_timestamp"]],
    pair_greater("order_total_price", "item_price_default"),
    pair_greater("item_price", "item_price_default"),
    pair_greater("order_id", "product_id", or_equal=False),
])
