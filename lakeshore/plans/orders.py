"""Orders: nested documents -> bronze -> silver item rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.casts import to_bigint, to_date, to_double, to_int
from lakeshore.operators.changes import CHANGE_TYPE, DELETE, UPDATE_PRE
from lakeshore.operators.dedupe import dedupe_latest
from lakeshore.operators.upsert import BROADCAST_KEYS, DELETED
from lakeshore.schemas import KEYS, ORDERS_COLUMNS


def silver_orders(orders_raw: DataFrame, load_ts=None, reference_compat: bool = False,
                  with_product_name: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One row per order item, typed (lenient casts: bad values -> NULL).

    Orders whose ``items`` is empty or NULL produce no row (``explode``).
    ``customer_name`` keeps the order's customer; the original pipeline
    overwrote it with the product name, which ``reference_compat=True`` gives.
    ``keep`` names further columns of the documents to carry along.
    """
    ts = load_ts if isinstance(load_ts, Column) else (
        F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp"))
    item = F.col("_item")
    df = orders_raw.select("*", F.explode("items").alias("_item"))
    cols = {
        "customer_birth_day": F.col("customer_birth_day"),
        "customer_document_number": to_bigint("customer_document_number"),
        "customer_name": item["name"] if reference_compat else F.col("customer_name"),
        "order_dt": to_date("order_dt"),
        "order_id": F.col("order_id"),
        "status": F.col("status"),
        "order_total_price": to_double("total_price"),
        "record_timestamp": ts.cast("timestamp"),
        **_item_columns(item),
    }
    out = [cols[c].alias(c) for c in ORDERS_COLUMNS]
    if with_product_name:
        out.append(item["name"].alias("product_name"))
    return df.select(*out, *keep)


def _item_columns(item: Column) -> dict[str, Column]:
    """The silver columns that come from an item."""
    return {
        "amount": to_int(item["amount"]),
        "cuit": to_bigint(item["cuit"]),
        "item_price_default": to_double(item["price_default"]),
        "item_price": to_double(item["price"]),
        "product_id": to_bigint(item["product_id"]),
    }


def latest_items(orders_raw: DataFrame, load_ts=None, order_by: Sequence[str | Column] = ("record_timestamp",)) -> DataFrame:
    """Silver items of documents that have one row per ``order_id``, kept latest per key.

    Items can only repeat within a document then.  Ordered by named columns, those of
    documents that have two items of one product are kept latest inside the array, in
    one pass and without a shuffle; other orders take such documents through the
    keep-latest window.
    """
    # An array in an array is bound by the lambda, so that it is made once.
    products = F.transform("items", lambda i: to_bigint(i["product_id"]))
    repeats = lambda ids: F.size(F.array_distinct(ids)) < F.size(ids)
    twice = F.coalesce(F.transform(F.array(products), lambda ids: repeats(F.array_compact(ids)))[0], F.lit(False))
    if all(isinstance(c, str) for c in order_by):
        return silver_orders(orders_raw.withColumn("items", F.when(twice, _latest_in(order_by)).otherwise(F.col("items"))), load_ts)
    kept = dedupe_latest(silver_orders(orders_raw.where(twice), load_ts), KEYS["orders"], order_by)
    return silver_orders(orders_raw.where(~twice), load_ts).unionByName(kept)


def _latest_in(order_by: Sequence[str]) -> Column:
    """A document's items, one per product: the one ``dedupe_latest`` keeps of their silver rows."""
    def rank(item: Column, n: Column) -> Column:
        values = _item_columns(item)
        # The other columns are the document's: they tell no item of it from another.
        by = [c for c in dict.fromkeys(("product_id", *order_by, *ORDERS_COLUMNS)) if c in values]
        return F.struct(*[values[c].alias(c) for c in by], n.alias("_n"))

    ranks = F.sort_array(F.transform("items", rank), asc=False)
    firsts = F.transform(F.array(ranks), lambda r: F.filter(
        r, lambda x, k: (k == 0) | ~x["product_id"].eqNullSafe(F.get(r, k - 1)["product_id"])))[0]
    return F.transform(firsts, lambda x: F.get("items", x["_n"]))


def _gone() -> Column:
    return F.col(CHANGE_TYPE).isin(DELETE, UPDATE_PRE)


def _product_ids() -> Column:
    return F.coalesce(F.transform("items", lambda i: to_bigint(i["product_id"])), F.array().cast("array<bigint>"))


def change_marks(changes: DataFrame) -> DataFrame:
    """(order_id, _several, _lost) of the orders in a change feed whose last items take more than their document to tell.

    ``_several``: the order has several documents of a kind, a document that goes
    after the one that comes, an item twice, or no id; its items are put in order row
    by row.  ``_lost``: products that went and did not come again.  Only ids are
    shuffled.
    """
    gone, ids = _gone(), _product_ids()
    unknown = F.col("order_id").isNull()
    slim = changes.select("order_id", "version", gone.alias("_gone"), F.when(~unknown, F.array_distinct(ids)).alias("_ids"),
                          (unknown | (F.size(F.array_distinct(ids)) < F.size(ids))).alias("_twice"))
    of = lambda cond, value: F.when(cond, value)
    come, go = ~F.col("_gone"), F.col("_gone")
    per = slim.groupBy("order_id").agg(
        F.count_if(come).alias("_n"), F.count_if(go).alias("_m"), F.max(of(come, F.col("version"))).alias("_v"),
        F.max(of(go, F.col("version"))).alias("_w"), F.max("_twice").alias("_twice"),
        F.flatten(F.collect_list(of(come, F.col("_ids")))).alias("_come"), F.flatten(F.collect_list(of(go, F.col("_ids")))).alias("_go"))
    several = F.col("_twice") | (F.col("_n") > 1) | (F.col("_m") > 1) | F.coalesce(F.col("_w") > F.col("_v"), F.lit(False))
    marks = per.select("order_id", several.alias("_several"), F.array_except("_go", "_come").alias("_lost"))
    return marks.where(F.col("_several") | (F.size("_lost") > 0))


def item_changes(changes: DataFrame, load_ts=None, marks: DataFrame | None = None) -> DataFrame:
    """A change feed of order documents -> the last change of each of their items.

    ``changes`` has the documents' columns, ``_change_type`` and ``version``.
    Pre-images and deleted documents take their items away, post-images and
    inserted ones bring theirs; of an item's changes the highest version wins,
    and within a version the one that brings it.  So an item that a new version
    of its order no longer has ends as a tombstone (``_deleted``), of which only
    the key counts.

    Most orders have one document that comes, one that goes or one of each:
    their items are told apart by ``marks`` (``change_marks``, persisted by a
    caller that can let them go), and only those of other orders go through the
    keep-latest window.
    """
    marks = change_marks(changes) if marks is None else marks
    several = marks.where("_several").select("order_id")
    n = several.count()
    marked = changes.select("*", _gone().alias(DELETED))
    plain = marked.where(~F.col(DELETED))
    if n:
        few = several.select(F.col("order_id").alias("_id"))
        few = F.broadcast(few) if n <= BROADCAST_KEYS else few
        same = F.col("order_id").eqNullSafe(F.col("_id"))
        plain, whole = plain.join(few, same, "left_anti"), marked.join(few, same, "left_semi")
    brought = silver_orders(plain, load_ts, keep=[DELETED])
    lost = marks.where("NOT _several").select("order_id", F.explode("_lost").alias("product_id"))
    lost = lost.select(*[F.col(f.name) if f.name in KEYS["orders"] else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in brought.schema.fields if f.name != DELETED], F.lit(True).alias(DELETED))
    out = brought.unionByName(lost)
    if not n:
        return out
    ordered = dedupe_latest(silver_orders(whole, load_ts, keep=["version", DELETED]), KEYS["orders"], ["version", F.col(DELETED).asc()])
    return out.unionByName(ordered.drop("version"))


def dropped_orders(orders_raw: DataFrame) -> DataFrame:
    """Orders the explode drops (no items); counted by the quality report."""
    return orders_raw.where(F.coalesce(F.size("items"), F.lit(-1)) <= 0).select("order_id")


def document_totals(orders_raw: DataFrame) -> DataFrame:
    """Per document: item count and total recomputed from the items (sum of price x amount)."""
    items = F.col("items")
    line = F.transform(items, lambda m: m["price"].try_cast("decimal(15,2)") * m["amount"].try_cast("int"))
    total = F.aggregate(line, F.lit(0).cast("decimal(38,2)"), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
    return orders_raw.select(
        "order_id", "status",
        F.coalesce(F.size(items), F.lit(0)).cast("int").alias("n_items"),
        total.cast("decimal(18,2)").alias("items_total"),
        F.col("total_price").try_cast("decimal(18,2)").alias("total_price"))
