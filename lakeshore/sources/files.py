"""Landed files -> DataFrames, batch or streaming, with a quarantine for bad records.

Files are read as text lines and parsed with ``from_json`` / ``from_csv``
column expressions; a record that does not parse is split off to quarantine
instead of failing the job.  This works the same on ``spark.read`` and
``spark.readStream`` (the stream form is used inside ``foreachBatch``).

* Order documents: a line is a JSON array of orders (as ``json.dumps`` writes a
  list) or a single JSON object (as Spark's JSON writer writes).  Every order
  element is parsed on its own, so one bad field NULLs only that field of that
  order (reported in ``_bad_fields``) and one broken line never touches others.
  Keys outside the schema are kept as JSON text in ``_rescued_data``.
* Log lines: ten space-separated fields, quotes respected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.schemas import JOB_RUNS_LISTING, ORDER_DOC, SCHEMAS


def text_files(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of every file under ``path`` (any folder layout; no path columns added).

    ``recursiveFileLookup`` reads ``year=/record_dt=`` and ``record_dt=`` folders
    side by side, which partition discovery would reject.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").option("recursiveFileLookup", "true")
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


@dataclass
class ParsedOrders:
    orders: DataFrame       # ORDERS_RAW columns (+ _bad_fields array)
    bad_records: DataFrame  # value: lines that are not JSON orders
    docs: DataFrame         # per element: raw text, typed struct, string map (persist to parse once)
    troubled: DataFrame     # the bad records (value), and order_id and _bad_fields of the orders that have some


def _elements(line_col: str) -> Column:
    v = F.trim(F.col(line_col))
    return (F.when(v.startswith("["), F.from_json(v, "array<string>"))
             .when(v.startswith("{"), F.array(v)))


def order_elements(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``_doc``: the text of every order element, unparsed."""
    return lines.select(F.explode(_elements(line_col)).alias("_doc"))


def parse_order_lines(lines: DataFrame, load_date=None, line_col: str = "value", schema: T.StructType = ORDER_DOC,
                      seen: Observation | None = None) -> ParsedOrders:
    """Split landed order lines into parsed orders and quarantined records.

    ``schema`` is the stored schema the documents are read under.

    A line starting with ``[`` is split into its elements (one JSON parse to
    raw element text); a line starting with ``{`` is its own single element,
    with no extra parse.  Each element is then parsed once, inside the
    generator (field accesses on a ``from_json`` result would otherwise each
    become their own pruned parse).  Quarantined: lines that are neither,
    arrays that do not parse, and elements that are not a JSON object.

    ``seen`` receives the numbers of bad_records and of orders with bad_fields from
    the pass that reads any of the parts.
    """
    tagged = lines.select(F.col(line_col).alias("_line"), _elements(line_col).alias("_elems"))
    blank = F.trim(F.col("_line")) == ""
    # A bad line makes one element without text.
    elems = F.coalesce("_elems", F.when(~blank, F.array(F.lit(None).cast("string"))))
    rows = tagged.select(F.when(F.col("_elems").isNull(), F.col("_line")).alias("_line"), F.inline(F.transform(
        elems, lambda e: F.struct(e.alias("_doc"), F.from_json(e, schema).alias("s"),
                                  F.from_json(e, "map<string,string>").alias("m")))))
    # A field present in the document that did not convert to its type.
    bad_fields = F.array_compact(F.array(*[
        F.when(F.col("m")[c].isNotNull() & F.col("s")[c].isNull(), F.lit(c)) for c in schema.names]))
    rows = rows.withColumn("_bad_fields", bad_fields)
    bad, odd = F.col("m").isNull(), F.size("_bad_fields") > 0
    if seen is not None:
        rows = rows.observe(seen, F.count_if(bad).alias("bad_records"), F.count_if(odd).alias("bad_fields"))
    text = F.coalesce("_line", "_doc").alias("value")
    parsed = rows.where(~bad)
    known = F.array(*[F.lit(c) for c in schema.names])
    extra = F.map_filter("m", lambda k, v: ~F.array_contains(known, k))
    rescued = F.when(F.size(extra) > 0, F.to_json(extra))
    stamp = F.current_date() if load_date is None else F.lit(load_date).cast("date")
    orders = parsed.select(
        *[F.col("s")[c].alias(c) for c in schema.names],
        rescued.alias("_rescued_data"), stamp.alias("record_timestamp"),
        "_bad_fields")
    troubled = rows.where(bad | odd).select(bad.alias("_bad"), text, F.col("s")["order_id"].alias("order_id"), "_bad_fields")
    return ParsedOrders(orders, rows.where(bad).select(text), rows.where(F.col("_line").isNull()).select("_doc", "s", "m"), troubled)


def read_order_documents(spark: SparkSession, path: str, load_date=None) -> ParsedOrders:
    """Batch read of landed order documents."""
    return parse_order_lines(text_files(spark, path), load_date)


def read_records(spark: SparkSession, path: str, table: str, fmt: str = "json") -> DataFrame:
    """A day's new records for ``table`` read with its stored schema (no inference,
    so column order and types never depend on the data)."""
    return spark.read.schema(SCHEMAS[table]).format(fmt).load(path)


def read_job_runs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed job-run listings (``{"runs": [...]}`` per file, or per line without ``multi_line``) -> one row per run."""
    listing = spark.read.schema(JOB_RUNS_LISTING).option("multiLine", str(multi_line).lower()).json(path)
    return listing.select(F.inline("runs"))


def schema_drift(parsed_docs: DataFrame, doc_col: str = "_doc",
                 schema: T.StructType = ORDER_DOC) -> DataFrame:
    """Keys seen in the documents that the stored schema does not have, with counts."""
    keys = F.explode(F.map_keys(F.from_json(F.col(doc_col), "map<string,string>")))
    known = [f.name for f in schema.fields]
    return (parsed_docs.select(keys.alias("key")).where(~F.col("key").isin(known))
                       .groupBy("key").count())
