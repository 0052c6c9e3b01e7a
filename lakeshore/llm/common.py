"""Helpers shared by the text operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshore.session import ensure_checkpoint_dir

#: ASCII white space; everything else belongs to words.
SPACE = r"\x20\x09-\x0D"
WORD = re.compile(rf"[^{SPACE}]+")
#: Entries a per-worker cache may hold before it is emptied.
CACHE_ENTRIES = 300_000
#: Rows and bytes of an Arrow batch of texts where these are compared or read as sets.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
#: Parts in which a class is ranked before it is ranked whole.
SAMPLE_PARTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    Every call takes a folder of its own.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, nbytes: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs run inside send texts to Python in batches of at most ``rows`` rows and about ``nbytes`` bytes.

    A batch is held several times over, by the JVM outside its heap and by the worker.
    """
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": nbytes}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        # A smaller bound that is set stays.
        spark.conf.set(k, str(min(v, int(before[k])) if (before[k] or "").isdigit() and int(before[k]) else v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last one the worker, which Spark keeps for further tasks, returns Arrow's free memory."""
    yield from batches
    pa.default_memory_pool().release_unused()


def id_remainder(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % F.lit(modulus)


def one_label_per_doc(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label): NULLs ignored, the larger of conflicting labels wins."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))


def sample_per_class(rows: DataFrame, per_class: int, max_classes: int | None = None, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """At most ``per_class`` rows of each ``label``, the first by a hash of ``keys``.

    The bound of a training sample.  Where ``max_classes`` is given, only the labels with
    most rows (ties: by label) are taken.  Each rank is cut before its shuffle (Spark
    plans a group limit).  A class is first cut in SAMPLE_PARTS parts, so the
    task that ranks it whole reads at most SAMPLE_PARTS * per_class rows,
    however many rows and input partitions hold the class.
    """
    if max_classes is not None:
        # At most max_classes rows.
        taken = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(max_classes).select("label")
        rows = rows.join(F.broadcast(taken), "label", "left_semi")
    order = [F.xxhash64(*keys), *map(F.col, keys)]
    part = F.pmod(F.hash(*keys), F.lit(SAMPLE_PARTS))
    for by in (["label", part], ["label"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        rows = rows.withColumn("_r", rank).where(F.col("_r") <= per_class).drop("_r")
    return rows


def texts_of(docs: DataFrame, chosen: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, text, label) of the chosen rows: at most ``per_class`` of each label, however often an id repeats.

    ``chosen`` is a bounded sample; its columns but ``label`` are the key, and
    ``docs`` has them.
    """
    keys = [c for c in chosen.columns if c != "label"]
    rows = docs.select(*keys, "text").join(F.broadcast(chosen.distinct()), keys).withColumn("_text", F.xxhash64("text"))
    return sample_per_class(rows, per_class, keys=(*keys, "_text")).select("doc_id", "text", "label")


def text_list(column) -> list[str]:
    """An Arrow column as Python strings, NULL as empty text."""
    return [t or "" for t in column.to_pylist()]


def some_texts(column, rows: int = 500) -> Iterator[list[str]]:
    """The same, some rows at a time."""
    for at in range(0, len(column), rows):
        yield text_list(column.slice(at, rows))


def unused(names: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


class Cache(dict):
    """Computes a missing value; emptied when it holds ``entries``."""

    def __init__(self, make, entries: int = CACHE_ENTRIES) -> None:
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        value = self[key] = self.make(key)
        return value
