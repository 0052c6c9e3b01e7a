"""Folder-partitioned tables with a bounded number of files per folder.

A plain ``partitionBy`` write makes a file per folder and task: a rare country
gets a small file from every task, and after a shuffle by country one task
writes all of a hot one.  Here the batch's own row counts decide: a value with
many rows is dealt to as many tasks as it fills files, rare values share a task
and get one file each.  A write of many small files would be all tasks that way:
its tasks write up to ``FILES_PER_TASK`` files each, of exactly as many rows as asked.

Defined cases: rows whose value is NULL go to the folder Spark keeps for NULL;
equal rows meet in one task, which still splits its files at the bound; a batch
without rows writes no files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Window
from pyspark.sql import functions as F

from lakeshore.operators.dedupe import tie_break_columns

#: Rows of a target file, and how far a file may exceed that before it is split.
ROWS_PER_FILE = 2_000_000
SLACK = 1.5
#: Folder values up to which their table of slots is broadcast; with more of them the rows are joined by a shuffle.
BROADCAST_VALUES = 100_000
#: Files that have a task each; of a write with more of them a task writes several, up to as many files and rows.
OWN_TASKS = 200
FILES_PER_TASK, ROWS_PER_TASK = 128, ROWS_PER_FILE


def file_slots(df: DataFrame, by: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """(``by``..., n_rows, n_files, slot): the files of each value and its first slot.

    A value of at least ``rows_per_file`` rows owns its slots; smaller ones share
    slots of about as many rows.  The windows run over one row per folder.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    hot = F.col("n_rows") >= rows_per_file
    files = F.when(hot, F.ceil(F.col("n_rows") / rows_per_file)).otherwise(F.lit(1)).cast("long")
    before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(hot, F.col("n_files")).otherwise(F.lit(0))
    small = F.when(hot, F.lit(0)).otherwise(F.col("n_rows"))
    shared = F.sum(own).over(Window.partitionBy()) + F.floor(F.coalesce(F.sum(small).over(before), F.lit(0)) / rows_per_file)
    first = F.when(hot, F.coalesce(F.sum(own).over(before), F.lit(0))).otherwise(shared)
    return counts.withColumn("n_files", files).withColumn("slot", first.cast("long"))


def write_bounded(df: DataFrame, path: str, by: Sequence[str], rows_per_file: int = ROWS_PER_FILE, mode: str = "append") -> None:
    """Write ``df`` as Parquet partitioned by ``by``: a value of n rows gets ceil(n / rows_per_file) files.

    The mode ``overwrite`` replaces all of ``path``, folders without new rows included.
    ``df`` is read twice, once for the counts and once for the rows (three times where
    a task writes several files): pass a written or persisted one where it is costly.
    One shuffle, by slot (two where a task writes several files); a row's slot comes
    from a hash of its columns, so a recomputed task deals its rows as before.
    """
    slots = file_slots(df, by, rows_per_file).persist()
    files_per_task = max(1, min(FILES_PER_TASK, ROWS_PER_TASK // rows_per_file))
    writer = lambda rows: rows.select(*[F.col(f"`{c}`") for c in df.columns]).write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*by)
    try:
        top = slots.agg(F.count(F.lit(1)).alias("n"), F.max(F.col("slot") + F.col("n_files")).alias("slots"),
                        F.sum("n_files").alias("files")).first()
        if not top["n"]:
            writer(df).parquet(path)
            return
        if files_per_task > 1 and top["files"] > OWN_TASKS:
            _write_numbered(df, slots, path, by, rows_per_file, files_per_task, writer)
            return
        dealt = _with_slots(df, slots, by, top["n"], ["n_files", "slot"])
        slot = F.col("_slot_slot") + F.pmod(_row_hash(df), F.col("_slot_n_files"))
        rows = dealt.withColumn("_slot", slot.cast("int")).repartitionById(int(top["slots"]), F.col("_slot"))
        writer(rows).option("maxRecordsPerFile", str(int(SLACK * rows_per_file))).parquet(path)
    finally:
        slots.unpersist()


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])


def _with_slots(df: DataFrame, table: DataFrame, keys: Sequence[str], n: int, columns: Sequence[str]) -> DataFrame:
    """``df`` with the ``columns`` (as ``_slot_<name>``) of the row of ``table``, which has ``n``, with the same ``keys``."""
    named = table.select(*[F.col(f"`{c}`").alias(f"_slot_of_{c}") for c in keys], *[F.col(c).alias(f"_slot_{c}") for c in columns])
    same = [df[f"`{c}`"].eqNullSafe(named[f"`_slot_of_{c}`"]) for c in keys]
    joined = df.join(F.broadcast(named) if n <= BROADCAST_VALUES else named, same)
    return joined.drop(*[named[f"`_slot_of_{c}`"] for c in keys])


def _write_numbered(df: DataFrame, slots: DataFrame, path: str, by: Sequence[str], rows_per_file: int, files_per_task: int,
                    writer: Callable[[DataFrame], DataFrameWriter]) -> None:
    """Write files of exactly ``rows_per_file`` rows, the last one of a value aside, many of them in a task.

    A value's rows are dealt by their hash to bins of about a task's rows, and
    numbered there.  A bin that is not its value's only one keeps a multiple of
    ``rows_per_file`` rows; the few it has over are numbered on across the value's
    bins and dealt by whole files to tasks of their own.  So no task but a value's
    last ends a file early.  The order of the numbers is total but for equal rows,
    so both sides, and a recomputed task, number the rows alike.
    """
    task_rows = rows_per_file * files_per_task
    n_bins = F.ceil(F.col("n_files") / files_per_task).alias("bins")
    values = slots.select(*[F.col(f"`{c}`") for c in by], n_bins)
    binned = _with_slots(df, values, by, values.count(), ["bins"]).withColumn("_slot_hash", _row_hash(df))
    binned = binned.withColumn("_slot_bin", F.pmod("_slot_hash", "_slot_bins").cast("long"))
    key = [*by, "_slot_bin"]
    names = [F.col(f"`{c}`") for c in key]
    of_value = Window.partitionBy(*names[:-1])
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    over = F.when(F.col("_slot_bins") > 1, F.col("_n") % rows_per_file).otherwise(F.lit(0))
    # The rows over of a value begin a file of their own: its last bin fills up the file before.
    last = F.lead("_n").over(of_value.orderBy("_slot_bin")).isNull()
    filled = F.col("_over") + F.when(last, F.pmod(-F.sum("_over").over(of_value), F.lit(rows_per_file))).otherwise(F.lit(0))
    counted = (binned.groupBy(*names, "_slot_bins").agg(F.count(F.lit(1)).alias("_n")).withColumn("_over", over).withColumn("_filled", filled)
                     .withColumn("_task", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / task_rows).cast("int"))
                     .withColumn("_start", F.coalesce(F.sum("_filled").over(before), F.lit(0)))).persist()
    try:
        top = counted.agg(F.count(F.lit(1)).alias("n"), F.max("_task").alias("task"), F.sum("_filled").alias("filled")).first()
        rows = _with_slots(binned, counted, key, top["n"], ["_task", "_over", "_start"])
        maps = [f.name for f in df.schema if "map<" in f.dataType.simpleString()]
        order = ["_slot_hash", *[F.col(f"`{c}`") for c in tie_break_columns(df, by, [])], *[F.to_json(F.struct(f"`{c}`")) for c in maps]]
        number = F.row_number().over(Window.partitionBy("_slot__task", *names).orderBy(*order))
        numbered = rows.repartitionById(top["task"] + 1, F.col("_slot__task")).withColumn("_slot_number", number)
        out = numbered.where("_slot_number > _slot__over")
        if top["filled"]:
            place = F.floor((F.col("_slot__start") + F.col("_slot_number") - 1) / task_rows).cast("int")
            few = numbered.where(f"_slot_number <= _slot__over AND _slot_number < {rows_per_file}").withColumn("_slot_place", place)
            few = few.repartitionById(-(-top["filled"] // task_rows), F.col("_slot_place"))
            out = out.unionByName(few.drop("_slot_place"))
        writer(out).option("maxRecordsPerFile", str(rows_per_file)).parquet(path)
    finally:
        counted.unpersist()
