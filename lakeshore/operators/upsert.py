"""Keyed upsert (MERGE ... WHEN MATCHED UPDATE * / DELETE WHEN NOT MATCHED INSERT *).

``upsert`` is the pure DataFrame form: the new table contents.  ``merge_into``
keeps a Parquet table of appended batch folders, ``read_table`` puts the newest
row of each key together (now, or as of an earlier version or time), and
``write_snapshot`` writes that out now and then.  Each of them leaves a commit
record, which ``commit_history`` lists.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.operators.changes import CHANGE_TYPE, DELETE, INSERT, UPDATE_POST, UPDATE_PRE, table_changes
from lakeshore.operators.dedupe import dedupe_latest, tie_break_columns
from lakeshore.operators.places import FILE, ROW, at_places, bitmaps, but_places, placed

#: Folder names: a running number, and below it a batch or a snapshot.
SEQ, BATCH, SNAPSHOT = "_seq", "_batch", "_snapshot"
#: Batches merged before the table is written out as a snapshot.
SNAPSHOT_AFTER = 64
#: Where a batch with repeated keys waits until its latest rows are written.
REPEATS = "_repeats"
#: Repeated keys up to which their rows are picked out by a broadcast; with more, all rows are shuffled.
BROADCAST_KEYS = 1_000_000
#: Marks the rows of a batch that delete their key.
DELETED = "_deleted"
#: Commit records: one row per version (the running number of its folder).
COMMITS = "_commits"
COMMIT_COLUMNS = ("batch string, operation string, committed_at timestamp, num_source_rows long, num_inserted long, "
                  "num_updated long, num_deleted long, new_columns array<string>")
MERGED, SNAPSHOTTED = "MERGE", "SNAPSHOT"


def key_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order_by: Sequence[str | Column] = ("updated_dt",), dedupe: bool = True,
           null_keys: str = "quarantine", how: str = "anti") -> DataFrame:
    """Rows of ``target`` whose key is not in ``source``, plus ``source`` (latest per key).

    Equivalent to MERGE with update-all / insert-all.  The anti join shuffles
    once on the keys (or broadcasts a small source, AQE decides from its size).
    ``null_keys``: ``"quarantine"`` drops source rows with a NULL key part (see
    ``null_key_rows``), ``"insert"`` inserts them as MERGE would (they never
    match, so a replay inserts them again).

    ``how``: ``"anti"`` (target anti-join source keys, union source) suits a
    small source and a large target: the source broadcasts and the target is
    not shuffled, but the source plan is evaluated twice (persist or stage an
    expensive one).  ``"full"`` is one full outer join where source values win:
    each side is read once, and when both sides are already hash-partitioned
    by the keys (keep-latest windows are) the join adds no exchange.
    """
    keys = list(keys)
    src = source.select(*target.columns)
    if null_keys == "quarantine":
        src = src.where(key_not_null(keys))
    elif null_keys != "insert":
        raise ValueError("null_keys must be 'quarantine' or 'insert'")
    if dedupe:
        latest = dedupe_latest(src.where(key_not_null(keys)), keys, order_by)
        src = latest.unionByName(src.where(~key_not_null(keys))) if null_keys == "insert" else latest
    if how == "full":
        return _upsert_full(target, src, keys)
    if how != "anti":
        raise ValueError("how must be 'anti' or 'full'")
    kept = target.join(src.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(src)


def _upsert_full(target: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    cols = target.columns
    values = [c for c in cols if c not in keys]
    s = src.select(*keys, *[F.col(c).alias(f"_src_{c}") for c in values], F.lit(True).alias("_src_hit"))
    j = target.join(s, keys, "full_outer")
    hit = F.col("_src_hit").isNotNull()
    return j.select(*[F.col(c) if c in keys else F.when(hit, F.col(f"_src_{c}")).otherwise(F.col(c)).alias(c)
                      for c in cols])


def null_key_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows an upsert sends to quarantine."""
    return source.where(~key_not_null(keys))


def merge_into(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
               batch_id: int | str, order_by: Sequence[str | Column] = ("updated_dt",),
               null_keys: str = "quarantine", changes_path: str | None = None,
               snapshot_after: int = SNAPSHOT_AFTER, delete_when: Column | None = None,
               new_columns: str = "fail", count_changes: bool = True, committed_at=None, one_per_key: bool = False) -> DataFrame:
    """Upsert ``source`` into the table at ``path``; returns the rows applied.

    The batch, NULL keys handled and kept latest per key, is appended as one
    folder ``path/_seq=<n>/_batch=<id>``.  Nothing that a reader may use is
    replaced or deleted: a folder counts once its ``_SUCCESS`` marker is there,
    so a merge that died leaves the table as it was.  ``read_table`` puts the
    newest row of each key together.

    Whole rows are shuffled only where keys repeat: the batch is written as it
    comes, the keys alone are counted, and if some repeat, their rows are put in
    order and the folder is written anew, before it is marked complete.
    ``one_per_key`` says that the source has no repeated keys (NULL ones aside).

    A batch id that is merged again gets a new folder, which replaces the
    earlier one when it is complete, so a replay is exact (rows with a NULL key
    under ``null_keys="insert"`` included, unless a snapshot has been written
    since).

    ``delete_when``: rows for which it holds delete their key (a tombstone in
    the batch; a later batch may insert the key again).  The rows returned then
    have a ``_deleted`` column.

    ``new_columns``: what happens to source columns the table lacks: ``"fail"``,
    ``"drop"``, or ``"add"`` (they are appended to the table's columns, rows
    written before read NULL, and a later source without them is filled up).  A
    column of another type than the table's always fails.

    With ``changes_path`` the batch's row-level change feed (see
    ``changes.table_changes``) is written to ``changes_path/version=<batch id>``:
    the batch against the table without it, at the batch's own keys.  A replay
    keeps a feed that was completed.  Pre-images and deleted rows are written
    before the rows that take their place (``_write_changes``).

    The version's commit record has the rows in the batch and, with
    ``count_changes`` (a join of the batch's keys with the table's), how many
    keys were new, there before, and deleted.  ``committed_at`` stands for the
    present time in it.

    After ``snapshot_after`` batches the table is written out as a snapshot
    (``write_snapshot``).  Merges into one table run one at a time.
    """
    keys = list(keys)
    src = source
    if null_keys == "quarantine":
        src = src.where(key_not_null(keys))
    elif null_keys != "insert":
        raise ValueError("null_keys must be 'quarantine' or 'insert'")
    tie_break = tie_break_columns(src, keys, order_by)

    def latest(df: DataFrame) -> DataFrame:
        kept = dedupe_latest(df.where(key_not_null(keys)), keys, order_by, tie_break)
        return kept.unionByName(df.where(~key_not_null(keys))) if null_keys == "insert" else kept

    name = f"{BATCH}={quote(str(batch_id), safe='')}"
    there = [f for f in _live(spark, path) if f[1] != name]
    table = _columns(spark, path, there) if there else None
    added: list[str] = []
    gone = [F.coalesce(delete_when, F.lit(False)).alias(DELETED)] if delete_when is not None else []
    if table is not None:
        _record_missing(spark, path)
        columns, added = _fitted(src, table, new_columns)
    else:
        columns = [F.col(c) for c in src.columns if not (gone and c == DELETED)]
    fit = lambda df: df.select(*columns, *gone)
    seq = _next_seq(spark, path)
    folder = os.path.join(path, f"{SEQ}={seq}", name)
    if one_per_key:
        applied = fit(src)
        _write(applied, folder)
    elif set(src.columns) <= set(fit(src).columns) and not (gone and DELETED in src.columns):
        applied = fit(src)
        _write_latest(spark, path, seq, name, applied, keys, latest)
    else:
        # The order of the rows may need columns that the table does not take in.
        applied = fit(latest(src))
        _write(applied, folder)
    written = spark.read.schema(applied.schema).parquet(folder)
    kept = written.where(~F.col(DELETED)).drop(DELETED) if delete_when is not None else written

    feed = os.path.join(changes_path, f"version={batch_id}") if changes_path else None
    if feed and not _is_complete(spark, feed):
        if table is None:
            _write(kept.withColumn(CHANGE_TYPE, F.lit(INSERT)), feed, mode="overwrite")
        else:
            old = _contents(spark, path, there, keys, look=True, places=True)
            old = old.select("*", *[F.lit(None).cast(kept.schema[c].dataType).alias(c) for c in added])
            _write_changes(old, placed(written), keys, feed)
    counts = (None, None, None)
    if count_changes:
        counts = _counts(_contents(spark, path, there, keys), written, keys, delete_when is not None)
    _record(spark, path, seq, name, MERGED, committed_at, written.count(), counts, added)
    if len(_live(spark, path)) > snapshot_after:
        write_snapshot(spark, path, keys, committed_at=committed_at)
    return written


def _write(df: DataFrame, folder: str, mode: str = "error", complete: bool = True) -> None:
    """Write one folder of a merged table, without its marker if not ``complete``."""
    marker = str(complete).lower()
    df.write.mode(mode).option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", marker).parquet(folder)


def _write_latest(spark: SparkSession, path: str, seq: int, name: str, rows: DataFrame, keys: list[str],
                  latest: Callable[[DataFrame], DataFrame]) -> None:
    """Write ``rows`` as the folder ``name`` of number ``seq``, those of repeated keys as ``latest`` keeps them."""
    folder = os.path.join(path, f"{SEQ}={seq}", name)
    _write(rows, folder, complete=False)
    repeated = _repeated_keys(spark.read.schema(rows.schema).parquet(folder), keys).persist()
    try:
        n = repeated.count()
        fs, at = _file(spark, folder)
        if not n:
            fs.create(_file(spark, os.path.join(folder, "_SUCCESS"))[1]).close()
            return
        waiting = os.path.join(path, f"{REPEATS}={seq}")
        if not fs.rename(at, _file(spark, waiting)[1]):
            raise OSError(f"{folder} could not be set aside")
        written = spark.read.schema(rows.schema).parquet(waiting)
        if n <= BROADCAST_KEYS:
            few = F.broadcast(repeated)
            kept = written.join(few, keys, "left_anti").unionByName(latest(written.join(few, keys, "left_semi")))
        else:
            kept = latest(written)
        _write(kept.select(*rows.columns), folder)
        fs.delete(_file(spark, waiting)[1], True)
    finally:
        repeated.unpersist()


def _write_changes(old: DataFrame, new: DataFrame, keys: list[str], feed: str) -> None:
    """Write the change feed of a batch: placed rows ``new`` (with DELETED or without) over the placed table ``old``.

    The keys alone are joined, with a hash of the other columns (those without
    maps) and the places of the rows; whole rows are shuffled only where the
    hashes of old and new are equal, to compare them.  The rows that go are written before those that
    come, so that a reader of the files in their order never sees a row go that
    came in the same version.
    """
    columns = [c for c in old.columns if c not in (FILE, ROW)]
    values = [c for c in columns if c not in keys]
    gone = F.col(DELETED) if DELETED in new.columns else F.lit(False)
    # Maps can't be hashed, and NULLs leave no trace in a hash: unequal ones show a change, equal ones nothing.
    digest = F.xxhash64(F.lit(0), *[F.col(c) for c in values if "map<" not in old.schema[c].dataType.simpleString()])
    narrow = lambda df, side, *more: df.select(*keys, digest.alias(f"_hash{side}"), F.struct(FILE, ROW).alias(f"_at{side}"), *more)
    j = narrow(new, "_n", gone.alias("_gone")).join(narrow(old, "_o"), keys, "left")
    there = F.col("_at_o").isNotNull()
    one = lambda side, kind: F.struct(F.lit(kind).alias(CHANGE_TYPE), F.col(f"_at{side}.{FILE}").alias(FILE), F.col(f"_at{side}.{ROW}").alias(ROW))
    kinds = (F.when(there & F.col("_gone"), F.array(one("_o", DELETE)))
              .when(F.col("_gone"), F.array().cast(f"array<struct<{CHANGE_TYPE}:string,{FILE}:bigint,{ROW}:bigint>>"))
              .when(~there, F.array(one("_n", INSERT)))
              .when(F.col("_hash_o") != F.col("_hash_n"), F.array(one("_o", UPDATE_PRE), one("_n", UPDATE_POST)))
              .otherwise(F.array(one("_o", ""), one("_n", ""))))
    bits = bitmaps(j.select(F.explode(kinds).alias("_k")).select("_k.*"), (CHANGE_TYPE,)).persist()
    try:
        n = {r[0]: r[1] for r in bits.groupBy(CHANGE_TYPE).count().collect()}
        picked = lambda df, kind: at_places(df, bits.where(F.col(CHANGE_TYPE) == kind).drop(CHANGE_TYPE), n.get(kind, 0)).select(*columns)
        go = [picked(old, kind).withColumn(CHANGE_TYPE, F.lit(kind)) for kind in (DELETE, UPDATE_PRE) if kind in n]
        come = [picked(new, kind).withColumn(CHANGE_TYPE, F.lit(kind)) for kind in (INSERT, UPDATE_POST) if kind in n]
        if "" in n:
            both = table_changes(picked(old, ""), picked(new, ""), keys).select(*columns, CHANGE_TYPE)
            going = F.col(CHANGE_TYPE) == UPDATE_PRE
            go, come = [*go, both.where(going)], [*come, both.where(~going)]
        none = new.limit(0).select(*columns, F.lit(INSERT).alias(CHANGE_TYPE))
        _write(_union(go or [none]), feed, mode="overwrite", complete=not come)
        if come:
            _write(_union(come), feed, mode="append")
    finally:
        bits.unpersist()


def _union(parts: list[DataFrame]) -> DataFrame:
    out, *more = parts
    for p in more:
        out = out.unionByName(p)
    return out


def _repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys, NULL ones aside, of more than one row."""
    return rows.where(key_not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)


def _fitted(source: DataFrame, table: T.StructType, new_columns: str) -> tuple[list[Column], list[str]]:
    """(the source's columns in the table's order, names of columns the table gets)."""
    if new_columns not in ("fail", "drop", "add"):
        raise ValueError("new_columns must be 'fail', 'drop' or 'add'")
    extra = [c for c in source.columns if c not in table.names]
    missing = [c for c in table.names if c not in source.columns]
    if (extra and new_columns == "fail") or (missing and new_columns != "add"):
        raise ValueError(f"source and table differ: columns only in the source {extra}, only in the table {missing}")
    other = [f.name for f in table.fields if f.name in source.columns and not _same_type(source.schema[f.name].dataType, f.dataType)]
    if other:
        raise ValueError(f"columns of another type than the table's: {other}")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) if f.name in missing else F.col(f.name) for f in table.fields]
    added = extra if new_columns == "add" else []
    return columns + [F.col(c) for c in added], added


def _same_type(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def _counts(before: DataFrame | None, written: DataFrame, keys: list[str], deletes: bool) -> tuple[int, int, int]:
    """Keys of the batch that are (new, there before, deleted); rows without a key are new."""
    gone = F.col(DELETED) if deletes else F.lit(False)
    rows = written.select(*keys, gone.alias("_gone"))
    if before is None:
        rows = rows.withColumn("_hit", F.lit(None).cast("boolean"))
    else:
        # Only the batch's own keys leave the table's side.
        found = before.select(*keys).join(rows.select(*keys), keys, "left_semi").distinct().withColumn("_hit", F.lit(True))
        rows = rows.join(found, keys, "left")
    hit = F.col("_hit").isNotNull()
    r = rows.agg(F.count_if(~hit & ~F.col("_gone")), F.count_if(hit & ~F.col("_gone")), F.count_if(hit & F.col("_gone"))).first()
    return tuple(r)


def write_snapshot(spark: SparkSession, path: str, keys: Sequence[str], keep: int = 2, committed_at=None) -> None:
    """Write the table's contents as one folder, which stands for all folders before it once complete.

    Folders older than the last ``keep`` snapshots are deleted, so a reader
    that listed the table before the call still finds its files (``keep`` of 2
    at least), and versions before the oldest kept snapshot can't be read any more.
    """
    live = _live(spark, path)
    contents = _contents(spark, path, live, list(keys), look=True)
    if contents is None:
        return
    older = [seq for seq, name in _complete(spark, path) if name.startswith(SNAPSHOT)]
    seq = _next_seq(spark, path)
    name = f"{SNAPSHOT}={seq}"
    _write(contents, os.path.join(path, f"{SEQ}={seq}", name))
    _record(spark, path, seq, name, SNAPSHOTTED, committed_at, None, (0, 0, 0), [])
    if len(older) >= max(1, keep - 1):
        fs, root = _file(spark, path)
        for n in _sequence_numbers(spark, path):
            if n < older[-max(1, keep - 1)]:
                fs.delete(_file(spark, os.path.join(path, f"{SEQ}={n}"))[1], True)


def read_table(spark: SparkSession, path: str, keys: Sequence[str], version: int | None = None, as_of=None) -> DataFrame:
    """Contents of a table written by ``merge_into``: now, as of a version, or as of a time.

    The keys alone are looked through first.  Where none is in several batches,
    the rows are read as they are; else those that a later batch replaces are
    left out by their places in the files (``operators.places``).
    A version is the number that ``commit_history`` lists; ``as_of`` (a
    timestamp or its text) takes the last version committed by then.
    """
    if as_of is not None:
        if version is not None:
            raise ValueError("give a version or a time, not both")
        by_then = commit_history(spark, path).where(F.col("committed_at") <= F.lit(as_of).cast("timestamp"))
        version = by_then.agg(F.max("version")).first()[0]
        if version is None:
            raise ValueError(f"no version of {path} as of {as_of}")
    if version is not None and _complete(spark, path):
        oldest, newest = min(_sequence_numbers(spark, path)), max(seq for seq, _ in _complete(spark, path))
        if not oldest <= version <= newest:
            raise ValueError(f"version {version} of {path} can't be read: {oldest} to {newest} are kept")
    contents = _contents(spark, path, _live(spark, path, version), list(keys), look=True)
    if contents is None:
        raise FileNotFoundError(f"no merged table at {path}")
    return contents


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether a merge into ``path`` has finished."""
    return bool(_complete(spark, path))


def commit_history(spark: SparkSession, path: str) -> DataFrame:
    """The commit records of a merged table: ``version`` and COMMIT_COLUMNS, those of deleted folders included."""
    return spark.read.schema(f"{COMMIT_COLUMNS}, version long").json(_commits_path(path))


def read_changes(spark: SparkSession, changes_path: str) -> DataFrame:
    """The change feed of all merged batches, with a ``version`` column (the batch id)."""
    return spark.read.parquet(changes_path)


def _commits_path(path: str) -> str:
    folder, name = os.path.split(path.rstrip("/"))
    return os.path.join(folder, COMMITS, name)


def _record(spark: SparkSession, path: str, seq: int, name: str, operation: str, committed_at,
            rows: int | None, counts: tuple, added: list[str]) -> None:
    at = F.current_timestamp() if committed_at is None else F.lit(committed_at).cast("timestamp")
    row = spark.range(1, numPartitions=1).select(
        F.lit(name.split("=", 1)[1]).alias("batch"), F.lit(operation).alias("operation"), at.alias("committed_at"),
        *[F.lit(v).cast("long").alias(c) for c, v in zip(("num_source_rows", "num_inserted", "num_updated", "num_deleted"), (rows, *counts))],
        F.array(*map(F.lit, added)).cast("array<string>").alias("new_columns"))
    row.write.mode("overwrite").json(os.path.join(_commits_path(path), f"version={seq}"))


def _record_missing(spark: SparkSession, path: str) -> None:
    """Records, without counts, for folders whose writer died before it wrote theirs."""
    fs, pattern = _file(spark, os.path.join(_commits_path(path), "version=*", "_SUCCESS"))
    there = {int(st.getPath().getParent().getName().split("=")[1]) for st in fs.globStatus(pattern) or []}
    for seq, name in _complete(spark, path):
        if seq not in there:
            fs, marker = _file(spark, os.path.join(path, f"{SEQ}={seq}", name, "_SUCCESS"))
            at = F.timestamp_millis(F.lit(fs.getFileStatus(marker).getModificationTime()))
            _record(spark, path, seq, name, SNAPSHOTTED if name.startswith(SNAPSHOT) else MERGED, at, None, (None, None, None), [])


def _contents(spark: SparkSession, path: str, folders: list[tuple[int, str]], keys: list[str], look: bool = False,
              places: bool = False) -> DataFrame | None:
    """The folders' rows put together.

    ``look``: the keys are looked through first, and the rows that a later folder
    replaces are left out by their places, so no whole row is shuffled.
    ``places`` (with ``look``) keeps the columns of the rows' places.
    """
    if not folders:
        return None
    first, *later = [os.path.join(path, f"{SEQ}={seq}", name) for seq, name in folders]
    schema = T.StructType([*_columns(spark, path, folders).fields, T.StructField(DELETED, T.BooleanType())])
    base = spark.read.schema(schema).parquet(first)
    if look:
        base = placed(base)
    if later:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*later)
        if look:
            every = base.unionByName(placed(rows).select(*base.columns))
            bits = _replaced(base, placed(rows), keys).persist()
            n = bits.count()
            base = but_places(every, bits, n) if n else every
        else:
            base = _over(base, rows, keys, len(later))
    out = base.where(~F.coalesce(DELETED, F.lit(False))).drop(DELETED)
    return out if places or not look else out.drop(FILE, ROW)


def _columns(spark: SparkSession, path: str, folders: list[tuple[int, str]]) -> T.StructType:
    """The columns of the folders' table: they are only ever added, so the newest folder has all of them."""
    seq, name = folders[-1]
    fields = spark.read.parquet(os.path.join(path, f"{SEQ}={seq}", name)).schema.fields
    return T.StructType([f for f in fields if f.name != DELETED])


def _replaced(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of the places of rows whose key is in a later folder; a folder has a key once, and NULL keys stay."""
    narrow = [*keys, SEQ, FILE, ROW]
    every = base.withColumn(SEQ, F.lit(-1).cast(rows.schema[SEQ].dataType)).select(*narrow).unionByName(rows.select(*narrow))
    newest = F.max(SEQ).over(Window.partitionBy(*keys))
    return bitmaps(every.where(key_not_null(keys)).withColumn("_newest", newest).where(F.col(SEQ) < F.col("_newest")))


def _over(base: DataFrame, rows: DataFrame, keys: list[str], folders: int) -> DataFrame:
    """``base`` with the newest of the later ``rows``; a single folder has a key once."""
    if folders > 1:
        newest = dedupe_latest(rows.where(key_not_null(keys)), keys, [SEQ], tie_break=[])
        rows = newest.unionByName(rows.where(~key_not_null(keys)))
    return upsert(base, rows, keys, dedupe=False, null_keys="insert")


def _live(spark: SparkSession, path: str, version: int | None = None) -> list[tuple[int, str]]:
    """(number, name) of the folders that make up the table (as of a version), oldest first."""
    complete = [(seq, name) for seq, name in _complete(spark, path) if version is None or seq <= version]
    start = max((seq for seq, name in complete if name.startswith(SNAPSHOT)), default=-1)
    newest = {name: seq for seq, name in complete if seq >= start}
    return sorted((seq, name) for name, seq in newest.items())


def _complete(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    fs, marker = _file(spark, os.path.join(path, f"{SEQ}=*", "*", "_SUCCESS"))
    found = [st.getPath().getParent() for st in fs.globStatus(marker) or []]
    return sorted((int(f.getParent().getName().split("=")[1]), f.getName()) for f in found)


def _sequence_numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folders = _file(spark, os.path.join(path, f"{SEQ}=*"))
    return sorted(int(st.getPath().getName().split("=")[1]) for st in fs.globStatus(folders) or [])


def _next_seq(spark: SparkSession, path: str) -> int:
    """Past every folder, unfinished ones included."""
    return max(_sequence_numbers(spark, path), default=0) + 1


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _is_complete(spark: SparkSession, path: str) -> bool:
    fs, marker = _file(spark, os.path.join(path, "_SUCCESS"))
    return bool(fs.exists(marker))
