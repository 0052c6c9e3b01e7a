"""Spark session helpers.

The library never creates a session inside a transform; these helpers are for
entry points (bench, tests, command line).  Settings follow the rules of the
design: UTC session zone, AQE with partition coalescing and skew-join
splitting, no UI server.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Partial-result JSON parsing: one bad field NULLs only that field.
    "spark.sql.json.enablePartialResults": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "lakeshore",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is respected as is.
    Only when it is unset (tests, local runs) a scratch folder is taken.
    """
    cdir = spark.conf.get("spark.checkpoint.dir", None)
    if not cdir:
        cdir = spark.sparkContext.getCheckpointDir()
    if not cdir:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        cdir = tempfile.mkdtemp(prefix="lakeshore-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cdir)
    spark.sparkContext.setCheckpointDir(cdir)
    return cdir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, name)


def tune_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 128 << 20,
                   min_partitions: int | None = None) -> int:
    """Size shuffles for an input of ``input_bytes``.

    Starts with enough shuffle partitions that each holds about
    ``target_partition_bytes`` of input (so a partition fits an executor's
    memory without spilling at 100 TB), never fewer than twice the cores; AQE
    then coalesces small partitions and splits skewed ones at run time.
    Returns the partition count set.
    """
    cores = spark.sparkContext.defaultParallelism
    floor = min_partitions if min_partitions is not None else 2 * cores
    n = max(floor, -(-input_bytes // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_partition_bytes, 64 << 20)))
    return n


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under a path (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def partitions_for(spark: SparkSession, nbytes: int, partition_bytes: int) -> int:
    """Shuffle partitions for ``nbytes``: as many as set, and more where one would hold over ``partition_bytes``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nbytes // partition_bytes))
