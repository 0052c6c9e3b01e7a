from lakeshore.session import ensure_checkpoint_dir, path_bytes, tune_for_input


def test_checkpoint_dir_is_read_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured


def test_shuffle_partitions_sized_from_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = tune_for_input(spark, 100 * (128 << 20))
        assert n == 100 and spark.conf.get("spark.sql.shuffle.partitions") == "100"
        assert tune_for_input(spark, 10) == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert path_bytes(spark, "/root/testdata/sf0.001/nation.parquet") > 0
    assert path_bytes(spark, "/nonexistent/path") == 0
