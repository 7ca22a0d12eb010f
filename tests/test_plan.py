"""Helpers that decide where Spark evaluates an expression, and on how many cores."""

from pyspark.sql import functions as F

from tests.frames import plan_of
from tidewarden.functions.plan import computed_once, over_all_cores, pinned


def test_few_parts_are_dealt_to_all_cores(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(1000).repartition(2 * cores).write.parquet(f"{tmp_path}/many")
    one = over_all_cores(spark.read.parquet(f"{tmp_path}/one").filter("id > 10"))
    assert one.rdd.getNumPartitions() == cores and one.count() == 989
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        many = spark.read.parquet(f"{tmp_path}/many")
        assert over_all_cores(many) is many
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_splits_without_row_groups_are_no_parts(spark, tmp_path):
    """One row group in a file of many splits is one part; more rows than a task should take make more tasks."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(20_000).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        scan = spark.read.parquet(f"{tmp_path}/one")
        assert scan.rdd.getNumPartitions() > cores
        even = over_all_cores(scan)
        assert max(even.rdd.glom().map(len).collect()) < 2 * 20_000 / cores and even.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert over_all_cores(spark.read.parquet(f"{tmp_path}/one"), rows_per_task=100).rdd.getNumPartitions() == 200
    empty = spark.read.parquet(f"{tmp_path}/one").filter("id < 0")
    assert over_all_cores(empty).count() == 0


def test_costly_column_is_evaluated_once(spark):
    df = spark.range(3).withColumn("text", F.concat(F.lit("x"), "id"))
    twice = computed_once(df, {"digest": F.sha2("text", 256)}).filter("digest <> 'a'").select("digest", F.length("digest"))
    assert plan_of(twice).count("sha2(") == 1
    assert plan_of(df.withColumn("digest", pinned(F.sha2("text", 256))).filter("digest <> 'a'")).count("sha2(") == 1
