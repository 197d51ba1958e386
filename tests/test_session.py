"""Runtime settings: tasks of bounded size, whatever the session brings along."""

from pyspark.sql import functions as F

from salesloom.operators.joins import key_violations
from salesloom.session import TASK_SIZES, settings, tune


def test_tasks_get_no_larger_and_smaller_ones_stay(spark):
    scan, shuffle = TASK_SIZES
    with settings(spark, {scan: "128m", shuffle: str(64 << 20)}):
        tune(spark)
        assert (spark.conf.get(scan), spark.conf.get(shuffle)) == ("32m", "16m")
    with settings(spark, {scan: "1MB", shuffle: "8m"}):
        tune(spark)
        assert (spark.conf.get(scan), spark.conf.get(shuffle)) == ("1MB", "8m")


def test_keys_of_a_large_table_are_counted_in_more_tasks(spark, tmp_path):
    # 128 MB in eight files: a task reads 32 MB at most, where the session would read all in one.
    rows = spark.range(0, 8 << 20, 1, 8).select(F.col("id").alias("k"), F.xxhash64("id").alias("v"))
    rows.write.option("compression", "none").parquet(str(tmp_path / "t"))
    sizes = {"spark.sql.files.maxPartitionBytes": "1g", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    with settings(spark, sizes):
        tune(spark)
        read = spark.read.parquet(str(tmp_path / "t"))
        assert read.rdd.getNumPartitions() >= 4
        assert key_violations(read, ["k"], "t").count() == 0
