"""What ``written`` leaves on disk, and tables made by it."""

from pyspark.sql import functions as F

from tickfold.llm.common import written

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def test_shuffle_files_go_when_the_rows_are_written(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    stored = written(df, "counts")  # the plan and its shuffles are still held here
    assert shuffle_files(spark) <= before
    assert spark.conf.get(CLEANUP, None) == setting
    assert sorted(stored.collect()) == sorted(df.collect())
