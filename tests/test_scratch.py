import time
from pathlib import Path

from pyspark.sql import functions as F

from glotta import scratch


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirsString() for f in Path(d).rglob("shuffle_*")}


def test_shuffle_files_go_with_the_table(spark):
    before = shuffle_files(spark)
    setting = spark.conf.get(scratch.CLEANUP, None)
    table = scratch.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    for _ in range(50):  # they are removed beside the write
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(scratch.CLEANUP, None) == setting
    assert sorted(r["count"] for r in table.collect()) == [142] * 1 + [143] * 6
