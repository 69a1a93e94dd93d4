import time

import pytest
from pyspark.sql import functions as F

from evenkeel.session import scratch, settled, stage


def test_scratch_removes_what_was_staged_within(spark):
    with scratch(spark):
        outer = stage(spark.range(3), "outer")
        with scratch(spark):
            inner = stage(spark.range(5), "inner")
            kept = settled(inner.selectExpr("id * 2 AS id"), "kept")
        assert outer.count() == 3 and kept.count() == 5
        with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
            inner.inputFiles() and spark.read.parquet(*inner.inputFiles()).count()
        last = settled(kept, "last")
    assert sorted(r["id"] for r in last.collect()) == [0, 2, 4, 6, 8]
    assert stage(spark.range(2), "plain").count() == 2


def test_scratch_removes_after_a_failure(spark):
    with pytest.raises(ValueError):
        with scratch(spark):
            left = stage(spark.range(3), "left")
            files = left.inputFiles()
            raise ValueError
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(*files).count()


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    before = _shuffle_files(spark)
    held = stage(spark.range(10_000).repartition(2, "id"), "dealt")
    deadline = time.monotonic() + 20
    while _shuffle_files(spark) - before and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before and held.count() == 10_000


def test_a_frame_is_read_twice_after_its_shuffle_files_are_gone(spark):
    counts = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count().join(
        spark.range(7).withColumnRenamed("id", "k"), "k")
    first = sorted(counts.collect())
    time.sleep(1)
    assert sorted(counts.collect()) == first and counts.count() == 7
