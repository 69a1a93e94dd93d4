"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that every job relies on. They are session level, so applying
# them to a session somebody else created is safe and repeatable.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join that feeds an aggregation on the same key is only split for skew
    # when the extra shuffle it costs is allowed.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle files go with the job that wrote them. Otherwise they stay until the driver
    # happens to collect its garbage, and the disk holds those of all jobs before.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Replace only the run partitions that a write touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "evenkeel", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks, which name its shared folder."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors can reach: ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a folder shared by the executors")
    return folder


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt out by key to as many tasks as a shuffle has.

    For work that costs far more than its rows weigh, which a few scan tasks, or tasks
    that were merged by size, would otherwise do.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Used where several consumers read one expensive result, or where a result
    must not change between two readings. The table outlives lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


_SCRATCH: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged within, for a block that writes its result elsewhere.

    A frame over such a table must not be read after the block.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for a result that is to outlive the ``scratch`` block around it."""
    held = _SCRATCH.pop() if _SCRATCH else None
    try:
        return stage(df, name)
    finally:
        if held is not None:
            _SCRATCH.append(held)
