"""Reading and writing tables with explicit schemas, partitioned by run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.schemas import TABLES


def scan(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """A Parquet table with its declared schema; a run filter prunes partitions."""
    df = spark.read.schema(TABLES[table]).parquet(f"{root}/{table}")
    return df if run_id is None else df.where(F.col("run_id") == run_id)


def scan_all(
    spark: SparkSession, root: str, tables: list[str], run_id: str | None = None
) -> dict[str, DataFrame]:
    return {
        table: scan(spark, root, table, run_id if "run_id" in TABLES[table].names else None)
        for table in tables
    }


def conform(df: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns and types; a missing column is an error."""
    schema = TABLES[table]
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def write(df: DataFrame, root: str, table: str) -> None:
    """Replace the runs that are in the frame and leave the others alone."""
    out = conform(df, table).write.mode("overwrite").option("compression", "zstd")
    if "run_id" in TABLES[table].names:
        out = out.option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
    out.parquet(f"{root}/{table}")


def literal_rows(spark: SparkSession, table: str, rows: list[tuple]) -> DataFrame:
    """Rows written in code, checked against the width of their table."""
    width = len(TABLES[table])
    for row in rows:
        if len(row) != width:
            raise ValueError(f"{table} has {width} columns, row has {len(row)}: {row!r}")
    return spark.createDataFrame(rows, TABLES[table])


COMPLETED = ("FAILED", "READY_FOR_REVIEW", "CERTIFIED")


class RunConflict(ValueError):
    """A stored run was produced from another configuration."""


def stored_status(runs: DataFrame, run_id: str, config_hash: str) -> str:
    """Status of a stored run; one of another configuration is refused."""
    found = runs.where(F.col("run_id") == run_id).select("config_hash", "status").first()
    if found is None:
        raise ValueError(f"unknown run {run_id}")
    if found["config_hash"] != config_hash:
        raise RunConflict(f"{run_id} belongs to another configuration")
    return found["status"]


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, as one frame."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def register_views(frames: dict[str, DataFrame]) -> None:
    """Expose frames to SQL; registering again replaces the earlier definition."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
