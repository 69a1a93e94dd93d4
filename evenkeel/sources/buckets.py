"""Claim tables side by side: one bucket count and one key, so family joins read without an exchange.

A family's headers, lines and payments lie in files of the same bucket. Joins and sums
by family then start from the scan. A bucket cannot be split while it is read, so
families of very many rows are kept apart in tables without buckets, where joins
shuffle by the whole key and adaptive execution splits what is skewed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.session import settled, shared_folder, stage

FAMILY = "claim_family_key"
BUCKETS = 64
MOST_ROWS = 100_000  # of a family in one table, beyond which it is kept apart


@dataclass(frozen=True)
class Families:
    """Tables by name: those in buckets, and the rows of large families."""

    bucketed: dict[str, DataFrame]
    large: dict[str, DataFrame]


def _bucketed(df: DataFrame, table: str, buckets: int) -> DataFrame:
    spark, name = df.sparkSession, f"families_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}-{table}"
    # Dealt out by the same hash first, so that each bucket is one file of one task.
    df.repartition(buckets, FAMILY).write.bucketBy(buckets, FAMILY).sortBy(FAMILY).option(
        "path", path).option("compression", "zstd").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the frame keeps files and buckets; the files stay
    return stored


def write(tables: dict[str, DataFrame], buckets: int = BUCKETS, most_rows: int = MOST_ROWS) -> Families:
    """Stores tables that have a claim_family_key in buckets of equal families."""
    counted = [df.groupBy(FAMILY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_rows).select(FAMILY)
               for df in tables.values()]
    large = stage(reduce(DataFrame.union, counted).distinct(), "large-families")
    return Families(
        {t: _bucketed(df.join(large, FAMILY, "left_anti"), t, buckets) for t, df in tables.items()},
        {t: settled(df.join(large, FAMILY, "left_semi"), f"large-{t}") for t, df in tables.items()})


Join = Callable[[DataFrame, DataFrame, str], DataFrame]


def by_bucket(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of one family and version. The version is no key of the join but a condition on
    its pairs, since a join reads buckets as they are only by all of its keys."""
    facing = right.withColumnRenamed(FAMILY, "_family").withColumnRenamed("version_number", "_version")
    same = (left[FAMILY] == facing["_family"]) & (left["version_number"] - facing["_version"] == 0)
    return left.join(facing.hint("merge"), same, how).drop("_family", "_version")


def by_key(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    return left.join(right, [FAMILY, "version_number"], how)


def over_families(families: Families, build: Callable[[dict[str, DataFrame], Join], DataFrame]) -> DataFrame:
    """What ``build`` makes of the tables with the join it is given, of all families."""
    return build(families.bucketed, by_bucket).unionByName(build(families.large, by_key))
