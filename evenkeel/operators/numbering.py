"""Row numbers, of a whole table and by group, without a single task doing the work."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.session import stage


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows numbered 1, 2, 3 ... in the given order.

    Rows are range partitioned and numbered inside each partition; the offset of
    a partition is the number of rows in the ones before it. The range
    boundaries come from sampling, so the ordered rows are written once and the
    two readings see the same rows under the same partition number.
    """
    ordered = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("row_in_part", F.monotonically_increasing_id()
                    - F.shiftleft(F.spark_partition_id().cast("long"), 33)),
        "ordered")
    # One row per partition, so the window and the broadcast are bounded by the
    # shuffle partition count.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
        .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    )
    return (
        ordered.join(F.broadcast(offsets), "part")
        .withColumn(name, F.col("offset") + F.col("row_in_part") + 1)
        .drop("part", "row_in_part", "offset")
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on all keys, with NULL equal to NULL."""
    renamed = right.withColumnsRenamed({key: f"__{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return left.join(renamed, condition, how).drop(*[f"__{key}" for key in keys])


def positions(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The values of every group as rows, with their place from 1 on.

    The rows are numbered all at once and each group counts from its first, so no
    group has to be in one place, however many rows it has.
    """
    ordered = numbered(rows.select(*keys, column), [*keys, column], "number")
    starts = ordered.groupBy(*keys).agg(F.min("number").alias("start"))
    return null_safe_join(ordered, starts, keys, "inner").select(
        *keys, (F.col("number") - F.col("start") + 1).alias("position"), column)
