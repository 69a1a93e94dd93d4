"""Evidence of what arrived: files, expected partitions and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.schemas import TABLES

PARTITION = ("market_id", "month_start")


def calendar(bounds: DataFrame, first: str = "first_date", last: str = "last_date") -> DataFrame:
    """One row per day from the first to the last date of a one-row frame.

    Day keys count up from the first date, without numbering rows globally.
    """
    return (
        bounds.where(F.col(first) <= F.col(last))
        .select(F.col(first).alias("origin"),
                F.explode(F.sequence(F.col(first), F.col(last))).alias("calendar_date"))
        .select(
            (F.datediff("calendar_date", "origin") + 1).cast("long").alias("date_key"),
            "calendar_date",
            F.trunc("calendar_date", "MM").alias("month_start"),
            F.year("calendar_date").alias("year"),
            F.month("calendar_date").alias("month_number"),
            F.dayofmonth(F.last_day("calendar_date")).alias("days_in_month"))
    )


def calendar_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first_date"), F.lit(last).cast("date").alias("last_date"))
    return calendar(bounds)


def expected_partitions(
    dim_market: DataFrame, dim_date: DataFrame, run_id: str, entity: str
) -> DataFrame:
    """Every market and month that a complete release would contain."""
    months = dim_date.agg(F.sort_array(F.collect_set("month_start"))).scalar()
    return dim_market.select(
        F.lit(run_id).alias("run_id"), "market_id", F.explode(months).alias("month_start"),
        F.lit(entity).alias("entity"))


LANES = ("lane0", "lane1", "lane2", "lane3")


def row_fingerprint(*columns: str) -> Column:
    """The SHA-256 of one row as four 64-bit numbers that can be summed.

    Values stand behind their lengths and a null has a mark of its own, so no two rows of
    different values have one text, wherever a value begins or ends.
    """
    parts = [F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text, F.lit(";")), F.lit("N;"))
             for text in (F.col(c).cast("string") for c in columns)]
    digest = F.sha2(F.concat(*parts), 256)
    return F.struct(*[F.conv(F.substring(digest, 16 * i + 1, 16), 16, 10).cast("decimal(38,0)").alias(lane)
                      for i, lane in enumerate(LANES)])


def content_fingerprint(fingerprint: Column) -> Column:
    """Hash of a multiset of rows that depends neither on their order nor on the tasks.

    A sum in each lane rather than a XOR, so a row delivered twice changes it; sums are
    combined before the shuffle.
    """
    none = F.lit(0).cast("decimal(38,0)")
    totals = [F.coalesce(F.sum(fingerprint[lane]), none).cast("string") for lane in LANES]
    return F.sha2(F.concat_ws(",", *totals), 256)


def claim_partition_rows(raw_headers: DataFrame, raw_lines: DataFrame) -> DataFrame:
    """Every claim row with the market and month of the header it belongs to."""
    headers = raw_headers.withColumn("month_start", F.trunc("service_end_date", "MM"))
    owners = headers.select(
        "run_id", "claim_family_id", "version_number", *PARTITION).distinct()
    lines = raw_lines.join(owners, ["run_id", "claim_family_id", "version_number"])
    header_print = row_fingerprint(*[c for c in raw_headers.columns if c != "ingested_at"])
    line_print = row_fingerprint(*[c for c in raw_lines.columns if c != "ingested_at"])
    return headers.select("run_id", *PARTITION, header_print.alias("fingerprint")).unionByName(
        lines.select("run_id", *PARTITION, line_print.alias("fingerprint")))


def partition_lines(raw_lines: DataFrame, partition_headers: DataFrame) -> DataFrame:
    """Lines whose header version is among the given headers."""
    return raw_lines.join(
        partition_headers.select("claim_family_id", "version_number"),
        ["claim_family_id", "version_number"], "left_semi")


def source_files(arrived: DataFrame, rows: DataFrame, source_system: str) -> DataFrame:
    """File records for everything that arrived, empty files included.

    ``arrived`` names the files; ``rows`` holds their contents. A file with no
    rows is a complete report of a quiet month, so it is registered with zero.
    """
    contents = rows.groupBy("run_id", *PARTITION).agg(
        F.count(F.lit(1)).alias("row_count"),
        content_fingerprint(F.col("fingerprint")).alias("content_hash"))
    empty = F.sha2(F.lit(",".join("0" * len(LANES))), 256)
    return (
        arrived.join(contents, ["run_id", *PARTITION], "left")
        .withColumn("row_count", F.coalesce("row_count", F.lit(0)))
        .withColumn("content_hash", F.coalesce("content_hash", empty))
        .withColumn("source_system", F.lit(source_system))
        .select(*TABLES["source_file"].names)
    )
