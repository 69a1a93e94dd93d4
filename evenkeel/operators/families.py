"""What belongs to a claim family, told in one pass over tables that lie side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.buckets import FAMILY, Join

VERSION = [FAMILY, "version_number"]


def family_tables(raw_lines: DataFrame, raw_payments: DataFrame, headers: DataFrame,
                  finals: DataFrame, run_id: str) -> dict[str, DataFrame]:
    """The columns that family joins need of each table."""
    def landed(df: DataFrame, *columns: str) -> DataFrame:
        return df.where(F.col("run_id") == run_id).withColumnRenamed("claim_family_id", FAMILY).select(
            *VERSION, *columns)

    final_version = F.substring_index("claim_version_key", ":", -1).cast("long")
    return {
        "headers": headers.select(*VERSION, "replaces_version_key", "record_type", "status"),
        "lines": landed(raw_lines, "line_paid_amount_cents"),
        "payments": landed(raw_payments, "payment_date", "signed_amount_cents"),
        "finals": finals.select(FAMILY, final_version.alias("version_number")),
    }


def family_summary(tables: dict[str, DataFrame], join: Join) -> DataFrame:
    """One row a family: linked versions, lines of versions and of the final one, and its ledger."""
    headers, versions = tables["headers"], tables["headers"].select(*VERSION)
    replaced = headers.where("replaces_version_key is not null").select(FAMILY, F.substring_index(
        "replaces_version_key", ":", -1).cast("long").alias("version_number"))
    linked = join(replaced, versions, "inner").groupBy(FAMILY).agg(F.count(F.lit(1)).alias("linked_versions"))
    lines = join(tables["lines"], versions, "inner").groupBy(FAMILY).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("line_paid_amount_cents").alias("line_cents"))
    final = join(tables["lines"], tables["finals"], "inner").groupBy(FAMILY).agg(
        F.count(F.lit(1)).alias("final_lines"), F.sum("line_paid_amount_cents").alias("final_line_cents"))
    ledger = join(tables["payments"], versions, "inner").groupBy(FAMILY).agg(
        F.count(F.lit(1)).alias("payments"), F.sum("signed_amount_cents").alias("ledger_cents"))
    out = headers.groupBy(FAMILY).agg(F.count(F.lit(1)).alias("versions"))
    for part in (linked, lines, final, ledger):
        out = out.join(part.hint("merge"), FAMILY, "left")
    return out.fillna(0, ["linked_versions", "lines", "line_cents", "final_lines", "final_line_cents",
                          "payments", "ledger_cents"])
