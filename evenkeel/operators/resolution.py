"""Which filing speaks for an arrangement.

Lineage is inferred from names and never guessed: an unknown review type or two
filings of the same rank leave the arrangement unresolved and its amount NULL. A
newer filing without an amount does not fall back to an older one with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.identifiers import version_rank
from evenkeel.operators.numbering import positions

RESOLUTION_VERSION = "0.6.0"
KEY = ["state_code", "payment_type_normalised", "provider_class", "rating_period_start",
       "rating_period_end", "identifier_suffix"]
MONEY = ("amount_usd", "amount_cents", "federal_share_cents", "amount_source")


def _keyed(archive: DataFrame) -> DataFrame:
    """A missing suffix is no suffix; other missing key parts group together."""
    return archive.withColumn("identifier_suffix", F.coalesce("identifier_suffix", F.lit("")))


def resolve(archive: DataFrame) -> DataFrame:
    """One row per arrangement, with what is known about its lineage and amount.

    Filings are reduced by arrangement and rank first, so an arrangement with very
    many filings never meets in one place. Their number is here and their names are
    the rows of ``candidates``.
    """
    rows = _keyed(archive)
    rest = [c for c in rows.columns if c not in [*KEY, "sdp_identifier"]]
    by_rank = (
        rows.withColumn("rank", version_rank(F.col("review_type")))
        .groupBy(*KEY, "rank")
        .agg(F.count(F.lit(1)).alias("n"),
             F.min(F.struct("sdp_identifier", *rest)).alias("first"))
    )
    groups = by_rank.groupBy(*KEY).agg(
        F.sum("n").alias("filings"),
        F.count_if(F.col("rank").isNull()).alias("unranked"),
        F.max(F.struct("rank", "n", "first")).alias("top"),
        F.min("first").alias("lowest"))
    ambiguous = (F.col("unranked") > 0) | (F.col("top.n") != 1)
    picked = (
        groups.withColumn("ambiguous", ambiguous)
        .withColumn("row", F.when(F.col("ambiguous"), F.col("lowest")).otherwise(
            F.col("top.first")))
    )
    usable = ~F.col("ambiguous") & F.coalesce("amount_is_publishable", F.lit(False))
    resolved = (
        picked.select(*KEY, "filings", "ambiguous", "row.*")
        .withColumn("usable", usable)
        .withColumn("lineage_status", F.when(F.col("ambiguous"), "AMBIGUOUS")
                    .when(F.col("filings") == 1, "SINGLE_FILING")
                    .otherwise("INFERRED_FROM_IDENTIFIER"))
        .withColumn("amount_status", F.when(F.col("usable"), "KNOWN")
                    .when(F.col("ambiguous"), "UNRESOLVED_LINEAGE")
                    .otherwise("MISSING_LATEST_AMOUNT"))
        .withColumn("amount_is_publishable", F.col("usable"))
        .withColumn("resolution_version", F.lit(RESOLUTION_VERSION))
    )
    for column in MONEY:
        if column in resolved.columns:
            resolved = resolved.withColumn(column, F.when(F.col("usable"), F.col(column)))
    return resolved.withColumn("candidate_count", F.col("filings")).select(
        *archive.columns, "lineage_status", "candidate_count", "resolution_version",
        "amount_status")


def candidates(archive: DataFrame) -> DataFrame:
    """The filings of every arrangement, numbered in the order of their names."""
    return positions(_keyed(archive), KEY, "sdp_identifier")
