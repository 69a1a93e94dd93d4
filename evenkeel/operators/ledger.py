"""Signed ledgers: payments by claim version, capitation by member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.references import resolve_references
from evenkeel.schemas import TABLES


def payment_ledger(raw_payments: DataFrame, headers: DataFrame, run_id: str) -> DataFrame:
    """Payments attached to the version they paid, current or not.

    Attaching them to the final version would hide the history that explains a
    reversal. The load order of the rows carries no meaning here. Both sides are of the
    run before they meet, so its name is put back after the join.
    """
    of_run = F.col("run_id") == run_id
    landed = raw_payments.where(of_run).drop("run_id").withColumnRenamed(
        "claim_family_id", "claim_family_key")
    versions = headers.where(of_run).select(
        "claim_family_key", "version_number", "claim_version_key")
    return landed.join(versions, ["claim_family_key", "version_number"]).withColumn(
        "run_id", F.lit(run_id)).select(*TABLES["fact_payment_transaction"].names)


def capitation_ledger(
    raw_capitation: DataFrame,
    dim_member: DataFrame,
    dim_market: DataFrame,
    dim_plan: DataFrame,
    run_id: str,
) -> DataFrame:
    landed = raw_capitation.where(F.col("run_id") == run_id)
    return resolve_references(landed, dim_member, dim_market, dim_plan).select(
        *TABLES["fact_capitation_transaction"].names)


def ledger_balances(payments: DataFrame, cutoff: DataFrame) -> DataFrame:
    """Per family: signed balance through the cutoff and the rows it rests on."""
    paid = F.col("payment_date") <= F.col("as_of_cutoff")
    return (
        payments.join(cutoff, "run_id")
        .groupBy("claim_family_key", "run_id")
        .agg(
            F.sum(F.when(paid, F.col("signed_amount_cents"))).alias("ledger_cents"),
            F.count_if(paid).alias("rows_through_cutoff"),
        )
        .select("run_id", "claim_family_key", "ledger_cents", "rows_through_cutoff")
    )
