"""Claim versions, their lines, and the one version that speaks for a family."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.numbering import numbered
from evenkeel.operators.references import join_by_name, resolve_references
from evenkeel.schemas import TABLES


def version_key(family: str = "claim_family_key", version: str = "version_number") -> Column:
    """Natural key of a claim version, ``FAMILY:VERSION``.

    Unique, stable between runs and free to compute, where numbering all versions
    in one global order would pull them through a single task.
    """
    return F.concat(F.col(family), F.lit(":"), F.col(version).cast("string"))


def claim_header_versions(
    raw_headers: DataFrame,
    dim_member: DataFrame,
    dim_market: DataFrame,
    dim_plan: DataFrame,
    run_id: str,
) -> DataFrame:
    """Every submitted version, superseded and voided ones included."""
    landed = (
        raw_headers.where(F.col("run_id") == run_id)
        .drop("ingested_at", "run_id")
        .withColumnRenamed("claim_family_id", "claim_family_key")
    )
    headers = resolve_references(landed, dim_member, dim_market, dim_plan).withColumn(
        "claim_version_key", version_key())
    return link_replaced_versions(headers).withColumn("run_id", F.lit(run_id)).select(
        *TABLES["claim_header_version"].names)


def link_replaced_versions(headers: DataFrame) -> DataFrame:
    """Turn a stated ``FAMILY:VERSION`` into a key, only where that version exists.

    The headers are those of one run, whose name no row has to carry. Rows that replace nothing are most of the table. They look up their own key and
    ignore the answer, so they spread over all partitions instead of meeting in the
    one that holds NULL.
    """
    stated = F.col("replaces_version_id")
    colon = F.instr(stated, ":")
    number = F.substring(stated, colon + 1, F.length(stated)).try_cast("long")
    reference = F.when(
        colon > 0,
        F.concat(F.substring_index(stated, ":", 1), F.lit(":"), number.cast("string")))
    probe = F.coalesce(reference, F.col("claim_version_key"))
    known = headers.select(F.col("claim_version_key").alias("probe")).distinct().withColumn("is_known", F.lit(True))
    return (
        headers.withColumn("reference", reference)
        .withColumn("probe", probe)
        .join(known, "probe", "left")
        .withColumn("replaces_version_key", F.when(F.col("is_known"), F.col("reference")))
        .drop("reference", "probe", "is_known", "replaces_version_id")
    )


def numbered_versions(headers: DataFrame) -> DataFrame:
    """Dense integer keys in (family, version) order."""
    return numbered(headers, ["claim_family_key", "version_number"], "claim_version_number")


def effective_on(date: str, start: str = "effective_start", end: str = "effective_end") -> Column:
    """Both endpoints inclusive; an open end never expires."""
    return (F.col(start) <= F.col(date)) & (F.col(end).isNull() | (F.col(end) >= F.col(date)))


def header_lines(raw_lines: DataFrame, headers: DataFrame, run_id: str) -> DataFrame:
    """Landed lines of the run beside the header version they belong to.

    Both sides are of the run before they meet, so its name is put back after the join
    instead of being shuffled and sorted with every row.
    """
    of_run = F.col("run_id") == run_id
    lines = raw_lines.where(of_run).drop("run_id").withColumnRenamed(
        "claim_family_id", "claim_family_key")
    owners = headers.where(of_run).select(
        "claim_family_key", "version_number", "claim_version_key",
        "claim_file_type", "service_end_date")
    return lines.join(owners, ["claim_family_key", "version_number"]).withColumn(
        "run_id", F.lit(run_id))


def claim_line_versions(
    raw_lines: DataFrame,
    headers: DataFrame,
    service_category_map: DataFrame,
    dim_provider: DataFrame,
    run_id: str,
    mapping_version: str,
) -> DataFrame:
    """Lines with the category that was in force on the claim's last service day."""
    mapping = service_category_map.where(F.col("mapping_version") == mapping_version).select(
        "claim_file_type", "service_code", "category_key", "effective_start", "effective_end")
    lines = header_lines(raw_lines, headers, run_id)
    mapped = lines.join(mapping, ["claim_file_type", "service_code"]).where(
        effective_on("service_end_date"))
    providers = dim_provider.select("provider_id", "provider_key")
    return join_by_name(mapped, providers, "provider_id", "left").select(
        *TABLES["claim_line_version"].names)


def run_cutoff(pipeline_run: DataFrame, run_id: str) -> DataFrame:
    """The one row that carries the run's cutoff."""
    return F.broadcast(
        pipeline_run.where(F.col("run_id") == run_id).select("run_id", "as_of_cutoff"))


def through_cutoff(headers: DataFrame, pipeline_run: DataFrame, run_id: str) -> DataFrame:
    """Versions adjudicated by the cutoff; later ones have not happened yet."""
    return (
        headers.join(run_cutoff(pipeline_run, run_id), "run_id")
        .where(F.col("adjudicated_at") <= F.col("as_of_cutoff"))
        .drop("as_of_cutoff")
    )


_FINAL_HEADER = (
    "claim_version_key", "member_key", "market_key", "plan_key", "record_type",
    "claim_file_type", "status", "service_end_date", "header_paid_amount_cents")


def latest_versions(headers: DataFrame) -> DataFrame:
    """The highest version of each family.

    ``max`` of a struct keeps one candidate per family and task, so a family with
    very many versions is reduced before it is shuffled.
    """
    return (
        headers.groupBy("claim_family_key", "run_id")
        .agg(F.max(F.struct("version_number", *_FINAL_HEADER)).alias("latest"))
        .select("run_id", "claim_family_key", "latest.*")
    )


def population_match() -> Column:
    """How a claim relates to exposure. The order of the tests decides."""
    delivery = F.when(F.col("record_type") == "FFS", "FFS").otherwise("MANAGED_CARE")
    return (
        F.when(F.col("mm_market_key").isNull(), "NO_EXPOSURE")
        .when(
            (F.col("mm_market_key") != F.col("market_key"))
            | (F.col("mm_plan_key") != F.col("plan_key")), "CONFLICTING_EXPOSURE")
        .when(F.col("in_primary_cohort") == 0, "OUT_OF_COHORT")
        .when(F.col("delivery_system") != delivery, "CONFLICTING_EXPOSURE")
        .otherwise("MATCHED")
    )


def claim_finals(
    headers: DataFrame, member_months: DataFrame, pipeline_run: DataFrame, run_id: str
) -> DataFrame:
    """One accepted version per family, matched to exposure.

    The chain is resolved before denied and void outcomes are dropped; the other
    way round would leave the paid version of a voided family standing.
    """
    resolved = (
        latest_versions(through_cutoff(headers, pipeline_run, run_id))
        .where(F.col("status") == "ACCEPTED")
        .withColumn("service_month", F.trunc("service_end_date", "MM"))
    )
    exposure = member_months.select(
        "run_id", "member_key", F.col("month_start").alias("service_month"),
        F.col("market_key").alias("mm_market_key"), F.col("plan_key").alias("mm_plan_key"),
        "delivery_system", "in_primary_cohort")
    return (
        resolved.join(exposure, ["member_key", "service_month", "run_id"], "left")
        .withColumn("population_match", population_match())
        .select(*TABLES["fact_claim_header_final"].names)
    )


def claim_line_finals(finals: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of the chosen versions only."""
    chosen = finals.select("run_id", "claim_version_key", "claim_family_key")
    return lines.join(chosen, ["claim_version_key", "run_id"]).select(
        *TABLES["fact_claim_line_final"].names)
