"""Where landed rows and dollars went, and wider marts of the same facts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators.claims import run_cutoff
from evenkeel.operators.exposure import first_landed
from evenkeel.operators.kpis import matched
from evenkeel.operators.quality import mapped_codes, reference_gaps
from evenkeel.sources.commits import CommitLog

MART = ["run_id", "month_start", "market_key", "plan_key", "delivery_system", "eligibility_group"]


def claim_bridge(
    raw_headers: DataFrame, headers: DataFrame, finals: DataFrame, pipeline_run: DataFrame,
    run_id: str,
) -> DataFrame:
    """Landed fee-for-service cents by market and by the one reason they do or do not count.

    Every landed version falls under exactly one reason, so the reasons add up to
    the landed total.
    """
    version = ["claim_family_id", "version_number"]
    landed = raw_headers.where((F.col("run_id") == run_id) & (F.col("record_type") == "FFS"))
    known = headers.select(
        F.col("claim_family_key").alias("claim_family_id"), "version_number",
        F.lit(True).alias("is_curated"))
    cutoff = run_cutoff(pipeline_run, run_id)
    latest = (
        headers.join(cutoff, "run_id")
        .where(F.col("adjudicated_at") <= F.col("as_of_cutoff"))
        .groupBy(F.col("claim_family_key").alias("claim_family_id"))
        .agg(F.max("version_number").alias("latest_version"))
    )
    outcome = finals.select(
        F.col("claim_family_key").alias("claim_family_id"), "population_match")
    reason = (
        F.when(F.col("is_curated").isNull(), "UNRESOLVED_REFERENCE")
        .when(F.col("adjudicated_at") > F.col("as_of_cutoff"), "AFTER_CUTOFF")
        .when(F.col("version_number") < F.col("latest_version"), "SUPERSEDED")
        .when(F.col("status") != "ACCEPTED", "DENIED_OR_VOID")
        .otherwise(F.col("population_match"))
    )
    return (
        landed.join(cutoff, "run_id")
        .join(known, version, "left")
        .join(latest, "claim_family_id", "left")
        .join(outcome, "claim_family_id", "left")
        .groupBy("run_id", "market_id", reason.alias("reason"))
        .agg(F.count(F.lit(1)).alias("versions"),
             F.coalesce(F.sum("header_paid_amount_cents"), F.lit(0)).alias("cents"))
    )


def drop_report(
    inputs: dict[str, DataFrame], headers: DataFrame, lines: DataFrame, run_id: str,
    mapping_version: str, write: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Landed rows that reach no curated table, by table and reason, with their cents.

    With ``write`` the few counts of a table are stored before the next one's rows are
    looked for, so the disk holds what one of them shuffles.
    """
    dims = inputs["dim_member"], inputs["dim_market"], inputs["dim_plan"]

    def landed(table: str) -> DataFrame:
        return inputs[table].where(F.col("run_id") == run_id)

    def report(rows: DataFrame, table: str, reason: Column, cents: str | None) -> DataFrame:
        amount = F.lit(None).cast("long") if cents is None else F.sum(cents)
        counts = rows.groupBy(reason.alias("reason")).agg(
            F.count(F.lit(1)).alias("rows"), amount.alias("cents")
        ).select(F.lit(table).alias("table_name"), "reason", "rows", "cents")
        return counts if write is None else write(counts, "drops")

    def gaps(rows: DataFrame) -> tuple[DataFrame, Column]:
        found = reference_gaps(rows, *dims).where(
            F.col("no_member") | F.col("no_market") | F.col("no_plan"))
        return found, F.when(F.col("no_member"), "unknown member").when(
            F.col("no_market"), "unknown market").otherwise("unknown plan")

    row = ["run_id", "source_file_id", "source_row_id"]
    kept = first_landed(inputs["raw_eligibility_span"], run_id, "eligibility_span_id")
    repeated = landed("raw_eligibility_span").join(kept.select(*row), row, "left_anti")
    version = ["run_id", "claim_family_key", "version_number"]
    versions = headers.select(*version, "claim_file_type", "claim_version_key")
    raw_lines = landed("raw_claim_line").withColumnRenamed("claim_family_id", "claim_family_key")
    raw_payments = landed("raw_payment_transaction").withColumnRenamed(
        "claim_family_id", "claim_family_key")
    # Lines meet the versions once, whether they find one or not.
    owned = raw_lines.join(versions, version, "left")
    codes = mapped_codes(inputs["service_category_map"], mapping_version).withColumn(
        "is_mapped", F.lit(True))
    placed = lines.select("run_id", "claim_version_key", "line_number", "service_code")
    dropped = owned.join(
        placed, ["run_id", "claim_version_key", "line_number", "service_code"], "left_anti"
    ).join(codes, ["claim_file_type", "service_code"], "left")
    spans, span_reason = gaps(kept)
    claims, claim_reason = gaps(landed("raw_claim_header"))
    paid, paid_reason = gaps(landed("raw_capitation_transaction"))
    return reduce(DataFrame.unionByName, [
        report(repeated, "raw_eligibility_span", F.lit("span key landed before"), None),
        report(spans, "raw_eligibility_span", span_reason, None),
        report(claims, "raw_claim_header", claim_reason, "header_paid_amount_cents"),
        report(dropped, "raw_claim_line",
               F.when(F.col("claim_version_key").isNull(), "no header version")
               .when(F.col("is_mapped"), "code not in force on the service date")
               .otherwise("code not mapped"), "line_paid_amount_cents"),
        report(raw_payments.join(versions, version, "left_anti"), "raw_payment_transaction",
               F.lit("no header version"), "signed_amount_cents"),
        report(paid, "raw_capitation_transaction", paid_reason, "signed_amount_cents"),
    ])


def quality_failure_rate(quarantine: DataFrame, raw_tables: list[DataFrame]) -> DataFrame:
    """Distinct failing landed rows in percent of all landed rows; NULL without input.

    A row that several rules name counts once.
    """
    total = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n")) for df in raw_tables])
    failing = quarantine.select("source_file_id", "source_row_id").distinct().agg(
        F.count(F.lit(1)).alias("failing_rows"))
    rows = F.col("raw_rows")
    return failing.withColumn("raw_rows", total.agg(F.sum("n")).scalar()).withColumn(
        "failure_rate_pct",
        F.when(rows > 0, F.col("failing_rows").cast("double") * 100.0 / rows))


def _claims_in_cohort(finals: DataFrame, member_months: DataFrame, record_type: str) -> DataFrame:
    groups = member_months.select(
        "run_id", "member_key", "month_start", "delivery_system", "eligibility_group")
    return matched(finals, record_type).join(groups, ["run_id", "member_key", "month_start"])


def finance_mart(
    member_months: DataFrame, finals: DataFrame, final_lines: DataFrame, capitation: DataFrame
) -> DataFrame:
    """Raw components by month, market, plan, delivery system and eligibility group.

    Primary cohort only. Each fact reaches the grain alone, exposure drives.
    """
    cohort = member_months.where(F.col("in_primary_cohort") == 1)
    exposed = cohort.groupBy(*MART).agg(F.sum("member_month_weight").alias("member_months"))
    cents = final_lines.groupBy("run_id", "claim_family_key").agg(
        F.sum("line_paid_amount_cents").alias("cents"))
    spend = (
        _claims_in_cohort(finals, member_months, "FFS")
        .join(cents, ["run_id", "claim_family_key"], "left")
        .groupBy(*MART).agg(F.sum("cents").alias("ffs_paid_cents"),
                            F.count("claim_family_key").alias("ffs_claim_count"))
    )
    encounters = _claims_in_cohort(finals, member_months, "ENCOUNTER").groupBy(*MART).agg(
        F.count("claim_family_key").alias("encounter_count"))
    held = cohort.select("member_key", *MART)
    paid = (
        capitation.groupBy("run_id", "member_key", "market_key", "plan_key",
                           F.col("coverage_month").alias("month_start"))
        .agg(F.sum("signed_amount_cents").alias("cents"))
        .join(held, ["run_id", "member_key", "month_start", "market_key", "plan_key"])
        .groupBy(*MART).agg(F.sum("cents").alias("capitation_cents"))
    )
    measures = ("ffs_paid_cents", "ffs_claim_count", "encounter_count", "capitation_cents")
    out = exposed.join(spend, MART, "left").join(encounters, MART, "left").join(paid, MART, "left")
    return out.select(*MART, "member_months", *[
        F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])


def category_mart(
    member_months: DataFrame, finals: DataFrame, final_lines: DataFrame
) -> DataFrame:
    """Category cents and claims at the same grain; the claim counts do not add up."""
    cents = final_lines.groupBy("run_id", "claim_family_key", "category_key").agg(
        F.sum("line_paid_amount_cents").alias("cents"))
    return (
        _claims_in_cohort(finals, member_months, "FFS")
        .join(cents, ["run_id", "claim_family_key"])
        .groupBy(*MART, "category_key")
        .agg(F.sum("cents").alias("category_paid_cents"),
             F.count("claim_family_key").alias("claims_containing_category"))
    )


class ReleaseExists(ValueError):
    """A release identifier stands for one manifest only."""


# The fields of a release.
RELEASE = ("release_id", "run_id", "definition_version", "mapping_version", "rule_versions",
           "expected_partitions", "passed_partitions", "cutoff", "provisional_months", "approver",
           "approved_at", "status")


def write_release(log: CommitLog, release: dict) -> dict:
    """Adds one release to the manifest; a known release is never replaced.

    Each release is a file that its writer alone created, so of two that write the same
    release at once one is refused.
    """
    if set(release) != set(RELEASE):
        raise ValueError(f"a release has the fields {', '.join(RELEASE)}")

    def decide(entries: list[dict]) -> dict:
        if any(e["release_id"] == release["release_id"] for e in entries):
            raise ReleaseExists(release["release_id"])
        return release

    return log.append(decide)


def release_manifest(spark: SparkSession, log: CommitLog) -> DataFrame:
    """Every release in the order of the log, the first with number 1."""
    schema = ("release_number long, release_id string, run_id string, definition_version string, "
              "mapping_version string, rule_versions array<string>, expected_partitions long, "
              "passed_partitions long, cutoff date, provisional_months array<date>, approver string, "
              "approved_at timestamp, status string")
    return spark.createDataFrame([
        (n, *[_typed(f, e[f]) for f in RELEASE]) for n, e in enumerate(log.entries(), 1)], schema)


def _typed(field: str, value):
    if field == "cutoff":
        return date.fromisoformat(value)
    if field == "provisional_months":
        return [date.fromisoformat(v) for v in value]
    return datetime.fromisoformat(value) if field == "approved_at" else value
