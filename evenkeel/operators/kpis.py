"""KPI components and the measures built from them.

Each component reaches its own grain before anything is joined, ratios are taken
from summed components, and a ratio without a denominator is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKET_MONTH = ("run_id", "month_start", "market_key")


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``numerator * scale / denominator`` in double, NULL without a denominator."""
    return F.when(denominator > 0, numerator.cast("double") * F.lit(scale) / denominator)


def distinct_values(df: DataFrame, column: str) -> Column:
    """The distinct values of a dimension column as one array, NULL left out."""
    return df.agg(F.sort_array(F.collect_set(column))).scalar()


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def partition_status(
    dim_market: DataFrame, dim_date: DataFrame, pipeline_run: DataFrame, dq_result: DataFrame
) -> DataFrame:
    """Whether a market and month may be published.

    Every market of every given run has a row for every calendar month, whether or not
    anything happened in it. Give only runs whose rule results are given: without them
    nothing would speak against a run. A run-level failure outranks a failure of one partition.
    """
    failing = dq_result.where(
        (F.col("severity") == "BLOCKING") & (F.col("disposition") == "FAIL"))
    runs_failing = failing.where(F.col("market_id") == "ALL").select(
        "run_id", F.lit(True).alias("run_failed")).distinct()
    parts_failing = failing.where(F.col("market_id") != "ALL").select(
        "run_id", "market_id", F.col("month_start").try_cast("date").alias("month_start"),
        F.lit(True).alias("part_failed")).distinct()
    scaffold = (
        dim_market.select("market_key", "market_id")
        .withColumn("month_start", F.explode(distinct_values(dim_date, "month_start")))
        .withColumn("run_id", F.explode(distinct_values(pipeline_run, "run_id")))
    )
    return (
        scaffold.join(runs_failing, "run_id", "left")
        .join(parts_failing, ["run_id", "market_id", "month_start"], "left")
        .select(
            *MARKET_MONTH,
            F.when(F.col("run_failed"), "UNAVAILABLE_RUN")
            .when(F.col("part_failed"), "UNAVAILABLE_PARTITION")
            .otherwise("AVAILABLE").alias("partition_status"))
    )


def primary_exposure(member_months: DataFrame) -> DataFrame:
    return member_months.where(F.col("in_primary_cohort") == 1).select(
        "run_id", "member_key", "month_start", "market_key", "plan_key", "delivery_system",
        "eligibility_group", "member_month_weight", "eligible_days")


def exposure_month(member_months: DataFrame) -> DataFrame:
    """Member months and members by month, market and delivery system.

    The fact holds a member once per month, so counting rows counts members.
    """
    return primary_exposure(member_months).groupBy(
        *MARKET_MONTH, "delivery_system"
    ).agg(F.sum("member_month_weight").alias("member_months"),
          F.count("member_key").alias("distinct_members"))


def matched(finals: DataFrame, record_type: str) -> DataFrame:
    return finals.where(
        (F.col("record_type") == record_type) & (F.col("population_match") == "MATCHED")
    ).withColumnRenamed("service_month", "month_start")


def _family_lines(finals: DataFrame, final_lines: DataFrame) -> DataFrame:
    """Cents by family and category, summed before the join to the claim.

    After this a claim with very many lines is a handful of rows.
    """
    lines = final_lines.groupBy("claim_family_key", "run_id", "category_key").agg(
        F.sum("line_paid_amount_cents").alias("cents"))
    claims = matched(finals, "FFS").select(*MARKET_MONTH, "claim_family_key")
    return claims.join(lines, ["claim_family_key", "run_id"])


def ffs_spend_month(finals: DataFrame, final_lines: DataFrame) -> DataFrame:
    return _family_lines(finals, final_lines).groupBy(*MARKET_MONTH).agg(
        F.sum("cents").alias("paid_cents"))


def ffs_claims_month(finals: DataFrame) -> DataFrame:
    """Claims, not lines. The fact holds a family once, so rows are families."""
    return matched(finals, "FFS").groupBy(*MARKET_MONTH).agg(
        F.count("claim_family_key").alias("claim_count"))


def ffs_category_month(finals: DataFrame, final_lines: DataFrame) -> DataFrame:
    """Cents and claims by category; a claim counts once under each of its categories."""
    return _family_lines(finals, final_lines).groupBy(*MARKET_MONTH, "category_key").agg(
        F.sum("cents").alias("category_paid_cents"),
        F.count("claim_family_key").alias("claims_containing_category"))


def encounter_month(finals: DataFrame) -> DataFrame:
    """Encounters carry no money column, so none can be added to spend."""
    return matched(finals, "ENCOUNTER").groupBy(*MARKET_MONTH).agg(
        F.count("claim_family_key").alias("encounter_count"))


def capitation_month(capitation: DataFrame) -> DataFrame:
    return capitation.groupBy(
        "run_id", F.col("coverage_month").alias("month_start"), "market_key"
    ).agg(F.sum("signed_amount_cents").alias("capitation_cents"))


def kpi_ffs_month(
    exposure: DataFrame, spend: DataFrame, claims: DataFrame, status: DataFrame
) -> DataFrame:
    """Fee-for-service spend, PMPM, claims, rate and average cost, with status."""
    paid, count, months = _zero("paid_cents"), _zero("claim_count"), F.col("member_months")
    return (
        exposure.where(F.col("delivery_system") == "FFS")
        .join(spend, list(MARKET_MONTH), "left")
        .join(claims, list(MARKET_MONTH), "left")
        .join(status, list(MARKET_MONTH))
        .select(
            *MARKET_MONTH, "partition_status", "member_months", "distinct_members",
            paid.alias("ffs_paid_cents"),
            ratio(paid, months).alias("ffs_pmpm_cents"),
            count.alias("ffs_claim_count"),
            ratio(count, months, 1000.0).alias("ffs_claims_per_1000_mm"),
            ratio(paid, count).alias("ffs_avg_claim_cost_cents"))
    )


def kpi_managed_care_month(
    exposure: DataFrame, encounters: DataFrame, capitation: DataFrame, status: DataFrame
) -> DataFrame:
    """Encounters and capitation beside managed-care exposure.

    Capitation is counted for every member, exposure for the primary cohort.
    """
    count, paid = _zero("encounter_count"), _zero("capitation_cents")
    months = F.col("member_months")
    return (
        exposure.where(F.col("delivery_system") == "MANAGED_CARE")
        .join(encounters, list(MARKET_MONTH), "left")
        .join(capitation, list(MARKET_MONTH), "left")
        .join(status, list(MARKET_MONTH))
        .select(
            *MARKET_MONTH, "partition_status", "member_months", "distinct_members",
            count.alias("encounter_count"),
            ratio(count, months, 1000.0).alias("encounters_per_1000_mm"),
            paid.alias("capitation_cents"),
            ratio(paid, months).alias("capitation_pmpm_cents"))
    )


def kpi_period_membership(exposure: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Average membership over the calendar; NULL when a month is missing."""
    expected = dim_date.agg(F.count_distinct("month_start")).scalar()
    present, months = F.col("months_present"), F.col("total_member_months")
    return (
        exposure.groupBy("run_id", "market_key", "delivery_system")
        .agg(F.sum("member_months").alias("total_member_months"),
             F.count_distinct("month_start").alias("months_present"))
        .withColumn("months_expected", expected)
        .withColumn(
            "average_monthly_membership",
            F.when(present >= F.col("months_expected"), ratio(months, present)))
    )


def kpi_ffs_category_month(
    categories: DataFrame, dim_service_category: DataFrame, ffs_month: DataFrame
) -> DataFrame:
    """Share of spend and contribution to PMPM over the full market denominator."""
    names = dim_service_category.select("category_key", "category_code")
    totals = ffs_month.select(
        *MARKET_MONTH, "partition_status", "member_months",
        F.col("ffs_paid_cents").alias("market_month_paid_cents"))
    cents = F.col("category_paid_cents")
    return (
        categories.join(names, "category_key")
        .join(totals, list(MARKET_MONTH))
        .select(
            *MARKET_MONTH, "category_key", "category_code", "partition_status",
            "category_paid_cents", "market_month_paid_cents",
            ratio(cents, F.col("market_month_paid_cents"), 100.0).alias("ffs_spend_share_pct"),
            "member_months",
            ratio(cents, F.col("member_months")).alias("category_contribution_to_pmpm_cents"),
            "claims_containing_category")
    )
