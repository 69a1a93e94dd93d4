"""Movement of published measures from month to month.

These measures are specified beside the KPIs as definitions with worked examples.
All of them start from rows already aggregated to market and month, so their
windows hold the months of one market and nothing else.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Review thresholds.
MATERIAL_CENTS = 1_000_000
MATERIAL_PCT = 10.0
BASELINE_MONTHS = 12
SCORE_FACTOR = 0.6745
SCORE_LIMIT = 3.5
MINIMUM_MEMBER_MONTHS = 100


def payment_month(payments: DataFrame) -> DataFrame:
    """Net cash activity by the month of payment, adjustments included."""
    return payments.groupBy(
        "run_id", F.trunc("payment_date", "MM").alias("payment_month")
    ).agg(F.sum("signed_amount_cents").alias("net_payment_cents"),
          F.count(F.lit(1)).alias("transactions"))


def _with_prior(ffs_month: DataFrame) -> DataFrame:
    """Each month beside the calendar month before it, when that one exists."""
    prior = ffs_month.select(
        "run_id", "market_key", F.add_months("month_start", 1).alias("month_start"),
        F.col("ffs_paid_cents").alias("prior_paid_cents"),
        F.col("member_months").alias("prior_member_months"),
        F.col("ffs_pmpm_cents").alias("prior_pmpm_cents"))
    return ffs_month.join(prior, ["run_id", "market_key", "month_start"], "left")


def ffs_variance(ffs_month: DataFrame) -> DataFrame:
    """Spend change, its percentage, its bridge, and whether it deserves a review.

    Without the month before, nothing is compared. A zero baseline has no
    percentage and no bridge; activity that starts from it is new activity. The
    bridge gives the interaction of members and rate to the rate.
    """
    paid, prior = F.col("ffs_paid_cents"), F.col("prior_paid_cents")
    change = paid - prior
    months, prior_months = F.col("member_months"), F.col("prior_member_months")
    rate, prior_rate = F.col("ffs_pmpm_cents"), F.col("prior_pmpm_cents")
    percent = F.when(prior > 0, change.cast("double") * 100.0 / prior)
    bridged = (months > 0) & (prior_months > 0)
    new = (prior == 0) & (paid > 0)
    material = (
        F.when(prior > 0, (F.abs(change) >= MATERIAL_CENTS) & (F.abs(percent) >= MATERIAL_PCT))
        .when(prior == 0, paid >= MATERIAL_CENTS)
    )
    return _with_prior(ffs_month).select(
        "run_id", "market_key", "month_start", "partition_status", paid, prior,
        change.alias("change_cents"), percent.alias("change_pct"),
        F.coalesce(new, F.lit(False)).alias("is_new_activity"),
        F.when(bridged, (months - prior_months) * prior_rate).alias("membership_effect_cents"),
        F.when(bridged, months * (rate - prior_rate)).alias("pmpm_effect_cents"),
        F.coalesce(material, F.lit(False)).alias("is_material"))


def _apportioned(ffs_month: DataFrame, category_month: DataFrame) -> DataFrame:
    """The cents of a market and month over its categories, to the cent.

    Lines do not always add up to their headers, so the month's paid cents are shared in
    proportion to category cents: each category gets the whole cents of its share, and the
    cents that are left go one by one to the largest remainders, the lower category first
    among equal ones. A month without category cents is one part without a category.
    """
    keys = ["run_id", "market_key", "month_start"]
    month = Window.partitionBy(*keys)
    parts = ffs_month.select(*keys, "ffs_paid_cents").join(
        category_month.where("category_paid_cents > 0").select(*keys, "category_key", "category_paid_cents"),
        keys, "left").withColumn("whole", F.sum("category_paid_cents").over(month))
    wide = F.col("ffs_paid_cents").cast("decimal(19,0)") * F.col("category_paid_cents").cast("decimal(19,0)")
    shared = parts.withColumn("wide", wide).withColumn(
        "share", F.coalesce(F.expr("wide div whole"), F.col("ffs_paid_cents"))).withColumn(
        "rest", F.coalesce(F.expr("wide % whole"), F.lit(0)))
    left = F.col("ffs_paid_cents") - F.sum("share").over(month)
    place = F.row_number().over(month.orderBy(F.desc("rest"), "category_key"))
    return shared.withColumn("left", left).withColumn("place", place).select(
        *keys, "category_key", (F.col("share") + (F.col("place") <= F.col("left")).cast("long")).alias("cents"))


def category_contributions(ffs_month: DataFrame, category_month: DataFrame) -> DataFrame:
    """What each category adds to the change of a market's spend from the month before.

    Contributions of a market and month add up to its change in every case. The percentage
    of the change is unavailable where nothing changed, and may exceed 100 where categories
    offset each other. Months without the month before are not compared.
    """
    cents = _apportioned(ffs_month, category_month)
    keys = ["run_id", "market_key", "month_start", "category_key"]
    zero = F.lit(0).cast("long")
    sides = cents.select(*keys, F.col("cents").alias("current"), zero.alias("prior")).unionByName(
        cents.select("run_id", "market_key", F.add_months("month_start", 1).alias("month_start"), "category_key",
                     zero.alias("current"), F.col("cents").alias("prior")))
    both = sides.groupBy(*keys).agg(F.sum("current").alias("current_cents"), F.sum("prior").alias("prior_cents"))
    change = _with_prior(ffs_month).where("prior_paid_cents is not null").select(
        *keys[:3], (F.col("ffs_paid_cents") - F.col("prior_paid_cents")).alias("change_cents"))
    contribution = F.col("current_cents") - F.col("prior_cents")
    return both.join(change, keys[:3]).select(
        *keys, "current_cents", "prior_cents", contribution.alias("contribution_cents"), "change_cents",
        F.when(F.col("change_cents") != 0, contribution.cast("double") * 100.0 / F.col("change_cents")).alias(
            "contribution_pct"))


def _median(values: Column) -> Column:
    ordered = F.array_sort(values)
    middle = F.size(values).cast("double") / 2
    low, high = F.floor(middle - 0.5).cast("int"), F.ceil(middle - 0.5).cast("int")
    return (F.get(ordered, low) + F.get(ordered, high)) / 2


def pmpm_anomalies(
    ffs_month: DataFrame, provisional_from: date,
    minimum_member_months: int = MINIMUM_MEMBER_MONTHS,
) -> DataFrame:
    """Robust score of each month's PMPM against the twelve months before it.

    A candidate needs both an unusual score and a material impact. A gap in the
    history, a history without spread or too few members gives NOT_EVALUATED, and
    a provisional month gets an advisory and no score.
    """
    history = Window.partitionBy("run_id", "market_key").orderBy("month_start").rowsBetween(
        -BASELINE_MONTHS, -1)
    rate = F.col("ffs_pmpm_cents")
    based = (
        ffs_month.withColumn("baseline", F.collect_list("ffs_pmpm_cents").over(history))
        .withColumn("baseline_start", F.min("month_start").over(history))
        .withColumn("is_complete", F.coalesce(
            (F.size("baseline") == BASELINE_MONTHS)
            & (F.col("baseline_start") == F.add_months("month_start", -BASELINE_MONTHS)),
            F.lit(False)))
        .withColumn("median_pmpm", F.when(F.col("is_complete"), _median(F.col("baseline"))))
        .withColumn("mad", _median(F.transform(
            "baseline", lambda x: F.abs(x - F.col("median_pmpm")))))
        .withColumn("is_provisional", F.col("month_start") >= F.lit(provisional_from))
    )
    scored = (
        ~F.col("is_provisional") & F.col("is_complete") & (F.col("mad") > 0)
        & (F.col("member_months") >= minimum_member_months)
    )
    score = F.lit(SCORE_FACTOR) * (rate - F.col("median_pmpm")) / F.col("mad")
    impact = F.abs(rate - F.col("median_pmpm")) * F.col("member_months")
    candidate = (F.abs(F.col("score")) > SCORE_LIMIT) & (F.col("impact_cents") >= MATERIAL_CENTS)
    return (
        based.withColumn("score", F.when(scored, score))
        .withColumn("impact_cents", F.when(scored, impact))
        .withColumn("outcome", F.when(F.col("is_provisional"), "PRELIMINARY_ADVISORY")
                    .when(F.col("score").isNull(), "NOT_EVALUATED")
                    .when(candidate, "CANDIDATE").otherwise("NO_CANDIDATE"))
        .select("run_id", "market_key", "month_start", "member_months", "ffs_pmpm_cents",
                "median_pmpm", "score", "impact_cents", "outcome")
    )
