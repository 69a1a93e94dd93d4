"""Eligibility spans and the member-month exposure fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.references import resolve_references
from evenkeel.schemas import TABLES

# The attributes that must agree for a member to have one assignment in a month.
ASSIGNMENT = (
    "market_key", "plan_key", "program", "benefit_scope", "eligibility_group", "delivery_system")
MEMBER_MONTH = ("run_id", "member_key", "month_start")


def first_landed(raw: DataFrame, run_id: str, business_key: str) -> DataFrame:
    """One row per business key: the lowest source row, then the lowest file.

    Taken before any reference is resolved, so an unresolvable first row removes
    the key instead of letting a later copy stand in for it. A row without a key
    cannot be told apart from any other and is left out. ``min`` of a struct
    combines on the map side, so a key landed many times does not gather anywhere.
    """
    key = [business_key, "run_id"]
    order = ["source_row_id", "source_file_id"]
    rest = [c for c in raw.columns if c not in key + order]
    kept = (
        raw.where((F.col("run_id") == run_id) & F.col(business_key).isNotNull())
        .groupBy(*key)
        .agg(F.min(F.struct(*order, *rest)).alias("row"))
    )
    return kept.select(*key, "row.*").select(*raw.columns)


def eligibility_spans(
    raw_spans: DataFrame,
    dim_member: DataFrame,
    dim_market: DataFrame,
    dim_plan: DataFrame,
    run_id: str,
) -> DataFrame:
    """Curated spans: deduplicated by business key, then resolved to keys."""
    kept = first_landed(raw_spans, run_id, "eligibility_span_id").drop("ingested_at")
    resolved = resolve_references(kept, dim_member, dim_market, dim_plan)
    return resolved.select(*TABLES["eligibility_span"].names)


def _days_before(day: Column) -> Column:
    """Bit mask of the days of a month before ``day``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), day - 1) - 1


def month_masks(dim_date: DataFrame) -> DataFrame:
    """One row per calendar month; bit ``d - 1`` is set when day ``d`` is in the calendar."""
    bit = _days_before(F.dayofmonth("calendar_date")) + 1
    return dim_date.groupBy("month_start").agg(F.bit_or(bit).alias("calendar_days"))


def covered_months(spans: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Span rows spread over the calendar months they touch, with a day bit mask.

    Spans are clipped to the calendar first, so an open-ended span costs no more
    rows than the calendar has months, and a month is one row instead of up to 31.
    """
    first_date = dim_date.agg(F.min("calendar_date")).scalar()
    last_date = dim_date.agg(F.max("calendar_date")).scalar()
    dated = spans.where(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
    clipped = (
        dated.withColumn("start_date", F.greatest(F.col("start_date"), first_date))
        .withColumn("end_date", F.least(F.col("end_date"), last_date))
        .where(F.col("start_date") <= F.col("end_date"))
    )
    monthly = clipped.withColumn(
        "month_start",
        F.explode(F.sequence(
            F.trunc("start_date", "MM"), F.trunc("end_date", "MM"),
            F.expr("INTERVAL 1 MONTH"))),
    )
    month = F.col("month_start")
    first = F.when(F.trunc("start_date", "MM") == month, F.dayofmonth("start_date")).otherwise(1)
    last = F.when(F.trunc("end_date", "MM") == month, F.dayofmonth("end_date")).otherwise(31)
    days = (_days_before(last + 1) - _days_before(first)).bitwiseAND(F.col("calendar_days"))
    # One row per calendar month, so this side is bounded by the calendar.
    return (
        monthly.join(F.broadcast(month_masks(dim_date)), "month_start")
        .withColumn("covered_days", days)
        .where(F.col("covered_days") != 0)
        .drop("start_date", "end_date", "calendar_days")
    )


def member_assignments(spans: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per member and month: covered days, and the lowest and highest assignment.

    Two assignments differ exactly when the lowest and the highest do, so one
    aggregation with fixed-size state replaces a distinct count and an anti join.
    The union of covered days is the OR of the day masks.
    """
    complete = F.lit(True)
    for column in ASSIGNMENT:
        complete = complete & F.col(column).isNotNull()
    assignment = F.when(complete, F.struct(*ASSIGNMENT))
    return (
        covered_months(spans, dim_date)
        .groupBy(*MEMBER_MONTH[1:], "run_id")
        .agg(
            F.bit_or("covered_days").alias("covered_days"),
            F.min(assignment).alias("lowest"),
            F.max(assignment).alias("highest"),
        )
        .select(*MEMBER_MONTH, "covered_days", "lowest", "highest")
    )


def is_conflicting():
    return F.col("lowest") != F.col("highest")


def conflicting_member_months(assignments: DataFrame) -> DataFrame:
    return assignments.where(is_conflicting()).select(*MEMBER_MONTH)


def member_months(assignments: DataFrame) -> DataFrame:
    """The exposure fact; a member-month with two assignments is left out.

    Any covered day counts as one whole month; the days are kept beside it.
    """
    cohort = (F.col("program") == "MEDICAID") & (F.col("benefit_scope") == "FULL")
    return (
        assignments.where(F.col("lowest") == F.col("highest"))
        .select(*MEMBER_MONTH, "lowest.*", F.bit_count("covered_days").alias("eligible_days"))
        .withColumn("member_month_weight", F.lit(1))
        .withColumn("in_primary_cohort", F.when(cohort, 1).otherwise(0))
        .select(*TABLES["fact_member_month"].names)
    )
