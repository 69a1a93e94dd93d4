"""Published extracts: arrangements for BI, state caps, state readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.archive import dollars
from evenkeel.operators.numbering import positions
from evenkeel.operators.resolution import resolve
from evenkeel.sources.documents import cell

# Fixed value: the assessments that make a state's data usable.
USABLE_ASSESSMENTS = ("Low concern",)
# Fixed value: what the published caps are, and what they are not.
CAP_BASIS = ("Archive document-cap subtotal; overlap not resolved; not projected payments or "
             "actual spending")
STATE = ["state_code", "state_name"]
EXTRACT = (
    "sdp_identifier", "state_code", "state_name", "rating_period_year", "rating_period_start",
    "rating_period_end", "payment_type", "provider_class", "review_type", "amount_usd",
    "amount_is_zero", "amount_source", "document_type", "description", "dq_assessment",
    "reports_usably", "dq_assessment_year", "identifier_suffix", "lineage_status",
    "candidate_count", "amount_status", "resolution_version", "identifier_mismatch",
    "source_url", "source_sha256", "retrieved_at", "federal_share_usd")


def has_period() -> Column:
    return F.col("rating_period_start").isNotNull() & F.col("rating_period_end").isNotNull()


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """The frame itself, failing when a key occurs twice."""
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*rest)).alias("r"))
    once = F.when(F.col("n") > 1, F.raise_error(
        F.concat(F.lit(f"{key} is not unique: "), F.col(key)))).otherwise(F.col("r"))
    return grouped.withColumn("r", once).select(key, "r.*")


def bi_extract(archive: DataFrame, readiness: DataFrame) -> DataFrame:
    """Resolved arrangements with a complete rating period, beside state assessments."""
    current = resolve(archive.where(has_period()))
    joined = current.join(one_per_key(readiness, "state_name"), "state_name", "left")
    return (
        joined.drop("payment_type", "review_type")
        .withColumnsRenamed({"payment_type_normalised": "payment_type",
                             "review_type_normalised": "review_type"})
        .withColumn("rating_period_year", F.substring("rating_period_start", 1, 4))
        .withColumn("amount_is_zero", F.coalesce(F.col("amount_usd") == 0, F.lit(False)))
        .withColumn("federal_share_usd", dollars(F.col("federal_share_cents")))
        .select(*EXTRACT)
        .orderBy("rating_period_year", "state_code", "sdp_identifier")
    )


def extract_drops(archive: DataFrame, extract: DataFrame) -> DataFrame:
    """What the extract consolidated or could not date, in rows and cents."""
    dated = F.coalesce(has_period(), F.lit(False))
    return archive.agg(
        F.count_if(dated).alias("dated_rows"),
        F.count_if(~dated).alias("undateable_rows"),
        F.coalesce(F.sum(F.when(~dated, F.col("amount_cents"))), F.lit(0))
        .alias("undateable_cents"),
    ).withColumn("extract_rows", extract.agg(F.count(F.lit(1))).scalar()).withColumn(
        "consolidated_rows", F.col("dated_rows") - F.col("extract_rows"))


def extract_years(extract: DataFrame) -> DataFrame:
    """Known subtotals by start year; a year without any known amount is NULL."""
    cents = F.round(F.col("amount_usd") * 100).cast("long")
    return extract.groupBy("rating_period_year").agg(
        F.count(F.lit(1)).alias("arrangements"), dollars(F.sum(cents)).alias("known_amount_usd"))


def _capped(archive: DataFrame) -> DataFrame:
    return archive.where(
        F.col("grandfathered_cap_cents").isNotNull() & F.col("state_code").isNotNull()
        & F.col("state_name").isNotNull())


def state_caps(archive: DataFrame) -> DataFrame:
    """Document caps by state; the documents are the rows of ``state_cap_sources``."""
    return _capped(archive).groupBy(*STATE).agg(
        F.count("sdp_identifier").alias("cap_document_count"),
        dollars(F.sum("grandfathered_cap_cents")).alias("cap_document_sum_usd"),
    ).withColumn("measure_basis", F.lit(CAP_BASIS))


def state_cap_sources(archive: DataFrame) -> DataFrame:
    """The documents behind every state's caps, numbered in the order of their names."""
    return positions(_capped(archive), STATE, "sdp_identifier")


def state_coverage(archive: DataFrame, year: int) -> DataFrame:
    """Known subtotal and unknown count per state for periods that start in a year."""
    cohort = archive.where(
        (F.substring("rating_period_start", 1, 4) == str(year))
        & F.col("rating_period_end").isNotNull())
    known = F.col("amount_is_publishable")
    return (
        resolve(cohort).where(F.col("state_name").isNotNull())
        .groupBy("state_name")
        .agg(dollars(F.sum(F.when(known, F.col("amount_cents")))).alias("sdp_amount_usd"),
             F.count_if(known).alias("sdp_known_arrangements"),
             F.count_if(~known).alias("sdp_unknown_arrangements"))
    )


def state_dollars(coverage: DataFrame) -> DataFrame:
    """States with a known subtotal only; an unknown state is not a zero."""
    return coverage.where(F.col("sdp_amount_usd").isNotNull()).select(
        "state_name", "sdp_amount_usd")


def is_usable_assessment(column: Column) -> Column:
    return F.coalesce(F.trim(column).isin(*USABLE_ASSESSMENTS), F.lit(False))


# Columns of a topic file and the names they are published under.
TOPIC_COLUMNS = {
    "state": "State",
    "data_year": "Data Year",
    "dq_assessment": "DQ Assessment",
    "supplemental_payment_records": "# Supplemental Payment Records",
    "pct_missing_or_zero_payment":
        "% Supplemental Payment Records with Missing or Zero Payment",
    "pct_non_missing_payment_amount":
        "% Supplemental Payment Records with Non-Missing Service Tracking Payment Amt",
}


def assessed_states(topic_rows: DataFrame) -> DataFrame:
    """State rows of a topic file under their published names."""
    return topic_rows.select(
        F.col("year").alias("newest_year"),
        *[cell(column).alias(name) for name, column in TOPIC_COLUMNS.items()],
    ).withColumn("reports_usably", is_usable_assessment(F.col("dq_assessment")))


def state_readiness(assessed: DataFrame, coverage: DataFrame) -> DataFrame:
    """Assessed states beside the money they move; counts default to zero, money does not.

    Works from stored assessments as well, which then keep their snapshot while the
    amounts are recomputed.
    """
    joined = assessed.join(
        coverage.withColumnRenamed("state_name", "state"), "state", "left")
    return joined.withColumn(
        "sdp_known_arrangements", F.coalesce("sdp_known_arrangements", F.lit(0))
    ).withColumn("sdp_unknown_arrangements", F.coalesce("sdp_unknown_arrangements", F.lit(0)))


def assessment_counts(assessed: DataFrame) -> DataFrame:
    label = F.trim(F.coalesce("dq_assessment", F.lit("")))
    return assessed.groupBy(label.alias("dq_assessment")).agg(
        F.count(F.lit(1)).alias("states"), F.count_if("reports_usably").alias("usable_states"))


def largest_states(readiness: DataFrame, count: int = 10) -> DataFrame:
    """States with the largest known subtotal; zero and unknown do not rank."""
    return readiness.where(F.col("sdp_amount_usd") != 0).orderBy(
        F.desc("sdp_amount_usd"), "state").limit(count)


def rewritten_caveats(caveats: Column) -> Column:
    """Stored caveats speak of the newest assessment; a reused snapshot is not that."""
    return F.transform(caveats, lambda c: F.replace(
        c, F.lit("The newest published assessment is"),
        F.lit("The preserved assessment snapshot covers")))


def readiness_document(readiness: DataFrame, caveats: list[str]) -> DataFrame:
    """One JSON document. The states of one assessment file are a bounded list."""
    states = F.sort_array(F.collect_list(F.struct("state", *[
        c for c in readiness.columns if c not in ("state", "newest_year")])))
    return readiness.groupBy("newest_year").agg(
        F.count(F.lit(1)).alias("states_assessed"),
        F.count_if("reports_usably").alias("states_reporting_usably"),
        states.alias("states"),
    ).withColumn("caveats", rewritten_caveats(F.array(*[F.lit(c) for c in caveats])))
