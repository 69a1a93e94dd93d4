"""Data-quality rules.

A rule is one aggregation that counts what it evaluated, what failed and the
cents at stake; its disposition is derived from those counts. Rules that look at
many raw rows first collapse them to the distinct combinations being tested, so
a hot member, code or family is one row before anything is joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.claims import header_lines, run_cutoff
from evenkeel.operators.exposure import MEMBER_MONTH, covered_months, first_landed, is_conflicting
from evenkeel.operators.ledger import ledger_balances
from evenkeel.operators.references import join_by_name, market_plans
from evenkeel.schemas import TABLES

# Rule identifiers and the version of each rule.
RUN_RULES = {
    "DQ_ELIG_DUPLICATE_KEY": "v1",
    "DQ_ELIG_UNRESOLVED_REFERENCE": "v1",
    "DQ_LINE_UNMAPPED_SERVICE_CODE": "v1",
    "DQ_MM_CONFLICTING_ASSIGNMENT": "v1",
    "DQ_CLAIM_POPULATION_MATCH": "v3",
    "DQ_HEADER_LINE_BALANCE": "v1",
    "DQ_LEDGER_RECONCILES_TO_CLAIMS": "v1",
    "DQ_CAPITATION_CORRECTION_LINKED": "v1",
}
FEED_RULE = ("DQ_MISSING_MARKET_FEED", "v1")
UNMATCHED = ("NO_EXPOSURE", "CONFLICTING_EXPOSURE")
TOLERANCE_CENTS = 1


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("long")


def _side_by_side(*counts: DataFrame) -> DataFrame:
    """Several one-row counts as one row; a count stands in one of them only."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return rows.agg(*[F.sum(c).cast("long").alias(c) for c in rows.columns])


def _verdict(
    counts: DataFrame, run_id: str, rule: str, failed: Column | None = None
) -> DataFrame:
    """Counts of one run-level rule as a result row."""
    failed = F.col("failing_row_count") > 0 if failed is None else failed
    if "financial_impact_cents" not in counts.columns:
        counts = counts.withColumn("financial_impact_cents", F.lit(None).cast("long"))
    return (
        counts.withColumn("run_id", F.lit(run_id))
        .withColumn("rule_id", F.lit(rule))
        .withColumn("rule_version", F.lit(RUN_RULES[rule]))
        .withColumn("market_id", F.lit("ALL"))
        .withColumn("month_start", F.lit("ALL"))
        .withColumn("severity", F.lit("BLOCKING"))
        .withColumn("disposition", F.when(failed, "FAIL").otherwise("PASS"))
        .select(*TABLES["dq_result"].names)
    )


def duplicate_span_keys(raw_spans: DataFrame, run_id: str) -> DataFrame:
    """Rows beyond the first for a business key."""
    keys = (
        raw_spans.where(F.col("run_id") == run_id)
        .groupBy("eligibility_span_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = keys.agg(
        _total(F.col("n")).alias("evaluated_count"),
        _total(F.col("n") - 1).alias("failing_row_count"))
    return _verdict(counts, run_id, "DQ_ELIG_DUPLICATE_KEY")


def reference_gaps(
    raw: DataFrame, dim_member: DataFrame, dim_market: DataFrame, dim_plan: DataFrame
) -> DataFrame:
    """Adds ``no_member``, ``no_market`` and ``no_plan`` to rows with identifiers."""
    members = dim_member.select(
        F.col("synthetic_member_id").alias("member_id"), F.lit(True).alias("has_member"))
    markets = dim_market.select("market_id", F.lit(True).alias("has_market"))
    plans = market_plans(dim_market, dim_plan).select(
        "market_id", "plan_id", F.lit(True).alias("has_plan"))
    return (
        join_by_name(raw, members, "member_id", "left")
        .join(markets, "market_id", "left")
        .join(plans, ["market_id", "plan_id"], "left")
        .withColumn("no_member", F.col("has_member").isNull())
        .withColumn("no_market", F.col("has_market").isNull())
        .withColumn("no_plan", F.col("has_plan").isNull())
        .drop("has_member", "has_market", "has_plan")
    )


def unresolved_span_references(
    raw_spans: DataFrame,
    dim_member: DataFrame,
    dim_market: DataFrame,
    dim_plan: DataFrame,
    run_id: str,
) -> DataFrame:
    """Spans naming a member, market or plan that does not exist.

    A missing plan is counted as failing but does not by itself turn the verdict.
    """
    combinations = (
        raw_spans.where(F.col("run_id") == run_id)
        .groupBy("member_id", "market_id", "plan_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    gaps = reference_gaps(combinations, dim_member, dim_market, dim_plan)
    blocking = F.col("no_member") | F.col("no_market")
    counts = gaps.agg(
        _total(F.col("n")).alias("evaluated_count"),
        _total(F.when(blocking | F.col("no_plan"), F.col("n"))).alias("failing_row_count"),
        _total(F.when(blocking, F.col("n"))).alias("blocking_rows"))
    return _verdict(
        counts, run_id, "DQ_ELIG_UNRESOLVED_REFERENCE", F.col("blocking_rows") > 0)


def mapped_codes(service_category_map: DataFrame, mapping_version: str) -> DataFrame:
    """(file type, code) pairs the mapping version knows, whatever their dates."""
    return (
        service_category_map.where(F.col("mapping_version") == mapping_version)
        .select("claim_file_type", "service_code").distinct()
    )


def maybe_unmapped(
    lines: DataFrame, headers: DataFrame, service_category_map: DataFrame, mapping_version: str
) -> DataFrame:
    """Lines that may lack a category under one of the headers' file types.

    A code that is mapped under every file type of the map cannot fail with any of them, so
    its lines need not meet their headers. They stay where a header has another file type, or
    none. What is left out is decided by codes alone; what fails is left to the caller.
    """
    known = mapped_codes(service_category_map, mapping_version).where(
        F.col("claim_file_type").isNotNull() & F.col("service_code").isNotNull())
    types = known.select("claim_file_type").distinct()
    complete = known.groupBy("service_code").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") == types.agg(F.count(F.lit(1))).scalar()).select(
        "service_code", F.lit(True).alias("is_complete"))
    strays = headers.select("claim_file_type").distinct().join(types, "claim_file_type", "left_anti")
    return lines.join(complete, "service_code", "left").where(
        F.col("is_complete").isNull() | (strays.agg(F.count(F.lit(1))).scalar() > 0)
    ).drop("is_complete")


def unmapped_service_codes(
    raw_lines: DataFrame,
    raw_headers: DataFrame,
    service_category_map: DataFrame,
    run_id: str,
    mapping_version: str,
) -> DataFrame:
    """Lines whose code the map does not contain, with the cents on them.

    Lines that may fail meet their headers once and are then summed by code, so the
    map is compared with one row per code. A version with very many lines is a skewed
    join partition, which adaptive execution splits.
    """
    version = ["claim_family_id", "version_number"]
    lines = raw_lines.where(F.col("run_id") == run_id)
    types = raw_headers.where(F.col("run_id") == run_id).select(*version, "claim_file_type")
    by_code = (
        maybe_unmapped(lines.select(*version, "service_code", "line_paid_amount_cents"), types,
                       service_category_map, mapping_version)
        .join(types, version)
        .groupBy("claim_file_type", "service_code")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("line_paid_amount_cents").alias("cents"))
    )
    failing = by_code.join(
        mapped_codes(service_category_map, mapping_version),
        ["claim_file_type", "service_code"], "left_anti",
    ).agg(_total(F.col("n")).alias("failing_row_count"),
          _total(F.col("cents")).alias("financial_impact_cents"))
    evaluated = lines.agg(F.count(F.lit(1)).alias("evaluated_count"))
    return _verdict(_side_by_side(evaluated, failing), run_id, "DQ_LINE_UNMAPPED_SERVICE_CODE")


def missing_market_feeds(
    expected_partition: DataFrame, source_file: DataFrame, run_id: str
) -> DataFrame:
    """One row per expected market and month; a feed arrives as a file, not as rows."""
    expected = expected_partition.where(F.col("run_id") == run_id)
    files = source_file.select(
        "run_id", "entity", "market_id", "month_start", "source_file_id")
    arrivals = expected.join(files, ["run_id", "entity", "market_id", "month_start"], "left")
    rule, version = FEED_RULE
    return (
        arrivals.groupBy("run_id", "market_id", "month_start")
        .agg(F.count(F.lit(1)).alias("evaluated_count"),
             F.count_if(F.col("source_file_id").isNull()).alias("failing_row_count"))
        .withColumn("month_start", F.col("month_start").cast("string"))
        .withColumn("rule_id", F.lit(rule))
        .withColumn("rule_version", F.lit(version))
        .withColumn("severity", F.lit("BLOCKING"))
        .withColumn("financial_impact_cents", F.lit(None).cast("long"))
        .withColumn("disposition",
                    F.when(F.col("failing_row_count") > 0, "FAIL").otherwise("PASS"))
        .select(*TABLES["dq_result"].names)
    )


def conflicting_assignments(
    spans: DataFrame, assignments: DataFrame, run_id: str
) -> DataFrame:
    """Member-months held under more than one assignment."""
    evaluated = spans.agg(F.count(F.lit(1)).alias("evaluated_count"))
    failing = assignments.agg(F.count_if(is_conflicting()).alias("failing_row_count"))
    return _verdict(_side_by_side(evaluated, failing), run_id, "DQ_MM_CONFLICTING_ASSIGNMENT")


def claim_population(finals: DataFrame, run_id: str) -> DataFrame:
    """Claims with no or conflicting exposure; a claim outside the cohort is valid."""
    bad = F.col("population_match").isin(*UNMATCHED)
    counts = finals.agg(
        F.count(F.lit(1)).alias("evaluated_count"),
        F.count_if(bad).alias("failing_row_count"),
        _total(F.when(bad, F.col("header_paid_amount_cents"))).alias("financial_impact_cents"))
    return _verdict(counts, run_id, "DQ_CLAIM_POPULATION_MATCH")


def accepted_ffs(headers: DataFrame) -> DataFrame:
    return headers.where((F.col("record_type") == "FFS") & (F.col("status") == "ACCEPTED"))


def unbalanced_headers(
    headers: DataFrame,
    raw_lines: DataFrame,
    lines: DataFrame,
    service_category_map: DataFrame,
    run_id: str,
    mapping_version: str,
) -> DataFrame:
    """Accepted fee-for-service headers whose lines do not add up.

    A header with an unmapped line is left to the mapping rule, so one cause is
    reported once. Lines are summed before they are joined.
    """
    accepted = accepted_ffs(headers)
    unmapped = (
        header_lines(maybe_unmapped(raw_lines, accepted, service_category_map, mapping_version),
                     accepted, run_id)
        .join(mapped_codes(service_category_map, mapping_version),
              ["claim_file_type", "service_code"], "left_anti")
        .select("claim_version_key", "run_id").distinct()
    )
    sums = lines.groupBy("claim_version_key", "run_id").agg(
        F.sum("line_paid_amount_cents").alias("line_cents"))
    difference = F.col("header_paid_amount_cents") - F.coalesce(F.col("line_cents"), F.lit(0))
    return (
        accepted.join(unmapped, ["claim_version_key", "run_id"], "left_anti")
        .join(sums, ["claim_version_key", "run_id"], "left")
        .withColumn("difference_cents", difference)
        .where(F.abs("difference_cents") > TOLERANCE_CENTS)
    )


def header_line_balance(headers: DataFrame, unbalanced: DataFrame, run_id: str) -> DataFrame:
    evaluated = accepted_ffs(headers).agg(F.count(F.lit(1)).alias("evaluated_count"))
    failing = unbalanced.agg(F.count(F.lit(1)).alias("failing_row_count"))
    return _verdict(_side_by_side(evaluated, failing), run_id, "DQ_HEADER_LINE_BALANCE")


def family_balances(
    payments: DataFrame, finals: DataFrame, pipeline_run: DataFrame, run_id: str
) -> DataFrame:
    """Ledger balance of each paid family beside the balance of its final claim."""
    balances = ledger_balances(payments, run_cutoff(pipeline_run, run_id))
    current = finals.select("run_id", "claim_family_key", "header_paid_amount_cents")
    return (
        balances.join(current, ["claim_family_key", "run_id"], "left")
        .withColumn("final_cents", F.coalesce("header_paid_amount_cents", F.lit(0)))
        .withColumn("is_unreconciled",
                    (F.col("rows_through_cutoff") > 0)
                    & (F.abs(F.col("ledger_cents") - F.col("final_cents")) > TOLERANCE_CENTS))
        .select("run_id", "claim_family_key", "ledger_cents", "rows_through_cutoff", "final_cents",
                "is_unreconciled")
    )


def ledger_reconciles(balances: DataFrame, run_id: str) -> DataFrame:
    """Only families with payments are tested; a family without a final claim owes zero."""
    counts = balances.agg(
        F.count("claim_family_key").alias("evaluated_count"),
        F.count_if("is_unreconciled").alias("failing_row_count"))
    return _verdict(counts, run_id, "DQ_LEDGER_RECONCILES_TO_CLAIMS")


def is_unlinked_correction() -> Column:
    return (F.col("signed_amount_cents") < 0) & F.col("reverses_transaction_id").isNull()


def capitation_corrections_linked(raw_capitation: DataFrame, run_id: str) -> DataFrame:
    """Negative capitation must name what it reverses."""
    counts = raw_capitation.where(F.col("run_id") == run_id).agg(
        F.count(F.lit(1)).alias("evaluated_count"),
        F.count_if(is_unlinked_correction()).alias("failing_row_count"))
    return _verdict(counts, run_id, "DQ_CAPITATION_CORRECTION_LINKED")


def run_status(dq_result: DataFrame) -> DataFrame:
    """FAILED on any blocking failure, else ready for review."""
    blocking = (F.col("severity") == "BLOCKING") & (F.col("disposition") == "FAIL")
    return (
        dq_result.groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("rule_results"),
             F.count_if(blocking).alias("blocking_failures"))
        .withColumn("status", F.when(F.col("blocking_failures") > 0, "FAILED")
                    .otherwise("READY_FOR_REVIEW"))
    )


def quarantine_records(
    raw_spans: DataFrame,
    raw_headers: DataFrame,
    raw_lines: DataFrame,
    raw_capitation: DataFrame,
    dims: dict[str, DataFrame],
    unbalanced: DataFrame,
    finals: DataFrame,
    headers: DataFrame,
    run_id: str,
    mapping_version: str,
) -> DataFrame:
    """One row per landed row and rule that names it."""
    row = ["run_id", "source_file_id", "source_row_id"]

    def records(failing: DataFrame, rule: str, reason: Column) -> DataFrame:
        return failing.select(
            *row, F.lit(rule).alias("rule_id"), reason.alias("reason"),
            F.lit("OPEN").alias("remediation_status"))

    spans = raw_spans.where(F.col("run_id") == run_id)
    first = first_landed(raw_spans, run_id, "eligibility_span_id").select(*row)
    nameless = spans.where(F.col("eligibility_span_id").isNull())
    nameless_first = nameless.groupBy("run_id").agg(
        F.min(F.struct("source_row_id", "source_file_id")).alias("k")
    ).select("run_id", "k.source_file_id", "k.source_row_id")
    duplicates = spans.join(first.unionByName(nameless_first), row[::-1], "left_anti")
    gaps = reference_gaps(
        spans, dims["dim_member"], dims["dim_market"], dims["dim_plan"]
    ).where(F.col("no_member") | F.col("no_market") | F.col("no_plan"))
    missing = F.concat_ws(
        ", ", F.when(F.col("no_member"), "member"), F.when(F.col("no_market"), "market"),
        F.when(F.col("no_plan"), "plan"))
    types = raw_headers.where(F.col("run_id") == run_id).select(
        "claim_family_id", "version_number", "claim_file_type").distinct()
    unmapped = (
        maybe_unmapped(raw_lines.where(F.col("run_id") == run_id), types,
                       dims["service_category_map"], mapping_version)
        .join(types, ["claim_family_id", "version_number"])
        .join(mapped_codes(dims["service_category_map"], mapping_version),
              ["claim_file_type", "service_code"], "left_anti")
    )
    unmatched = finals.where(F.col("population_match").isin(*UNMATCHED)).select(
        "run_id", "claim_version_key", "population_match"
    ).join(headers.select("claim_version_key", *row), ["claim_version_key", "run_id"])
    corrections = raw_capitation.where(
        (F.col("run_id") == run_id) & is_unlinked_correction())
    parts = [
        records(duplicates, "DQ_ELIG_DUPLICATE_KEY",
                F.lit("span key landed before")),
        records(gaps, "DQ_ELIG_UNRESOLVED_REFERENCE", F.concat(F.lit("unknown "), missing)),
        records(unmapped, "DQ_LINE_UNMAPPED_SERVICE_CODE",
                F.concat(F.lit("no category for "), F.col("service_code"))),
        records(unmatched, "DQ_CLAIM_POPULATION_MATCH", F.col("population_match")),
        records(unbalanced, "DQ_HEADER_LINE_BALANCE",
                F.concat(F.lit("header minus lines: "),
                         F.col("difference_cents").cast("string"), F.lit(" cents"))),
        records(corrections, "DQ_CAPITATION_CORRECTION_LINKED",
                F.lit("negative amount reverses nothing")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()
