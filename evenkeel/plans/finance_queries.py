"""Registered finance queries over the star-schema proxies."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators import (
    claims, constraints, exposure, kpis, reconciliation, variance)
from evenkeel.plans import proxies
from evenkeel.plans.finance import CURATED, DIMENSIONS, OPERATIONAL, RAW, FinanceRun
from evenkeel.session import scratch, settled
from evenkeel.session import stage as write_stage
from evenkeel.sources.tables import table_counts

Query = Callable[[SparkSession, str], DataFrame]

# Months that are still developing at the cutoff, and a gate for small markets.
PROVISIONAL_FROM = date(1999, 4, 1)
MINIMUM_MEMBER_MONTHS = 100

RULES = {
    "dq_duplicate_span_keys": "DQ_ELIG_DUPLICATE_KEY",
    "dq_unresolved_references": "DQ_ELIG_UNRESOLVED_REFERENCE",
    "dq_unmapped_service_codes": "DQ_LINE_UNMAPPED_SERVICE_CODE",
    "dq_missing_market_feeds": "DQ_MISSING_MARKET_FEED",
    "dq_conflicting_assignments": "DQ_MM_CONFLICTING_ASSIGNMENT",
    "dq_claim_population": "DQ_CLAIM_POPULATION_MATCH",
    "dq_header_line_balance": "DQ_HEADER_LINE_BALANCE",
    "dq_ledger_reconciles": "DQ_LEDGER_RECONCILES_TO_CLAIMS",
    "dq_capitation_linked": "DQ_CAPITATION_CORRECTION_LINKED",
}
COMPONENTS = ("primary_exposure", "exposure_month", "ffs_spend_month", "ffs_claims_month",
              "ffs_category_month", "encounter_month", "capitation_month",
              "kpi_period_membership")
MEASURES = ("kpi_ffs_month", "kpi_managed_care_month", "kpi_ffs_category_month")


# Inputs that several rules and curated tables read, and the curated tables over them. A map
# that is written is known to be small, so joins with it do not shuffle the other side.
LANDED = ("raw_eligibility_span", "raw_claim_header", "service_category_map")
SHARED = ("eligibility_span", "claim_header_version", "member_assignment", "claim_line_version",
          "fact_claim_header_final")
EVIDENCE = (*SHARED, "dq_result")
# Where a curated row came from, which the quarantine reports and measures do not read.
PROVENANCE = ("source_file_id", "source_row_id")


def _over_run(build: Callable[[FinanceRun], DataFrame], stage: tuple[str, ...] = (),
              contents: bool = False, landed: tuple[str, ...] = (),
              unread: tuple[str, ...] = ()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        if not stage and not landed:
            return build(proxies.finance_run(spark, sf_dir, contents))
        # What was staged is removed as soon as the result stands.
        with scratch(spark):
            run = proxies.finance_run(spark, sf_dir, contents, shared=contents and bool(stage))
            return settled(build(run.landed(*landed).staged(*stage, unread=unread)), "result")
    return query


def _ready(run: FinanceRun) -> DataFrame:
    """The run row with the status its rules give it."""
    status = run.run_status.select("run_id", F.col("status").alias("resolved"))
    return run["pipeline_run"].join(status, "run_id").withColumn(
        "status", F.col("resolved")).drop("resolved")


def constraint_violations(run: FinanceRun) -> DataFrame:
    """Constraints that some row violates. Every table is read several times, so the
    derived ones are written first."""
    tables = {t: run[t] for t in (*OPERATIONAL, *RAW, *DIMENSIONS)} | run.curated_tables
    for table in (*RAW, "source_file", *CURATED):
        if table not in run.curated:
            tables[table] = write_stage(tables[table], table)
    return constraints.constraint_violations(tables, constraints.keyed_apart).where("violations > 0")


def queries() -> dict[str, Query]:
    traced = {"stage": SHARED, "landed": LANDED}
    shared, evidence = ({"stage": s, "landed": LANDED, "unread": PROVENANCE} for s in (SHARED, EVIDENCE))
    out: dict[str, Query] = {
        "eligibility_spans": _over_run(lambda r: r.spans),
        "member_months": _over_run(lambda r: r.member_months),
        "conflicting_member_months": _over_run(
            lambda r: exposure.conflicting_member_months(r.assignments)),
        "claim_header_versions": _over_run(lambda r: r.headers),
        "numbered_versions": _over_run(lambda r: claims.numbered_versions(
            r.headers.select("claim_family_key", "version_number"))),
        "claim_line_versions": _over_run(lambda r: r.lines),
        "claim_finals": _over_run(lambda r: r.finals),
        "claim_line_finals": _over_run(lambda r: r.final_lines),
        "payment_ledger": _over_run(lambda r: r.payments),
        "capitation_ledger": _over_run(lambda r: r.capitation),
        "family_balances": _over_run(lambda r: r.family_balances),
        "calendar": _over_run(lambda r: r["dim_date"]),
        "expected_partitions": _over_run(lambda r: r["expected_partition"]),
        "source_files": _over_run(lambda r: r["source_file"].select(
            "source_file_id", "market_id", "month_start", "row_count", "content_hash"),
            contents=True),
        "dq_results": _over_run(lambda r: r.dq_result, **shared),
        "run_status": _over_run(lambda r: r.run_status, **shared),
        "quarantine": _over_run(lambda r: r.quarantine, **traced),
        "partition_status": _over_run(lambda r: r.partition_status, **shared),
        "partition_status_feeds": _over_run(lambda r: kpis.partition_status(
            r["dim_market"], r["dim_date"], r["pipeline_run"],
            r.rule("DQ_MISSING_MARKET_FEED"))),
        "preflight_blockers": _over_run(lambda r: r.blockers(_ready(r)), **evidence),
        "table_counts": _over_run(lambda r: table_counts(r.curated_tables), **shared),
    }
    out |= {
        "payment_month": _over_run(lambda r: variance.payment_month(r.payments)),
        "ffs_variance": _over_run(
            lambda r: variance.ffs_variance(r.view("v_kpi_ffs_month")), **evidence),
        "category_contributions": _over_run(
            lambda r: variance.category_contributions(
                r.view("v_kpi_ffs_month"), r.view("v_ffs_category_month")), **evidence),
        "pmpm_anomalies": _over_run(
            lambda r: variance.pmpm_anomalies(
                r.view("v_kpi_ffs_month"), PROVISIONAL_FROM, MINIMUM_MEMBER_MONTHS), **evidence),
        "claim_bridge": _over_run(lambda r: reconciliation.claim_bridge(
            r["raw_claim_header"], r.headers, r.finals, r["pipeline_run"], r.run_id),
            ("claim_header_version",)),
        "drop_report": _over_run(lambda r: reconciliation.drop_report(
            r.inputs, r.headers, r.lines, r.run_id, r.mapping_version, write_stage),
            ("claim_header_version", "claim_line_version")),
        "quality_failure_rate": _over_run(lambda r: reconciliation.quality_failure_rate(
            r.quarantine, [r[t] for t in RAW]), **traced),
        "finance_mart": _over_run(lambda r: reconciliation.finance_mart(
            r.member_months, r.finals, r.final_lines, r.capitation), **shared),
        "category_mart": _over_run(lambda r: reconciliation.category_mart(
            r.member_months, r.finals, r.final_lines), **shared),
        "constraint_violations": _over_run(constraint_violations, EVIDENCE, contents=True),
    }
    # Rules that look at headers more than once.
    of_rule = {"dq_unmapped_service_codes": {"landed": LANDED[1:]},
               "dq_header_line_balance": {"landed": LANDED[1:], "stage": ("claim_header_version",)}}
    for name, rule in RULES.items():
        out[name] = _over_run(lambda r, rule=rule: r.rule(rule), **of_rule.get(name, {}))
    for name in COMPONENTS:
        out[name] = _over_run(lambda r, name=name: r.view(f"v_{name}"))
    for name in MEASURES:
        out[name] = _over_run(lambda r, name=name: r.view(f"v_{name}"), **shared)
    return out
