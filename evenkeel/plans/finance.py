"""The finance run: landed rows to curated facts, evidence and measures."""

from __future__ import annotations

from copy import copy
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators import claims, exposure, kpis, ledger, preflight, quality
from evenkeel.schemas import TABLES
from evenkeel.session import stage
from evenkeel.sources import snapshots
from evenkeel.sources import tables as store

RAW = ("raw_eligibility_span", "raw_claim_header", "raw_claim_line", "raw_payment_transaction",
       "raw_capitation_transaction")
DIMENSIONS = ("dim_market", "dim_member", "dim_plan", "dim_provider", "dim_service_category",
              "service_category_map", "dim_date")
OPERATIONAL = ("pipeline_run", "source_file", "expected_partition")
# Curated table -> attribute of the run that builds it, in build order.
CURATED_ATTRIBUTES = {
    "eligibility_span": "spans",
    "member_assignment": "assignments",
    "fact_member_month": "member_months",
    "claim_header_version": "headers",
    "claim_line_version": "lines",
    "fact_claim_header_final": "finals",
    "fact_claim_line_final": "final_lines",
    "fact_payment_transaction": "payments",
    "fact_capitation_transaction": "capitation",
    "dq_result": "dq_result",
}
CURATED = tuple(name for name in CURATED_ATTRIBUTES if name in TABLES)

VIEWS = ("v_partition_status", "v_primary_exposure", "v_exposure_month", "v_ffs_spend_month",
         "v_ffs_claims_month", "v_ffs_category_month", "v_encounter_month",
         "v_capitation_month", "v_kpi_ffs_month", "v_kpi_managed_care_month",
         "v_kpi_period_membership", "v_kpi_ffs_category_month")


@dataclass
class FinanceRun:
    """One run over a set of input tables.

    Every table is a lazy DataFrame built from the ones before it. ``curated``
    holds tables that are already written; they are read instead of rebuilt.
    """

    inputs: dict[str, DataFrame]
    run_id: str
    mapping_version: str
    curated: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, table: str) -> DataFrame:
        return self.inputs[table]

    @property
    def _dims(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self["dim_member"], self["dim_market"], self["dim_plan"]

    @cached_property
    def spans(self) -> DataFrame:
        return self.curated.get("eligibility_span") or exposure.eligibility_spans(
            self["raw_eligibility_span"], *self._dims, self.run_id)

    @cached_property
    def assignments(self) -> DataFrame:
        return self.curated.get("member_assignment") or exposure.member_assignments(
            self.spans, self["dim_date"])

    @cached_property
    def member_months(self) -> DataFrame:
        return self.curated.get("fact_member_month") or exposure.member_months(self.assignments)

    @cached_property
    def headers(self) -> DataFrame:
        return self.curated.get("claim_header_version") or claims.claim_header_versions(
            self["raw_claim_header"], *self._dims, self.run_id)

    @cached_property
    def lines(self) -> DataFrame:
        return self.curated.get("claim_line_version") or claims.claim_line_versions(
            self["raw_claim_line"], self.headers, self["service_category_map"],
            self["dim_provider"], self.run_id, self.mapping_version)

    @cached_property
    def finals(self) -> DataFrame:
        return self.curated.get("fact_claim_header_final") or claims.claim_finals(
            self.headers, self.member_months, self["pipeline_run"], self.run_id)

    @cached_property
    def final_lines(self) -> DataFrame:
        return self.curated.get("fact_claim_line_final") or claims.claim_line_finals(
            self.finals, self.lines)

    @cached_property
    def payments(self) -> DataFrame:
        return self.curated.get("fact_payment_transaction") or ledger.payment_ledger(
            self["raw_payment_transaction"], self.headers, self.run_id)

    @cached_property
    def capitation(self) -> DataFrame:
        return self.curated.get("fact_capitation_transaction") or ledger.capitation_ledger(
            self["raw_capitation_transaction"], *self._dims, self.run_id)

    def staged(self, *tables: str, unread: tuple[str, ...] = ()) -> "FinanceRun":
        """The same run with the named tables written once to the shared folder.

        For work in which several rules and measures read one curated table.
        Tables are staged in the given order and build on each other. Columns that nothing
        after it reads are not written.
        """
        run = self
        for table in tables:
            df = run.curated_table(table)
            run = FinanceRun(self.inputs, self.run_id, self.mapping_version,
                             {**run.curated, table: stage(df.drop(*unread), table)})
        return run

    def landed(self, *tables: str) -> "FinanceRun":
        """The same run with the named inputs written once to the shared folder.

        For work in which several tables and rules read inputs that are derived.
        """
        inputs = copy(self.inputs)
        for table in tables:
            inputs[table] = stage(self[table], table)
        return FinanceRun(inputs, self.run_id, self.mapping_version, self.curated)

    # evidence

    @cached_property
    def unbalanced_headers(self) -> DataFrame:
        return quality.unbalanced_headers(
            self.headers, self["raw_claim_line"], self.lines, self["service_category_map"],
            self.run_id, self.mapping_version)

    @cached_property
    def family_balances(self) -> DataFrame:
        return quality.family_balances(
            self.payments, self.finals, self["pipeline_run"], self.run_id)

    def rule(self, rule_id: str) -> DataFrame:
        """Result rows of one rule."""
        run = self.run_id
        return {
            "DQ_ELIG_DUPLICATE_KEY": lambda: quality.duplicate_span_keys(
                self["raw_eligibility_span"], run),
            "DQ_ELIG_UNRESOLVED_REFERENCE": lambda: quality.unresolved_span_references(
                self["raw_eligibility_span"], *self._dims, run),
            "DQ_LINE_UNMAPPED_SERVICE_CODE": lambda: quality.unmapped_service_codes(
                self["raw_claim_line"], self["raw_claim_header"],
                self["service_category_map"], run, self.mapping_version),
            "DQ_MISSING_MARKET_FEED": lambda: quality.missing_market_feeds(
                self["expected_partition"], self["source_file"], run),
            "DQ_MM_CONFLICTING_ASSIGNMENT": lambda: quality.conflicting_assignments(
                self.spans, self.assignments, run),
            "DQ_CLAIM_POPULATION_MATCH": lambda: quality.claim_population(self.finals, run),
            "DQ_HEADER_LINE_BALANCE": lambda: quality.header_line_balance(
                self.headers, self.unbalanced_headers, run),
            "DQ_LEDGER_RECONCILES_TO_CLAIMS": lambda: quality.ledger_reconciles(
                self.family_balances, run),
            "DQ_CAPITATION_CORRECTION_LINKED": lambda: quality.capitation_corrections_linked(
                self["raw_capitation_transaction"], run),
        }[rule_id]()

    @cached_property
    def dq_result(self) -> DataFrame:
        return self.curated.get("dq_result") or reduce(
            DataFrame.unionByName, [self.rule(r) for r in (*quality.RUN_RULES, quality.FEED_RULE[0])])

    @cached_property
    def quarantine(self) -> DataFrame:
        return quality.quarantine_records(
            self["raw_eligibility_span"], self["raw_claim_header"], self["raw_claim_line"],
            self["raw_capitation_transaction"], self.inputs, self.unbalanced_headers,
            self.finals, self.headers, self.run_id, self.mapping_version)

    @cached_property
    def run_status(self) -> DataFrame:
        return quality.run_status(self.dq_result)

    # measures

    @cached_property
    def partition_status(self) -> DataFrame:
        return kpis.partition_status(
            self["dim_market"], self["dim_date"],
            self["pipeline_run"].where(F.col("run_id") == self.run_id), self.dq_result)

    @cached_property
    def exposure_month(self) -> DataFrame:
        return kpis.exposure_month(self.member_months)

    @cached_property
    def kpi_ffs_month(self) -> DataFrame:
        return kpis.kpi_ffs_month(
            self.exposure_month, kpis.ffs_spend_month(self.finals, self.final_lines),
            kpis.ffs_claims_month(self.finals), self.partition_status)

    def view(self, name: str) -> DataFrame:
        """One component or measure by the name it is published under."""
        return {
            "v_partition_status": lambda: self.partition_status,
            "v_primary_exposure": lambda: kpis.primary_exposure(self.member_months),
            "v_exposure_month": lambda: self.exposure_month,
            "v_ffs_spend_month": lambda: kpis.ffs_spend_month(self.finals, self.final_lines),
            "v_ffs_claims_month": lambda: kpis.ffs_claims_month(self.finals),
            "v_ffs_category_month": lambda: kpis.ffs_category_month(
                self.finals, self.final_lines),
            "v_encounter_month": lambda: kpis.encounter_month(self.finals),
            "v_capitation_month": lambda: kpis.capitation_month(self.capitation),
            "v_kpi_ffs_month": lambda: self.kpi_ffs_month,
            "v_kpi_managed_care_month": lambda: kpis.kpi_managed_care_month(
                self.exposure_month, kpis.encounter_month(self.finals),
                kpis.capitation_month(self.capitation), self.partition_status),
            "v_kpi_period_membership": lambda: kpis.kpi_period_membership(
                self.exposure_month, self["dim_date"]),
            "v_kpi_ffs_category_month": lambda: kpis.kpi_ffs_category_month(
                kpis.ffs_category_month(self.finals, self.final_lines),
                self["dim_service_category"], self.kpi_ffs_month),
        }[name]()

    def publish_views(self) -> None:
        """Register every view for SQL; publishing again replaces the definitions."""
        store.register_views(self.views)

    @property
    def views(self) -> dict[str, DataFrame]:
        return {name: self.view(name) for name in VIEWS}

    def curated_table(self, name: str) -> DataFrame:
        return getattr(self, CURATED_ATTRIBUTES[name])

    @property
    def curated_tables(self) -> dict[str, DataFrame]:
        return {name: self.curated_table(name) for name in CURATED}

    def blockers(self, runs: DataFrame | None = None) -> DataFrame:
        runs = self["pipeline_run"] if runs is None else runs
        return preflight.blockers(
            runs, self["expected_partition"], self.dq_result, self.run_id)


def view_of_run(spark: SparkSession, view: str, run_id: str) -> DataFrame:
    """A published view of one run, read through SQL with named parameters."""
    if view not in VIEWS:
        raise ValueError(f"unknown view {view}")
    return spark.sql(
        "SELECT * FROM IDENTIFIER(:view) WHERE run_id = :run_id",
        args={"view": view, "run_id": run_id})


def release(run: FinanceRun, release_id: str, definition_version: str, provisional_from: date,
            approver: str, approved_at: datetime) -> dict:
    """The manifest entry of a run: what was expected, what passed, and under which versions.

    What the driver reads is bounded by the rules and by the months of the calendar.
    """
    row = run["pipeline_run"].where(F.col("run_id") == run.run_id).first()
    rules = run.dq_result.select("rule_id", "rule_version").distinct().collect()
    passed = run.partition_status.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("partition_status") == "AVAILABLE").alias("passed")).first()
    months = run["dim_date"].where(F.col("month_start") >= F.lit(provisional_from)).select(
        "month_start").distinct().collect()
    return {
        "release_id": release_id, "run_id": run.run_id, "definition_version": definition_version,
        "mapping_version": run.mapping_version,
        "rule_versions": sorted(f"{r['rule_id']}={r['rule_version']}" for r in rules),
        "expected_partitions": passed["n"], "passed_partitions": passed["passed"],
        "cutoff": row["as_of_cutoff"].isoformat(),
        "provisional_months": sorted(m["month_start"].isoformat() for m in months),
        "approver": approver, "approved_at": approved_at.isoformat(),
        "status": run.run_status.first()["status"]}


def execute(
    spark: SparkSession, root: str, run_id: str, mapping_version: str, config_hash: str
) -> FinanceRun:
    """Run over stored tables, publishing all curated tables with one commit.

    Tables are written to a folder of the attempt; later stages read what earlier ones
    wrote, so nothing is computed twice and a lost executor costs a task, not a lineage.
    Readers see the run when its commit is there, and then all of it. A committed run is
    read back instead of computed again; one with another configuration or mapping is
    refused. Of two attempts at one run, the first to commit stands for it.
    """
    inputs = store.scan_all(spark, root, [*OPERATIONAL, *RAW, *DIMENSIONS])
    asked = {"config_hash": config_hash, "mapping_version": mapping_version}
    store.stored_status(inputs["pipeline_run"], run_id, config_hash)
    entry = snapshots.committed(spark, root).get(run_id)
    if entry is not None:
        snapshots.check(entry, **asked)
    else:
        attempt, written = snapshots.Attempt(spark, root), {}
        for table in CURATED:
            run = FinanceRun(inputs, run_id, mapping_version, dict(written))
            written[table] = attempt.write(run.curated_table(table), table)
        status = FinanceRun(inputs, run_id, mapping_version, written).run_status.first()["status"]
        attempt.write(inputs["pipeline_run"].where(F.col("run_id") == run_id).withColumn(
            "status", F.lit(status)), "pipeline_run")
        snapshots.check(attempt.commit(run_id, status=status, **asked), **asked)
    return published(spark, root, run_id)


def published(spark: SparkSession, root: str, run_id: str) -> FinanceRun:
    """A committed run, read from its snapshot."""
    entry = snapshots.committed(spark, root).get(run_id)
    if entry is None:
        raise ValueError(f"{run_id} is not published")
    inputs = store.scan_all(spark, root, [*OPERATIONAL, *RAW, *DIMENSIONS])
    inputs["pipeline_run"] = snapshots.with_committed(inputs["pipeline_run"], spark, root)
    return FinanceRun(inputs, run_id, entry["mapping_version"], {
        t: snapshots.read(spark, root, t, {run_id: entry}) for t in CURATED})
