"""Resolution, evidence and measures against hand-derived numbers."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import claims, constraints, exposure, kpis
from evenkeel.plans import finance
from evenkeel.sources import snapshots
from evenkeel.sources import tables as store

from tests.finance_rows import (
    EXPECTED_RULES, MAPPING, RUN, by, finance_run, frame, rows_of, total, world)


@pytest.fixture(scope="module")
def run(spark):
    built = finance_run(spark)
    # Small literal tables: keep the curated layer so each test is one short job.
    curated = {name: df.cache() for name, df in built.curated_tables.items()}
    return finance.FinanceRun(built.inputs, RUN, MAPPING, curated)


@pytest.fixture(scope="module")
def clean(spark):
    built = finance_run(spark, "clean")
    curated = {name: df.cache() for name, df in built.curated_tables.items()}
    return finance.FinanceRun(built.inputs, RUN, MAPPING, curated)


def test_row_counts(run):
    counts = {r["table_name"]: r["row_count"]
              for r in store.table_counts(run.curated_tables).collect()}
    assert counts == {
        "eligibility_span": 7, "fact_member_month": 11, "claim_header_version": 9,
        "claim_line_version": 9, "fact_claim_header_final": 5, "fact_claim_line_final": 5,
        "fact_payment_transaction": 8, "fact_capitation_transaction": 4, "dq_result": 14}


def test_partial_month_keeps_days_and_weighs_one(run):
    row = by(run.member_months, "member_key", "month_start")[(3, "2026-01-01")]
    assert (row["eligible_days"], row["member_month_weight"]) == (12, 1)


def test_lowest_source_row_survives(run):
    assert by(run.spans, "eligibility_span_id")["SYN_ELG_001"]["source_row_id"] == "ELG_001"


def test_replacement_and_void(run):
    finals = by(run.finals, "claim_family_key")
    assert finals["SYN_C002"]["claim_version_key"] == "SYN_C002:2"
    assert finals["SYN_C002"]["header_paid_amount_cents"] == 12000
    assert "SYN_C003" not in finals and "SYN_C004" not in finals
    headers = by(run.headers, "claim_version_key")
    assert headers["SYN_C002:2"]["replaces_version_key"] == "SYN_C002:1"
    assert headers["SYN_C002:1"]["replaces_version_key"] is None


def test_stated_predecessor_must_exist(spark):
    def change(table, rows):
        for row in rows:
            if row.get("replaces_version_id") == "SYN_C002:1":
                row["replaces_version_id"] = "SYN_C002:7"
            elif row.get("replaces_version_id") == "SYN_C003:1":
                row["replaces_version_id"] = "nocolon"
        return rows
    headers = by(finance_run(spark, change=change).headers, "claim_version_key")
    assert {h["replaces_version_key"] for h in headers.values()} == {None}


def test_numbered_versions_match_global_order(run):
    numbered = claims.numbered_versions(run.headers).collect()
    order = sorted(numbered, key=lambda r: (r["claim_family_key"], r["version_number"]))
    assert [r["claim_version_number"] for r in order] == list(range(1, 10))


def test_cutoff_hides_later_versions(spark):
    tables = world(spark)
    tables["pipeline_run"] = tables["pipeline_run"].withColumn(
        "as_of_cutoff", F.lit("2026-02-10").cast("date"))
    finals = by(finance.FinanceRun(tables, RUN, MAPPING).finals, "claim_family_key")
    assert finals["SYN_C002"]["claim_version_key"] == "SYN_C002:1"
    assert "SYN_C007" not in finals


def test_ledger(run):
    balances = by(run.family_balances, "claim_family_key")
    assert balances["SYN_C002"]["ledger_cents"] == 12000
    assert balances["SYN_C003"]["ledger_cents"] == 0
    assert not any(b["is_unreconciled"] for b in balances.values())


def test_defects_are_found_and_nothing_else(run, clean):
    failing = {r["rule_id"] for r in run.dq_result.where("disposition = 'FAIL'").collect()}
    assert failing == EXPECTED_RULES
    assert clean.dq_result.where("disposition = 'FAIL'").count() == 0
    rules = by(run.dq_result, "rule_id", "market_id", "month_start")
    unmapped = rules[("DQ_LINE_UNMAPPED_SERVICE_CODE", "ALL", "ALL")]
    assert (unmapped["evaluated_count"], unmapped["failing_row_count"],
            unmapped["financial_impact_cents"]) == (10, 1, 6000)
    duplicate = rules[("DQ_ELIG_DUPLICATE_KEY", "ALL", "ALL")]
    assert (duplicate["evaluated_count"], duplicate["failing_row_count"]) == (8, 1)
    assert rules[("DQ_MISSING_MARKET_FEED", "SYN_MKT_C", "2026-02-01")]["disposition"] == "FAIL"
    assert rules[("DQ_MISSING_MARKET_FEED", "SYN_MKT_B", "2026-02-01")]["disposition"] == "PASS"


def test_empty_file_is_registered(run):
    files = by(run["source_file"], "source_file_id")
    assert files["SRC_CLAIMS_SYN_MKT_B_2026-02-01"]["row_count"] == 0
    assert files["SRC_CLAIMS_SYN_MKT_A_2026-02-01"]["row_count"] == 6


def test_run_status(run, clean):
    assert run.run_status.first()["status"] == "FAILED"
    assert clean.run_status.first()["status"] == "READY_FOR_REVIEW"


def test_ffs_measures(run):
    ffs = by(run.view("v_kpi_ffs_month"), "month_start", "market_key")
    a = ffs[("2026-01-01", 1)]
    assert (a["member_months"], a["distinct_members"], a["ffs_paid_cents"],
            a["ffs_claim_count"], a["ffs_pmpm_cents"]) == (3, 3, 12000, 1, 4000.0)
    b = ffs[("2026-01-01", 2)]
    assert (b["ffs_paid_cents"], b["ffs_claim_count"], b["ffs_avg_claim_cost_cents"]) == (0, 0, None)
    feb = ffs[("2026-02-01", 1)]
    assert (feb["member_months"], feb["ffs_paid_cents"], feb["ffs_claim_count"],
            feb["ffs_pmpm_cents"], feb["ffs_avg_claim_cost_cents"]) == (1, 12000, 2, 12000.0, 6000.0)
    january = [v for k, v in ffs.items() if k[0] == "2026-01-01"]
    assert sum(v["ffs_paid_cents"] for v in january) == 16500
    assert sum(v["member_months"] for v in january) == 5


def test_category_measures(run):
    rows = by(run.view("v_kpi_ffs_category_month"), "month_start", "market_key", "category_code")
    assert rows[("2026-01-01", 1, "OUTPATIENT")]["category_paid_cents"] == 7000
    assert rows[("2026-01-01", 1, "PROFESSIONAL")]["category_paid_cents"] == 5000
    january_a = [v for k, v in rows.items() if k[:2] == ("2026-01-01", 1)]
    assert sum(v["claims_containing_category"] for v in january_a) == 2
    assert sum(v["ffs_spend_share_pct"] for v in january_a) == pytest.approx(100)
    assert sum(v["category_contribution_to_pmpm_cents"] for v in january_a) == pytest.approx(4000)


def test_managed_care_measures(run):
    row = by(run.view("v_kpi_managed_care_month"), "month_start", "market_key")[("2026-01-01", 2)]
    assert (row["capitation_cents"], row["encounter_count"]) == (47500, 1)
    columns = run.view("v_encounter_month").columns
    assert not [c for c in columns if "cents" in c]


def test_exposure_is_split_by_delivery(run):
    assert total(run.view("v_kpi_ffs_month"), "member_months") == 7
    assert total(run.view("v_kpi_managed_care_month"), "member_months") == 2


def test_average_membership(run):
    rows = by(run.view("v_kpi_period_membership"), "market_key", "delivery_system")
    assert rows[(1, "FFS")]["average_monthly_membership"] == 2.0
    assert rows[(2, "FFS")]["average_monthly_membership"] is None


def test_partition_status(run, spark):
    assert {r["partition_status"] for r in run.partition_status.collect()} == {"UNAVAILABLE_RUN"}
    passing = run.dq_result.withColumn(
        "disposition", F.when(F.col("market_id") == "ALL", "PASS").otherwise(F.col("disposition")))
    status = kpis.partition_status(
        run["dim_market"], run["dim_date"], run["pipeline_run"], passing)
    bad = status.where("partition_status <> 'AVAILABLE'").collect()
    assert [(r["market_key"], r["month_start"], r["partition_status"]) for r in bad] == [
        (3, date(2026, 2, 1), "UNAVAILABLE_PARTITION")]


@pytest.mark.parametrize("market,plan", [("SYN_MKT_B", "SYN_PLAN_B_FFS"),
                                         ("SYN_MKT_A", "SYN_PLAN_A1")])
def test_assignment_mismatch_conflicts(spark, market, plan):
    def change(table, rows):
        if table == "raw_claim_header":
            for row in rows:
                if row["claim_family_id"] == "SYN_C001":
                    row |= {"market_id": market, "plan_id": plan}
        return rows
    built = finance_run(spark, change=change)
    assert by(built.finals, "claim_family_key")["SYN_C001"]["population_match"] == \
        "CONFLICTING_EXPOSURE"
    assert built.rule("DQ_CLAIM_POPULATION_MATCH").first()["disposition"] == "FAIL"


def test_out_of_cohort_is_valid(spark):
    def change(table, rows):
        for row in rows:
            if table == "raw_claim_header" and row["member_id"] == "SYN_M001":
                row["member_id"] = "SYN_M005"
        return rows
    built = finance_run(spark, "clean", change)
    rule = built.rule("DQ_CLAIM_POPULATION_MATCH").first()
    assert (rule["disposition"], rule["failing_row_count"], rule["financial_impact_cents"]) == \
        ("PASS", 0, 0)
    assert built.finals.where("population_match = 'OUT_OF_COHORT'").count() == 3


def test_conflicting_member_month_has_no_exposure(spark):
    def change(table, rows):
        if table == "raw_eligibility_span":
            extra = dict(rows[0], source_row_id="ELG_900", eligibility_span_id="SYN_ELG_900",
                         benefit_scope="LIMITED", start_date=date(2026, 1, 31),
                         end_date=date(2026, 1, 31))
            rows.append(extra)
        return rows
    built = finance_run(spark, change=change)
    conflicts = exposure.conflicting_member_months(built.assignments).collect()
    assert [(r["member_key"], r["month_start"]) for r in conflicts] == [(1, date(2026, 1, 1))]
    assert by(built.finals, "claim_family_key")["SYN_C001"]["population_match"] == "NO_EXPOSURE"
    rule = built.rule("DQ_MM_CONFLICTING_ASSIGNMENT").first()
    assert (rule["evaluated_count"], rule["failing_row_count"]) == (8, 1)


def test_open_ended_spans_stop_at_the_calendar(spark, run):
    open_span = run.spans.limit(1).withColumn("end_date", F.lit("9999-12-31").cast("date"))
    months = exposure.covered_months(open_span, run["dim_date"])
    assert months.count() == 2


def test_unbalanced_header(spark):
    def change(table, rows):
        for row in rows:
            if table == "raw_claim_line" and row["source_row_id"] == "LIN_009":
                row["line_paid_amount_cents"] = 4400
        return rows
    rule = finance_run(spark, change=change).rule("DQ_HEADER_LINE_BALANCE").first()
    assert (rule["failing_row_count"], rule["disposition"]) == (1, "FAIL")


def test_missing_plan_counts_without_turning_the_verdict(spark):
    def change(table, rows):
        if table == "raw_eligibility_span":
            rows[1]["plan_id"] = "SYN_PLAN_NONE"
        return rows
    rule = finance_run(spark, change=change).rule("DQ_ELIG_UNRESOLVED_REFERENCE").first()
    assert (rule["failing_row_count"], rule["disposition"]) == (1, "PASS")


def test_quarantine_names_rows(run):
    found = {(r["rule_id"], r["source_row_id"]) for r in run.quarantine.collect()}
    assert found == {("DQ_ELIG_DUPLICATE_KEY", "ELG_008"),
                     ("DQ_LINE_UNMAPPED_SERVICE_CODE", "LIN_010")}


def test_preflight_clean(clean):
    ready = clean["pipeline_run"].withColumn("status", F.lit("READY_FOR_REVIEW"))
    assert clean.blockers(ready).count() == 0
    from evenkeel.operators.preflight import assessment
    row = assessment(ready, clean["expected_partition"], clean.dq_result, RUN).first()
    assert (row["expected_checks"], row["observed_checks"],
            row["eligible_for_submission"]) == (14, 14, True)


def test_preflight_defects_survive_a_forced_status(run):
    ready = run["pipeline_run"].withColumn("status", F.lit("READY_FOR_REVIEW"))
    codes = [r["code"] for r in run.blockers(ready).collect()]
    assert codes == ["RULE_NOT_PASSED"] * 3


@pytest.mark.parametrize("mutate,code", [
    (lambda dq: dq.where("rule_id <> 'DQ_HEADER_LINE_BALANCE'"), "MISSING_CHECK"),
    (lambda dq: dq.withColumn("rule_version", F.when(
        F.col("rule_id") == "DQ_CLAIM_POPULATION_MATCH", "old").otherwise(
        F.col("rule_version"))), "UNEXPECTED_CHECK"),
    (lambda dq: dq.withColumn("disposition", F.when(
        F.col("rule_id") == "DQ_HEADER_LINE_BALANCE", "NOT_EVALUATED").otherwise(
        F.col("disposition"))), "RULE_NOT_PASSED"),
    (lambda dq: dq.withColumn("failing_row_count", F.lit(1)), "RULE_NOT_PASSED"),
    (lambda dq: dq.unionByName(dq), "DUPLICATE_CHECK"),
])
def test_preflight_mutations(clean, mutate, code):
    from evenkeel.operators.preflight import blockers
    ready = clean["pipeline_run"].withColumn("status", F.lit("READY_FOR_REVIEW"))
    found = blockers(ready, clean["expected_partition"], mutate(clean.dq_result), RUN)
    assert code in {r["code"] for r in found.collect()}


def test_preflight_run_and_partitions(clean):
    from evenkeel.operators.preflight import blockers
    created = blockers(clean["pipeline_run"], clean["expected_partition"], clean.dq_result, RUN)
    assert {r["code"] for r in created.collect()} == {"RUN_NOT_READY"}
    ready = clean["pipeline_run"].withColumn("status", F.lit("READY_FOR_REVIEW"))
    bare = blockers(ready, clean["expected_partition"].limit(0), clean.dq_result, RUN)
    assert {r["code"] for r in bare.collect()} == {"NO_EXPECTED_PARTITIONS", "UNEXPECTED_CHECK"}
    unknown = blockers(ready, clean["expected_partition"], clean.dq_result, "UNKNOWN")
    assert [r["code"] for r in unknown.collect()] == ["UNKNOWN_RUN"]


def test_constraints_hold_on_the_clean_run(clean):
    tables = {**clean.inputs, **clean.curated_tables}
    bad = constraints.constraint_violations(tables).where("violations <> 0").collect()
    assert bad == []


def test_checked_writes_count_what_separate_passes_count(clean, spark):
    from evenkeel.session import stage
    tables = {t: stage(df, t) for t, df in {**clean.inputs, **clean.curated_tables}.items()}
    tables["claim_header_version"] = tables["claim_header_version"].withColumn("status", F.lit("ODD"))
    tables["raw_claim_line"] = tables["raw_claim_line"].unionByName(tables["raw_claim_line"].limit(2)).withColumn(
        "source_file_id", F.lit("LOST"))
    tables["fact_payment_transaction"] = tables["fact_payment_transaction"].limit(0)
    report, stored, rows = constraints.checked_writes(tables, stage)
    key = lambda r: (r["table_name"], r["constraint_kind"], r["constraint_name"])
    got = {key(r): r["violations"] for r in report.collect()}
    want = {key(r): r["violations"] for r in constraints.constraint_violations(tables).collect()}
    assert got == want and sum(n > 0 for n in got.values()) >= 3
    assert sorted(got) == sorted(constraints.constraint_names({t: df.columns for t, df in tables.items()}))
    assert rows == {t: df.count() for t, df in stored.items()}
    text = constraints.keyed_violations(stored)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text


def test_keys_of_all_tables_are_judged_without_generated_rows(clean, spark):
    from evenkeel.session import stage
    tables = {t: clean.curated_tables[t] for t in ("claim_header_version", "eligibility_span", "fact_payment_transaction")}
    tables["claim_header_version"] = tables["claim_header_version"].unionByName(
        tables["claim_header_version"].limit(1))
    tables["dim_member"] = clean["dim_member"].limit(1)
    tables = {t: stage(df, t) for t, df in tables.items()}
    counted = constraints.keyed_violations(tables)
    got = {(r["table_name"], r["constraint_kind"], r["constraint_name"]): r["violations"] for r in counted.collect()}
    for (table, kind, name), violations in got.items():
        if kind == "UNIQUE":
            found = constraints.duplicate_keys(tables[table], tuple(name.split(",")))
            assert violations == sum(r["n"] - 1 for r in found.collect())
        elif kind == "REFERENCE":
            parent, targets = next(x[1:] for x in constraints.REFERENCES[table] if x[0] == name)
            found = constraints.orphans(tables[table], tables[parent], name, targets)
            assert violations == sum(r["n"] for r in found.collect())
    assert got[("claim_header_version", "UNIQUE", "claim_version_key")] == 1
    assert got[("eligibility_span", "REFERENCE", "member_key")] > 0
    text = counted._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "SortAggregate" not in text and "Expand" in text
    every = constraints.constraint_violations(tables)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in every


@pytest.mark.parametrize("table,change,kind,name", [
    ("fact_member_month", {"eligible_days": 32}, "CHECK", "eligible_days_range"),
    ("fact_member_month", {"program": "CHIP"}, "CHECK", "cohort_definition"),
    ("fact_payment_transaction", {"signed_amount_cents": -5}, "CHECK", "sign_follows_event"),
    ("fact_payment_transaction", {"event_type": "REVERSAL"}, "CHECK", "reversal_names_payment"),
    ("fact_capitation_transaction", {"signed_amount_cents": -1, "reverses_transaction_id": None},
     "CHECK", "negative_is_linked"),
    ("claim_header_version", {"header_paid_amount_cents": None}, "CHECK", "accepted_ffs_paid"),
    ("eligibility_span", {"program": "OTHER"}, "CHECK", "program_code"),
    ("eligibility_span", {"member_key": 99}, "REFERENCE", "member_key"),
    ("eligibility_span", {"end_date": date(2020, 1, 1)}, "CHECK", "dates_ordered"),
    ("claim_line_version", {"category_key": None}, "NOT_NULL", "category_key"),
])
def test_constraints_name_the_violation(spark, clean, table, change, kind, name):
    tables = {**clean.inputs, **clean.curated_tables}
    rows = [r.asDict() for r in tables[table].orderBy(*tables[table].columns).collect()]
    target = rows if table != "claim_header_version" else [
        r for r in rows if r["record_type"] == "FFS" and r["status"] == "ACCEPTED"]
    if table == "fact_payment_transaction":
        target = [r for r in rows if r["event_type"] == "PAYMENT"]
    if table == "fact_member_month":
        target = [r for r in rows if r["in_primary_cohort"] == 1]
    target[0].update(change)
    tables[table] = frame(spark, table, rows)
    found = constraints.constraint_violations(
        {t: tables[t] for t in (table, "dim_member", "dim_market", "dim_plan")})
    assert (table, kind, name) in {
        (r["table_name"], r["constraint_kind"], r["constraint_name"])
        for r in found.where("violations > 0").collect()}


def test_chain_must_not_branch_or_cycle(spark, run):
    rows = [r.asDict() for r in run.headers.collect()]
    rows[0].update(claim_family_key="F", claim_version_key="F:2", version_number=2,
                   replaces_version_key="F:1")
    rows[1].update(claim_family_key="F", claim_version_key="F:3", version_number=3,
                   replaces_version_key="F:1")
    rows[2].update(claim_family_key="F", claim_version_key="F:1", version_number=1,
                   replaces_version_key="F:3")
    headers = frame(spark, "claim_header_version", rows)
    assert constraints.branching_versions(headers).count() == 1
    assert [r["claim_version_key"] for r in constraints.cycling_versions(headers).collect()] == [
        "F:1"]


def test_overlapping_map_is_reported(spark):
    rows = rows_of("service_category_map")
    rows.append(dict(rows[0], effective_start=date(2026, 2, 1), category_key=4))
    mapping = frame(spark, "service_category_map", rows)
    assert constraints.overlapping_mappings(mapping).count() == 1


def test_literal_rows_check_their_width(spark):
    with pytest.raises(ValueError):
        store.literal_rows(spark, "dim_market", [(1, "A")])


def test_stored_run_is_written_once_and_replayed(spark, tmp_path):
    root = str(tmp_path)
    for table, df in world(spark).items():
        store.write(df, root, table)
    first = finance.execute(spark, root, RUN, MAPPING, "defective")
    assert first["pipeline_run"].first()["status"] == "FAILED"
    again = finance.execute(spark, root, RUN, MAPPING, "defective")
    assert set(again.curated) == set(finance.CURATED)
    assert again.view("v_kpi_ffs_month").count() == first.view("v_kpi_ffs_month").count()
    with pytest.raises(store.RunConflict):
        finance.execute(spark, root, RUN, MAPPING, "clean")
    with pytest.raises(store.RunConflict):
        finance.execute(spark, root, RUN, "MAP_V2", "defective")


def test_published_views_answer_sql(spark, run):
    run.publish_views()
    run.publish_views()
    assert finance.view_of_run(spark, "v_kpi_ffs_month", RUN).count() == run.view(
        "v_kpi_ffs_month").count()
    assert finance.view_of_run(spark, "v_exposure_month", "OTHER").count() == 0
    with pytest.raises(ValueError):
        finance.view_of_run(spark, "pipeline_run", RUN)


def test_lines_follow_their_partition(run):
    from evenkeel.sources.arrivals import partition_lines
    headers = run["raw_claim_header"].where(
        "market_id = 'SYN_MKT_A' AND month(service_end_date) = 2")
    lines = partition_lines(run["raw_claim_line"], headers).collect()
    assert {r["source_row_id"] for r in lines} == {"LIN_003", "LIN_004", "LIN_010"}


def test_a_run_is_published_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path), []
    for table, df in world(spark).items():
        store.write(df, root, table)
    write = snapshots.Attempt.write

    def look() -> int:
        return sum(df.count() for df in snapshots.scan(spark, root, list(finance.CURATED)).values())

    def watched(self, df, table):
        seen.append(look())
        if len(seen) == 5:
            raise RuntimeError("the writer is lost")
        return write(self, df, table)

    monkeypatch.setattr(snapshots.Attempt, "write", watched)
    with pytest.raises(RuntimeError):
        finance.execute(spark, root, RUN, MAPPING, "defective")
    with pytest.raises(ValueError):
        finance.published(spark, root, RUN)
    run = finance.execute(spark, root, RUN, MAPPING, "defective")
    assert set(seen) == {0} and look() > 0
    assert run["pipeline_run"].first()["status"] == "FAILED"
    assert snapshots.scan(spark, root, ["dq_result"], RUN)["dq_result"].count() == run.dq_result.count() > 0
    with pytest.raises(ValueError):
        snapshots.scan(spark, root, ["dq_result"], "RUN_9")


def test_of_two_attempts_the_first_commit_stands(spark, tmp_path):
    root = str(tmp_path)
    one, other = snapshots.Attempt(spark, root), snapshots.Attempt(spark, root)
    rows = world(spark)["pipeline_run"]
    for attempt, status in ((one, "FAILED"), (other, "READY_FOR_REVIEW")):
        attempt.write(rows.withColumn("status", F.lit(status)), "pipeline_run")
    facts = {"config_hash": "c", "mapping_version": "m", "status": "-"}
    assert other.commit(RUN, **facts)["attempt"] == other.name
    assert one.commit(RUN, **facts)["attempt"] == other.name
    assert snapshots.scan(spark, root, ["pipeline_run"])["pipeline_run"].first()["status"] == "READY_FOR_REVIEW"
