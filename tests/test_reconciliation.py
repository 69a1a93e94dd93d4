"""Bridges, drops and movement against worked examples."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import reconciliation, variance
from evenkeel.sources.commits import CommitLog
from tests.finance_rows import MAPPING, RUN, by, finance_run


@pytest.fixture(scope="module")
def run(spark):
    return finance_run(spark)


MONTHS = ("run_id string, market_key long, month_start date, partition_status string, "
          "member_months long, ffs_paid_cents long, ffs_pmpm_cents double")


def months(spark, rows):
    return spark.createDataFrame(
        [("R", 1, m, "AVAILABLE", mm, paid, paid / mm if mm else None) for m, mm, paid in rows],
        MONTHS)


def test_bridge_adds_up(spark):
    # Worked example: 1,000 MM and $200,000, then 1,100 MM and $231,000.
    data = months(spark, [(date(2025, 1, 1), 1000, 20_000_000), (date(2025, 2, 1), 1100, 23_100_000),
                          (date(2025, 4, 1), 10, 500)])
    rows = by(variance.ffs_variance(data), "month_start")
    feb = rows["2025-02-01"]
    assert feb["change_cents"] == 3_100_000 and feb["change_pct"] == pytest.approx(15.5)
    assert feb["membership_effect_cents"] == pytest.approx(2_000_000)
    assert feb["pmpm_effect_cents"] == pytest.approx(1_100_000)
    assert feb["is_material"] is True
    assert rows["2025-04-01"]["change_cents"] is None
    assert rows["2025-01-01"]["is_material"] is False


def test_new_activity(spark):
    data = months(spark, [(date(2025, 1, 1), 10, 0), (date(2025, 2, 1), 10, 2_000_000)])
    feb = by(variance.ffs_variance(data), "month_start")["2025-02-01"]
    assert (feb["change_pct"], feb["is_new_activity"], feb["is_material"]) == (None, True, True)


@pytest.mark.parametrize("pmpm,provisional,outcome,score", [
    (20_040, date(2026, 1, 1), "NO_CANDIDATE", 5.396),
    (21_500, date(2026, 1, 1), "CANDIDATE", 202.35),
    (21_500, date(2025, 1, 1), "PRELIMINARY_ADVISORY", None),
])
def test_quiet_history(spark, pmpm, provisional, outcome, score):
    # Worked example: twelve months alternating between $199.95 and $200.05.
    history = [(date(2024, m, 1), 1000, 19_995_000 if m % 2 else 20_005_000) for m in range(1, 13)]
    data = months(spark, [*history, (date(2025, 1, 1), 1000, pmpm * 1000)])
    rows = by(variance.pmpm_anomalies(data, provisional), "month_start")
    last = rows["2025-01-01"]
    assert last["outcome"] == outcome
    assert last["score"] == (pytest.approx(score, rel=1e-3) if score else None)
    assert rows["2024-12-01"]["outcome"] == "NOT_EVALUATED"


def test_gap_is_not_evaluated(spark):
    history = [(date(2023 + m // 12, m % 12 + 1, 1), 1000, 20_000_000 + m * 1000)
               for m in range(13) if m != 5]
    rows = by(variance.pmpm_anomalies(months(spark, history), date(2026, 1, 1)), "month_start")
    assert {r["outcome"] for r in rows.values()} == {"NOT_EVALUATED"}


def test_claim_bridge_keeps_every_version(run):
    bridge = reconciliation.claim_bridge(
        run["raw_claim_header"], run.headers, run.finals, run["pipeline_run"], RUN)
    rows = by(bridge, "market_id", "reason")
    assert rows[("SYN_MKT_A", "MATCHED")]["cents"] == 30000
    assert rows[("SYN_MKT_A", "SUPERSEDED")]["cents"] == 18000
    assert rows[("SYN_MKT_A", "DENIED_OR_VOID")]["versions"] == 1
    assert sum(r["versions"] for r in rows.values()) == 8


def test_drop_report(run):
    report = reconciliation.drop_report(run.inputs, run.headers, run.lines, RUN, MAPPING)
    rows = {(r["table_name"], r["reason"]): (r["rows"], r["cents"]) for r in report.collect()}
    assert rows == {("raw_eligibility_span", "span key landed before"): (1, None),
                    ("raw_claim_line", "code not mapped"): (1, 6000)}


def test_drop_report_joins_lines_to_versions_once(run):
    lines = run["raw_claim_line"]
    lost = lines.where("line_paid_amount_cents = 6000").withColumn("claim_family_id", F.lit("LOST"))
    inputs = {**run.inputs, "raw_claim_line": lines.unionByName(lost)}
    report = reconciliation.drop_report(inputs, run.headers, run.lines, RUN, MAPPING)
    rows = {(r["table_name"], r["reason"]): (r["rows"], r["cents"]) for r in report.collect()}
    assert rows[("raw_claim_line", "no header version")] == (lost.count(), 6000 * lost.count())
    assert rows[("raw_claim_line", "code not mapped")] == (1, 6000)
    # Repeated spans, lines that are placed, and payments.
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 3


def test_failure_rate(run):
    raw = [run[t] for t in ("raw_eligibility_span", "raw_claim_line")]
    row = reconciliation.quality_failure_rate(run.quarantine, raw).first()
    assert (row["failing_rows"], row["raw_rows"]) == (2, 18)
    empty = reconciliation.quality_failure_rate(
        run.quarantine.limit(0), [run["raw_claim_line"].limit(0)]).first()
    assert empty["failure_rate_pct"] is None


def test_marts(run):
    mart = by(reconciliation.finance_mart(
        run.member_months, run.finals, run.final_lines, run.capitation),
        "month_start", "plan_key", "eligibility_group")
    assert mart[("2026-01-01", 1, "ADULT")]["ffs_paid_cents"] == 12000
    managed = mart[("2026-01-01", 4, "ADULT")]
    assert (managed["capitation_cents"], managed["encounter_count"]) == (47500, 1)
    categories = reconciliation.category_mart(run.member_months, run.finals, run.final_lines)
    assert categories.where("month_start = '2026-01-01' AND plan_key = 1").count() == 2


def test_payment_months(run):
    rows = by(variance.payment_month(run.payments), "payment_month")
    assert {k: r["net_payment_cents"] for k, r in rows.items()} == {
        "2026-01-01": 16500, "2026-02-01": 18000}


def _release(number, approver="reviewer"):
    return {"release_id": f"REL_{number}", "run_id": RUN, "definition_version": "1", "mapping_version": "MAP_V1",
            "rule_versions": ["A=1", "B=2"], "expected_partitions": 6, "passed_partitions": 5,
            "cutoff": "2026-03-31", "provisional_months": ["2026-02-01"], "approver": approver,
            "approved_at": "2026-04-01T10:00:00", "status": "READY_FOR_REVIEW"}


def test_release_is_never_replaced(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "releases"))
    assert reconciliation.release_manifest(spark, log).count() == 0
    reconciliation.write_release(log, _release(1))
    with pytest.raises(reconciliation.ReleaseExists):
        reconciliation.write_release(log, _release(1, "somebody else"))
    with pytest.raises(ValueError):
        reconciliation.write_release(log, {"release_id": "REL_9"})
    reconciliation.write_release(log, _release(2))
    first, second = reconciliation.release_manifest(spark, log).orderBy("release_number").collect()
    assert (first["release_id"], first["approver"], second["release_id"]) == ("REL_1", "reviewer", "REL_2")
    assert second["provisional_months"] == [date(2026, 2, 1)] and second["rule_versions"] == ["A=1", "B=2"]


def test_of_concurrent_writers_one_wins(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: log.put(1, {"writer": i}), range(24)))
    assert won.count(True) == 1
    assert log.entries() == [{"writer": won.index(True)}]

    def write(i):
        try:
            return reconciliation.write_release(releases, _release(i % 3, f"writer {i}"))["approver"]
        except reconciliation.ReleaseExists:
            return None

    releases = CommitLog(spark, str(tmp_path / "releases"))
    with ThreadPoolExecutor(6) as pool:
        approvers = [a for a in pool.map(write, range(12)) if a]
    held = reconciliation.release_manifest(spark, releases).collect()
    assert sorted(r["release_number"] for r in held) == [1, 2, 3]
    assert sorted(r["release_id"] for r in held) == ["REL_0", "REL_1", "REL_2"]
    assert sorted(r["approver"] for r in held) == sorted(approvers)


def test_category_contributions_add_up_to_the_change(spark):
    ffs = spark.createDataFrame([
        (RUN, 1, date(2026, 1, 1), "AVAILABLE", 10, 100, 10.0), (RUN, 1, date(2026, 2, 1), "AVAILABLE", 10, 101, 10.1),
        (RUN, 1, date(2026, 3, 1), "AVAILABLE", 10, 101, 10.1), (RUN, 1, date(2026, 5, 1), "AVAILABLE", 10, 7, 0.7),
        (RUN, 2, date(2026, 1, 1), "AVAILABLE", 10, 50, 5.0), (RUN, 2, date(2026, 2, 1), "AVAILABLE", 10, 0, 0.0)],
        "run_id string, market_key long, month_start date, partition_status string, member_months long, "
        "ffs_paid_cents long, ffs_pmpm_cents double")
    parts = spark.createDataFrame([
        (RUN, 1, date(2026, 1, 1), 1, 30), (RUN, 1, date(2026, 1, 1), 2, 30), (RUN, 1, date(2026, 1, 1), 3, 30),
        (RUN, 1, date(2026, 2, 1), 1, 40), (RUN, 1, date(2026, 2, 1), 2, 0), (RUN, 1, date(2026, 3, 1), 4, 9)],
        "run_id string, market_key long, month_start date, category_key long, category_paid_cents long")
    rows = variance.category_contributions(ffs, parts).collect()
    got = {(r["market_key"], r["month_start"].month, r["category_key"]): r["contribution_cents"] for r in rows}
    assert got == {
        # 100 over three equal parts is 34, 33, 33: the lowest category has the cent that is left.
        (1, 2, 1): 101 - 34, (1, 2, 2): -33, (1, 2, 3): -33, (1, 3, 1): -101, (1, 3, 4): 101, (2, 2, None): -50}
    assert all(r["contribution_pct"] is None for r in rows if r["change_cents"] == 0)
    assert next(r for r in rows if (r["market_key"], r["category_key"]) == (1, 1) and r["month_start"].month == 2)[
        "contribution_pct"] == 6700.0


def test_category_contributions_meet_the_bridge(run):
    ffs = run.view("v_kpi_ffs_month")
    rows = variance.category_contributions(ffs, run.view("v_ffs_category_month")).collect()
    sums = {}
    for r in rows:
        key = r["market_key"], r["month_start"]
        sums[key] = sums.get(key, 0) + r["contribution_cents"]
    want = {(r["market_key"], r["month_start"]): r["change_cents"]
            for r in variance.ffs_variance(ffs).where("prior_paid_cents is not null").collect()}
    assert rows and sums == want
