"""Hot keys against brute force, and plans that must keep their shape."""

import random
import re
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import claims, exposure
from evenkeel.plans import registry
from evenkeel.sources import arrivals
from evenkeel.sources import tables as store

from tests.finance_rows import LANDED_AT, RUN, finance_run, frame, world


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def spans():
    """Spans of a few members; one of them holds more than a third of all."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        member = 1 if rng.random() < 0.5 else rng.randint(2, 30)
        start = date(2025, 11, 15) + timedelta(days=rng.randint(0, 140))
        rows.append({
            "eligibility_span_id": f"E{i}", "run_id": RUN, "member_key": member,
            "market_key": 1, "plan_key": 1, "program": "MEDICAID",
            "benefit_scope": "LIMITED" if member > 20 and i % 7 == 0 else "FULL",
            "eligibility_group": "ADULT", "delivery_system": "FFS", "start_date": start,
            "end_date": start + timedelta(days=rng.randint(-2, 50)),
            "source_file_id": "F", "source_row_id": str(i)})
    return rows


def test_member_months_equal_day_by_day(spark, spans):
    days, kinds = defaultdict(set), defaultdict(set)
    for row in spans:
        day = max(row["start_date"], date(2026, 1, 1))
        while day <= min(row["end_date"], date(2026, 3, 31)):
            key = (row["member_key"], day.replace(day=1))
            days[key].add(day)
            kinds[key].add(row["benefit_scope"])
            day += timedelta(days=1)
    expected = {k: len(v) for k, v in days.items() if len(kinds[k]) == 1}
    clash = {k for k in days if len(kinds[k]) > 1}
    calendar = arrivals.calendar_between(spark, "2026-01-01", "2026-03-31")
    held = exposure.member_assignments(frame(spark, "eligibility_span", spans), calendar)
    got = {(r["member_key"], r["month_start"]): r["eligible_days"]
           for r in exposure.member_months(held).collect()}
    assert got == expected
    assert {(r["member_key"], r["month_start"])
            for r in exposure.conflicting_member_months(held).collect()} == clash
    assert clash


def test_hot_family_resolves_to_its_last_version(spark):
    rng = random.Random(11)
    rows = []
    for i in range(300):
        family = "HOT" if i % 3 else f"F{rng.randint(0, 40)}"
        rows.append({
            "claim_version_key": f"{family}:{i + 1}", "run_id": RUN, "claim_family_key": family,
            "version_number": i + 1, "member_key": 1, "market_key": 1, "plan_key": 1,
            "claim_file_type": "OT", "record_type": "FFS",
            "status": rng.choice(["ACCEPTED", "VOID", "DENIED"]),
            "service_start_date": date(2026, 1, 1), "service_end_date": date(2026, 1, 2),
            "adjudicated_at": date(2026, 1, 1) + timedelta(days=rng.randint(0, 60)),
            "header_paid_amount_cents": i, "source_file_id": "F", "source_row_id": str(i)})
    cutoff = date(2026, 2, 1)
    expected = {}
    for row in sorted(rows, key=lambda r: r["version_number"]):
        if row["adjudicated_at"] <= cutoff:
            expected[row["claim_family_key"]] = row
    expected = {f: r["claim_version_key"] for f, r in expected.items() if r["status"] == "ACCEPTED"}
    runs = frame(spark, "pipeline_run", [
        {"run_id": RUN, "as_of_cutoff": cutoff, "started_at": LANDED_AT}])
    finals = claims.claim_finals(
        frame(spark, "claim_header_version", rows), frame(spark, "fact_member_month", []), runs, RUN)
    assert {r["claim_family_key"]: r["claim_version_key"] for r in finals.collect()} == expected


def test_repeated_lines_weigh_once_per_copy(spark):
    """Duplicate headers multiply lines exactly as a join of the raw rows does."""
    def change(table, rows):
        if table == "raw_claim_header":
            rows.append(dict(rows[-1], source_row_id="HDR_900"))
        if table == "raw_claim_line":
            rows += [dict(rows[-1], source_row_id=f"LIN_9{i}", line_number=i) for i in range(2, 9)]
        return rows
    rule = finance_run(spark, change=change).rule("DQ_LINE_UNMAPPED_SERVICE_CODE").first()
    assert (rule["evaluated_count"], rule["failing_row_count"],
            rule["financial_impact_cents"]) == (17, 16, 96000)


def test_run_filter_prunes_partitions(spark, tmp_path):
    store.write(world(spark)["raw_claim_line"], str(tmp_path), "raw_claim_line")
    df = store.scan(spark, str(tmp_path), "raw_claim_line", RUN).select(
        "claim_family_id").where(F.col("version_number") == 1)
    text = plan(df)
    assert "PartitionFilters: [isnotnull(run_id" in text
    assert "PushedFilters: [IsNotNull(version_number), EqualTo(version_number,1)]" in text
    assert "ReadSchema: struct<claim_family_id:string,version_number:bigint>" in text


def test_writing_one_run_keeps_the_others(spark, tmp_path):
    lines = world(spark)["raw_claim_line"]
    root = str(tmp_path)
    store.write(lines.unionByName(lines.withColumn("run_id", F.lit("OTHER"))), root, "raw_claim_line")
    store.write(lines.limit(1).withColumn("run_id", F.lit("OTHER")), root, "raw_claim_line")
    assert store.scan(spark, root, "raw_claim_line", RUN).count() == 10
    assert store.scan(spark, root, "raw_claim_line", "OTHER").count() == 1


def test_no_range_or_cross_join_in_exposure(spark, spans):
    calendar = arrivals.calendar_between(spark, "2026-01-01", "2026-03-31")
    df = exposure.member_months(exposure.member_assignments(
        frame(spark, "eligibility_span", spans), calendar))
    text = plan(df)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_resolution_has_no_window_and_no_python(spark):
    run = finance_run(spark)
    for df in (run.finals, run.view("v_kpi_ffs_month")):
        text = plan(df)
        assert "Window" not in text and "Python" not in text and "Cartesian" not in text


def test_fingerprint_ignores_order_and_counts_copies(spark):
    rows = [("r", "m", date(2026, 1, 1), str(i)) for i in range(20)]
    schema = "run_id string, market_id string, month_start date, v string"

    def fingerprint(data):
        df = spark.createDataFrame(data, schema).select(
            "run_id", "market_id", "month_start",
            arrivals.row_fingerprint("v").alias("fingerprint"))
        return df.agg(arrivals.content_fingerprint(F.col("fingerprint"))).first()[0]

    assert fingerprint(rows) == fingerprint(rows[::-1])
    assert fingerprint(rows) != fingerprint(rows + rows[:1])
    assert fingerprint(rows + rows[:1]) != fingerprint(rows + rows[1:2])


def test_fingerprint_tells_values_apart(spark):
    def fingerprint(data):
        df = spark.createDataFrame(data, "a string, b string").select(
            arrivals.row_fingerprint("a", "b").alias("fingerprint"))
        return df.agg(arrivals.content_fingerprint(F.col("fingerprint"))).first()[0]

    different = [
        [("", "x")], [(None, "x")], [("x", None)], [("a|b", "c")], [("a", "b|c")], [("a;1:b", "c")], [("a", "b;1:c")],
        [("N;", None)], [(None, "N;")], [("a", "b"), ("c", "d")], [("a", "d"), ("c", "b")], [("b", "a"), ("d", "c")],
        [("a", "b")], [("a", "b")] * 2, [("a", "b")] * 3, [("é", "x")], [("e", "\u0301x")]]
    found = [fingerprint(rows) for rows in different]
    assert len(set(found)) == len(found) and all(len(h) == 64 for h in found)
    assert fingerprint([("a", "b"), ("c", None)]) == fingerprint([("c", None), ("a", "b")])


def test_entry_queries_are_registered_with_oracles():
    import __spark_entry__ as entry
    assert set(registry.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_claim_versions_aggregate_by_hash_and_are_written_once(spark, tmp_path):
    from datetime import datetime

    from evenkeel.plans import proxies
    rows = [(1, 1, "R", "F"), (1, 1, "N", "O"), (1, 2, "R", "F"), (1, 3, "Z", "F"), (1, 4, "R", "A"),
            (1, 5, None, None)]
    spark.createDataFrame(
        [(o, 1, 1, n, 1.0, 2.0, 0.0, 0.0, flag, status, datetime(1998, 1, n)) for o, n, flag, status in rows],
        proxies.STAR_SCHEMAS["lineitem"]).write.parquet(str(tmp_path / "lineitem.parquet"))
    versions = proxies.claim_versions(spark, str(tmp_path))
    got = {r["l_linenumber"]: (r["flag"], r["line_status"], r["paid"]) for r in versions.collect()}
    assert got == {1: (0, 0, 400), 2: (0, 0, 200), 3: (1, 0, 200), 4: (0, -1, 200), 5: (None, None, 200)}
    assert "SortAggregate" not in plan(versions)
    inputs = proxies.FinanceInputs(spark, str(tmp_path), shared=True)
    assert inputs.versions is inputs.versions
    assert "stage/versions" in inputs.versions.inputFiles()[0]


def test_no_sort_starts_with_what_is_alike_in_all_rows(spark):
    """A sort compares the first eight bytes of its first key before it looks at rows."""
    run = finance_run(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {name: plan(df) for name, df in {
            "headers": run.headers, "lines": run.lines, "finals": run.finals, "final_lines": run.final_lines,
            "payments": run.payments, "balances": run.family_balances, "assignments": run.assignments,
            "unbalanced": run.unbalanced_headers}.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plans["headers"] and "SortAggregate" in plans["finals"]
    firsts = {name: set(re.findall(r"Sort \[(\w+)#", text)) for name, text in plans.items()}
    assert all(firsts.values())
    assert not [n for n, found in firsts.items() if found & {"run_id", "member_id", "provider_id"}], firsts


def test_lines_whose_code_is_mapped_everywhere_meet_no_headers(spark):
    """The rule counts what a plain join counts, and only lines that may fail go to it."""
    from evenkeel.operators import quality
    maps = [("IP", "A"), ("RX", "A"), ("IP", "B"), ("RX", None), (None, "C")]
    mapping = frame(spark, "service_category_map", [
        {"mapping_version": "M", "claim_file_type": t, "service_code": c, "category_key": 1,
         "effective_start": date(2025, 1, 1)} for t, c in maps])
    codes = ["A", "A", "B", "C", None, "Z"]
    lines = frame(spark, "raw_claim_line", [
        {"run_id": RUN, "claim_family_id": f"F{f}", "version_number": 1, "line_number": i,
         "service_code": c, "line_paid_amount_cents": 10 ** i}
        for f in range(4) for i, c in enumerate(codes)])

    def headers(types):
        return frame(spark, "raw_claim_header", [
            {"run_id": RUN, "claim_family_id": f"F{f}", "version_number": 1, "claim_file_type": t}
            for f, t in enumerate(types)])

    for types, kept in ((["IP", "RX", "IP", "IP"], 16), (["IP", "RX", "IP", "LT"], 24), (["IP", "RX", None], 24)):
        expected = [10 ** i for f, t in enumerate(types) for i, c in enumerate(codes)
                    if t is None or c is None or (t, c) not in maps]
        rule = quality.unmapped_service_codes(lines, headers(types), mapping, RUN, "M").first()
        assert (rule["evaluated_count"], rule["failing_row_count"], rule["financial_impact_cents"]) == (
            24, len(expected), sum(expected))
        assert quality.maybe_unmapped(lines, headers(types), mapping, "M").count() == kept


def test_inputs_are_written_once_without_columns_that_nothing_reads(spark):
    plain = finance_run(spark)
    run = plain.landed("raw_claim_header", "service_category_map")
    assert "stage/raw_claim_header" in run["raw_claim_header"].inputFiles()[0]
    assert "stage/raw_claim_header" not in str(plain["raw_claim_header"].inputFiles())
    staged = run.staged("claim_header_version", "claim_line_version", unread=("source_file_id", "source_row_id"))
    assert not {"source_file_id", "source_row_id"} & set(staged.headers.columns)
    assert sorted(map(str, staged.dq_result.collect())) == sorted(map(str, plain.dq_result.collect()))


def test_landed_rows_of_a_run_meet_without_its_name(spark):
    """What is the same in all rows is neither shuffled nor sorted with them."""
    run = finance_run(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (run.lines, run.payments, run.headers):
            assert not re.findall(r"(?:Exchange hashpartitioning|Sort )[\[(][^\n]*run_id", plan(df))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    both = {t: df.unionByName(df.withColumn("run_id", F.lit("OTHER"))) if "run_id" in df.columns else df
            for t, df in run.inputs.items()}
    again = type(run)(both, RUN, run.mapping_version)
    for name in ("headers", "lines", "payments", "finals", "dq_result"):
        assert sorted(map(str, getattr(again, name).collect())) == sorted(map(str, getattr(run, name).collect()))
