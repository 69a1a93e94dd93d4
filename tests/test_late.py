"""Late claim headers: equal to a full run, from the files of touched slots alone."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import claims
from evenkeel.plans.late import LateRuns, unseen
from evenkeel.sources.tables import RunConflict
from tests.finance_rows import RUN, finance_run

FIRST, LAST = date(2026, 2, 10), date(2026, 3, 31)


def rows(df):
    return sorted((tuple(r) for r in df.drop("run_id").select(sorted(set(df.columns) - {"run_id"})).collect()), key=str)


@pytest.fixture(scope="module")
def run(spark):
    return finance_run(spark)


@pytest.fixture
def runs(spark, run, tmp_path):
    return LateRuns(spark, str(tmp_path), (run["dim_member"], run["dim_market"], run["dim_plan"]),
                    run.member_months, 16)


def full(spark, run, headers, cutoff):
    context = spark.range(1).select(F.lit(RUN).alias("run_id"), F.lit(cutoff).alias("as_of_cutoff"))
    versions = claims.claim_header_versions(
        headers, run["dim_member"], run["dim_market"], run["dim_plan"], RUN)
    return claims.claim_finals(versions, run.member_months, context, RUN)


def test_late_versions_equal_a_full_run(spark, run, runs):
    landed = run["raw_claim_header"]
    late = F.col("claim_family_id").isin("SYN_C003", "SYN_C007") & (
        (F.col("version_number") == 2) | (F.col("claim_family_id") == "SYN_C007"))
    first = runs.run("R1", FIRST, landed.where(~late))
    assert rows(runs.finals("R1")) == rows(full(spark, run, landed.where(~late), FIRST))
    # Late rows, and one that was delivered before, now in another file.
    again = landed.where("claim_family_id = 'SYN_C001'").withColumn("source_file_id", F.lit("ANOTHER"))
    entry = runs.run("R2", LAST, landed.where(late).unionByName(again))
    want = rows(full(spark, run, landed, LAST))
    assert rows(runs.finals("R2")) == want and want != rows(runs.finals("R1"))
    # The second version of SYN_C002 was there, but after the first cutoff.
    changed = {r["claim_family_key"]: (r["earlier_cents"], r["later_cents"]) for r in runs.delta("R1", "R2").collect()}
    assert changed == {"SYN_C002": (10000, 12000), "SYN_C003": (8000, None), "SYN_C007": (None, 6000)}
    slot = {r["claim_family_id"]: r["s"] for r in landed.select(
        "claim_family_id", runs._slot("claim_family_id").alias("s")).collect()}
    assert entry["recomputed"] == sorted({slot[f] for f in changed})
    # Untouched slots are the files of the first run.
    kept = {s: a for s, a in first["finals"].items() if int(s) not in entry["recomputed"]}
    assert kept and kept.items() <= entry["finals"].items()


def test_untouched_files_are_not_read(spark, run, runs, tmp_path):
    landed = run["raw_claim_header"]
    runs.run("R1", LAST, landed.where("claim_family_id <> 'SYN_C007'"))
    late = landed.where("claim_family_id = 'SYN_C007'")
    slot = late.select(runs._slot("claim_family_id")).first()[0]
    # Files that cannot be read: only slots that the late row does not touch.
    spoilt = [p for table in ("landed", "fact_claim_header_final") for p in tmp_path.glob(f"{table}/*/slot=*/*.parquet")
              if p.parent.name != f"slot={slot}"]
    whole = {p: p.read_bytes() for p in spoilt}
    for p in spoilt:
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
        p.write_bytes(b"not a table")
    runs.run("R2", LAST, late)
    for p, content in whole.items():
        p.write_bytes(content)
    assert spoilt and rows(runs.finals("R2")) == rows(full(spark, run, landed, LAST))


def test_replays_empty_deliveries_and_conflicts(spark, run, runs):
    landed = run["raw_claim_header"]
    runs.run("R0", FIRST, landed.limit(0))
    assert runs.finals("R0").count() == 0
    one = runs.run("R1", FIRST, landed.unionByName(landed))
    assert runs.run("R1", FIRST, landed.limit(0)) == one
    assert runs.run("R2", FIRST, landed)["recomputed"] == []
    assert rows(runs.finals("R2")) == rows(full(spark, run, landed, FIRST))
    assert runs.delta("R1", "R2").count() == 0
    with pytest.raises(RunConflict):
        runs.run("R1", LAST, landed)
    with pytest.raises(RunConflict):
        runs.run("R3", date(2026, 1, 1), landed)


def test_delivered_rows_are_shuffled_once_and_known_contents_are_left_out(spark, run, runs):
    landed = run["raw_claim_header"].withColumn("slot", runs._slot("claim_family_id"))
    elsewhere = landed.withColumn("source_file_id", F.lit("ZZZ"))
    nameless = landed.limit(1).withColumns({
        "claim_family_id": F.lit(None).cast("string"), "slot": F.lit(3)})
    delivered = landed.unionByName(elsewhere).unionByName(nameless)
    known = elsewhere.where("claim_family_id = 'SYN_C001'").unionByName(nameless)
    got = unseen(delivered, known)
    want = landed.where("claim_family_id <> 'SYN_C001'").unionByName(nameless)
    assert got.columns == delivered.columns
    assert rows(got) == rows(want)
    assert rows(unseen(delivered, None)) == rows(landed.unionByName(nameless))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan, plan
