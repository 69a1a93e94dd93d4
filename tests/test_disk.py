"""What queries leave on the disk, and what they hold there at one time."""

import pathlib
import random

import pytest

from evenkeel.llm import shingles
from evenkeel.operators import constraints, families, reconciliation
from evenkeel.plans import finance_queries, handover_queries, planted, proxies
from evenkeel.session import shared_folder, stage
from evenkeel.sources import buckets
from tests.finance_rows import MAPPING, RUN, finance_run
from tests.llm import rows


def staged(spark):
    """Folders of the tables that were staged and are still there."""
    place = pathlib.Path(shared_folder(spark).removeprefix("file:")) / "stage"
    return set(place.iterdir()) if place.exists() else set()


def names(folders):
    return sorted(p.name.rsplit("-", 1)[0] for p in folders)


def sorted_rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture
def star(spark, monkeypatch):
    """Registered queries over the small run of the tests."""
    run = finance_run(spark)
    monkeypatch.setattr(proxies, "finance_run", lambda *a, **k: finance_run(spark))
    return run


def test_near_copies_leave_no_index(spark):
    draw, before = random.Random(5), staged(spark)
    text = rows.words(draw, 100)
    made = [(0, text, "en", "a"), (1, text + " more", "en", "a"), (2, rows.words(draw, 90), "en", "a")]
    kept = shingles.keep_one(rows.table(spark, made))
    assert names(staged(spark) - before) == ["near-copies"]
    assert {r["doc_id"] for r in kept.collect()} == {0, 2}


def test_a_query_over_staged_tables_leaves_its_result_only(spark, star):
    before = staged(spark)
    got = finance_queries._over_run(
        lambda r: r.spans, ("eligibility_span",), landed=("service_category_map",))(spark, "")
    assert names(staged(spark) - before) == ["result"]
    assert got.count() and sorted_rows(got) == sorted_rows(star.spans)


def test_drops_are_counted_table_by_table(spark, star):
    held = []

    def write(df, name):
        held.append(stage(df, name))
        return held[-1]

    asked = star.inputs, star.headers, star.lines, RUN, MAPPING
    got = reconciliation.drop_report(*asked, write)
    assert len(held) == 6 and sorted_rows(got) == sorted_rows(reconciliation.drop_report(*asked))


def test_keys_are_judged_one_constraint_at_a_time(spark):
    run = finance_run(spark)
    tables = {t: stage(run.curated_table(t), t) for t in ("claim_header_version", "fact_payment_transaction")}
    tables |= {t: stage(run[t], t) for t in ("dim_member", "pipeline_run")}
    tables["claim_header_version"] = tables["claim_header_version"].unionByName(
        tables["claim_header_version"].limit(2))
    groups = constraints._key_groups(tables)
    every = [c for g in groups for c in g]
    assert len(every) == len(set(every)) and sum(len(g) > 1 for g in groups) == 1
    assert {("claim_header_version", "UNIQUE", "claim_version_key")} in groups
    assert {("fact_payment_transaction", "REFERENCE", "reverses_transaction_id")} in groups
    before = staged(spark)
    apart = constraints.keyed_apart(tables)
    assert names(staged(spark) - before) == ["violations"] * len(groups)
    assert sorted_rows(apart) == sorted_rows(constraints.keyed_violations(tables))
    assert apart.where("violations > 0").count()


def test_tables_that_are_written_with_checks_are_removed(spark, monkeypatch):
    run, before = finance_run(spark), staged(spark)
    monkeypatch.setattr(planted, "tables", lambda *a: {
        t: stage(planted.with_planted(run[t], t), t) for t in ("dim_member", "dim_market", "dim_date")})
    got = planted.constraint_report(spark, "")
    assert names(staged(spark) - before) == ["report"] and got.where("violations > 0").count()


def test_family_summary_leaves_its_result_only(spark, star):
    before = staged(spark)
    got = handover_queries.family_summary(spark, "")
    left = names(staged(spark) - before)
    assert left == ["family-summary"]
    want = families.family_summary(families.family_tables(
        star["raw_claim_line"], star["raw_payment_transaction"], star.headers, star.finals, RUN), buckets.by_key)
    assert sorted_rows(got) == sorted_rows(want)


@pytest.mark.parametrize("query", ["stored_run", "published_runs"])
def test_inputs_of_a_stored_run_are_removed(spark, monkeypatch, query):
    before, asked = staged(spark), []
    world = finance_run(spark, "clean")

    class Inputs(dict):
        def __missing__(self, table):
            return world[table]

    def made(*_, **__):
        asked.append(stage(spark.range(1), "orders"))
        return type(world)(Inputs(), RUN, MAPPING)

    monkeypatch.setattr(proxies, "finance_run", made)
    monkeypatch.setattr(handover_queries.finance, "execute", lambda *a: (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        getattr(handover_queries, query)(spark, "")
    assert asked and not staged(spark) - before
