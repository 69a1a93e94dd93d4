"""Family joins over buckets: the same rows as joins by key, and no exchange below them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import families
from evenkeel.sources import buckets
from tests.finance_rows import RUN, finance_run


@pytest.fixture(scope="module")
def tables(spark):
    run = finance_run(spark)
    return families.family_tables(
        run["raw_claim_line"], run["raw_payment_transaction"], run.headers, run.finals, RUN)


def rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("most_rows", [buckets.MOST_ROWS, 1, 0])
def test_families_in_buckets_and_apart(spark, tables, most_rows):
    stored = buckets.write(tables, buckets=4, most_rows=most_rows)
    apart = stored.large["headers"].select(buckets.FAMILY).distinct().count()
    counts = [Counter(r[buckets.FAMILY] for r in df.collect()) for df in tables.values()]
    with_headers = {r[buckets.FAMILY] for r in tables["headers"].collect()}
    assert apart == sum(any(c[f] > most_rows for c in counts) for f in with_headers)
    assert not stored.bucketed["lines"].join(stored.large["headers"], buckets.FAMILY, "left_semi").count()
    got = buckets.over_families(stored, families.family_summary)
    assert rows(got) == rows(families.family_summary(tables, buckets.by_key))
    one = got.where("claim_family_key = 'SYN_C002'").first()
    assert (one["versions"], one["linked_versions"], one["lines"], one["final_lines"], one["final_line_cents"]) == (
        2, 1, 2, 1, 12000)


def test_no_exchange_below_family_joins(spark, tables):
    many = {t: df.crossJoin(spark.range(40)).withColumn(
        buckets.FAMILY, F.concat(buckets.FAMILY, F.lit("-"), "id")).drop("id") for t, df in tables.items()}
    stored = buckets.write(many, buckets=4)
    summary = families.family_summary(stored.bucketed, buckets.by_bucket)
    text = summary._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert "Exchange" not in text and "Broadcast" not in text
    assert summary.count() == 7 * 40
