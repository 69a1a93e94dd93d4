"""Is the recorded evidence complete enough to submit a run?

The required inventory is stated here and not derived from the results, so a rule
that never ran cannot remove itself from what is required.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators.quality import FEED_RULE, RUN_RULES

POLICY_VERSION = "submission-preflight-v1"
CHECK = ("rule_id", "rule_version", "market_id", "month_start")


def required_checks(run: DataFrame, partitions: DataFrame) -> DataFrame:
    """Every run-level rule once, and the feed rule once per expected partition."""
    rules = F.array(*[
        F.struct(F.lit(rule).alias("rule_id"), F.lit(version).alias("rule_version"))
        for rule, version in sorted(RUN_RULES.items())])
    run_level = run.select("run_id", F.inline(rules)).select(
        "run_id", "rule_id", "rule_version", F.lit("ALL").alias("market_id"),
        F.lit("ALL").alias("month_start"))
    feeds = partitions.select(
        "run_id", F.lit(FEED_RULE[0]).alias("rule_id"),
        F.lit(FEED_RULE[1]).alias("rule_version"), "market_id",
        F.col("month_start").cast("string").alias("month_start")).distinct()
    return run_level.unionByName(feeds)


def _evidence(
    spark: SparkSession, pipeline_run: DataFrame, expected_partition: DataFrame,
    dq_result: DataFrame, run_id: str,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    asked = spark.createDataFrame([(run_id,)], "run_id string")
    run = asked.join(pipeline_run.select("run_id", "status"), "run_id", "left")
    known = run.where(F.col("status").isNotNull())
    partitions = expected_partition.where(F.col("entity") == "claims").join(
        known.select("run_id"), "run_id", "left_semi")
    rows = dq_result.join(known.select("run_id"), "run_id", "left_semi")
    return run, known, partitions, rows


def blockers(
    pipeline_run: DataFrame, expected_partition: DataFrame, dq_result: DataFrame, run_id: str
) -> DataFrame:
    """Everything that stands against submission, one row per reason."""
    run, known, partitions, rows = _evidence(
        pipeline_run.sparkSession, pipeline_run, expected_partition, dq_result, run_id)
    required = required_checks(known, partitions)
    none = F.lit(None).cast("string")

    def report(frame: DataFrame, code: str | Column, **context) -> DataFrame:
        names = ("status", *CHECK, "disposition")
        return frame.select(
            "run_id", (F.lit(code) if isinstance(code, str) else code).alias("code"),
            *[context.get(name, none).alias(name) for name in names])

    check = {name: F.col(name) for name in CHECK}
    expected_any = partitions.select("run_id").distinct()
    keyed = ["run_id", *CHECK]
    # What is required and what was observed meet once, by check.
    met = (
        required.select(*keyed, F.lit(1).alias("asked"), F.lit(0).alias("seen"))
        .unionByName(rows.select(*keyed, F.lit(0).alias("asked"), F.lit(1).alias("seen")))
        .groupBy(*keyed)
        .agg(F.sum("asked").cast("int").alias("asked"), F.sum("seen").cast("int").alias("seen")))
    asked, seen, nothing = F.col("asked"), F.col("seen"), F.lit(0)
    compared = met.withColumn("code", F.explode(F.concat(
        F.array_repeat(F.lit("DUPLICATE_CHECK"), F.greatest(seen - 1, nothing)),
        F.array_repeat(F.lit("UNEXPECTED_CHECK"), F.when(asked == 0, seen).otherwise(nothing)),
        F.array_repeat(F.lit("MISSING_CHECK"), F.when(seen == 0, asked).otherwise(nothing)))))
    not_passed = rows.where(
        (F.col("severity") != "BLOCKING") | (F.col("disposition") != "PASS")
        | (F.col("failing_row_count") != 0))
    parts = [
        report(run.where(F.col("status").isNull()), "UNKNOWN_RUN"),
        report(known.where(F.col("status") != "READY_FOR_REVIEW"), "RUN_NOT_READY",
               status=F.col("status")),
        report(known.join(expected_any, "run_id", "left_anti"), "NO_EXPECTED_PARTITIONS"),
        report(compared, F.col("code"), **check),
        report(not_passed, "RULE_NOT_PASSED", **check, disposition=F.col("disposition")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def assessment(
    pipeline_run: DataFrame, expected_partition: DataFrame, dq_result: DataFrame, run_id: str
) -> DataFrame:
    """One row: is the run eligible, and on how many checks that rests."""
    run, known, partitions, rows = _evidence(
        pipeline_run.sparkSession, pipeline_run, expected_partition, dq_result, run_id)
    against = blockers(pipeline_run, expected_partition, dq_result, run_id)
    marked = [
        run.select("run_id", F.lit("run").alias("kind")),
        required_checks(known, partitions).select("run_id", F.lit("expected").alias("kind")),
        rows.select("run_id", F.lit("observed").alias("kind")),
        against.select("run_id", F.lit("blocker").alias("kind"))]
    return (
        reduce(DataFrame.unionByName, marked)
        .groupBy("run_id")
        .agg(*[F.count_if(F.col("kind") == kind).alias(name) for kind, name in (
            ("expected", "expected_checks"), ("observed", "observed_checks"),
            ("blocker", "blocker_count"))])
        .withColumn("policy_version", F.lit(POLICY_VERSION))
        .withColumn("eligible_for_submission", F.col("blocker_count") == 0)
    )
