"""A finance run that no rule speaks against, derived from the same orders.

Only orders of known members with an existing plan count. A customer is covered for
every whole month with an order, an order is one accepted claim of one mapped line, its
payment is the claim's amount, and every expected file came.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.operators import preflight
from evenkeel.plans import proxies
from evenkeel.plans.finance import FinanceRun
from evenkeel.plans.finance_queries import Query, _ready
from evenkeel.sources import arrivals
from evenkeel.sources.tables import conform, literal_rows

CODE = "CLEAN"
ENTITY = "claims"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = proxies.orders_by_customer(spark, sf_dir)
    no_plan = (F.col("n_regionkey") == 4) & (F.col("c_mktsegment") == "MACHINERY")
    return rows.where((F.col("c_acctbal") >= 0) & ~no_plan)


def _family() -> Column:
    return F.concat(F.lit("C"), F.col("o_orderkey").cast("string"))


def _member() -> list[Column]:
    return [F.col("c_name").alias("member_id"), F.col("n_name").alias("market_id"),
            F.col("c_mktsegment").alias("plan_id")]


def raw_eligibility_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc("order_date", "MM")
    covered = _orders(spark, sf_dir).groupBy(
        "o_custkey", "c_name", "n_name", "c_mktsegment", "c_acctbal", month.alias("month")).agg(
        F.min("o_orderkey").alias("o_orderkey"))
    managed, balance = F.col("c_mktsegment").isin(*proxies.MANAGED), F.col("c_acctbal")
    return covered.select(
        F.col("o_orderkey").cast("string").alias("source_row_id"),
        F.concat_ws("-", F.lit("E"), "o_custkey", F.date_format("month", "yyyy-MM"))
        .alias("eligibility_span_id"), *_member(),
        F.lit("MEDICAID").alias("program"), F.lit("FULL").alias("benefit_scope"),
        F.when(balance < 5000, "CHILD").otherwise("ADULT").alias("eligibility_group"),
        F.when(managed, "MANAGED_CARE").otherwise("FFS").alias("delivery_system"),
        F.col("month").alias("start_date"), F.last_day("month").alias("end_date"))


def raw_claim_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    managed = F.col("c_mktsegment").isin(*proxies.MANAGED)
    return _orders(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("source_row_id"),
        _family().alias("claim_family_id"), F.lit(1).alias("version_number"),
        F.lit(None).alias("replaces_version_id"), *_member(), F.lit("OT").alias("claim_file_type"),
        F.when(managed, "ENCOUNTER").otherwise("FFS").alias("record_type"),
        F.lit("ACCEPTED").alias("status"), F.col("order_date").alias("service_start_date"),
        F.col("order_date").alias("service_end_date"), F.col("order_date").alias("adjudicated_at"),
        F.when(~managed, proxies.cents("o_totalprice")).alias("header_paid_amount_cents"))


def raw_claim_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    managed = F.col("c_mktsegment").isin(*proxies.MANAGED)
    return _orders(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("source_row_id"),
        _family().alias("claim_family_id"), F.lit(1).alias("version_number"),
        F.lit(1).alias("line_number"), F.lit(CODE).alias("service_code"),
        F.lit(None).alias("provider_id"), F.lit(1).alias("units"),
        F.when(~managed, proxies.cents("o_totalprice")).otherwise(0).alias("line_paid_amount_cents"))


def raw_payment_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = _orders(spark, sf_dir).where(~F.col("c_mktsegment").isin(*proxies.MANAGED))
    return paid.select(
        F.col("o_orderkey").cast("string").alias("source_row_id"),
        F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("payment_transaction_id"),
        _family().alias("claim_family_id"), F.lit(1).alias("version_number"),
        F.col("order_date").alias("payment_date"), F.lit("PAYMENT").alias("event_type"),
        F.lit(None).alias("reverses_transaction_id"),
        proxies.cents("o_totalprice").alias("signed_amount_cents"))


def raw_capitation_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = _orders(spark, sf_dir).where(F.col("c_mktsegment").isin(*proxies.MANAGED))
    key = F.concat(F.lit("CAP"), F.col("o_orderkey").cast("string"))
    return paid.select(
        key.alias("source_row_id"), key.alias("capitation_transaction_id"), *_member(),
        F.trunc("order_date", "MM").alias("coverage_month"), F.col("order_date").alias("payment_date"),
        F.lit(None).alias("reverses_transaction_id"),
        proxies.cents("o_totalprice").alias("signed_amount_cents"))


_LANDED = {build.__name__: build for build in (
    raw_eligibility_span, raw_claim_header, raw_claim_line, raw_payment_transaction,
    raw_capitation_transaction)}


class CleanInputs(proxies.FinanceInputs):
    """The inputs of the clean run; dimensions and expectations are those of the other."""

    def __missing__(self, table: str) -> DataFrame:
        if table in _LANDED:
            landed = _LANDED[table](self.spark, self.sf_dir)
            self[table] = conform(
                landed.withColumn("source_file_id", F.lit(f"SRC_{table}"))
                .withColumn("run_id", F.lit(proxies.RUN))
                .withColumn("ingested_at", F.lit(proxies.LANDED)), table)
        elif table == "service_category_map":
            self[table] = literal_rows(self.spark, table, [
                (proxies.MAPPING, "OT", CODE, 4, date(1990, 1, 1), None)])
        elif table == "source_file":
            arrived = arrivals.expected_partitions(
                self["dim_market"], self["dim_date"], proxies.RUN, ENTITY)
            self[table] = conform(arrived.select(
                "*", F.concat_ws("_", F.lit("SRC"), "market_id", "month_start").alias("source_file_id"),
                F.lit(proxies.LANDED).alias("ingested_at"), F.lit("synthetic").alias("source_system"),
                F.lit(None).alias("content_hash"), F.lit(None).alias("row_count")), table)
        else:
            own = {t: self[t] for t in ("service_category_map",) if t in self}
            super().__missing__(table)
            self.update(own)
        return self[table]


def _over_run(build) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = CleanInputs(spark, sf_dir)
        inputs["service_category_map"]
        run = FinanceRun(inputs, proxies.RUN, proxies.MAPPING)
        return build(run.staged("claim_header_version", "member_assignment", "claim_line_version",
                                "fact_claim_header_final", "dq_result"))
    return query


def queries() -> dict[str, Query]:
    return {
        "clean_run_status": _over_run(lambda r: r.run_status),
        "clean_dq_failures": _over_run(lambda r: r.dq_result.where(
            "disposition <> 'PASS' OR failing_row_count <> 0")),
        "clean_preflight_blockers": _over_run(lambda r: r.blockers(_ready(r))),
        "clean_assessment": _over_run(lambda r: preflight.assessment(
            _ready(r), r["expected_partition"], r.dq_result, r.run_id)),
        "clean_kpi_ffs_month": _over_run(lambda r: r.view("v_kpi_ffs_month")),
        "clean_partition_status": _over_run(lambda r: r.partition_status),
    }
