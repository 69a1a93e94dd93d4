"""Finance inputs derived from a star schema of orders.

Customers are members, nations are markets, segments are plans, orders open
eligibility spans and claim families, and order lines are claim versions, claim
lines and payments. Every table is derived from all rows of its sources.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.plans.finance import DIMENSIONS, FinanceRun
from evenkeel.session import stage
from evenkeel.sources import arrivals
from evenkeel.sources.tables import conform, literal_rows

RUN = "RUN_0001"
MAPPING = "MAP_V1"
CUTOFF = date(1999, 6, 30)
LANDED = datetime(1999, 7, 1)
MANAGED = ("BUILDING", "MACHINERY")

# Segment numbers and the category of each part type.
SEGMENTS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
CATEGORIES = {
    "LARGE": (1, "INPATIENT"), "MEDIUM": (2, "INSTITUTIONAL_LT"), "SMALL": (3, "OUTPATIENT"),
    "STANDARD": (4, "PROFESSIONAL"), "ECONOMY": (5, "PHARMACY"), "PROMO": (6, "OTHER")}


# Declared, so that opening a table reads no footers and starts no job.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def _lookup(column: str, values: dict) -> Column:
    chosen = F.lit(None)
    for key, value in values.items():
        chosen = F.when(F.col(column) == key, F.lit(value)).otherwise(chosen)
    return chosen


def _is_managed() -> Column:
    return F.col("c_mktsegment").isin(*MANAGED)


def _landed(df: DataFrame, table: str, file_id: Column | None = None) -> DataFrame:
    file_id = F.lit(f"SRC_{table}") if file_id is None else file_id
    return conform(
        df.withColumn("source_file_id", file_id)
        .withColumn("run_id", F.lit(RUN))
        .withColumn("ingested_at", F.lit(LANDED)), table)


def orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's name, market and plan."""
    orders = read(spark, sf_dir, "orders").withColumn("order_date", F.to_date("o_orderdate"))
    customer = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_acctbal",
        "c_mktsegment")
    nation = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    return orders.join(customer.join(nation, "c_nationkey"), "o_custkey")


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    customer, part = read(spark, sf_dir, "customer"), read(spark, sf_dir, "part")
    markets = nation.join(region, nation.n_regionkey == region.r_regionkey)
    # The segments and the bounds of the calendar are a row each; taken once, they are not
    # sought in customers and orders again by every table that is built on them.
    segments = customer.agg(F.sort_array(F.collect_set("c_mktsegment"))).first()[0]
    plans = nation.withColumn("c_mktsegment", F.explode(
        F.array(*[F.lit(s) for s in segments]).cast("array<string>"))).where(
        ~((F.col("n_regionkey") == 4) & (F.col("c_mktsegment") == "MACHINERY")))
    types = part.select("p_type").distinct()
    codes = part.select("p_type", "p_brand").distinct()
    file_types = F.explode(F.array(*[F.lit(t) for t in ("IP", "LT", "OT", "RX")]))
    # Large parts change category in mid 1998, economy parts start late, and
    # promotional parts have no pharmacy mapping.
    large, economy = F.col("p_type") == "LARGE", F.col("p_type") == "ECONOMY"
    opened, open_end = F.lit(date(1995, 1, 1)), F.lit(None).cast("date")
    own_category = _lookup("p_type", {t: k for t, (k, _) in CATEGORIES.items()})

    def period(category, start, end):
        return F.struct(category.alias("k"), start.alias("s"), end.alias("e"))

    periods = F.when(large, F.array(
        period(own_category, opened, F.lit(date(1998, 6, 30))),
        period(F.lit(6), F.lit(date(1998, 7, 1)), open_end),
    )).otherwise(F.array(period(
        own_category, F.when(economy, F.lit(date(1996, 1, 1))).otherwise(opened), open_end)))
    mapping = (
        codes.withColumn("claim_file_type", file_types)
        .where(~((F.col("p_type") == "PROMO") & (F.col("claim_file_type") == "RX")))
        .withColumn("period", F.explode(periods))
    )
    found = read(spark, sf_dir, "orders").agg(
        F.trunc(F.to_date(F.min("o_orderdate")), "MM").alias("first_date"),
        F.last_day(F.to_date(F.max("o_orderdate"))).alias("last_date"))
    bounds = spark.createDataFrame([tuple(found.first())], found.schema)
    return {
        "dim_market": conform(markets.select(
            F.col("n_nationkey").alias("market_key"), F.col("n_name").alias("market_id"),
            F.col("n_name").alias("market_name"), F.col("r_name").alias("state_code")),
            "dim_market"),
        "dim_plan": conform(plans.select(
            (F.col("n_nationkey") * 10 + _lookup("c_mktsegment", SEGMENTS)).alias("plan_key"),
            F.col("n_nationkey").alias("market_key"), F.col("c_mktsegment").alias("plan_id"),
            F.concat_ws(" ", "n_name", "c_mktsegment").alias("plan_name"),
            F.when(_is_managed(), "MANAGED_CARE").otherwise("FFS_NOT_APPLICABLE")
            .alias("plan_type")), "dim_plan"),
        "dim_member": conform(customer.where(F.col("c_acctbal") >= 0).select(
            F.col("c_custkey").alias("member_key"), F.col("c_name").alias("synthetic_member_id"),
            F.when(F.col("c_acctbal") < 5000, "18-34").otherwise("65+").alias("age_band")),
            "dim_member"),
        "dim_provider": conform(
            read(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0).select(
                F.col("s_suppkey").alias("provider_key"), F.col("s_name").alias("provider_id"),
                F.when(F.col("s_acctbal") > 5000, "HOSPITAL").otherwise("PHYSICIAN")
                .alias("provider_type")), "dim_provider"),
        "dim_service_category": conform(types.select(
            _lookup("p_type", {t: k for t, (k, _) in CATEGORIES.items()}).alias("category_key"),
            _lookup("p_type", {t: c for t, (_, c) in CATEGORIES.items()}).alias("category_code"),
            F.col("p_type").alias("category_name")), "dim_service_category"),
        "service_category_map": conform(mapping.select(
            F.lit(MAPPING).alias("mapping_version"), "claim_file_type",
            F.concat_ws(" ", "p_type", "p_brand").alias("service_code"),
            F.col("period.k").alias("category_key"), F.col("period.s").alias("effective_start"),
            F.col("period.e").alias("effective_end")), "service_category_map"),
        "dim_date": arrivals.calendar(bounds),
    }


def raw_eligibility_span(orders: DataFrame) -> DataFrame:
    limited = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    balance = F.col("c_acctbal")
    spans = orders.select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("source_row_id"),
        F.concat(F.lit("E"), F.col("o_custkey").cast("string"), F.lit("-"),
                 F.date_format("order_date", "yyyy-MM")).alias("eligibility_span_id"),
        F.col("c_name").alias("member_id"), F.col("n_name").alias("market_id"),
        F.col("c_mktsegment").alias("plan_id"),
        F.when(balance > 8000, "CHIP").otherwise("MEDICAID").alias("program"),
        F.when(limited, "LIMITED").otherwise("FULL").alias("benefit_scope"),
        F.when(balance < 2000, "CHILD").when(balance < 5000, "ADULT")
        .when(balance < 7500, "AGED").otherwise("DISABILITY").alias("eligibility_group"),
        F.when(_is_managed(), "MANAGED_CARE").otherwise("FFS").alias("delivery_system"),
        F.col("order_date").alias("start_date"),
        F.date_add("order_date", (F.col("o_orderkey") % 60).cast("int")).alias("end_date"))
    return _landed(spans, "raw_eligibility_span")


def _family(column: str) -> Column:
    return F.concat(F.lit("C"), F.col(column).cast("string"))


def _beside(column: str, value: str) -> Column:
    """-1, 0 or 1 as a text is below, equal to or above a value.

    Their extremes tell whether the extreme text is the value, in a hash aggregation; one over
    texts sorts its rows.
    """
    text = F.col(column)
    return F.when(text < value, -1).when(text == value, 0).when(text > value, 1)


def claim_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version per (order, line number)."""
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
        .agg(
            F.max(_beside("l_returnflag", "R")).alias("flag"),
            F.min(_beside("l_linestatus", "F")).alias("line_status"),
            F.to_date(F.max("l_shipdate")).alias("shipped"),
            F.coalesce(F.sum(F.when(F.col("l_quantity") < 50, cents("l_extendedprice"))),
                       F.lit(0)).alias("paid"))
    )


def raw_claim_header(orders: DataFrame, versions: DataFrame) -> DataFrame:
    """One version per (order, line number); repeated lines are its claim lines."""
    rows = versions.join(orders, "o_orderkey")
    family = _family("o_orderkey")
    version = F.col("l_linenumber").cast("long")
    moved = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    priority = F.col("o_orderpriority")
    end = F.date_add("order_date", F.col("l_linenumber").cast("int"))
    headers = rows.select(
        F.concat_ws(":", family, version.cast("string")).alias("source_row_id"),
        family.alias("claim_family_id"), version.alias("version_number"),
        F.when(version > 1, F.concat_ws(":", family, (version - 1).cast("string")))
        .alias("replaces_version_id"),
        F.col("c_name").alias("member_id"), F.col("n_name").alias("market_id"),
        F.when(moved, "FURNITURE").otherwise(F.col("c_mktsegment")).alias("plan_id"),
        F.when(priority == "1-URGENT", "IP").when(priority == "2-HIGH", "LT")
        .when(priority == "5-LOW", "RX").otherwise("OT").alias("claim_file_type"),
        F.when(_is_managed(), "ENCOUNTER").otherwise("FFS").alias("record_type"),
        F.when(F.col("flag") != 0, "ACCEPTED")
        .when(F.col("line_status") == 0, "DENIED").otherwise("VOID").alias("status"),
        F.col("order_date").alias("service_start_date"), end.alias("service_end_date"),
        F.col("shipped").alias("adjudicated_at"),
        F.when(~_is_managed(), F.col("paid")).alias("header_paid_amount_cents"))
    file_id = F.concat_ws(
        "_", F.lit("SRC_CLAIMS"), "market_id",
        F.trunc("service_end_date", "MM").cast("string"))
    return _landed(headers, "raw_claim_header", file_id)


def raw_claim_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws(" ", "p_type", "p_brand").alias("service_code"))
    lines = read(spark, sf_dir, "lineitem").join(part, "l_partkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_quantity").cast("long"))
        .alias("source_row_id"),
        _family("l_orderkey").alias("claim_family_id"),
        F.col("l_linenumber").alias("version_number"),
        F.col("l_partkey").alias("line_number"), "service_code",
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
        .alias("provider_id"),
        F.col("l_quantity").cast("long").alias("units"),
        cents("l_extendedprice").alias("line_paid_amount_cents"))
    return _landed(lines, "raw_claim_line")


def raw_payment_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    reversal = F.col("l_returnflag") == "R"
    paid = cents("l_extendedprice")
    payments = read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .alias("source_row_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .alias("payment_transaction_id"),
        _family("l_orderkey").alias("claim_family_id"),
        F.col("l_linenumber").alias("version_number"),
        F.to_date("l_shipdate").alias("payment_date"),
        F.when(reversal, "REVERSAL").otherwise("PAYMENT").alias("event_type"),
        F.when(reversal, F.concat_ws("-", "l_orderkey", "l_linenumber"))
        .alias("reverses_transaction_id"),
        F.when(reversal, -paid).otherwise(paid).alias("signed_amount_cents"))
    return _landed(payments, "raw_payment_transaction")


def raw_capitation_transaction(orders: DataFrame) -> DataFrame:
    negative = F.col("o_orderstatus") == "P"
    linked = negative & (F.col("o_orderpriority") != "5-LOW")
    amount = cents("o_totalprice")
    rows = orders.where(_is_managed()).select(
        F.concat(F.lit("CAP"), F.col("o_orderkey").cast("string")).alias("source_row_id"),
        F.concat(F.lit("CAP"), F.col("o_orderkey").cast("string"))
        .alias("capitation_transaction_id"),
        F.col("c_name").alias("member_id"), F.col("n_name").alias("market_id"),
        F.col("c_mktsegment").alias("plan_id"),
        F.trunc("order_date", "MM").alias("coverage_month"),
        F.date_add("order_date", 5).alias("payment_date"),
        F.when(linked, F.concat(F.lit("CAP"), (F.col("o_orderkey") - 1).cast("string")))
        .alias("reverses_transaction_id"),
        F.when(negative, -amount).otherwise(amount).alias("signed_amount_cents"))
    return _landed(rows, "raw_capitation_transaction")


def arrived_claim_files(
    dim_market: DataFrame, dim_date: DataFrame, nation: DataFrame
) -> DataFrame:
    """Claim files that came: markets of region 3 send nothing in December."""
    silent = nation.where(F.col("n_regionkey") == 3).select(
        F.col("n_name").alias("market_id"), F.lit(12).alias("silent_month"))
    expected = arrivals.expected_partitions(dim_market, dim_date, RUN, "claims")
    return (
        expected.join(silent, "market_id", "left")
        .where(F.col("silent_month").isNull() | (F.month("month_start") != F.col("silent_month")))
        .withColumn("source_file_id", F.concat_ws(
            "_", F.lit("SRC_CLAIMS"), "market_id", F.col("month_start").cast("string")))
        .withColumn("ingested_at", F.lit(LANDED))
        .drop("silent_month")
    )


class FinanceInputs(dict):
    """Input tables by name, each built when it is first asked for.

    File records carry their row counts and fingerprints only when ``contents`` is
    set; arrival itself is evidenced by the record alone. Where many tables and rules
    read the landed ones, ``shared`` writes what these are derived from once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, contents: bool = False,
                 shared: bool = False):
        super().__init__()
        self.spark, self.sf_dir, self.contents, self.shared = spark, sf_dir, contents, shared

    def _once(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, name) if self.shared else df

    @cached_property
    def orders(self) -> DataFrame:
        return self._once(orders_by_customer(self.spark, self.sf_dir), "orders")

    @cached_property
    def versions(self) -> DataFrame:
        return self._once(claim_versions(self.spark, self.sf_dir), "versions")

    def __missing__(self, table: str) -> DataFrame:
        spark, sf_dir = self.spark, self.sf_dir
        if table == "raw_claim_header":
            self[table] = raw_claim_header(self.orders, self.versions)
        elif table in _OF_ORDERS:
            self[table] = _OF_ORDERS[table](self.orders)
        elif table in _OF_LINES:
            self[table] = _OF_LINES[table](spark, sf_dir)
        elif table == "pipeline_run":
            self[table] = literal_rows(spark, "pipeline_run", [
                (RUN, "star", 0, "star", "1", CUTOFF, LANDED, None, "CREATED")])
        elif table == "expected_partition":
            self[table] = arrivals.expected_partitions(
                self["dim_market"], self["dim_date"], RUN, "claims")
        elif table == "source_file":
            arrived = arrived_claim_files(
                self["dim_market"], self["dim_date"], read(spark, sf_dir, "nation"))
            if self.contents:
                contents = arrivals.claim_partition_rows(
                    self["raw_claim_header"], self["raw_claim_line"])
                self[table] = arrivals.source_files(arrived, contents, "synthetic")
            else:
                self[table] = conform(
                    arrived.withColumn("source_system", F.lit("synthetic"))
                    .withColumn("content_hash", F.lit(None))
                    .withColumn("row_count", F.lit(None)), "source_file")
        elif table in DIMENSIONS:
            self.update(dimensions(spark, sf_dir))
        else:
            raise KeyError(table)
        return self[table]


_OF_ORDERS = {build.__name__: build for build in (raw_eligibility_span, raw_capitation_transaction)}
_OF_LINES = {build.__name__: build for build in (raw_claim_line, raw_payment_transaction)}


def finance_run(spark: SparkSession, sf_dir: str, contents: bool = False,
                shared: bool = False) -> FinanceRun:
    return FinanceRun(FinanceInputs(spark, sf_dir, contents, shared), RUN, MAPPING)
