"""Explicit schemas of every table, keys, and the constraints that go with them.

Money is integer cents in ``LongType`` throughout; dates are ``DateType`` and a
month is the date of its first day.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "str": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "ts": T.TimestampType(),
    "bool": T.BooleanType(),
    "double": T.DoubleType(),
    "strs": T.ArrayType(T.StringType()),
    "longs": T.ArrayType(T.LongType()),
}


def _table(*columns: str) -> T.StructType:
    """``"name:type"`` strings to a schema; everything is nullable when landed."""
    fields = []
    for column in columns:
        name, kind = column.split(":")
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


_LANDED = ("source_file_id:str", "source_row_id:str", "run_id:str", "ingested_at:ts")

TABLES: dict[str, T.StructType] = {
    # operational evidence
    "pipeline_run": _table(
        "run_id:str", "scenario_id:str", "seed:long", "config_hash:str", "code_version:str",
        "as_of_cutoff:date", "started_at:ts", "ended_at:ts", "status:str"),
    "source_file": _table(
        "source_file_id:str", "run_id:str", "source_system:str", "entity:str", "market_id:str",
        "month_start:date", "content_hash:str", "row_count:long", "ingested_at:ts"),
    "expected_partition": _table("run_id:str", "market_id:str", "month_start:date", "entity:str"),
    "quarantine_record": _table(
        "run_id:str", "source_file_id:str", "source_row_id:str", "rule_id:str", "reason:str",
        "remediation_status:str"),
    "dq_result": _table(
        "run_id:str", "rule_id:str", "rule_version:str", "market_id:str", "month_start:str",
        "severity:str", "evaluated_count:long", "failing_row_count:long",
        "financial_impact_cents:long", "disposition:str"),
    "expected_defect": _table(
        "scenario_id:str", "defect_id:str", "entity:str", "source_row_id:str",
        "expected_rule_id:str", "description:str"),
    # landing tables, one row per delivered record
    "raw_eligibility_span": _table(
        *_LANDED, "eligibility_span_id:str", "member_id:str", "market_id:str", "plan_id:str",
        "program:str", "benefit_scope:str", "eligibility_group:str", "delivery_system:str",
        "start_date:date", "end_date:date"),
    "raw_claim_header": _table(
        *_LANDED, "claim_family_id:str", "version_number:long", "replaces_version_id:str",
        "member_id:str", "market_id:str", "plan_id:str", "claim_file_type:str",
        "record_type:str", "status:str", "service_start_date:date", "service_end_date:date",
        "adjudicated_at:date", "header_paid_amount_cents:long"),
    "raw_claim_line": _table(
        *_LANDED, "claim_family_id:str", "version_number:long", "line_number:long",
        "service_code:str", "provider_id:str", "units:long", "line_paid_amount_cents:long"),
    "raw_payment_transaction": _table(
        *_LANDED, "payment_transaction_id:str", "claim_family_id:str", "version_number:long",
        "payment_date:date", "event_type:str", "reverses_transaction_id:str",
        "signed_amount_cents:long"),
    "raw_capitation_transaction": _table(
        *_LANDED, "capitation_transaction_id:str", "member_id:str", "market_id:str",
        "plan_id:str", "coverage_month:date", "payment_date:date",
        "reverses_transaction_id:str", "signed_amount_cents:long"),
    # dimensions
    "dim_market": _table("market_key:long", "market_id:str", "market_name:str", "state_code:str"),
    "dim_member": _table("member_key:long", "synthetic_member_id:str", "age_band:str"),
    "dim_plan": _table(
        "plan_key:long", "market_key:long", "plan_id:str", "plan_name:str", "plan_type:str"),
    "dim_provider": _table("provider_key:long", "provider_id:str", "provider_type:str"),
    "dim_service_category": _table("category_key:long", "category_code:str", "category_name:str"),
    "service_category_map": _table(
        "mapping_version:str", "claim_file_type:str", "service_code:str", "category_key:long",
        "effective_start:date", "effective_end:date"),
    "dim_date": _table(
        "date_key:long", "calendar_date:date", "month_start:date", "year:int",
        "month_number:int", "days_in_month:int"),
    # curated facts
    "eligibility_span": _table(
        "eligibility_span_id:str", "run_id:str", "member_key:long", "market_key:long",
        "plan_key:long", "program:str", "benefit_scope:str", "eligibility_group:str",
        "delivery_system:str", "start_date:date", "end_date:date", "source_file_id:str",
        "source_row_id:str"),
    "fact_member_month": _table(
        "run_id:str", "member_key:long", "month_start:date", "market_key:long",
        "plan_key:long", "program:str", "benefit_scope:str", "eligibility_group:str",
        "delivery_system:str", "eligible_days:int", "member_month_weight:int",
        "in_primary_cohort:int"),
    "claim_header_version": _table(
        "claim_version_key:str", "run_id:str", "claim_family_key:str", "version_number:long",
        "replaces_version_key:str", "member_key:long", "market_key:long", "plan_key:long",
        "claim_file_type:str", "record_type:str", "status:str", "service_start_date:date",
        "service_end_date:date", "adjudicated_at:date", "header_paid_amount_cents:long",
        "source_file_id:str", "source_row_id:str"),
    "claim_line_version": _table(
        "run_id:str", "claim_version_key:str", "line_number:long", "category_key:long",
        "service_code:str", "provider_key:long", "units:long", "line_paid_amount_cents:long"),
    "fact_claim_header_final": _table(
        "run_id:str", "claim_family_key:str", "claim_version_key:str", "member_key:long",
        "market_key:long", "plan_key:long", "record_type:str", "claim_file_type:str",
        "service_month:date", "header_paid_amount_cents:long", "population_match:str"),
    "fact_claim_line_final": _table(
        "run_id:str", "claim_family_key:str", "line_number:long", "category_key:long",
        "provider_key:long", "line_paid_amount_cents:long"),
    "fact_payment_transaction": _table(
        "payment_transaction_id:str", "run_id:str", "claim_family_key:str",
        "claim_version_key:str", "payment_date:date", "event_type:str",
        "reverses_transaction_id:str", "signed_amount_cents:long", "source_file_id:str",
        "source_row_id:str"),
    "fact_capitation_transaction": _table(
        "capitation_transaction_id:str", "run_id:str", "member_key:long", "market_key:long",
        "plan_key:long", "coverage_month:date", "payment_date:date",
        "reverses_transaction_id:str", "signed_amount_cents:long", "source_file_id:str",
        "source_row_id:str"),
}

# The codes that each coded column may hold.
CODES = {
    "run_status": ("CREATED", "VALIDATING", "FAILED", "READY_FOR_REVIEW", "CERTIFIED"),
    "severity": ("BLOCKING", "WARNING"),
    "disposition": ("PASS", "FAIL", "ACCEPTED_WITH_REASON", "NOT_EVALUATED"),
    "remediation": ("OPEN", "CORRECTED", "ACCEPTED_WITH_REASON"),
    "age_band": ("0-17", "18-34", "35-49", "50-64", "65+"),
    "plan_type": ("MANAGED_CARE", "FFS_NOT_APPLICABLE"),
    "category": ("INPATIENT", "INSTITUTIONAL_LT", "OUTPATIENT", "PROFESSIONAL", "PHARMACY", "OTHER"),
    "file_type": ("IP", "LT", "OT", "RX"),
    "program": ("MEDICAID", "CHIP"),
    "benefit_scope": ("FULL", "LIMITED"),
    "eligibility_group": ("CHILD", "ADULT", "AGED", "DISABILITY"),
    "delivery_system": ("FFS", "MANAGED_CARE"),
    "record_type": ("FFS", "ENCOUNTER"),
    "claim_status": ("ACCEPTED", "DENIED", "VOID"),
    "population_match": ("MATCHED", "OUT_OF_COHORT", "NO_EXPOSURE", "CONFLICTING_EXPOSURE"),
    "event_type": ("PAYMENT", "REVERSAL"),
}
