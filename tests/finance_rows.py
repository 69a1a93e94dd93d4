"""A finance world small enough to check by hand.

The rows are fixed values: the expected numbers in the tests follow from them.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from evenkeel.plans.finance import FinanceRun
from evenkeel.schemas import TABLES
from evenkeel.sources import arrivals
from evenkeel.sources.tables import literal_rows

RUN = "RUN_FIXTURE_0001"
MAPPING = "MAP_V1"
LANDED_AT = datetime(2026, 3, 31)

# Fixed values, one row per line, columns separated by "|", empty for NULL.
ROWS = {
    "dim_market": """
        1|SYN_MKT_A|Northgate|TX
        2|SYN_MKT_B|Larkfield|OH
        3|SYN_MKT_C|Westbrook|AZ""",
    "dim_plan": """
        1|1|SYN_PLAN_A_FFS|Northgate fee-for-service|FFS_NOT_APPLICABLE
        2|1|SYN_PLAN_A1|Northgate Care Plan|MANAGED_CARE
        3|2|SYN_PLAN_B_FFS|Larkfield fee-for-service|FFS_NOT_APPLICABLE
        4|2|SYN_PLAN_B1|Larkfield Health Choice|MANAGED_CARE
        5|3|SYN_PLAN_C_FFS|Westbrook fee-for-service|FFS_NOT_APPLICABLE
        6|3|SYN_PLAN_C1|Westbrook Community Plan|MANAGED_CARE""",
    "dim_member": """
        1|SYN_M001|35-49
        2|SYN_M002|18-34
        3|SYN_M003|0-17
        4|SYN_M004|50-64
        5|SYN_M005|0-17
        6|SYN_M006|65+
        7|SYN_M007|18-34""",
    "dim_provider": """
        1|SYN_PRV_001|HOSPITAL
        2|SYN_PRV_002|PHYSICIAN
        3|SYN_PRV_003|PHARMACY""",
    "dim_service_category": """
        1|INPATIENT|Inpatient
        2|INSTITUTIONAL_LT|Institutional long-term care
        3|OUTPATIENT|Outpatient
        4|PROFESSIONAL|Professional
        5|PHARMACY|Pharmacy
        6|OTHER|Other""",
    "service_category_map": """
        MAP_V1|OT|SVC_OUTPT_01|3|2026-01-01|
        MAP_V1|OT|SVC_PROF_01|4|2026-01-01|
        MAP_V1|IP|SVC_IP_01|1|2026-01-01|
        MAP_V1|RX|SVC_RX_01|5|2026-01-01|
        MAP_V1|LT|SVC_LT_01|2|2026-01-01|""",
    "raw_eligibility_span": """
        ELG_001|SYN_ELG_001|SYN_M001|SYN_MKT_A|SYN_PLAN_A_FFS|MEDICAID|FULL|ADULT|FFS|2026-01-01|2026-02-28
        ELG_002|SYN_ELG_002|SYN_M002|SYN_MKT_A|SYN_PLAN_A_FFS|MEDICAID|FULL|ADULT|FFS|2026-01-01|2026-01-31
        ELG_003|SYN_ELG_003|SYN_M003|SYN_MKT_B|SYN_PLAN_B_FFS|MEDICAID|FULL|CHILD|FFS|2026-01-20|2026-01-31
        ELG_004|SYN_ELG_004|SYN_M004|SYN_MKT_B|SYN_PLAN_B1|MEDICAID|FULL|ADULT|MANAGED_CARE|2026-01-01|2026-02-28
        ELG_005|SYN_ELG_005|SYN_M005|SYN_MKT_A|SYN_PLAN_A_FFS|CHIP|LIMITED|CHILD|FFS|2026-01-01|2026-02-28
        ELG_006|SYN_ELG_006|SYN_M006|SYN_MKT_C|SYN_PLAN_C_FFS|MEDICAID|FULL|AGED|FFS|2026-01-01|2026-02-28
        ELG_007|SYN_ELG_007|SYN_M007|SYN_MKT_A|SYN_PLAN_A_FFS|MEDICAID|FULL|ADULT|FFS|2026-01-01|2026-01-31
        ELG_008|SYN_ELG_001|SYN_M001|SYN_MKT_A|SYN_PLAN_A_FFS|MEDICAID|FULL|ADULT|FFS|2026-01-01|2026-02-28""",
    "raw_claim_header": """
        HDR_001|SYN_C001|1||SYN_M001|SYN_MKT_A|SYN_PLAN_A_FFS|OT|FFS|ACCEPTED|2026-01-10|2026-01-10|2026-01-10|12000
        HDR_002|SYN_C002|1||SYN_M001|SYN_MKT_A|SYN_PLAN_A_FFS|OT|FFS|ACCEPTED|2026-02-05|2026-02-05|2026-02-05|10000
        HDR_003|SYN_C002|2|SYN_C002:1|SYN_M001|SYN_MKT_A|SYN_PLAN_A_FFS|OT|FFS|ACCEPTED|2026-02-05|2026-02-05|2026-02-20|12000
        HDR_004|SYN_C003|1||SYN_M007|SYN_MKT_A|SYN_PLAN_A_FFS|IP|FFS|ACCEPTED|2026-01-15|2026-01-16|2026-01-15|8000
        HDR_005|SYN_C003|2|SYN_C003:1|SYN_M007|SYN_MKT_A|SYN_PLAN_A_FFS|IP|FFS|VOID|2026-01-15|2026-01-16|2026-01-28|0
        HDR_006|SYN_C004|1||SYN_M003|SYN_MKT_B|SYN_PLAN_B_FFS|OT|FFS|DENIED|2026-01-22|2026-01-22|2026-01-25|0
        HDR_007|SYN_C005|1||SYN_M004|SYN_MKT_B|SYN_PLAN_B1|OT|ENCOUNTER|ACCEPTED|2026-01-12|2026-01-12|2026-01-12|
        HDR_008|SYN_C006|1||SYN_M006|SYN_MKT_C|SYN_PLAN_C_FFS|RX|FFS|ACCEPTED|2026-01-08|2026-01-08|2026-01-08|4500
        HDR_009|SYN_C007|1||SYN_M001|SYN_MKT_A|SYN_PLAN_A_FFS|OT|FFS|ACCEPTED|2026-02-14|2026-02-14|2026-02-14|6000""",
    "raw_claim_line": """
        LIN_001|SYN_C001|1|1|SVC_OUTPT_01|SYN_PRV_001|1|7000
        LIN_002|SYN_C001|1|2|SVC_PROF_01|SYN_PRV_002|1|5000
        LIN_003|SYN_C002|1|1|SVC_OUTPT_01|SYN_PRV_001|1|10000
        LIN_004|SYN_C002|2|1|SVC_OUTPT_01|SYN_PRV_001|1|12000
        LIN_005|SYN_C003|1|1|SVC_IP_01|SYN_PRV_001|2|8000
        LIN_006|SYN_C003|2|1|SVC_IP_01|SYN_PRV_001|2|0
        LIN_007|SYN_C004|1|1|SVC_OUTPT_01|SYN_PRV_002|1|0
        LIN_008|SYN_C005|1|1|SVC_OUTPT_01|SYN_PRV_002|1|
        LIN_009|SYN_C006|1|1|SVC_RX_01|SYN_PRV_003|30|4500
        LIN_010|SYN_C007|1|1|SVC_UNMAPPED_99|SYN_PRV_002|1|6000""",
    "raw_payment_transaction": """
        PAY_001|SYN_TXN_001|SYN_C001|1|2026-01-10|PAYMENT||12000
        PAY_002|SYN_TXN_002|SYN_C002|1|2026-02-05|PAYMENT||10000
        PAY_003|SYN_TXN_003|SYN_C002|1|2026-02-20|REVERSAL|SYN_TXN_002|-10000
        PAY_004|SYN_TXN_004|SYN_C002|2|2026-02-20|PAYMENT||12000
        PAY_005|SYN_TXN_005|SYN_C003|1|2026-01-15|PAYMENT||8000
        PAY_006|SYN_TXN_006|SYN_C003|2|2026-01-28|REVERSAL|SYN_TXN_005|-8000
        PAY_007|SYN_TXN_007|SYN_C006|1|2026-01-08|PAYMENT||4500
        PAY_008|SYN_TXN_008|SYN_C007|1|2026-02-14|PAYMENT||6000""",
    "raw_capitation_transaction": """
        CAP_001|SYN_CAP_001|SYN_M004|SYN_MKT_B|SYN_PLAN_B1|2026-01-01|2026-01-05||45000
        CAP_002|SYN_CAP_002|SYN_M004|SYN_MKT_B|SYN_PLAN_B1|2026-01-01|2026-02-10|SYN_CAP_001|-45000
        CAP_003|SYN_CAP_003|SYN_M004|SYN_MKT_B|SYN_PLAN_B1|2026-01-01|2026-02-10||47500
        CAP_004|SYN_CAP_004|SYN_M004|SYN_MKT_B|SYN_PLAN_B1|2026-02-01|2026-02-05||47500""",
}

# Claim files that arrive. B's February file is empty, C's never comes.
ARRIVING = (("SYN_MKT_A", "2026-01-01"), ("SYN_MKT_A", "2026-02-01"),
            ("SYN_MKT_B", "2026-01-01"), ("SYN_MKT_B", "2026-02-01"),
            ("SYN_MKT_C", "2026-01-01"))

# The planted defects and the rule that must find each.
EXPECTED_RULES = {"DQ_ELIG_DUPLICATE_KEY", "DQ_LINE_UNMAPPED_SERVICE_CODE",
                  "DQ_MISSING_MARKET_FEED"}

_PARSE = {"bigint": int, "int": int, "string": str, "date": date.fromisoformat}


def rows_of(table: str) -> list[dict]:
    """Parsed rows; landed rows get their file, run and arrival time."""
    schema = TABLES[table]
    fields = list(schema.fields)
    landed = table.startswith("raw_")
    if landed:
        fields = [fields[1], *fields[4:]]
    rows = []
    for line in ROWS[table].strip().splitlines():
        values = line.strip().split("|")
        assert len(values) == len(fields), (table, line)
        row = {f.name: (_PARSE[f.dataType.simpleString()](v) if v else None)
               for f, v in zip(fields, values)}
        if landed:
            row |= {"source_file_id": f"SRC_{table}", "run_id": RUN, "ingested_at": LANDED_AT}
        rows.append(row)
    return rows


def frame(spark, table: str, rows: list[dict]):
    names = TABLES[table].names
    return literal_rows(spark, table, [tuple(row.get(n) for n in names) for row in rows])


def world(spark, scenario: str = "defective", change=None) -> dict:
    """All input tables. ``change(table, rows)`` may return other rows."""
    rows = {table: rows_of(table) for table in ROWS}
    arriving = list(ARRIVING)
    if scenario == "clean":
        rows["raw_eligibility_span"] = [
            r for r in rows["raw_eligibility_span"] if r["source_row_id"] != "ELG_008"]
        for line in rows["raw_claim_line"]:
            if line["service_code"] == "SVC_UNMAPPED_99":
                line["service_code"] = "SVC_PROF_01"
        arriving.append(("SYN_MKT_C", "2026-02-01"))
    tables = {t: frame(spark, t, change(t, r) if change else r) for t, r in rows.items()}
    tables["dim_date"] = arrivals.calendar_between(spark, "2026-01-01", "2026-02-28")
    tables["pipeline_run"] = frame(spark, "pipeline_run", [{
        "run_id": RUN, "scenario_id": scenario, "seed": 1, "config_hash": scenario,
        "code_version": "test", "as_of_cutoff": date(2026, 3, 31), "started_at": LANDED_AT,
        "status": "CREATED"}])
    tables["expected_partition"] = arrivals.expected_partitions(
        tables["dim_market"], tables["dim_date"], RUN, "claims")
    arrived = spark.createDataFrame(
        [(f"SRC_CLAIMS_{m}_{d}", RUN, "claims", m, date.fromisoformat(d), LANDED_AT)
         for m, d in arriving],
        "source_file_id string, run_id string, entity string, market_id string, "
        "month_start date, ingested_at timestamp")
    contents = arrivals.claim_partition_rows(tables["raw_claim_header"], tables["raw_claim_line"])
    claims = arrivals.source_files(arrived, contents, "synthetic")
    others = frame(spark, "source_file", [
        {"source_file_id": f"SRC_{t}", "run_id": RUN, "source_system": "synthetic",
         "entity": t, "content_hash": "0", "row_count": len(rows[t]), "ingested_at": LANDED_AT}
        for t in rows if t.startswith("raw_")])
    tables["source_file"] = claims.unionByName(others)
    return tables


def finance_run(spark, scenario: str = "defective", change=None) -> FinanceRun:
    return FinanceRun(world(spark, scenario, change), RUN, MAPPING)


def by(df, *keys: str) -> dict:
    """Rows as dictionaries, keyed by one or several columns."""
    out = {}
    for row in df.collect():
        key = tuple(str(row[k]) if isinstance(row[k], date) else row[k] for k in keys)
        out[key[0] if len(key) == 1 else key] = row.asDict()
    return out


def total(df, column: str) -> int:
    return df.agg(F.sum(column)).first()[0]
