"""Finance oracle: one chain of common table expressions, day by day and row by row."""

from __future__ import annotations

from evenkeel.operators import constraints
from evenkeel.plans.finance import CURATED, DIMENSIONS, OPERATIONAL, RAW
from evenkeel.schemas import TABLES

_MANAGED = "('BUILDING', 'MACHINERY')"

# Name -> body, in dependency order.
CTES: dict[str, str] = {
    "oc": """
        SELECT o.*, CAST(o.o_orderdate AS DATE) AS od, c.c_name, c.c_acctbal, c.c_mktsegment,
               n.n_name, n.n_regionkey, n.n_nationkey
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "mkt": """
        SELECT CAST(n_nationkey AS BIGINT) AS market_key, n_name AS market_id, r_name AS state_code
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "pln": f"""
        SELECT CAST(n_nationkey * 10 + CASE s.seg WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
                 WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS BIGINT) AS plan_key,
               CAST(n_nationkey AS BIGINT) AS market_key, s.seg AS plan_id,
               CASE WHEN s.seg IN {_MANAGED} THEN 'MANAGED_CARE' ELSE 'FFS_NOT_APPLICABLE' END
                 AS plan_type
        FROM nation, (SELECT DISTINCT c_mktsegment AS seg FROM customer) s
        WHERE NOT (n_regionkey = 4 AND s.seg = 'MACHINERY')""",
    "mem": """
        SELECT c_custkey AS member_key, c_name AS member_id,
               CASE WHEN c_acctbal < 5000 THEN '18-34' ELSE '65+' END AS age_band
        FROM customer WHERE c_acctbal >= 0""",
    "prov": """
        SELECT s_suppkey AS provider_key, s_name AS provider_id FROM supplier
        WHERE s_acctbal >= 0""",
    "cat": """
        SELECT DISTINCT CAST(CASE p_type WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'SMALL' THEN 3
                 WHEN 'STANDARD' THEN 4 WHEN 'ECONOMY' THEN 5 ELSE 6 END AS BIGINT) AS category_key,
               CASE p_type WHEN 'LARGE' THEN 'INPATIENT' WHEN 'MEDIUM' THEN 'INSTITUTIONAL_LT'
                 WHEN 'SMALL' THEN 'OUTPATIENT' WHEN 'STANDARD' THEN 'PROFESSIONAL'
                 WHEN 'ECONOMY' THEN 'PHARMACY' ELSE 'OTHER' END AS category_code, p_type
        FROM part""",
    "codes": """
        SELECT DISTINCT p.p_type, p.p_type || ' ' || p.p_brand AS service_code, t.ft
        FROM part p, (VALUES ('IP'), ('LT'), ('OT'), ('RX')) AS t(ft)
        WHERE NOT (p.p_type = 'PROMO' AND t.ft = 'RX')""",
    "map": """
        SELECT ft AS claim_file_type, service_code, category_key,
               CASE WHEN c.p_type = 'ECONOMY' THEN DATE '1996-01-01' ELSE DATE '1995-01-01' END AS e0,
               CASE WHEN c.p_type = 'LARGE' THEN DATE '1998-06-30' END AS e1
        FROM codes c JOIN cat ON cat.p_type = c.p_type
        UNION ALL
        SELECT ft, service_code, 6, DATE '1998-07-01', NULL FROM codes WHERE p_type = 'LARGE'""",
    "cal": """
        SELECT CAST(d AS DATE) AS d, CAST(date_trunc('month', d) AS DATE) AS month_start
        FROM (SELECT unnest(generate_series(
                date_trunc('month', min(o_orderdate)),
                CAST(last_day(max(o_orderdate)) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM orders)""",
    "months": "SELECT DISTINCT month_start FROM cal",
    "rel": f"""
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS source_row_id,
               'E' || o_custkey || '-' || strftime(od, '%Y-%m') AS span_id,
               c_name AS member_id, n_name AS market_id, c_mktsegment AS plan_id,
               CASE WHEN c_acctbal > 8000 THEN 'CHIP' ELSE 'MEDICAID' END AS program,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'LIMITED'
                    ELSE 'FULL' END AS benefit_scope,
               CASE WHEN c_acctbal < 2000 THEN 'CHILD' WHEN c_acctbal < 5000 THEN 'ADULT'
                    WHEN c_acctbal < 7500 THEN 'AGED' ELSE 'DISABILITY' END AS eligibility_group,
               CASE WHEN c_mktsegment IN {_MANAGED} THEN 'MANAGED_CARE' ELSE 'FFS' END
                 AS delivery_system,
               od AS start_date, od + CAST(o_orderkey % 60 AS INTEGER) AS end_date
        FROM oc""",
    "rhd": f"""
        SELECT 'C' || l_orderkey AS fam, CAST(l_linenumber AS BIGINT) AS ver,
               'C' || l_orderkey || ':' || l_linenumber AS vkey,
               CASE WHEN l_linenumber > 1
                    THEN 'C' || l_orderkey || ':' || (l_linenumber - 1) END AS replaces,
               c_name AS member_id, n_name AS market_id,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'FURNITURE'
                    ELSE c_mktsegment END AS plan_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'IP' WHEN '2-HIGH' THEN 'LT'
                    WHEN '5-LOW' THEN 'RX' ELSE 'OT' END AS file_type,
               CASE WHEN c_mktsegment IN {_MANAGED} THEN 'ENCOUNTER' ELSE 'FFS' END AS record_type,
               CASE WHEN flag <> 'R' THEN 'ACCEPTED' WHEN line_status = 'F' THEN 'DENIED'
                    ELSE 'VOID' END AS status,
               od AS service_start, od + l_linenumber AS service_end, shipped AS adjudicated,
               CASE WHEN c_mktsegment NOT IN {_MANAGED} THEN coalesce(paid, 0) END AS cents
        FROM (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS flag,
                     min(l_linestatus) AS line_status, CAST(max(l_shipdate) AS DATE) AS shipped,
                     CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT))
                          FILTER (l_quantity < 50) AS BIGINT) AS paid
              FROM lineitem GROUP BY l_orderkey, l_linenumber)
        JOIN oc ON o_orderkey = l_orderkey""",
    "rln": """
        SELECT 'C' || l_orderkey AS fam, CAST(l_linenumber AS BIGINT) AS ver,
               l_partkey AS line_number, p_type || ' ' || p_brand AS service_code,
               'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS provider_id,
               CAST(l_quantity AS BIGINT) AS units,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         strftime(l_shipdate, '%Y%m%d'), CAST(l_quantity AS BIGINT)) AS source_row_id
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "rpay": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS txn,
               'C' || l_orderkey AS fam, CAST(l_linenumber AS BIGINT) AS ver,
               CAST(l_shipdate AS DATE) AS payment_date,
               CASE WHEN l_returnflag = 'R' THEN 'REVERSAL' ELSE 'PAYMENT' END AS event_type,
               CASE WHEN l_returnflag = 'R' THEN l_orderkey || '-' || l_linenumber END AS reverses,
               CAST(round(l_extendedprice * 100) AS BIGINT)
                 * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS cents
        FROM lineitem""",
    "rcap": f"""
        SELECT 'CAP' || o_orderkey AS txn, c_name AS member_id, n_name AS market_id,
               c_mktsegment AS plan_id, CAST(date_trunc('month', od) AS DATE) AS coverage_month,
               od + 5 AS payment_date,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'
                    THEN 'CAP' || (o_orderkey - 1) END AS reverses,
               CAST(round(o_totalprice * 100) AS BIGINT)
                 * CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END AS cents
        FROM oc WHERE c_mktsegment IN {_MANAGED}""",
    "span": """
        SELECT r.span_id, m.member_key, k.market_key, p.plan_key, r.program, r.benefit_scope,
               r.eligibility_group, r.delivery_system, r.start_date, r.end_date, r.source_row_id
        FROM (SELECT *, row_number() OVER (PARTITION BY span_id ORDER BY source_row_id) AS rn
              FROM rel) r
        JOIN mem m USING (member_id) JOIN mkt k USING (market_id)
        JOIN pln p ON p.plan_id = r.plan_id AND p.market_key = k.market_key
        WHERE rn = 1""",
    "day": "SELECT s.*, c.d, c.month_start FROM span s JOIN cal c ON c.d >= s.start_date AND c.d <= s.end_date",
    "held": """
        SELECT member_key, month_start, market_key, plan_key, program, benefit_scope,
               eligibility_group, delivery_system, count(DISTINCT d) AS days
        FROM day GROUP BY ALL""",
    "clash": "SELECT member_key, month_start FROM held GROUP BY ALL HAVING count(*) > 1",
    "mm": """
        SELECT h.*, CASE WHEN program = 'MEDICAID' AND benefit_scope = 'FULL' THEN 1 ELSE 0 END
                 AS cohort
        FROM held h ANTI JOIN clash USING (member_key, month_start)""",
    "hdr": """
        SELECT r.*, m.member_key, k.market_key, p.plan_key
        FROM rhd r JOIN mem m USING (member_id) JOIN mkt k USING (market_id)
        JOIN pln p ON p.plan_id = r.plan_id AND p.market_key = k.market_key""",
    "lin": """
        SELECT l.*, h.vkey, mp.category_key, pr.provider_key
        FROM rln l JOIN hdr h ON h.fam = l.fam AND h.ver = l.ver
        JOIN map mp ON mp.claim_file_type = h.file_type AND mp.service_code = l.service_code
          AND mp.e0 <= h.service_end AND coalesce(mp.e1, DATE '9999-12-31') >= h.service_end
        LEFT JOIN prov pr USING (provider_id)""",
    "fin": """
        SELECT q.fam, q.vkey, q.member_key, q.market_key, q.plan_key, q.record_type, q.file_type,
               q.service_month, q.cents,
               CASE WHEN mm.market_key IS NULL THEN 'NO_EXPOSURE'
                    WHEN mm.market_key <> q.market_key OR mm.plan_key <> q.plan_key
                      THEN 'CONFLICTING_EXPOSURE'
                    WHEN cohort = 0 THEN 'OUT_OF_COHORT'
                    WHEN (q.record_type = 'FFS') <> (mm.delivery_system = 'FFS')
                      THEN 'CONFLICTING_EXPOSURE'
                    ELSE 'MATCHED' END AS population_match
        FROM (SELECT *, CAST(date_trunc('month', service_end) AS DATE) AS service_month,
                     row_number() OVER (PARTITION BY fam ORDER BY ver DESC) AS rn
              FROM hdr WHERE adjudicated <= DATE '1999-06-30') q
        LEFT JOIN mm ON mm.member_key = q.member_key AND mm.month_start = q.service_month
        WHERE rn = 1 AND status = 'ACCEPTED'""",
    "finl": """
        SELECT f.fam, f.service_month, f.market_key, f.record_type, f.population_match,
               l.line_number, l.category_key, l.provider_key, l.cents
        FROM fin f JOIN lin l USING (vkey)""",
    "pay": "SELECT r.*, h.vkey FROM rpay r JOIN hdr h ON h.fam = r.fam AND h.ver = r.ver",
    "capt": """
        SELECT r.*, m.member_key, k.market_key, p.plan_key
        FROM rcap r JOIN mem m USING (member_id) JOIN mkt k USING (market_id)
        JOIN pln p ON p.plan_id = r.plan_id AND p.market_key = k.market_key""",
    "files": """
        SELECT m.market_id, x.month_start FROM mkt m, months x
        WHERE NOT (month(x.month_start) = 12 AND m.market_id IN
                   (SELECT n_name FROM nation WHERE n_regionkey = 3))""",
    "badline": """
        SELECT l.*, h.record_type, h.status, h.vkey FROM rln l
        JOIN rhd h ON h.fam = l.fam AND h.ver = l.ver
        ANTI JOIN map ON map.claim_file_type = h.file_type AND map.service_code = l.service_code""",
    "unbal": """
        SELECT h.vkey, h.fam, h.ver, h.cents - coalesce(s.c, 0) AS diff FROM hdr h
        LEFT JOIN (SELECT vkey, sum(cents) AS c FROM lin GROUP BY ALL) s USING (vkey)
        WHERE h.record_type = 'FFS' AND h.status = 'ACCEPTED'
          AND h.vkey NOT IN (SELECT vkey FROM badline) AND abs(h.cents - coalesce(s.c, 0)) > 1""",
    "bal": """
        SELECT p.fam, count(*) FILTER (payment_date <= DATE '1999-06-30') AS n,
               CAST(sum(p.cents) FILTER (payment_date <= DATE '1999-06-30') AS BIGINT) AS ledger,
               coalesce(any_value(f.cents), 0) AS final
        FROM pay p LEFT JOIN fin f USING (fam) GROUP BY p.fam""",
    "gap": """
        SELECT r.*, r.member_id NOT IN (SELECT member_id FROM mem) AS no_member,
               r.market_id NOT IN (SELECT market_id FROM mkt) AS no_market,
               (r.market_id, r.plan_id) NOT IN
                 (SELECT (m.market_id, p.plan_id) FROM pln p JOIN mkt m USING (market_key)) AS no_plan
        FROM rel r""",
    "q1": """SELECT 'DQ_ELIG_DUPLICATE_KEY' AS rule_id, 'v1' AS rule_version, 'ALL' AS market_id,
        'ALL' AS month_start, count(*) AS ev, count(*) - count(DISTINCT span_id) AS bad,
        NULL::BIGINT AS impact, count(*) > count(DISTINCT span_id) AS failed FROM rel""",
    "q2": """SELECT 'DQ_ELIG_UNRESOLVED_REFERENCE', 'v1', 'ALL', 'ALL', count(*),
        count(*) FILTER (no_member OR no_market OR no_plan), NULL::BIGINT,
        count(*) FILTER (no_member OR no_market) > 0 FROM gap""",
    "q3": """SELECT 'DQ_LINE_UNMAPPED_SERVICE_CODE', 'v1', 'ALL', 'ALL',
        (SELECT count(*) FROM rln), count(*), CAST(coalesce(sum(cents), 0) AS BIGINT), count(*) > 0
        FROM badline""",
    "q4": """SELECT 'DQ_MISSING_MARKET_FEED', 'v1', m.market_id, CAST(x.month_start AS VARCHAR),
        1, CASE WHEN f.market_id IS NULL THEN 1 ELSE 0 END, NULL::BIGINT, f.market_id IS NULL
        FROM mkt m CROSS JOIN months x
        LEFT JOIN files f ON f.market_id = m.market_id AND f.month_start = x.month_start""",
    "q5": """SELECT 'DQ_MM_CONFLICTING_ASSIGNMENT', 'v1', 'ALL', 'ALL', (SELECT count(*) FROM span),
        (SELECT count(*) FROM clash), NULL::BIGINT, (SELECT count(*) FROM clash) > 0""",
    "q6": """SELECT 'DQ_CLAIM_POPULATION_MATCH', 'v3', 'ALL', 'ALL', count(*),
        count(*) FILTER (population_match IN ('NO_EXPOSURE', 'CONFLICTING_EXPOSURE')),
        CAST(coalesce(sum(cents) FILTER (population_match IN ('NO_EXPOSURE', 'CONFLICTING_EXPOSURE')), 0)
             AS BIGINT),
        count(*) FILTER (population_match IN ('NO_EXPOSURE', 'CONFLICTING_EXPOSURE')) > 0 FROM fin""",
    "q7": """SELECT 'DQ_HEADER_LINE_BALANCE', 'v1', 'ALL', 'ALL',
        (SELECT count(*) FROM hdr WHERE record_type = 'FFS' AND status = 'ACCEPTED'),
        (SELECT count(*) FROM unbal), NULL::BIGINT, (SELECT count(*) FROM unbal) > 0""",
    "q8": """SELECT 'DQ_LEDGER_RECONCILES_TO_CLAIMS', 'v1', 'ALL', 'ALL', count(*),
        count(*) FILTER (n > 0 AND abs(ledger - final) > 1), NULL::BIGINT,
        count(*) FILTER (n > 0 AND abs(ledger - final) > 1) > 0 FROM bal""",
    "q9": """SELECT 'DQ_CAPITATION_CORRECTION_LINKED', 'v1', 'ALL', 'ALL', count(*),
        count(*) FILTER (cents < 0 AND reverses IS NULL), NULL::BIGINT,
        count(*) FILTER (cents < 0 AND reverses IS NULL) > 0 FROM rcap""",
    "dq": """
        SELECT 'RUN_0001' AS run_id, rule_id, rule_version, market_id, month_start,
               'BLOCKING' AS severity, CAST(ev AS BIGINT) AS evaluated_count,
               CAST(bad AS BIGINT) AS failing_row_count, impact AS financial_impact_cents,
               CASE WHEN failed THEN 'FAIL' ELSE 'PASS' END AS disposition
        FROM (FROM q1 UNION ALL FROM q2 UNION ALL FROM q3 UNION ALL FROM q4 UNION ALL FROM q5
              UNION ALL FROM q6 UNION ALL FROM q7 UNION ALL FROM q8 UNION ALL FROM q9)""",
    "status": """
        SELECT m.market_key, x.month_start,
               CASE WHEN (SELECT count(*) FROM dq WHERE market_id = 'ALL' AND disposition = 'FAIL') > 0
                    THEN 'UNAVAILABLE_RUN'
                    WHEN b.market_id IS NOT NULL THEN 'UNAVAILABLE_PARTITION'
                    ELSE 'AVAILABLE' END AS partition_status
        FROM mkt m CROSS JOIN months x
        LEFT JOIN (SELECT DISTINCT market_id, month_start FROM dq
                   WHERE market_id <> 'ALL' AND disposition = 'FAIL') b
          ON b.market_id = m.market_id AND b.month_start = CAST(x.month_start AS VARCHAR)""",
    "expo": """
        SELECT month_start, market_key, delivery_system, count(*) AS member_months,
               count(DISTINCT member_key) AS distinct_members
        FROM mm WHERE cohort = 1 GROUP BY ALL""",
    "spend": """
        SELECT service_month AS month_start, market_key, CAST(sum(cents) AS BIGINT) AS paid_cents
        FROM finl WHERE record_type = 'FFS' AND population_match = 'MATCHED' GROUP BY ALL""",
    "clm": """
        SELECT service_month AS month_start, market_key, count(DISTINCT fam) AS claim_count
        FROM fin WHERE record_type = 'FFS' AND population_match = 'MATCHED' GROUP BY ALL""",
    "catm": """
        SELECT service_month AS month_start, market_key, category_key,
               CAST(sum(cents) AS BIGINT) AS category_paid_cents,
               count(DISTINCT fam) AS claims_containing_category
        FROM finl WHERE record_type = 'FFS' AND population_match = 'MATCHED' GROUP BY ALL""",
    "enc": """
        SELECT service_month AS month_start, market_key, count(DISTINCT fam) AS encounter_count
        FROM fin WHERE record_type = 'ENCOUNTER' AND population_match = 'MATCHED' GROUP BY ALL""",
    "capm": """
        SELECT coverage_month AS month_start, market_key, CAST(sum(cents) AS BIGINT)
                 AS capitation_cents
        FROM capt GROUP BY ALL""",
    "kffs": """
        SELECT 'RUN_0001' AS run_id, e.month_start, e.market_key, s.partition_status,
               e.member_months, e.distinct_members, coalesce(p.paid_cents, 0) AS ffs_paid_cents,
               CAST(coalesce(p.paid_cents, 0) AS DOUBLE) / e.member_months AS ffs_pmpm_cents,
               coalesce(c.claim_count, 0) AS ffs_claim_count,
               CAST(coalesce(c.claim_count, 0) AS DOUBLE) * 1000 / e.member_months
                 AS ffs_claims_per_1000_mm,
               CASE WHEN c.claim_count > 0
                    THEN CAST(coalesce(p.paid_cents, 0) AS DOUBLE) / c.claim_count END
                 AS ffs_avg_claim_cost_cents
        FROM expo e JOIN status s USING (month_start, market_key)
        LEFT JOIN spend p USING (month_start, market_key)
        LEFT JOIN clm c USING (month_start, market_key)
        WHERE e.delivery_system = 'FFS'""",
    "hist": """
        SELECT *, list(ffs_pmpm_cents) OVER h AS base, min(month_start) OVER h AS base_start
        FROM kffs WINDOW h AS (PARTITION BY market_key ORDER BY month_start
                               ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)""",
    "med": """
        SELECT *, coalesce(len(base) = 12 AND base_start = month_start - INTERVAL 12 MONTH, FALSE) AS full12,
          CASE WHEN len(base) = 12 AND base_start = month_start - INTERVAL 12 MONTH
               THEN list_median(base) END AS md FROM hist""",
    "mad": """
        SELECT *, list_median(list_transform(base, lambda x: abs(x - md))) AS mad,
          month_start >= DATE '1999-04-01' AS prov FROM med""",
    "lastv": "SELECT fam, max(ver) AS v FROM hdr WHERE adjudicated <= DATE '1999-06-30' GROUP BY fam",
    "expm": """
        SELECT month_start, market_key, plan_key, delivery_system, eligibility_group,
               count(*) AS member_months FROM mm WHERE cohort = 1 GROUP BY ALL""",
    "fing": """
        SELECT f.*, f.service_month AS month_start, m.delivery_system, m.eligibility_group FROM fin f
        JOIN mm m ON m.member_key = f.member_key AND m.month_start = f.service_month
        WHERE f.population_match = 'MATCHED'""",
}


def with_ctes(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    return f"WITH {body}\n{select}"


_SPAN = """SELECT span_id AS eligibility_span_id, 'RUN_0001' AS run_id, member_key, market_key,
    plan_key, program, benefit_scope, eligibility_group, delivery_system, start_date, end_date,
    'SRC_raw_eligibility_span' AS source_file_id, source_row_id FROM span"""
_FILE = """'SRC_CLAIMS_' || market_id || '_' || CAST(date_trunc('month', service_end) AS DATE)"""

def _marked(*columns: str) -> str:
    """Values behind their lengths, joined; a null is marked."""
    return " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) || ';', 'N;')"
                       for c in columns)


def _lane(place: int) -> str:
    """The sum of one of four 64-bit parts of the rows' digests, as text."""
    part = f"substr(sha256(t), {16 * place + 1}, 16)"
    return f"CAST(sum(CAST(CAST('0x' || {part} AS UBIGINT) AS HUGEINT)) AS VARCHAR)"


SELECTS: dict[str, str] = {
    "eligibility_spans": _SPAN,
    "member_months": """SELECT 'RUN_0001' AS run_id, member_key, month_start, market_key, plan_key,
        program, benefit_scope, eligibility_group, delivery_system,
        CAST(days AS INTEGER) AS eligible_days, 1 AS member_month_weight, cohort AS in_primary_cohort
        FROM mm""",
    "conflicting_member_months":
        "SELECT 'RUN_0001' AS run_id, member_key, month_start FROM clash",
    "claim_header_versions": f"""SELECT h.vkey AS claim_version_key, 'RUN_0001' AS run_id,
        h.fam AS claim_family_key, h.ver AS version_number, p.vkey AS replaces_version_key,
        h.member_key, h.market_key, h.plan_key, h.file_type AS claim_file_type, h.record_type,
        h.status, h.service_start AS service_start_date, h.service_end AS service_end_date,
        h.adjudicated AS adjudicated_at, h.cents AS header_paid_amount_cents,
        {_FILE.replace('market_id', 'h.market_id').replace('service_end)', 'h.service_end)')}
          AS source_file_id, h.vkey AS source_row_id
        FROM hdr h LEFT JOIN hdr p ON p.vkey = h.replaces""",
    "numbered_versions": """SELECT fam AS claim_family_key, ver AS version_number,
        row_number() OVER (ORDER BY fam, ver) AS claim_version_number FROM hdr""",
    "claim_line_versions": """SELECT 'RUN_0001' AS run_id, vkey AS claim_version_key, line_number,
        category_key, service_code, provider_key, units, cents AS line_paid_amount_cents FROM lin""",
    "claim_finals": """SELECT 'RUN_0001' AS run_id, fam AS claim_family_key,
        vkey AS claim_version_key, member_key, market_key, plan_key, record_type,
        file_type AS claim_file_type, service_month, cents AS header_paid_amount_cents,
        population_match FROM fin""",
    "claim_line_finals": """SELECT 'RUN_0001' AS run_id, fam AS claim_family_key, line_number,
        category_key, provider_key, cents AS line_paid_amount_cents FROM finl""",
    "payment_ledger": """SELECT txn AS payment_transaction_id, 'RUN_0001' AS run_id,
        fam AS claim_family_key, vkey AS claim_version_key, payment_date, event_type,
        reverses AS reverses_transaction_id, cents AS signed_amount_cents,
        'SRC_raw_payment_transaction' AS source_file_id, txn AS source_row_id FROM pay""",
    "capitation_ledger": """SELECT txn AS capitation_transaction_id, 'RUN_0001' AS run_id,
        member_key, market_key, plan_key, coverage_month, payment_date,
        reverses AS reverses_transaction_id, cents AS signed_amount_cents,
        'SRC_raw_capitation_transaction' AS source_file_id, txn AS source_row_id FROM capt""",
    "family_balances": """SELECT 'RUN_0001' AS run_id, fam AS claim_family_key,
        ledger AS ledger_cents, n AS rows_through_cutoff, final AS final_cents,
        n > 0 AND abs(ledger - final) > 1 AS is_unreconciled FROM bal""",
    "calendar": """SELECT CAST(d - min(d) OVER () + 1 AS BIGINT) AS date_key, d AS calendar_date,
        month_start, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_number,
        CAST(day(last_day(d)) AS INTEGER) AS days_in_month FROM cal""",
    "expected_partitions": """SELECT 'RUN_0001' AS run_id, market_id, month_start,
        'claims' AS entity FROM mkt, months""",
    "source_files": """
        SELECT 'SRC_CLAIMS_' || f.market_id || '_' || f.month_start AS source_file_id,
               f.market_id, f.month_start, coalesce(c.n, 0) AS row_count,
               coalesce(c.h, sha256('0,0,0,0')) AS content_hash
        FROM files f LEFT JOIN (
          SELECT market_id, month_start, count(*) AS n,
                 sha256(""" + " || ',' || ".join(_lane(i) for i in range(4)) + """) AS h
          FROM (
            SELECT market_id, CAST(date_trunc('month', service_end) AS DATE) AS month_start,
              """ + _marked(
                  "'SRC_CLAIMS_' || market_id || '_' || CAST(date_trunc('month', service_end) AS DATE)", "vkey",
                  "'RUN_0001'", "fam", "ver", "replaces", "member_id", "market_id", "plan_id", "file_type",
                  "record_type", "status", "service_start", "service_end", "adjudicated", "cents") + """ AS t
            FROM rhd
            UNION ALL
            SELECT h.market_id, CAST(date_trunc('month', h.service_end) AS DATE),
              """ + _marked(
                  "'SRC_raw_claim_line'", "l.source_row_id", "'RUN_0001'", "l.fam", "l.ver", "l.line_number",
                  "l.service_code", "l.provider_id", "l.units", "l.cents") + """
            FROM rln l JOIN rhd h ON h.fam = l.fam AND h.ver = l.ver)
          GROUP BY ALL) c USING (market_id, month_start)""",
    "dq_results": "SELECT * FROM dq",
    "run_status": """SELECT run_id, count(*) AS rule_results,
        count(*) FILTER (disposition = 'FAIL') AS blocking_failures,
        CASE WHEN count(*) FILTER (disposition = 'FAIL') > 0 THEN 'FAILED'
             ELSE 'READY_FOR_REVIEW' END AS status FROM dq GROUP BY run_id""",
    "quarantine": """
        SELECT DISTINCT 'RUN_0001' AS run_id, source_file_id, source_row_id, rule_id, reason,
               'OPEN' AS remediation_status FROM (
          SELECT 'SRC_raw_eligibility_span' AS source_file_id, source_row_id,
                 'DQ_ELIG_DUPLICATE_KEY' AS rule_id, 'span key landed before' AS reason
          FROM (SELECT *, row_number() OVER (PARTITION BY span_id ORDER BY source_row_id) AS rn
                FROM rel) WHERE rn > 1
          UNION ALL
          SELECT 'SRC_raw_eligibility_span', source_row_id, 'DQ_ELIG_UNRESOLVED_REFERENCE',
                 'unknown ' || concat_ws(', ', CASE WHEN no_member THEN 'member' END,
                   CASE WHEN no_market THEN 'market' END, CASE WHEN no_plan THEN 'plan' END)
          FROM gap WHERE no_member OR no_market OR no_plan
          UNION ALL
          SELECT 'SRC_raw_claim_line', source_row_id, 'DQ_LINE_UNMAPPED_SERVICE_CODE',
                 'no category for ' || service_code FROM badline
          UNION ALL
          SELECT 'SRC_CLAIMS_' || h.market_id || '_' || CAST(date_trunc('month', h.service_end) AS DATE),
                 h.vkey, 'DQ_CLAIM_POPULATION_MATCH', f.population_match
          FROM fin f JOIN hdr h USING (vkey)
          WHERE f.population_match IN ('NO_EXPOSURE', 'CONFLICTING_EXPOSURE')
          UNION ALL
          SELECT 'SRC_CLAIMS_' || h.market_id || '_' || CAST(date_trunc('month', h.service_end) AS DATE),
                 h.vkey, 'DQ_HEADER_LINE_BALANCE', 'header minus lines: ' || u.diff || ' cents'
          FROM unbal u JOIN hdr h USING (vkey)
          UNION ALL
          SELECT 'SRC_raw_capitation_transaction', txn, 'DQ_CAPITATION_CORRECTION_LINKED',
                 'negative amount reverses nothing' FROM rcap WHERE cents < 0 AND reverses IS NULL)""",
    "partition_status": """SELECT 'RUN_0001' AS run_id, month_start, market_key, partition_status
        FROM status""",
    "partition_status_feeds": """SELECT 'RUN_0001' AS run_id, x.month_start, m.market_key,
        CASE WHEN f.market_id IS NULL THEN 'UNAVAILABLE_PARTITION' ELSE 'AVAILABLE' END
          AS partition_status
        FROM mkt m CROSS JOIN months x
        LEFT JOIN files f ON f.market_id = m.market_id AND f.month_start = x.month_start""",
    "primary_exposure": """SELECT 'RUN_0001' AS run_id, member_key, month_start, market_key, plan_key,
        delivery_system, eligibility_group, 1 AS member_month_weight,
        CAST(days AS INTEGER) AS eligible_days FROM mm WHERE cohort = 1""",
    "exposure_month": "SELECT 'RUN_0001' AS run_id, * FROM expo",
    "ffs_spend_month": "SELECT 'RUN_0001' AS run_id, * FROM spend",
    "ffs_claims_month": "SELECT 'RUN_0001' AS run_id, * FROM clm",
    "ffs_category_month": "SELECT 'RUN_0001' AS run_id, * FROM catm",
    "encounter_month": "SELECT 'RUN_0001' AS run_id, * FROM enc",
    "capitation_month": "SELECT 'RUN_0001' AS run_id, * FROM capm",
    "kpi_ffs_month": "SELECT * FROM kffs",
    "kpi_managed_care_month": """SELECT 'RUN_0001' AS run_id, e.month_start, e.market_key,
        s.partition_status, e.member_months, e.distinct_members,
        coalesce(n.encounter_count, 0) AS encounter_count,
        CAST(coalesce(n.encounter_count, 0) AS DOUBLE) * 1000 / e.member_months
          AS encounters_per_1000_mm,
        coalesce(c.capitation_cents, 0) AS capitation_cents,
        CAST(coalesce(c.capitation_cents, 0) AS DOUBLE) / e.member_months AS capitation_pmpm_cents
        FROM expo e JOIN status s USING (month_start, market_key)
        LEFT JOIN enc n USING (month_start, market_key)
        LEFT JOIN capm c USING (month_start, market_key)
        WHERE e.delivery_system = 'MANAGED_CARE'""",
    "kpi_period_membership": """SELECT 'RUN_0001' AS run_id, market_key, delivery_system,
        CAST(sum(member_months) AS BIGINT) AS total_member_months,
        count(DISTINCT month_start) AS months_present,
        (SELECT count(*) FROM months) AS months_expected,
        CASE WHEN count(DISTINCT month_start) = (SELECT count(*) FROM months)
             THEN CAST(sum(member_months) AS DOUBLE) / count(DISTINCT month_start) END
          AS average_monthly_membership
        FROM expo GROUP BY market_key, delivery_system""",
    "kpi_ffs_category_month": """SELECT 'RUN_0001' AS run_id, c.month_start, c.market_key,
        c.category_key, cat.category_code, k.partition_status, c.category_paid_cents,
        k.ffs_paid_cents AS market_month_paid_cents,
        CASE WHEN k.ffs_paid_cents > 0 THEN CAST(c.category_paid_cents AS DOUBLE) * 100
             / k.ffs_paid_cents END AS ffs_spend_share_pct,
        k.member_months,
        CAST(c.category_paid_cents AS DOUBLE) / k.member_months
          AS category_contribution_to_pmpm_cents,
        c.claims_containing_category
        FROM catm c JOIN cat USING (category_key) JOIN kffs k USING (month_start, market_key)""",
    "preflight_blockers": """
        SELECT 'RUN_0001' AS run_id, 'RUN_NOT_READY' AS code, 'FAILED' AS status,
               NULL AS rule_id, NULL AS rule_version, NULL AS market_id, NULL AS month_start,
               NULL AS disposition FROM (SELECT count(*) AS n FROM dq WHERE disposition = 'FAIL')
        WHERE n > 0
        UNION ALL
        SELECT run_id, 'RULE_NOT_PASSED', NULL, rule_id, rule_version, market_id, month_start,
               disposition FROM dq WHERE disposition <> 'PASS' OR failing_row_count <> 0""",
    "table_counts": """
        SELECT 'eligibility_span' AS table_name, count(*) AS row_count FROM span
        UNION ALL SELECT 'fact_member_month', count(*) FROM mm
        UNION ALL SELECT 'claim_header_version', count(*) FROM hdr
        UNION ALL SELECT 'claim_line_version', count(*) FROM lin
        UNION ALL SELECT 'fact_claim_header_final', count(*) FROM fin
        UNION ALL SELECT 'fact_claim_line_final', count(*) FROM finl
        UNION ALL SELECT 'fact_payment_transaction', count(*) FROM pay
        UNION ALL SELECT 'fact_capitation_transaction', count(*) FROM capt
        UNION ALL SELECT 'dq_result', count(*) FROM dq""",
}
_REASON = """CASE WHEN no_member THEN 'unknown member' WHEN no_market THEN 'unknown market'
    ELSE 'unknown plan' END"""


def _gaps(table: str) -> str:
    return f"""(SELECT r.*, r.member_id NOT IN (SELECT member_id FROM mem) AS no_member,
        r.market_id NOT IN (SELECT market_id FROM mkt) AS no_market,
        (r.market_id, r.plan_id) NOT IN (SELECT (m.market_id, p.plan_id)
           FROM pln p JOIN mkt m USING (market_key)) AS no_plan FROM {table} r)"""


_MART = "month_start, market_key, plan_key, delivery_system, eligibility_group"
SELECTS |= {
    "payment_month": """SELECT 'RUN_0001' AS run_id,
        CAST(date_trunc('month', payment_date) AS DATE) AS payment_month,
        CAST(sum(cents) AS BIGINT) AS net_payment_cents, count(*) AS transactions
        FROM pay GROUP BY 2""",
    "ffs_variance": """
        SELECT 'RUN_0001' AS run_id, k.market_key, k.month_start, k.partition_status,
          k.ffs_paid_cents, p.ffs_paid_cents AS prior_paid_cents,
          k.ffs_paid_cents - p.ffs_paid_cents AS change_cents,
          CASE WHEN p.ffs_paid_cents > 0 THEN CAST(k.ffs_paid_cents - p.ffs_paid_cents AS DOUBLE)
            * 100 / p.ffs_paid_cents END AS change_pct,
          coalesce(p.ffs_paid_cents = 0 AND k.ffs_paid_cents > 0, FALSE) AS is_new_activity,
          (k.member_months - p.member_months) * p.ffs_pmpm_cents AS membership_effect_cents,
          k.member_months * (k.ffs_pmpm_cents - p.ffs_pmpm_cents) AS pmpm_effect_cents,
          coalesce(CASE WHEN p.ffs_paid_cents > 0
            THEN abs(k.ffs_paid_cents - p.ffs_paid_cents) >= 1000000 AND
              abs(CAST(k.ffs_paid_cents - p.ffs_paid_cents AS DOUBLE) * 100 / p.ffs_paid_cents) >= 10
            WHEN p.ffs_paid_cents = 0 THEN k.ffs_paid_cents >= 1000000 END, FALSE) AS is_material
        FROM kffs k LEFT JOIN kffs p ON p.market_key = k.market_key
          AND p.month_start = CAST(k.month_start - INTERVAL 1 MONTH AS DATE)""",
    "category_contributions": """
        SELECT * FROM (WITH parts AS (
          SELECT k.month_start, k.market_key, k.ffs_paid_cents AS s, c.category_key, c.category_paid_cents AS c,
            sum(c.category_paid_cents) OVER (PARTITION BY k.month_start, k.market_key) AS w
          FROM kffs k LEFT JOIN (SELECT * FROM catm WHERE category_paid_cents > 0) c USING (month_start, market_key)),
        shares AS (SELECT *, CASE WHEN w IS NULL THEN CAST(s AS HUGEINT) ELSE CAST(s AS HUGEINT) * c // w END AS share,
            CASE WHEN w IS NULL THEN CAST(0 AS HUGEINT) ELSE CAST(s AS HUGEINT) * c % w END AS rest FROM parts),
        given AS (SELECT month_start, market_key, category_key, CAST(share + CASE WHEN
              row_number() OVER (PARTITION BY month_start, market_key ORDER BY rest DESC, category_key NULLS FIRST)
              <= s - sum(share) OVER (PARTITION BY month_start, market_key) THEN 1 ELSE 0 END AS BIGINT) AS cents
          FROM shares),
        pairs AS (SELECT k.month_start, k.market_key, k.ffs_paid_cents - p.ffs_paid_cents AS change_cents,
            p.month_start AS before FROM kffs k JOIN kffs p ON p.market_key = k.market_key
            AND p.month_start = CAST(k.month_start - INTERVAL 1 MONTH AS DATE)),
        held AS (
          SELECT p.month_start, p.market_key, p.change_cents, g.category_key, g.cents AS now, 0 AS old
          FROM pairs p JOIN given g USING (month_start, market_key)
          UNION ALL SELECT p.month_start, p.market_key, p.change_cents, g.category_key, 0, g.cents
          FROM pairs p JOIN given g ON g.market_key = p.market_key AND g.month_start = p.before)
        SELECT 'RUN_0001' AS run_id, market_key, month_start, category_key,
          CAST(sum(now) AS BIGINT) AS current_cents, CAST(sum(old) AS BIGINT) AS prior_cents,
          CAST(sum(now) - sum(old) AS BIGINT) AS contribution_cents, change_cents,
          CASE WHEN change_cents <> 0 THEN CAST(sum(now) - sum(old) AS DOUBLE) * 100 / change_cents END
            AS contribution_pct
        FROM held GROUP BY market_key, month_start, category_key, change_cents)""",
    "pmpm_anomalies": """
        SELECT run_id, market_key, month_start, member_months, ffs_pmpm_cents, md AS median_pmpm,
          score, impact_cents, CASE WHEN prov THEN 'PRELIMINARY_ADVISORY'
            WHEN score IS NULL THEN 'NOT_EVALUATED'
            WHEN abs(score) > 3.5 AND impact_cents >= 1000000 THEN 'CANDIDATE'
            ELSE 'NO_CANDIDATE' END AS outcome
        FROM (SELECT *, CASE WHEN ok THEN 0.6745::DOUBLE * (ffs_pmpm_cents - md) / mad END AS score,
                CASE WHEN ok THEN abs(ffs_pmpm_cents - md) * member_months END AS impact_cents
              FROM (SELECT *, NOT prov AND full12 AND mad > 0 AND member_months >= 100 AS ok
                    FROM mad))""",
    "claim_bridge": """
        SELECT 'RUN_0001' AS run_id, r.market_id,
          CASE WHEN h.vkey IS NULL THEN 'UNRESOLVED_REFERENCE'
            WHEN r.adjudicated > DATE '1999-06-30' THEN 'AFTER_CUTOFF'
            WHEN r.ver < l.v THEN 'SUPERSEDED' WHEN r.status <> 'ACCEPTED' THEN 'DENIED_OR_VOID'
            ELSE f.population_match END AS reason,
          count(*) AS versions, CAST(coalesce(sum(r.cents), 0) AS BIGINT) AS cents
        FROM rhd r LEFT JOIN hdr h ON h.vkey = r.vkey LEFT JOIN lastv l ON l.fam = r.fam
        LEFT JOIN fin f ON f.fam = r.fam WHERE r.record_type = 'FFS' GROUP BY ALL""",
    "drop_report": f"""
        SELECT table_name, reason, count(*) AS rows, CAST(sum(cents) AS BIGINT) AS cents FROM (
          SELECT 'raw_eligibility_span' AS table_name, 'span key landed before' AS reason,
            NULL::BIGINT AS cents FROM (SELECT row_number() OVER (PARTITION BY span_id
              ORDER BY source_row_id) AS rn FROM rel) WHERE rn > 1
          UNION ALL SELECT 'raw_eligibility_span', {_REASON}, NULL FROM (SELECT *, row_number()
              OVER (PARTITION BY span_id ORDER BY source_row_id) AS rn FROM {_gaps('rel')})
            WHERE rn = 1 AND (no_member OR no_market OR no_plan)
          UNION ALL SELECT 'raw_claim_header', {_REASON}, cents FROM {_gaps('rhd')}
            WHERE no_member OR no_market OR no_plan
          UNION ALL SELECT 'raw_capitation_transaction', {_REASON}, cents FROM {_gaps('rcap')}
            WHERE no_member OR no_market OR no_plan
          UNION ALL SELECT 'raw_claim_line', 'no header version', cents FROM rln l
            ANTI JOIN hdr h ON h.fam = l.fam AND h.ver = l.ver
          UNION ALL SELECT 'raw_payment_transaction', 'no header version', cents FROM rpay l
            ANTI JOIN hdr h ON h.fam = l.fam AND h.ver = l.ver
          UNION ALL SELECT 'raw_claim_line', CASE WHEN (h.file_type, l.service_code) IN
              (SELECT (claim_file_type, service_code) FROM map)
              THEN 'code not in force on the service date' ELSE 'code not mapped' END, l.cents
            FROM rln l JOIN hdr h ON h.fam = l.fam AND h.ver = l.ver
            WHERE NOT EXISTS (SELECT 1 FROM map WHERE map.claim_file_type = h.file_type
              AND map.service_code = l.service_code AND map.e0 <= h.service_end
              AND coalesce(map.e1, DATE '9999-12-31') >= h.service_end)
        ) GROUP BY ALL""",
    "finance_mart": f"""
        SELECT 'RUN_0001' AS run_id, e.*, coalesce(s.paid, 0) AS ffs_paid_cents,
          coalesce(s.n, 0) AS ffs_claim_count, coalesce(n.n, 0) AS encounter_count,
          coalesce(c.paid, 0) AS capitation_cents
        FROM expm e
        LEFT JOIN (SELECT {_MART}, count(*) AS n, CAST(sum(x.cents) AS BIGINT) AS paid
                   FROM fing LEFT JOIN (SELECT fam, sum(cents) AS cents FROM finl GROUP BY fam) x
                     USING (fam) WHERE record_type = 'FFS' GROUP BY ALL) s USING ({_MART})
        LEFT JOIN (SELECT {_MART}, count(*) AS n FROM fing WHERE record_type = 'ENCOUNTER'
                   GROUP BY ALL) n USING ({_MART})
        LEFT JOIN (SELECT m.month_start, m.market_key, m.plan_key, m.delivery_system,
                     m.eligibility_group, CAST(sum(c.cents) AS BIGINT) AS paid
                   FROM capt c JOIN mm m ON m.member_key = c.member_key
                     AND m.month_start = c.coverage_month AND m.market_key = c.market_key
                     AND m.plan_key = c.plan_key AND m.cohort = 1 GROUP BY ALL) c USING ({_MART})""",
    "category_mart": f"""
        SELECT 'RUN_0001' AS run_id, {_MART.replace('month_start', 'f.month_start').replace(
            'market_key', 'f.market_key')}, l.category_key,
          CAST(sum(l.cents) AS BIGINT) AS category_paid_cents,
          count(DISTINCT f.fam) AS claims_containing_category
        FROM fing f JOIN finl l ON l.fam = f.fam WHERE f.record_type = 'FFS'
        GROUP BY ALL""",
    "quality_failure_rate": f"""
        SELECT failing_rows, raw_rows, CAST(failing_rows AS DOUBLE) * 100 / raw_rows
          AS failure_rate_pct
        FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT source_file_id, source_row_id
                      FROM ({SELECTS['quarantine']}))) AS failing_rows,
              (SELECT count(*) FROM rel) + (SELECT count(*) FROM rhd) + (SELECT count(*) FROM rln)
              + (SELECT count(*) FROM rpay) + (SELECT count(*) FROM rcap) AS raw_rows)""",
    "constraint_violations": """
        SELECT * FROM (
          SELECT 'dim_member' AS table_name, 'CHECK' AS constraint_kind,
            'synthetic_id' AS constraint_name, count(*) AS violations FROM mem
            WHERE NOT starts_with(member_id, 'SYN_')
          UNION ALL SELECT 'dim_provider', 'CHECK', 'synthetic_id', count(*) FROM prov
            WHERE NOT starts_with(provider_id, 'SYN_')
          UNION ALL SELECT 'raw_claim_line', 'UNIQUE', 'source_file_id,source_row_id',
            count(*) - count(DISTINCT source_row_id) FROM rln
          UNION ALL SELECT 'raw_payment_transaction', 'UNIQUE', 'source_file_id,source_row_id',
            count(*) - count(DISTINCT txn) FROM rpay
          UNION ALL SELECT 'raw_eligibility_span', 'REFERENCE', 'source_file_id', count(*) FROM rel
          UNION ALL SELECT 'raw_claim_line', 'REFERENCE', 'source_file_id', count(*) FROM rln
          UNION ALL SELECT 'raw_payment_transaction', 'REFERENCE', 'source_file_id', count(*) FROM rpay
          UNION ALL SELECT 'raw_capitation_transaction', 'REFERENCE', 'source_file_id', count(*) FROM rcap
          UNION ALL SELECT 'raw_claim_header', 'REFERENCE', 'source_file_id', count(*) FROM rhd r
            ANTI JOIN files f ON f.market_id = r.market_id
              AND f.month_start = CAST(date_trunc('month', r.service_end) AS DATE)
          UNION ALL SELECT 'eligibility_span', 'REFERENCE', 'source_file_id', count(*) FROM span
          UNION ALL SELECT 'claim_header_version', 'REFERENCE', 'source_file_id', count(*) FROM hdr r
            ANTI JOIN files f ON f.market_id = r.market_id
              AND f.month_start = CAST(date_trunc('month', r.service_end) AS DATE)
          UNION ALL SELECT 'claim_line_version', 'UNIQUE', 'claim_version_key,line_number',
            count(*) - count(DISTINCT (vkey, line_number)) FROM lin
          UNION ALL SELECT 'claim_line_version', 'CHECK', 'line_positive', count(*) FROM lin
            WHERE line_number < 1
          UNION ALL SELECT 'fact_claim_line_final', 'UNIQUE', 'run_id,claim_family_key,line_number',
            count(*) - count(DISTINCT (fam, line_number)) FROM finl
          UNION ALL SELECT 'fact_payment_transaction', 'UNIQUE', 'payment_transaction_id',
            count(*) - count(DISTINCT txn) FROM pay
          UNION ALL SELECT 'fact_payment_transaction', 'REFERENCE', 'source_file_id', count(*) FROM pay
          UNION ALL SELECT 'fact_payment_transaction', 'REFERENCE', 'reverses_transaction_id',
            count(*) FROM pay WHERE reverses IS NOT NULL AND reverses NOT IN (SELECT txn FROM pay)
          UNION ALL SELECT 'fact_capitation_transaction', 'REFERENCE', 'source_file_id', count(*) FROM capt
          UNION ALL SELECT 'fact_capitation_transaction', 'REFERENCE', 'reverses_transaction_id',
            count(*) FROM capt WHERE reverses IS NOT NULL AND reverses NOT IN (SELECT txn FROM capt)
          UNION ALL SELECT 'fact_capitation_transaction', 'CHECK', 'negative_is_linked',
            count(*) FROM capt WHERE cents < 0 AND reverses IS NULL
        ) WHERE violations > 0""",
}
for _rule, _cte in (
    ("dq_duplicate_span_keys", "DQ_ELIG_DUPLICATE_KEY"),
    ("dq_unresolved_references", "DQ_ELIG_UNRESOLVED_REFERENCE"),
    ("dq_unmapped_service_codes", "DQ_LINE_UNMAPPED_SERVICE_CODE"),
    ("dq_missing_market_feeds", "DQ_MISSING_MARKET_FEED"),
    ("dq_conflicting_assignments", "DQ_MM_CONFLICTING_ASSIGNMENT"),
    ("dq_claim_population", "DQ_CLAIM_POPULATION_MATCH"),
    ("dq_header_line_balance", "DQ_HEADER_LINE_BALANCE"),
    ("dq_ledger_reconciles", "DQ_LEDGER_RECONCILES_TO_CLAIMS"),
    ("dq_capitation_linked", "DQ_CAPITATION_CORRECTION_LINKED"),
):
    SELECTS[_rule] = f"SELECT * FROM dq WHERE rule_id = '{_cte}'"


SELECTS["stored_exposure"] = SELECTS["exposure_month"]
# Violations of the star's own rows, and of the rows that the planted run changes.
_COUNTED = """
    SELECT 'pipeline_run' AS t, 'CHECK' AS k, 'dates_ordered' AS c, 1 AS n
    UNION ALL SELECT 'source_file', 'CHECK', 'row_count_not_negative', count(*) FROM files WHERE month(month_start) = 11
    UNION ALL SELECT 'dim_date', 'CHECK', 'month_number_range', count(*) FROM cal WHERE month(d) = 12
    UNION ALL SELECT 'dim_date', 'CHECK', 'days_in_month_range', count(*) FROM cal WHERE month(d) = 2
    UNION ALL SELECT 'dim_member', 'CHECK', 'synthetic_id', count(*) FROM mem WHERE NOT starts_with(member_id, 'SYN_')
    UNION ALL SELECT 'dim_provider', 'CHECK', 'synthetic_id', count(*) FROM prov
      WHERE NOT starts_with(provider_id, 'SYN_')
    UNION ALL SELECT 'dq_result', 'CHECK', 'failing_within_evaluated', 2
    UNION ALL SELECT 'dq_result', 'CHECK', 'counts_not_negative', 1
    UNION ALL SELECT 'dq_result', 'CHECK', 'disposition_code', 1
    UNION ALL SELECT 'raw_claim_line', 'UNIQUE', 'source_file_id,source_row_id',
      count(*) - count(DISTINCT source_row_id) FROM rln
    UNION ALL SELECT 'raw_payment_transaction', 'UNIQUE', 'source_file_id,source_row_id',
      count(*) - count(DISTINCT txn) FROM rpay
    UNION ALL SELECT 'raw_claim_header', 'REFERENCE', 'source_file_id', count(*) FROM rhd r
      ANTI JOIN files f ON f.market_id = r.market_id
        AND f.month_start = CAST(date_trunc('month', r.service_end) AS DATE)
    UNION ALL SELECT 'eligibility_span', 'CHECK', 'dates_ordered', count(*) FROM span WHERE span_id LIKE '%3'
    UNION ALL SELECT 'eligibility_span', 'CHECK', 'program_code', count(*) FROM span WHERE span_id LIKE '%-07'
    UNION ALL SELECT 'fact_member_month', 'CHECK', 'eligible_days_range', count(*) FROM mm WHERE month(month_start) = 2
    UNION ALL SELECT 'fact_member_month', 'CHECK', 'weight_is_one', count(*) FROM mm WHERE month(month_start) = 3
    UNION ALL SELECT 'fact_member_month', 'CHECK', 'cohort_flag', count(*) FROM mm
      WHERE month(month_start) = 4 AND cohort = 1
    UNION ALL SELECT 'fact_member_month', 'CHECK', 'cohort_definition', count(*) FROM mm
      WHERE month(month_start) = 5 AND cohort = 0
    UNION ALL SELECT 'claim_header_version', 'REFERENCE', 'source_file_id', count(*) FROM hdr r
      ANTI JOIN files f ON f.market_id = r.market_id
        AND f.month_start = CAST(date_trunc('month', r.service_end) AS DATE)
    UNION ALL SELECT 'claim_header_version', 'CHECK', 'status_code', count(*) FROM hdr WHERE fam LIKE '%3'
    UNION ALL SELECT 'claim_header_version', 'CHECK', 'dates_ordered', count(*) FROM hdr WHERE fam LIKE '%4'
    UNION ALL SELECT 'claim_header_version', 'CHECK', 'version_positive', count(*) FROM hdr
      WHERE fam LIKE '%6' AND ver = 1
    UNION ALL SELECT 'claim_header_version', 'CHECK', 'accepted_ffs_paid', count(*) FROM hdr
      WHERE fam LIKE '%7' AND record_type = 'FFS' AND status = 'ACCEPTED'
    UNION ALL SELECT 'claim_header_version', 'CHECK', 'paid_not_negative', count(*) FROM hdr WHERE fam LIKE '%8'
    UNION ALL SELECT 'claim_header_version', 'CHECK', 'first_version_replaces_nothing', count(*) FROM hdr
      WHERE fam LIKE '%9' AND ver = 1
    UNION ALL SELECT 'claim_header_version', 'CHAIN', 'does_not_cycle', count(*) FROM hdr
      WHERE fam LIKE '%9' AND ver = 1
    UNION ALL SELECT 'claim_header_version', 'CHAIN', 'does_not_branch', count(*) FROM hdr a
      JOIN hdr b ON b.fam = a.fam AND b.ver = 2 WHERE a.fam LIKE '%9' AND a.ver = 1
    UNION ALL SELECT 'claim_line_version', 'UNIQUE', 'claim_version_key,line_number',
      count(*) - count(DISTINCT (vkey, line_number)) FROM lin
    UNION ALL SELECT 'claim_line_version', 'CHECK', 'line_positive', count(*) FROM lin WHERE line_number < 1
    UNION ALL SELECT 'claim_line_version', 'CHECK', 'paid_not_negative', count(*) FROM lin WHERE line_number % 10 = 3
    UNION ALL SELECT 'fact_claim_header_final', 'CHECK', 'population_match_code', count(*) FROM fin
      WHERE fam LIKE '%5'
    UNION ALL SELECT 'fact_claim_line_final', 'UNIQUE', 'run_id,claim_family_key,line_number',
      count(*) - count(DISTINCT (fam, line_number)) FROM finl
    UNION ALL SELECT 'fact_payment_transaction', 'UNIQUE', 'payment_transaction_id',
      count(*) - count(DISTINCT txn) FROM pay
    UNION ALL SELECT 'fact_payment_transaction', 'REFERENCE', 'reverses_transaction_id', count(*) FROM pay
      WHERE reverses IS NOT NULL AND txn NOT LIKE '%4' AND reverses NOT IN (SELECT txn FROM pay)
    UNION ALL SELECT 'fact_payment_transaction', 'CHECK', 'event_type_code', count(*) FROM pay
      WHERE event_type = 'PAYMENT' AND txn LIKE '%2'
    UNION ALL SELECT 'fact_payment_transaction', 'CHECK', 'sign_follows_event', count(*) FROM pay
      WHERE event_type = 'PAYMENT' AND (txn LIKE '%2' OR txn LIKE '%6')
    UNION ALL SELECT 'fact_payment_transaction', 'CHECK', 'reversal_names_payment', count(*) FROM pay
      WHERE event_type = 'REVERSAL' AND txn LIKE '%4'
    UNION ALL SELECT 'fact_capitation_transaction', 'REFERENCE', 'source_file_id', count(*) FROM capt
      WHERE txn LIKE '%8'
    UNION ALL SELECT 'fact_capitation_transaction', 'REFERENCE', 'reverses_transaction_id', count(*) FROM capt
      WHERE reverses IS NOT NULL AND reverses NOT IN (SELECT txn FROM capt)
    UNION ALL SELECT 'fact_capitation_transaction', 'CHECK', 'negative_is_linked', count(*) FROM capt
      WHERE cents < 0 AND reverses IS NULL"""


def _constraint_report() -> str:
    """The counted violations, and zero for every other constraint of the declared tables."""
    listed = ", ".join(str(x) for x in constraints.constraint_names({
        t: TABLES[t].names for t in (*OPERATIONAL, *RAW, *DIMENSIONS, *CURATED)}))
    return f"""SELECT n.t AS table_name, n.k AS constraint_kind, n.c AS constraint_name,
        CAST(coalesce(v.n, 0) AS BIGINT) AS violations
        FROM (VALUES {listed}) n(t, k, c) LEFT JOIN ({_COUNTED}) v USING (t, k, c)"""


SELECTS["family_summary"] = """
    SELECT h.fam AS claim_family_key, count(*) AS versions,
      count(*) FILTER (h.replaces IN (SELECT vkey FROM hdr)) AS linked_versions,
      coalesce(any_value(l.n), 0) AS lines, coalesce(any_value(l.c), 0) AS line_cents,
      coalesce(any_value(f.n), 0) AS final_lines, coalesce(any_value(f.c), 0) AS final_line_cents,
      coalesce(any_value(p.n), 0) AS payments, coalesce(any_value(p.c), 0) AS ledger_cents
    FROM hdr h
    LEFT JOIN (SELECT r.fam, count(*) AS n, CAST(sum(r.cents) AS BIGINT) AS c FROM rln r
               SEMI JOIN hdr v ON v.fam = r.fam AND v.ver = r.ver GROUP BY ALL) l ON l.fam = h.fam
    LEFT JOIN (SELECT r.fam, count(*) AS n, CAST(sum(r.cents) AS BIGINT) AS c FROM rln r
               SEMI JOIN fin v ON v.vkey = r.fam || ':' || r.ver GROUP BY ALL) f ON f.fam = h.fam
    LEFT JOIN (SELECT fam, count(*) AS n, CAST(sum(cents) AS BIGINT) AS c FROM pay GROUP BY ALL) p ON p.fam = h.fam
    GROUP BY h.fam"""
SELECTS["constraint_report"] = _constraint_report()
SELECTS["published_runs"] = f"""SELECT t.*, r.run_id FROM ({SELECTS['table_counts']}) t,
    (VALUES ('RUN_0001'), ('RUN_0002')) r(run_id)"""
SELECTS["release_manifest"] = f"""
    SELECT r.release_number, r.release_id, 'RUN_0001' AS run_id, 'KPI_V1' AS definition_version,
      'MAP_V1' AS mapping_version,
      (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT rule_id || '=' || rule_version AS v FROM dq))
        AS rule_versions,
      (SELECT count(*) FROM ({SELECTS['partition_status']})) AS expected_partitions,
      (SELECT count(*) FROM ({SELECTS['partition_status']}) WHERE partition_status = 'AVAILABLE')
        AS passed_partitions,
      DATE '1999-06-30' AS cutoff,
      (SELECT string_agg(CAST(month_start AS VARCHAR), ',' ORDER BY month_start) FROM months
        WHERE month_start >= DATE '1999-04-01') AS provisional_months,
      r.approver, TIMESTAMP '1999-08-01 00:00:00' AS approved_at,
      (SELECT CASE WHEN count(*) FILTER (disposition = 'FAIL') > 0 THEN 'FAILED' ELSE 'READY_FOR_REVIEW' END FROM dq)
        AS status
    FROM (VALUES (CAST(1 AS BIGINT), 'REL_1', 'reviewer'), (CAST(2 AS BIGINT), 'REL_2', 'second reviewer'))
      r(release_number, release_id, approver)"""
SELECTS["stored_run"] = f"SELECT *, row_count AS replayed_rows FROM ({SELECTS['table_counts']})"
SELECTS["routed_lines"] = """
    SELECT source_row_id, fam AS claim_family_id, ver AS version_number, line_number FROM rln
    SEMI JOIN (SELECT r.* FROM rhd r SEMI JOIN files f ON f.market_id = r.market_id
      AND f.month_start = CAST(date_trunc('month', r.service_end) AS DATE)) h
    ON h.fam = rln.fam AND h.ver = rln.ver"""


# The clean run: whole months of customers with orders, one paid claim an order.
_CLEAN = f"""
    WITH b AS (
      SELECT CAST(date_trunc('month', od) AS DATE) AS month_start, CAST(n_nationkey AS BIGINT) AS market_key,
             o_custkey, od, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, c_mktsegment IN {_MANAGED} AS managed
      FROM oc WHERE c_acctbal >= 0 AND NOT (n_regionkey = 4 AND c_mktsegment = 'MACHINERY')),
    e AS (SELECT month_start, market_key, count(DISTINCT o_custkey) AS n,
            coalesce(CAST(sum(cents) FILTER (od <= DATE '1999-06-30') AS BIGINT), 0) AS paid,
            count(*) FILTER (od <= DATE '1999-06-30') AS claims
          FROM b WHERE NOT managed GROUP BY 1, 2)
    SELECT 'RUN_0001' AS run_id, month_start, market_key, 'AVAILABLE' AS partition_status,
      n AS member_months, n AS distinct_members, paid AS ffs_paid_cents,
      CAST(paid AS DOUBLE) / n AS ffs_pmpm_cents, claims AS ffs_claim_count,
      CAST(claims AS DOUBLE) * 1000 / n AS ffs_claims_per_1000_mm,
      CASE WHEN claims > 0 THEN CAST(paid AS DOUBLE) / claims END AS ffs_avg_claim_cost_cents
    FROM e"""
_CHECKS = "(SELECT count(*) FROM mkt, months) + 8"
SELECTS |= {
    "clean_run_status": f"""SELECT 'RUN_0001' AS run_id, {_CHECKS} AS rule_results,
        0 AS blocking_failures, 'READY_FOR_REVIEW' AS status""",
    "clean_dq_failures": "SELECT * FROM dq WHERE FALSE",
    "clean_preflight_blockers": f"SELECT * FROM ({SELECTS['preflight_blockers']}) WHERE FALSE",
    "clean_assessment": f"""SELECT 'RUN_0001' AS run_id, {_CHECKS} AS expected_checks,
        {_CHECKS} AS observed_checks, 0 AS blocker_count, 'submission-preflight-v1' AS policy_version,
        TRUE AS eligible_for_submission""",
    "clean_kpi_ffs_month": f"SELECT * FROM ({_CLEAN})",
    "clean_partition_status": """SELECT 'RUN_0001' AS run_id, month_start, market_key,
        'AVAILABLE' AS partition_status FROM mkt, months""",
}


_FIRST = CTES["fin"].replace("1999-06-30", "1998-12-31").replace("FROM hdr WHERE", "FROM hdr WHERE ver <= 4 AND")
SELECTS |= {
    "late_finals": SELECTS["claim_finals"],
    "late_changes": f"""SELECT coalesce(e.fam, l.fam) AS claim_family_key, e.vkey AS earlier_version_key,
        e.cents AS earlier_cents, e.population_match AS earlier_match, l.vkey AS later_version_key,
        l.cents AS later_cents, l.population_match AS later_match
        FROM ({_FIRST}) e FULL JOIN fin l ON e.fam = l.fam WHERE e IS DISTINCT FROM l""",
}


def statements() -> dict[str, str]:
    return {name: with_ctes(select) for name, select in SELECTS.items()}
