"""Keys, references and checks as a validation job.

Spark does not enforce constraints on write, so each one is counted instead. All
checks of a table share one pass over it; keys and references aggregate before
they shuffle. ``checked_writes`` counts them while tables are written: checks are
observed by the write itself, and keys and references of all tables take one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from evenkeel.schemas import CODES
from evenkeel.session import stage

# Table -> keys that must be unique
KEYS: dict[str, list[tuple[str, ...]]] = {
    "pipeline_run": [("run_id",)],
    "source_file": [("source_file_id",)],
    "expected_partition": [("run_id", "market_id", "month_start", "entity")],
    "quarantine_record": [("run_id", "source_file_id", "source_row_id", "rule_id")],
    "dq_result": [("run_id", "rule_id", "rule_version", "market_id", "month_start")],
    "expected_defect": [("scenario_id", "defect_id")],
    "raw_eligibility_span": [("source_file_id", "source_row_id")],
    "raw_claim_header": [("source_file_id", "source_row_id")],
    "raw_claim_line": [("source_file_id", "source_row_id")],
    "raw_payment_transaction": [("source_file_id", "source_row_id")],
    "raw_capitation_transaction": [("source_file_id", "source_row_id")],
    "dim_market": [("market_key",), ("market_id",)],
    "dim_member": [("member_key",), ("synthetic_member_id",)],
    "dim_plan": [("plan_key",), ("market_key", "plan_id")],
    "dim_provider": [("provider_key",), ("provider_id",)],
    "dim_service_category": [("category_key",), ("category_code",)],
    "service_category_map": [
        ("mapping_version", "claim_file_type", "service_code", "effective_start")],
    "dim_date": [("date_key",), ("calendar_date",)],
    "eligibility_span": [("eligibility_span_id",)],
    "fact_member_month": [("run_id", "member_key", "month_start")],
    "claim_header_version": [("claim_version_key",), ("claim_family_key", "version_number")],
    "claim_line_version": [("claim_version_key", "line_number")],
    "fact_claim_header_final": [("run_id", "claim_family_key")],
    "fact_claim_line_final": [("run_id", "claim_family_key", "line_number")],
    "fact_payment_transaction": [("payment_transaction_id",)],
    "fact_capitation_transaction": [("capitation_transaction_id",)],
}

_DIMS = [("member_key", "dim_member", "member_key"), ("market_key", "dim_market", "market_key"),
         ("plan_key", "dim_plan", "plan_key")]
_RUN = ("run_id", "pipeline_run", "run_id")
_FILE = ("source_file_id", "source_file", "source_file_id")
_VERSION = ("claim_version_key", "claim_header_version", "claim_version_key")
_CATEGORY = ("category_key", "dim_service_category", "category_key")
_PROVIDER = ("provider_key", "dim_provider", "provider_key")

# Table -> (child columns, parent table, parent columns); comma separated when composite
REFERENCES: dict[str, list[tuple[str, str, str]]] = {
    "source_file": [_RUN],
    "expected_partition": [_RUN],
    "dq_result": [_RUN],
    "quarantine_record": [_RUN, _FILE],
    "raw_eligibility_span": [_FILE, _RUN],
    "raw_claim_header": [_FILE, _RUN],
    "raw_claim_line": [_FILE, _RUN],
    "raw_payment_transaction": [_FILE, _RUN],
    "raw_capitation_transaction": [_FILE, _RUN],
    "dim_plan": [("market_key", "dim_market", "market_key")],
    "service_category_map": [_CATEGORY],
    "eligibility_span": [_RUN, *_DIMS, _FILE],
    "fact_member_month": [_RUN, *_DIMS],
    "claim_header_version": [
        _RUN, *_DIMS, _FILE,
        ("replaces_version_key", "claim_header_version", "claim_version_key")],
    "claim_line_version": [_VERSION, _CATEGORY, _PROVIDER],
    "fact_claim_header_final": [_RUN, _VERSION, *_DIMS],
    "fact_claim_line_final": [
        ("run_id,claim_family_key", "fact_claim_header_final", "run_id,claim_family_key"),
        _CATEGORY, _PROVIDER],
    "fact_payment_transaction": [
        _RUN, _VERSION, _FILE,
        ("reverses_transaction_id", "fact_payment_transaction", "payment_transaction_id")],
    "fact_capitation_transaction": [
        _RUN, *_DIMS, _FILE,
        ("reverses_transaction_id", "fact_capitation_transaction", "capitation_transaction_id")],
}

# Table -> columns that may be NULL once curated
OPTIONAL: dict[str, tuple[str, ...]] = {
    "pipeline_run": ("ended_at",),
    "source_file": ("market_id", "month_start"),
    "dq_result": ("market_id", "month_start", "financial_impact_cents"),
    "dim_market": (), "dim_member": (), "dim_plan": (), "dim_provider": (),
    "dim_service_category": (), "dim_date": (),
    "service_category_map": ("effective_end",),
    "expected_partition": (), "eligibility_span": (), "fact_member_month": (),
    "quarantine_record": (),
    "expected_defect": ("source_row_id",),
    "claim_header_version": ("replaces_version_key", "header_paid_amount_cents"),
    "claim_line_version": ("provider_key", "units", "line_paid_amount_cents"),
    "fact_claim_header_final": ("header_paid_amount_cents",),
    "fact_claim_line_final": ("provider_key", "line_paid_amount_cents"),
    "fact_payment_transaction": ("reverses_transaction_id",),
    "fact_capitation_transaction": ("reverses_transaction_id",),
}


def _one_of(column: str, codes: str) -> tuple[str, str]:
    values = ", ".join(f"'{v}'" for v in CODES[codes])
    return f"{column}_code", f"{column} IN ({values})"


_POPULATION = [_one_of("program", "program"), _one_of("benefit_scope", "benefit_scope"),
               _one_of("eligibility_group", "eligibility_group"),
               _one_of("delivery_system", "delivery_system")]
_CLAIM = [_one_of("claim_file_type", "file_type"), _one_of("record_type", "record_type")]

# Table -> (name, condition that must not be false)
CHECKS: dict[str, list[tuple[str, str]]] = {
    "pipeline_run": [
        _one_of("status", "run_status"),
        ("dates_ordered", "ended_at IS NULL OR ended_at >= started_at")],
    "source_file": [
        ("row_count_not_negative", "row_count >= 0"),
        ("synthetic_source", "source_system = 'synthetic'")],
    "quarantine_record": [_one_of("remediation_status", "remediation")],
    "dq_result": [
        _one_of("severity", "severity"), _one_of("disposition", "disposition"),
        ("counts_not_negative", "evaluated_count >= 0 AND failing_row_count >= 0"),
        ("failing_within_evaluated", "failing_row_count <= evaluated_count")],
    "dim_member": [
        _one_of("age_band", "age_band"),
        ("synthetic_id", "startswith(synthetic_member_id, 'SYN_')")],
    "dim_provider": [("synthetic_id", "startswith(provider_id, 'SYN_')")],
    "dim_plan": [_one_of("plan_type", "plan_type")],
    "dim_service_category": [_one_of("category_code", "category")],
    "service_category_map": [
        _one_of("claim_file_type", "file_type"),
        ("dates_ordered", "effective_end IS NULL OR effective_end >= effective_start")],
    "dim_date": [
        ("month_number_range", "month_number BETWEEN 1 AND 12"),
        ("days_in_month_range", "days_in_month BETWEEN 28 AND 31")],
    "eligibility_span": [*_POPULATION, ("dates_ordered", "end_date >= start_date")],
    "fact_member_month": [
        *_POPULATION,
        ("eligible_days_range", "eligible_days BETWEEN 1 AND 31"),
        ("weight_is_one", "member_month_weight = 1"),
        ("cohort_flag", "in_primary_cohort IN (0, 1)"),
        ("cohort_definition",
         "in_primary_cohort = 0 OR (program = 'MEDICAID' AND benefit_scope = 'FULL')")],
    "claim_header_version": [
        *_CLAIM, _one_of("status", "claim_status"),
        ("dates_ordered", "service_end_date >= service_start_date"),
        ("version_positive", "version_number >= 1"),
        ("accepted_ffs_paid", "NOT (record_type = 'FFS' AND status = 'ACCEPTED') "
                              "OR header_paid_amount_cents IS NOT NULL"),
        ("paid_not_negative",
         "header_paid_amount_cents IS NULL OR header_paid_amount_cents >= 0"),
        ("first_version_replaces_nothing",
         "version_number > 1 OR replaces_version_key IS NULL")],
    "claim_line_version": [
        ("line_positive", "line_number >= 1"),
        ("paid_not_negative", "line_paid_amount_cents IS NULL OR line_paid_amount_cents >= 0")],
    "fact_claim_header_final": [*_CLAIM, _one_of("population_match", "population_match")],
    "fact_payment_transaction": [
        _one_of("event_type", "event_type"),
        ("reversal_names_payment",
         "(event_type = 'REVERSAL') = (reverses_transaction_id IS NOT NULL)"),
        ("sign_follows_event",
         "(event_type = 'PAYMENT' AND signed_amount_cents >= 0) "
         "OR (event_type = 'REVERSAL' AND signed_amount_cents <= 0)")],
    "fact_capitation_transaction": [
        ("negative_is_linked",
         "signed_amount_cents >= 0 OR reverses_transaction_id IS NOT NULL")],
}


def _finding(counts: DataFrame, table: str, kind: str, name: str) -> DataFrame:
    return counts.select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("constraint_kind"),
        F.lit(name).alias("constraint_name"),
        F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations"))


def _present(columns: list[str]):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Key values held by more than one row."""
    return df.where(_present(list(key))).groupBy(*key).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, columns: str, parent_columns: str) -> DataFrame:
    """Key values of the child without a parent, with the rows that hold them."""
    names, targets = columns.split(","), parent_columns.split(",")
    held = child.where(_present(names)).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(*[F.col(t).alias(n) for t, n in zip(targets, names)]).distinct()
    return held.join(known, names, "left_anti")


def violating_rows(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which a check is false; an unknown outcome passes, as in SQL."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(True)))


def branching_versions(headers: DataFrame) -> DataFrame:
    """Versions replaced by more than one later version."""
    return (
        headers.where(F.col("replaces_version_key").isNotNull())
        .groupBy("run_id", "replaces_version_key")
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    )


def _may_loop() -> Column:
    replaced = F.regexp_extract("replaces_version_key", r"^(.*):(\d+)$", 1)
    number = F.regexp_extract("replaces_version_key", r"^(.*):(\d+)$", 2).try_cast("long")
    return F.col("replaces_version_key").isNotNull() & (
        (replaced != F.col("claim_family_key")) | (number >= F.col("version_number")))


def cycling_versions(headers: DataFrame) -> DataFrame:
    """Versions that replace a later version, or another family; such links can loop."""
    return headers.where(_may_loop())


def overlapping_mappings(service_category_map: DataFrame) -> DataFrame:
    """Map rows still in force when the next row of the same code starts."""
    code = Window.partitionBy("mapping_version", "claim_file_type", "service_code").orderBy(
        "effective_start")
    following = F.lead("effective_start").over(code)
    return service_category_map.withColumn("next_start", following).where(
        F.col("next_start").isNotNull()
        & (F.col("effective_end").isNull() | (F.col("effective_end") >= F.col("next_start"))))


def _row_rules(table: str, columns: list[str]) -> list[tuple[str, str, str | None]]:
    """(kind, name, condition that must not be false) of what can be told from one row."""
    found: list[tuple[str, str, str | None]] = [("CHECK", *c) for c in CHECKS.get(table, [])]
    if table in OPTIONAL:
        found += [("NOT_NULL", c, f"{c} IS NOT NULL") for c in columns if c not in OPTIONAL[table]]
    if table == "claim_header_version":
        found.append(("CHAIN", "does_not_cycle", None))
    return found


def _violates(condition: str | None) -> Column:
    return _may_loop() if condition is None else ~F.coalesce(F.expr(condition), F.lit(True))


# The key by which a chain must not branch.
_BRANCH = ("run_id", "replaces_version_key")


def constraint_names(tables: dict[str, list[str]]) -> list[tuple[str, str, str]]:
    """(table, kind, name) of every constraint of tables with the given columns."""
    out = []
    for table, columns in tables.items():
        out += [(table, "UNIQUE", ",".join(k)) for k in KEYS.get(table, [])]
        out += [(table, "REFERENCE", c) for c, parent, _ in REFERENCES.get(table, []) if parent in tables]
        out += [(table, kind, name) for kind, name, _ in _row_rules(table, columns)]
        if table == "claim_header_version":
            out.append((table, "CHAIN", "does_not_branch"))
        if table == "service_category_map":
            out.append((table, "CHECK", "dates_do_not_overlap"))
    return out


def _key_text(columns: list[str]) -> Column:
    """The value of a key as text, several behind their lengths; null if one of them is."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[x for t in texts for x in (F.char_length(t).cast("string"), F.lit(":"), t)])


# Tables whose keys grow with the rows that land; the others hold as many as there are
# markets, plans, months and codes.
_GROWING = ("raw_", "fact_", "claim_", "eligibility_", "quarantine_", "dim_member", "dim_provider")


def _key_groups(tables: dict[str, DataFrame]) -> list[set[tuple[str, str, str]]]:
    """Keyed constraints in groups: all that compare few keys, and every other one alone."""
    few, alone = set(), []
    parents = {(t, columns): parent for t, of in REFERENCES.items() for columns, parent, _ in of}
    keyed = [c for c in constraint_names({t: [] for t in tables})
             if c[1] in ("UNIQUE", "REFERENCE") or c[1:] == ("CHAIN", "does_not_branch")]
    for table, kind, name in keyed:
        held = parents[table, name] if kind == "REFERENCE" else table
        if table.startswith(_GROWING) and held.startswith(_GROWING):
            alone.append({(table, kind, name)})
        else:
            few.add((table, kind, name))
    return [*([few] if few else []), *alone]


def keyed_apart(tables: dict[str, DataFrame]) -> DataFrame:
    """``keyed_violations`` with the counts of one group of constraints written before the next.

    The keys of all constraints are many times the rows of all tables. This way the disk
    holds those of one constraint at a time.
    """
    return reduce(DataFrame.unionByName, [
        stage(keyed_violations(tables, group), "violations") for group in _key_groups(tables)])


def keyed_violations(
    tables: dict[str, DataFrame], only: set[tuple[str, str, str]] | None = None
) -> DataFrame:
    """(table_name, constraint_kind, constraint_name, violations) of keys, references and branches.

    Every row gives the keys it holds and the keys it refers to, parents give the keys
    they have, and one aggregation over (constraint, key) judges them all. It combines on
    the map side, so a key that many rows refer to is one row a task. A constraint is a
    number there, even where a key is held and odd where a parent has it.
    """
    names: list[tuple[str, str, str]] = []
    given: dict[str, list[Column]] = {table: [] for table in tables}

    def told(table: str, what: str, name: str, columns: list[str]) -> int | None:
        if only is not None and (table, what, name) not in only:
            return None
        names.append((table, what, name))
        given[table].append(_key_text(columns).alias(str(2 * len(names) - 2)))
        return 2 * len(names) - 1

    for table in tables:
        for key in KEYS.get(table, []):
            told(table, "UNIQUE", ",".join(key), list(key))
        for columns, parent, targets in REFERENCES.get(table, []):
            if parent in tables:
                number = told(table, "REFERENCE", columns, columns.split(","))
                if number is not None:
                    given[parent].append(_key_text(targets.split(",")).alias(str(number)))
        if table == "claim_header_version":
            told(table, "CHAIN", "does_not_branch", list(_BRANCH))
    keys = [tables[t].select(*found) for t, found in given.items() if found]
    rows = reduce(DataFrame.unionByName, [
        df.unpivot([], [f"`{number}`" for number in df.columns], "told", "key") for df in keys])
    told_as = F.col("told").cast("int")
    judged = rows.where("key is not null").groupBy(
        F.floor(told_as / 2).cast("int").alias("number"), "key").agg(
        F.sum(1 - told_as % 2).alias("held"), F.max(told_as % 2).alias("known"))
    constraint = F.get(F.array(*[F.struct(
        F.lit(table).alias("table_name"), F.lit(kind).alias("constraint_kind"), F.lit(name).alias("constraint_name"))
        for table, kind, name in names]), F.col("number"))
    refers = F.array(*[F.lit(kind == "REFERENCE") for _, kind, _ in names])
    excess = F.when(~F.get(refers, F.col("number")), F.greatest(F.col("held") - 1, F.lit(0))).otherwise(
        F.when(F.col("known") == 1, 0).otherwise(F.col("held")))
    return judged.groupBy("number").agg(F.sum(excess).cast("long").alias("violations")).select(
        constraint.alias("of"), "violations").select("of.*", "violations")


def checked_writes(
    tables: dict[str, DataFrame], write: Callable[[DataFrame, str], DataFrame]
) -> tuple[DataFrame, dict[str, DataFrame], dict[str, int]]:
    """Every constraint with its violations, zeros included; the tables as written; their rows.

    ``write`` stores a table and gives it back.
    """
    found, stored, rows = observed_writes(tables, write)
    return write_report(found, stored), stored, rows


Counted = list[tuple[str, str, str, int]]


def observed_writes(
    tables: dict[str, DataFrame], write: Callable[[DataFrame, str], DataFrame]
) -> tuple[Counted, dict[str, DataFrame], dict[str, int]]:
    """Violations that are told from one row; the tables as written; their rows.

    Checks and rows are metrics that the write observes, so they cost no scan; their number
    is bounded by the constraints.
    """
    found: Counted = []
    stored, rows = {}, {}
    for table, df in tables.items():
        checks = _row_rules(table, df.columns)
        seen = Observation(f"{table} constraints")
        stored[table] = write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[
            F.count_if(_violates(condition)).alias(f"c{i}") for i, (_, _, condition) in enumerate(checks)]), table)
        # Metrics come with the rows of a write; one without any has none to give.
        metrics = seen.get
        rows[table] = metrics.get("rows", 0)
        found += [(table, kind, name, metrics.get(f"c{i}", 0)) for i, (kind, name, _) in enumerate(checks)]
    return found, stored, rows


def write_report(
    found: Counted, stored: dict[str, DataFrame],
    keyed: Callable[[dict[str, DataFrame]], DataFrame] = keyed_violations,
) -> DataFrame:
    """Every constraint with its violations, from what the writes told and the stored keys."""
    names = constraint_names({t: df.columns for t, df in stored.items()})
    spark = next(iter(stored.values())).sparkSession
    schema = "table_name string, constraint_kind string, constraint_name string, violations long"
    known = {x[:3] for x in found}
    counted = spark.createDataFrame(found + [(*n, 0) for n in names if n not in known], schema)
    judged = keyed(stored)
    if "service_category_map" in stored:
        judged = judged.unionByName(_finding(overlapping_mappings(stored["service_category_map"]).agg(
            F.count(F.lit(1)).alias("violations")), "service_category_map", "CHECK", "dates_do_not_overlap"))
    return counted.unionByName(judged).groupBy("table_name", "constraint_kind", "constraint_name").agg(
        F.sum("violations").alias("violations"))


def constraint_violations(
    tables: dict[str, DataFrame],
    keyed: Callable[[dict[str, DataFrame]], DataFrame] = keyed_violations,
) -> DataFrame:
    """Violations of every constraint whose tables were given, zeros included.

    The checks of a table are one pass over it; keys and references of all tables are one
    aggregation.
    """
    findings = [keyed(tables)]
    for table, df in tables.items():
        checks = _row_rules(table, df.columns)
        if checks:
            wide = df.agg(*[
                F.count_if(_violates(condition)).alias(f"c{i}") for i, (_, _, condition) in enumerate(checks)])
            rows = F.array(*[
                F.struct(F.lit(kind).alias("constraint_kind"),
                         F.lit(name).alias("constraint_name"),
                         F.col(f"c{i}").alias("violations"))
                for i, (kind, name, _) in enumerate(checks)])
            findings.append(wide.select(F.lit(table).alias("table_name"), F.inline(rows)))
    if "service_category_map" in tables:
        findings.append(_finding(
            overlapping_mappings(tables["service_category_map"]).agg(
                F.count(F.lit(1)).alias("violations")),
            "service_category_map", "CHECK", "dates_do_not_overlap"))
    # A constraint without any key has no row above.
    names = constraint_names({t: df.columns for t, df in tables.items()})
    spark = next(iter(tables.values())).sparkSession
    findings.append(spark.createDataFrame(
        [(*n, 0) for n in names],
        "table_name string, constraint_kind string, constraint_name string, violations long"))
    return reduce(DataFrame.unionByName, findings).groupBy(
        "table_name", "constraint_kind", "constraint_name").agg(F.sum("violations").alias("violations"))
