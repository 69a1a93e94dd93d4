"""Registered queries that write what they derive and read it back, as a user of the files does."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.operators import exposure, extracts, families, kpis, reconciliation
from evenkeel.plans import document_proxies, document_queries, finance, proxies
from evenkeel.plans.finance_queries import EVIDENCE, LANDED, PROVENANCE, PROVISIONAL_FROM, Query
from evenkeel.plans.late import LateRuns
from evenkeel.session import scratch, settled, shared_folder, stage
from evenkeel.sources import buckets, documents, listing, tables
from evenkeel.sources.arrivals import partition_lines
from evenkeel.sources.commits import CommitLog

CONFIG = "star"  # configuration hash of the proxy run
# Fixed value: the caveat that a readiness document carries about its assessments.
CAVEATS = ["The newest published assessment is older than the periods shown."]


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def archive_csv(spark, sf_dir: str) -> DataFrame:
    """The archive as its sorted CSV files hold it."""
    path = _folder(spark, "archive-csv")
    documents.write_csv(document_proxies.archive_rows(spark, sf_dir), path, "sdp_identifier")
    return documents.read_archive(spark, path)


def extract_csv(spark, sf_dir: str) -> DataFrame:
    """The BI extract as its sorted CSV files hold it."""
    path = _folder(spark, "extract-csv")
    extract = document_queries.bi_extract(spark, sf_dir)
    documents.write_csv(extract, path, "rating_period_year", "state_code", "sdp_identifier")
    return documents.read_csv(spark, path, extract.schema)


def measures_csv(spark, sf_dir: str) -> DataFrame:
    """State assessments from an export of measures, written and read as CSV."""
    path = _folder(spark, "measures")
    documents.write_csv(document_proxies.measures(spark, sf_dir).select(
        F.lit("V1").alias("tafVersionId"), F.lit("M1").alias("measureId"), "payload"), path)
    files = documents.topic_files(documents.read_measures(spark, path))
    return extracts.assessed_states(documents.topic_rows(documents.newest_file(files)))


def topic_notes(spark, sf_dir: str) -> DataFrame:
    """The note of every state in the newest topic file, a cell of several lines."""
    path = _folder(spark, "measures")
    documents.write_csv(document_proxies.measures(spark, sf_dir).select(
        F.lit("V1").alias("tafVersionId"), F.lit("M1").alias("measureId"), "payload"), path)
    files = documents.topic_files(documents.read_measures(spark, path))
    return documents.topic_rows(documents.newest_file(files)).select(
        documents.cell("State").alias("state"), documents.cell("Note").alias("note"))


ENTRIES = 1_000  # of a manifest document, about


def manifest_json(spark, sf_dir: str) -> DataFrame:
    """The manifest as its JSON documents hold it."""
    path, rows = _folder(spark, "manifest"), document_proxies.manifest(document_proxies.listed(spark, sf_dir))
    rows = stage(rows, "manifest")
    part = F.pmod(F.xxhash64("sdp_identifier"), F.lit(rows.count() // ENTRIES + 1))
    entry = F.struct(*[c for c in rows.columns if c != "manifest_retrieved_at"])
    documents.write_json(rows.groupBy(part.alias("part"), F.col("manifest_retrieved_at").alias("retrieved_at")).agg(
        F.collect_list(entry).alias("preprints")).drop("part"), path)
    held = documents.read_manifest(spark, path, one_a_line=True)
    return held.select(*rows.columns).withColumn(
        "identifier_repairs", F.array_join("identifier_repairs", "; ")).withColumn(
        "file_key", listing.file_key(F.col("sdp_identifier")))


def page_files(spark, sf_dir: str) -> DataFrame:
    """Every page as a file of its own, read back with its length, hash and kind.

    Pages of even number are given the mark of another kind of document.
    """
    path = _folder(spark, "files")
    marked = F.concat(F.when(F.col("page_id") % 2 == 0, F.lit("%PDF")).otherwise(F.lit("")),
                      F.coalesce("html", F.lit("")))
    rows = proxies.read(spark, sf_dir, "pages").select("page_id", marked.alias("value"))
    folders = documents.write_files(rows, path, "page_id", "value")
    number = F.regexp_extract("path", r"page_id=(-?\d+)$", 1).try_cast("long")
    return documents.read_binaries(spark, folders).select(
        number.alias("page_id"), "length", "content_sha256", "is_pdf")


FIRST_VERSIONS = 4  # that had landed when the first run was made
FIRST_CUTOFF = date(1998, 12, 31)


def _late_runs(spark, sf_dir: str) -> LateRuns:
    """Two runs: of first versions at an early cutoff, then of later versions that land with repeated rows."""
    run = proxies.finance_run(spark, sf_dir).staged("member_assignment", "fact_member_month")
    landed = stage(run["raw_claim_header"], "landed")
    runs = LateRuns(spark, _folder(spark, "late"), (run["dim_member"], run["dim_market"], run["dim_plan"]),
                    run.member_months)
    runs.run("RUN_0000", FIRST_CUTOFF, landed.where(F.col("version_number") <= FIRST_VERSIONS))
    runs.run(proxies.RUN, proxies.CUTOFF, landed.where(
        (F.col("version_number") == 1) | (F.col("version_number") > FIRST_VERSIONS)))
    return runs


def late_finals(spark, sf_dir: str) -> DataFrame:
    """Finals after late versions, which a full run over all of them gives too."""
    return _late_runs(spark, sf_dir).finals(proxies.RUN)


def late_changes(spark, sf_dir: str) -> DataFrame:
    """Families whose final the late versions or the later cutoff changed."""
    return _late_runs(spark, sf_dir).delta("RUN_0000", proxies.RUN)


def _readiness_document(spark, sf_dir: str) -> DataFrame:
    return extracts.readiness_document(document_queries._readiness(spark, sf_dir), CAVEATS)


def readiness_summary(spark, sf_dir: str) -> DataFrame:
    """The readiness document without its states, caveats joined."""
    return _readiness_document(spark, sf_dir).select(
        "newest_year", "states_assessed", "states_reporting_usably",
        F.array_join("caveats", "; ").alias("caveats"))


def readiness_json(spark, sf_dir: str) -> DataFrame:
    """State assessments as the readiness document holds them."""
    path = _folder(spark, "readiness")
    documents.write_json(_readiness_document(spark, sf_dir), path)
    return documents.read_readiness(spark, path)


def stored_assessment(spark, sf_dir: str) -> DataFrame:
    """Readiness from stored assessments, with amounts that are computed anew."""
    path = _folder(spark, "assessment")
    assessed = document_proxies.assessed(spark, sf_dir)
    documents.write_parquet(assessed, path)
    stored = spark.read.schema(assessed.schema).parquet(path)
    return extracts.state_readiness(stored, document_queries._coverage(spark, sf_dir))


def routed_lines(spark, sf_dir: str) -> DataFrame:
    """Claim lines whose header came in a file that is on record."""
    run = proxies.finance_run(spark, sf_dir)
    arrived = run["raw_claim_header"].join(
        run["source_file"].select("source_file_id"), "source_file_id", "left_semi")
    return partition_lines(run["raw_claim_line"], arrived).select(
        "source_row_id", "claim_family_id", "version_number", "line_number")


def stored_exposure(spark, sf_dir: str) -> DataFrame:
    """Member months from stored spans and dimensions, read as a published view in order."""
    root, run = _folder(spark, "store"), proxies.finance_run(spark, sf_dir)
    needed = ["raw_eligibility_span", "dim_member", "dim_market", "dim_plan", "dim_date"]
    for table in needed:
        tables.write(run[table], root, table)
    stored = tables.scan_all(spark, root, needed, proxies.RUN)
    spans = exposure.eligibility_spans(
        stored["raw_eligibility_span"], stored["dim_member"], stored["dim_market"],
        stored["dim_plan"], proxies.RUN)
    months = exposure.member_months(exposure.member_assignments(spans, stored["dim_date"]))
    tables.register_views({"v_exposure_month": kpis.exposure_month(months)})
    return finance.view_of_run(spark, "v_exposure_month", proxies.RUN).orderBy(
        "month_start", "market_key", "delivery_system")


def stored_run(spark, sf_dir: str) -> DataFrame:
    """Rows of every curated table after a stored run, and after its replay."""
    root = _folder(spark, "store")
    with scratch(spark):
        run = proxies.finance_run(spark, sf_dir, shared=True)
        for table in (*finance.OPERATIONAL, *finance.RAW, *finance.DIMENSIONS):
            tables.write(run[table], root, table)
    first = finance.execute(spark, root, proxies.RUN, proxies.MAPPING, CONFIG)
    again = finance.execute(spark, root, proxies.RUN, proxies.MAPPING, CONFIG)
    replayed = tables.table_counts(again.curated).withColumnRenamed("row_count", "replayed_rows")
    return tables.table_counts(first.curated).join(replayed, "table_name")


def family_summary(spark, sf_dir: str) -> DataFrame:
    """Versions, lines and ledger of every claim family, from tables in buckets of families."""
    with scratch(spark):
        with scratch(spark):
            run = proxies.finance_run(spark, sf_dir).staged(
                "claim_header_version", "member_assignment", "fact_claim_header_final", unread=PROVENANCE)
            stored = buckets.write(families.family_tables(
                run["raw_claim_line"], run["raw_payment_transaction"], run.headers, run.finals, proxies.RUN))
        return settled(buckets.over_families(stored, families.family_summary), "family-summary")


def published_runs(spark, sf_dir: str) -> DataFrame:
    """Rows of every curated table of two published runs, and of the first one's replay.

    The first run is asked for once more with another mapping, which must be refused.
    """
    root, both = _folder(spark, "published"), (proxies.RUN, "RUN_0002")
    with scratch(spark):
        run = proxies.finance_run(spark, sf_dir, shared=True)
        for table in (*finance.OPERATIONAL, *finance.RAW, *finance.DIMENSIONS):
            rows = run[table]
            if "run_id" in rows.columns:
                rows = rows.unionByName(rows.withColumn("run_id", F.lit(both[1])))
            tables.write(rows, root, table)
    for run_id in (*both, proxies.RUN):
        finance.execute(spark, root, run_id, proxies.MAPPING, CONFIG)
    try:
        finance.execute(spark, root, proxies.RUN, "MAP_V2", CONFIG)
    except tables.RunConflict:
        pass
    else:
        raise AssertionError("a published run was replaced by one of another mapping")
    counts = [tables.table_counts(finance.published(spark, root, r).curated).withColumn("run_id", F.lit(r))
              for r in both]
    return counts[0].unionByName(counts[1])


def release_manifest(spark, sf_dir: str) -> DataFrame:
    """Two releases of the run as the manifest holds them; the first one cannot be written again."""
    log = CommitLog(spark, _folder(spark, "releases"))
    run = proxies.finance_run(spark, sf_dir).landed(*LANDED).staged(*EVIDENCE, unread=PROVENANCE)
    first = finance.release(run, "REL_1", "KPI_V1", PROVISIONAL_FROM, "reviewer", datetime(1999, 8, 1))
    for release in (first, {**first, "release_id": "REL_2", "approver": "second reviewer"}):
        reconciliation.write_release(log, release)
    try:
        reconciliation.write_release(log, {**first, "approver": "somebody else"})
    except reconciliation.ReleaseExists:
        pass
    else:
        raise AssertionError("a release was written twice")
    held = reconciliation.release_manifest(spark, log)
    return held.withColumn("rule_versions", F.array_join("rule_versions", ",")).withColumn(
        "provisional_months", F.array_join(F.col("provisional_months").cast("array<string>"), ","))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        archive_csv, extract_csv, measures_csv, topic_notes, manifest_json, page_files, late_finals, late_changes,
        readiness_summary, readiness_json,
        stored_assessment, routed_lines, stored_exposure, stored_run, family_summary, published_runs, release_manifest)}
