"""Registered document queries."""

from __future__ import annotations

from html import unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import identifiers, letters, money, text
from evenkeel.operators import archive, extracts, resolution
from evenkeel.plans import document_proxies as proxies
from evenkeel.plans.finance_queries import Query
from evenkeel.plans.proxies import cents, read
from evenkeel.session import stage
from evenkeel.sources import documents, listing

YEAR = 1997
# What a record of the page table is recognised by.
HREF = r'href="(/[^"]*)"'


def _joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), "; ")


def identifier_parse(spark, sf_dir: str) -> DataFrame:
    """Every filing's control name, parsed."""
    names = proxies.filings(spark, sf_dir).select("o_orderkey", "sdp_identifier")
    return identifiers.with_parsed_identifier(names, "sdp_identifier").withColumn(
        "identifier_repairs", _joined("identifier_repairs")).withColumn(
        "version_rank", identifiers.version_rank(F.col("review_type")))


def form_amounts(spark, sf_dir: str) -> DataFrame:
    """Every filing's total as it was answered, read as cents."""
    rows = proxies.filings(spark, sf_dir).select(
        "o_orderkey", F.map_from_entries("answers").alias("fields"))
    return rows.select(
        "o_orderkey", money.read_amount(F.try_element_at("fields", F.lit("4-Text"))).alias("a")
    ).select("o_orderkey", "a.*")


def letter_amounts(spark, sf_dir: str) -> DataFrame:
    """The approved amount of every document, from its whole text."""
    rows = proxies.letters_of_documents(spark, sf_dir)
    return letters.with_letter_amount(rows, "pages", letters.PUBLISHED).drop("pages").withColumn(
        "all_amounts_cents", _joined("all_amounts_cents"))


def page_records(spark, sf_dir: str) -> DataFrame:
    """Labelled blocks of every page with a link, as records."""
    return listing.listing_records(read(spark, sf_dir, "pages"), "page_id", "html", "<li>", HREF, "")


def page_union(spark, sf_dir: str) -> DataFrame:
    """One record per first text line over all pages."""
    return listing.keyed_union(
        page_records(spark, sf_dir), "sdp_identifier", "page_id", "position")


def manifest(spark, sf_dir: str) -> DataFrame:
    rows = proxies.manifest(proxies.listed(spark, sf_dir))
    return rows.withColumn("identifier_repairs", _joined("identifier_repairs")).withColumn(
        "file_key", listing.file_key(F.col("sdp_identifier")))


def extraction_records(spark, sf_dir: str) -> DataFrame:
    rows = proxies.records(proxies.listed(spark, sf_dir))
    return rows.select(
        "sdp_identifier", *letters.FIELDS[:4], _joined("all_amounts_cents").alias(
            "all_amounts_cents"), "letter_pages_read", "issue", "identifier_mismatch",
        F.col("form.template").alias("form_template"), "form.field_count", "form.cms_id",
        F.col("form.issue").alias("form_issue"),
        F.col("form.federal_share.cents").alias("federal_cents"),
        F.col("form.nonfederal_share.issue").alias("nonfederal_issue"))


def archive_repeated(spark, sf_dir: str) -> DataFrame:
    """The archive from records that come twice, of which the first ones are wrong."""
    rows = proxies.listed(spark, sf_dir)
    read_last = _records(spark, sf_dir)
    first = read_last.withColumn("position", F.col("position") - 1).withColumn(
        "amount_cents", F.col("amount_cents") + 1)
    return archive.archive_rows(proxies.manifest(rows), first.unionByName(read_last))


# Markup whose references differ in form: decimal, hexadecimal, named, broken, without an end.
REFERENCES = ("&#150;", "&#146;s", "&#39dad", "&#65bc", "&#x0000026;", "&#0000000038;", "&#0;",
              "&#xD800;", "&#x110000;", "&#99999999999999999999;", "&#x1;x", "&#13;", "&#xFDD0;",
              "&amp;amp;", "&notit;", "&copy2", "&nosuch;", "&#;", "&#x;", "&", "&CounterClockwiseContourIntegral;")


def markup_text(spark, sf_dir: str) -> DataFrame:
    """Text of every page, with references to its own number and of every form added.

    The added lines come last; ``ampersands`` counts what references left in all lines.
    """
    number = F.col("page_id") % 50_000 + 200
    rows = read(spark, sf_dir, "pages").select("page_id", F.concat(
        F.coalesce("html", F.lit("")), F.lit("<p>a&#"), number.cast("string"), F.lit(";a</p><p>a&#x"),
        F.hex(number), F.lit(" a</p>"), *[F.lit(f"<p>{r}</p>") for r in REFERENCES]).alias("html"))
    added = 2 + sum(1 for r in REFERENCES if unescape(r).strip())
    lines = rows.select("page_id", text.text_lines(F.col("html")).alias("lines"))
    return lines.select(
        "page_id", F.array_join(F.slice("lines", -added, added), "|").alias("added"),
        F.regexp_count(F.array_join("lines", "\n"), F.lit("&")).cast("long").alias("ampersands"))


def _archive(spark, sf_dir: str) -> DataFrame:
    """The archive, written once: resolution and extracts read it several times."""
    return stage(proxies.archive_rows(spark, sf_dir), "archive")


def _records(spark, sf_dir: str) -> DataFrame:
    """Readings, written once so that no later filter repeats the parsing."""
    return stage(proxies.records(proxies.listed(spark, sf_dir)), "records")


def bi_extract(spark, sf_dir: str) -> DataFrame:
    return extracts.bi_extract(_archive(spark, sf_dir), proxies.readiness_rows(spark, sf_dir))


def extract_drops(spark, sf_dir: str) -> DataFrame:
    rows = _archive(spark, sf_dir)
    return extracts.extract_drops(rows, resolution.resolve(rows.where(extracts.has_period())))


def extract_years(spark, sf_dir: str) -> DataFrame:
    return extracts.extract_years(bi_extract(spark, sf_dir))


def _coverage(spark, sf_dir: str) -> DataFrame:
    return extracts.state_coverage(_archive(spark, sf_dir), YEAR)


def _readiness(spark, sf_dir: str) -> DataFrame:
    return extracts.state_readiness(proxies.assessed(spark, sf_dir), _coverage(spark, sf_dir))


def event_payloads(spark, sf_dir: str) -> DataFrame:
    """JSON properties by event type; what is not JSON is skipped."""
    parsed = F.from_json("props", "k bigint", {"mode": "PERMISSIVE"})
    value = cents("value")
    return (
        read(spark, sf_dir, "events").select("event_type", parsed["k"].alias("k"),
                                             value.alias("cents"))
        .where(F.col("k").isNotNull())
        .groupBy("event_type", "k")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("cents").alias("value_cents"))
    )


def queries() -> dict[str, Query]:
    return {
        "identifier_parse": identifier_parse,
        "form_amounts": form_amounts,
        "letter_amounts": letter_amounts,
        "page_records": page_records,
        "page_union": page_union,
        "event_payloads": event_payloads,
        "manifest": manifest,
        "extraction_records": extraction_records,
        "extraction_summary": lambda s, d: archive.extraction_summary(_records(s, d)),
        "extraction_value_counts": lambda s, d: archive.value_counts(_records(s, d), 60),
        "archive": proxies.archive_rows,
        "archive_repeated": archive_repeated,
        "markup_text": markup_text,
        "publish_summary": lambda s, d: archive.publish_summary(_archive(s, d)),
        "reading_agreement": lambda s, d: archive.reading_agreement(_archive(s, d)),
        "mismatch_components": lambda s, d: archive.mismatch_components(_archive(s, d)),
        "version_resolution": lambda s, d: resolution.resolve(_archive(s, d)).select(
            *resolution.KEY, "sdp_identifier", "lineage_status", "candidate_count",
            "amount_status", "amount_cents", "amount_usd", "federal_share_cents",
            "amount_source", "amount_is_publishable", "resolution_version"),
        "candidate_parts": lambda s, d: resolution.candidates(_archive(s, d)),
        "bi_extract": bi_extract,
        "extract_drops": extract_drops,
        "extract_years": extract_years,
        "state_caps": lambda s, d: extracts.state_caps(_archive(s, d)),
        "state_cap_sources": lambda s, d: extracts.state_cap_sources(_archive(s, d)),
        "state_coverage": _coverage,
        "state_dollars": lambda s, d: extracts.state_dollars(_coverage(s, d)),
        "topic_assessments": proxies.assessed,
        "assessment_counts": lambda s, d: extracts.assessment_counts(proxies.assessed(s, d)),
        "state_readiness": _readiness,
        "largest_states": lambda s, d: extracts.largest_states(_readiness(s, d)),
    }
