"""The document archive: one row per listed document, readable or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions import letters
from evenkeel.functions.forms import read_form
from evenkeel.functions.identifiers import with_cross_check

EXTRACTION_VERSION = "0.4.0"
_AMOUNT = "struct<cents:bigint,raw:string,ambiguous_unit:boolean,implausible:boolean,issue:string>"


def extraction_records(
    documents: DataFrame, identifier: str, pages: str, fields: str, error: str | None = None,
    reach: letters.Reach = letters.WHOLE,
) -> DataFrame:
    """What each document says: its letter, its form, and whether its names agree."""
    read = letters.with_letter_amount(documents, pages, reach).withColumn(
        "form", read_form(F.col(fields), None if error is None else F.col(error)))
    checked = read.withColumn("__stated", F.col("form.cms_id"))
    return with_cross_check(checked, identifier, "__stated", "identifier_mismatch").drop("__stated")


def is_usable(amount: Column) -> Column:
    """Read, with a stated unit, and of a credible size."""
    return F.coalesce(
        amount["cents"].isNotNull() & ~F.coalesce(amount["ambiguous_unit"], F.lit(False))
        & ~F.coalesce(amount["implausible"], F.lit(False)), F.lit(False))


def dollars(cents: Column) -> Column:
    return cents.cast("double") / 100


def last_record(records: DataFrame, identifier: str, position: str = "position") -> DataFrame:
    """One record per identifier, the last by position; without a position, any one."""
    rest = [c for c in records.columns if c not in (identifier, position)]
    place = F.col(position) if position in records.columns else F.lit(0)
    return records.groupBy(identifier).agg(
        F.max_by(F.struct(*rest), place).alias("r")).select(identifier, "r.*")


def archive_rows(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Listed documents beside what was read from them.

    A document without a record keeps its row, and of several records the last stands.
    The form is preferred to the letter
    and every caveat belongs to the source that was chosen.
    """
    columns = ["letter_type", "amount_cents", "matched_phrase", "form", "identifier_mismatch"]
    place = ["position"] if "position" in records.columns else []
    rec = last_record(records.select("sdp_identifier", *place, *columns), "sdp_identifier").select(
        "sdp_identifier", F.struct(*columns).alias("rec"))
    rows = manifest.join(rec, "sdp_identifier", "left")
    form, total = F.col("rec.form"), F.col("rec.form.total")
    federal, nonfederal = F.col("rec.form.federal_share"), F.col("rec.form.nonfederal_share")
    letter, kind = F.col("rec.amount_cents"), F.col("rec.letter_type")
    form_usable = is_usable(total)
    letter_usable = F.coalesce(letter.isNotNull() & (kind == letters.APPROVAL), F.lit(False))
    source = F.when(form_usable, "form_field").when(letter_usable, "approval_letter")
    chosen = F.when(form_usable, total["cents"]).when(letter_usable, letter)
    cap = F.when(kind == letters.PHASE_DOWN_TYPE, letter)
    from_form = F.coalesce(F.col("amount_source") == "form_field", F.lit(False))
    from_letter = F.coalesce(F.col("amount_source") == "approval_letter", F.lit(False))
    assumed = F.coalesce(total["ambiguous_unit"], F.lit(False))
    implausible = F.coalesce(total["implausible"], F.lit(False))
    mismatch = F.col("rec.identifier_mismatch")
    return (
        rows.withColumn("amount_source", source)
        .withColumn("chosen_cents", chosen)
        .withColumn("cap_cents", cap)
        .select(
            "sdp_identifier", "state_code", "state_name", "payment_type",
            "payment_type_normalised", "provider_class", "review_type",
            "review_type_normalised", "rating_period_start", "rating_period_end",
            "identifier_suffix", "description",
            kind.alias("document_type"), form["template"].alias("form_template"),
            F.col("chosen_cents").alias("amount_cents"),
            dollars(F.col("chosen_cents")).alias("amount_usd"), "amount_source",
            total["cents"].alias("total_amount_cents"),
            dollars(total["cents"]).alias("total_amount_usd"),
            total["raw"].alias("total_amount_raw"),
            federal["cents"].alias("federal_share_cents"),
            federal["raw"].alias("federal_share_raw"),
            nonfederal["cents"].alias("nonfederal_share_cents"),
            nonfederal["raw"].alias("nonfederal_share_raw"),
            F.col("cap_cents").alias("grandfathered_cap_cents"),
            dollars(F.col("cap_cents")).alias("grandfathered_cap_usd"),
            letter.alias("letter_amount_cents"),
            F.col("rec.matched_phrase").alias("letter_matched_phrase"),
            F.col("chosen_cents").isNotNull().alias("amount_is_publishable"),
            (from_form & assumed).alias("amount_unit_assumed"),
            (from_form & implausible).alias("amount_implausible"),
            F.when(~from_letter, total["issue"]).alias("amount_issue"),
            assumed.alias("form_unit_assumed"), implausible.alias("form_implausible"),
            form["cms_id"].alias("cms_id_in_document"),
            F.when(F.startswith(mismatch, F.lit("document disagrees")), mismatch)
            .alias("identifier_mismatch"),
            F.when(F.startswith(mismatch, F.lit("CMS ID field holds no")), mismatch)
            .alias("cms_id_unusable"),
            F.nullif(F.array_join("identifier_repairs", "; "), F.lit(""))
            .alias("identifier_repairs"),
            "identifier_issue", F.col("pdf_url").alias("source_url"),
            F.col("content_sha256").alias("source_sha256"),
            F.coalesce("retrieved_at", "manifest_retrieved_at").alias("retrieved_at"),
            "excluded_reason", F.lit(EXTRACTION_VERSION).alias("extraction_version"))
    )


def publish_summary(archive: DataFrame) -> DataFrame:
    """One row about the archive. Dollars come from summed cents."""
    source = F.col("amount_source")
    return archive.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("amount_is_publishable").alias("publishable_amounts"),
        F.count_distinct("state_code").alias("states"),
        F.coalesce(F.sum(F.when(F.col("amount_is_publishable"), F.col("amount_cents"))), F.lit(0))
        .alias("sum_total_cents"),
        F.count_if(source == "form_field").alias("from_form_field"),
        F.count_if(source == "approval_letter").alias("from_approval_letter"),
        F.count("identifier_mismatch").alias("identifier_mismatches"),
        F.count("cms_id_unusable").alias("cms_id_unusable"),
        F.count("grandfathered_cap_cents").alias("grandfathered_caps"),
        F.coalesce(F.sum("grandfathered_cap_cents"), F.lit(0)).alias("sum_cap_cents"),
        F.count("excluded_reason").alias("excluded"),
    ).withColumn("sum_total_usd", dollars(F.col("sum_total_cents"))).withColumn(
        "sum_cap_usd", dollars(F.col("sum_cap_cents")))


def extraction_summary(records: DataFrame) -> DataFrame:
    """One row about the reading: every approval is anchored, silent or unresolved."""
    approval = F.col("letter_type") == letters.APPROVAL
    total, federal = F.col("form.total"), F.col("form.federal_share")
    usable = is_usable(total)
    anchored = approval & F.col("amount_cents").isNotNull()
    silent = approval & F.coalesce(F.col("issue") == letters.NO_AMOUNT, F.lit(False))

    def cents(condition: Column, amount: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, amount["cents"])), F.lit(0))

    return records.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(approval).alias("approvals"),
        F.count_if(F.col("letter_type") == letters.PHASE_DOWN_TYPE)
        .alias("phase_down_determinations"),
        F.count_if(F.col("letter_type") == letters.FORM_ONLY).alias("form_only_no_letter"),
        F.count_if(anchored).alias("anchored"),
        F.count_if(silent).alias("no_amount_stated"),
        F.count_if(usable).alias("totals_from_form_fields"),
        F.count("identifier_mismatch").alias("identifier_mismatches"),
        cents(usable, total).alias("sum_total_cents"),
        cents(usable & is_usable(federal), federal).alias("sum_federal_cents"),
    ).withColumn(
        "unresolved", F.col("approvals") - F.col("anchored") - F.col("no_amount_stated"))


def value_counts(records: DataFrame, clause_chars: int | None = None) -> DataFrame:
    """Documents by phrase, by first clause of the issue, and by kind, in one pass.

    Clauses count whole unless ``clause_chars`` cuts them to so many characters.
    """
    clause = F.substring_index("issue", ",", 1)
    if clause_chars is not None:
        clause = F.substring(clause, 1, clause_chars)
    facets = {
        "phrase": F.coalesce("matched_phrase", F.lit("unanchored")),
        "issue": clause,
        "document_type": F.col("letter_type"),
    }
    labels = F.filter(F.array(*[
        F.struct(F.lit(facet).alias("facet"), value.alias("value"))
        for facet, value in facets.items()
    ]), lambda label: label["value"].isNotNull())
    return records.select(F.explode(labels).alias("label")).select("label.*").groupBy(
        "facet", "value").agg(F.count(F.lit(1)).alias("documents"))


def reading_agreement(archive: DataFrame) -> DataFrame:
    """How often form and letter state the same cents, overall and by payment type."""
    both = archive.where(
        F.col("letter_amount_cents").isNotNull() & F.col("total_amount_cents").isNotNull()
        & (F.col("document_type") == letters.APPROVAL)
        & ~F.col("form_unit_assumed") & ~F.col("form_implausible"))
    scopes = F.array(F.lit("ALL"), F.coalesce("payment_type_normalised", F.lit("UNKNOWN")))
    same = F.col("letter_amount_cents") == F.col("total_amount_cents")
    return (
        both.select(F.explode(scopes).alias("payment_type"), same.alias("same"))
        .groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("compared"), F.count_if("same").alias("agreeing"))
        .withColumn("agreement_rate", F.col("agreeing").cast("double") / F.col("compared"))
    )


def mismatch_components(archive: DataFrame) -> DataFrame:
    """Documents by the component on which their two names differ."""
    listed = F.regexp_extract("identifier_mismatch", r"^document disagrees on ([^:]*):", 1)
    return (
        archive.where(F.col("identifier_mismatch").isNotNull())
        .select(F.explode(F.split(listed, ", ")).alias("component"))
        .groupBy("component").agg(F.count(F.lit(1)).alias("documents"))
    )
