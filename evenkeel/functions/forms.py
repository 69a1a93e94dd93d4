"""Answers in the named fields of a form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions.money import read_amount, unread_amount
from evenkeel.functions.text import strip

NUMBERED, PROSE, MINIMAL, UNKNOWN = "numbered", "prose", "minimal", "unknown"

# Logical answers and the field names that hold them, in order.
ALIASES = {
    "state": ("0.1-State",),
    "cms_id": ("0.2-CMS ID",),
    "rating_period_start": ("1-DateStart_af_date",),
    "rating_period_end": ("1-DateEnd_af_date",),
    "managed_care_programs": ("3-Text",),
    "total_amount": ("4-Text",),
    "federal_share": ("4.a-Text",),
    "nonfederal_share": ("4.b-Text",),
}
# A minimal form has few fields; a prose form names one by its question.
MINIMAL_FIELDS = 12
PROSE_NAME = 40


def template(fields: Column) -> Column:
    """Which form this is, told by its field names alone."""
    names = F.map_keys(fields)
    return (
        F.when(F.map_contains_key(fields, F.lit("4-Text"))
               | F.map_contains_key(fields, F.lit("0.2-CMS ID")), NUMBERED)
        .when(F.size(names) <= MINIMAL_FIELDS, MINIMAL)
        .when(F.exists(names, lambda name: F.length(name) > PROSE_NAME), PROSE)
        .otherwise(UNKNOWN)
    )


def answer(fields: Column, logical: str) -> Column:
    """The first answer that is not blank."""
    return F.coalesce(*[
        F.nullif(strip(F.try_element_at(fields, F.lit(name))), F.lit(""))
        for name in ALIASES[logical]])


def read_form(fields: Column, error: Column | None = None) -> Column:
    """The answers of one form, or which template stopped the reading.

    ``fields`` maps field names to their values; NULL stands for a form that could
    not be opened, in which case ``error`` says why.
    """
    kind = F.when(fields.isNull(), UNKNOWN).otherwise(template(fields))
    readable = F.coalesce(kind == NUMBERED, F.lit(False))
    reason = F.lit("") if error is None else F.coalesce(error, F.lit(""))

    def text(logical: str) -> Column:
        return F.when(readable, answer(fields, logical))

    def amount(logical: str) -> Column:
        return F.when(readable, read_amount(answer(fields, logical))).otherwise(unread_amount())

    return F.struct(
        kind.alias("template"),
        F.when(fields.isNull(), 0).otherwise(F.size(fields)).alias("field_count"),
        *[text(name).alias(name) for name in (
            "state", "cms_id", "rating_period_start", "rating_period_end",
            "managed_care_programs")],
        amount("total_amount").alias("total"),
        amount("federal_share").alias("federal_share"),
        amount("nonfederal_share").alias("nonfederal_share"),
        F.when(fields.isNull(), F.substring(F.concat(F.lit("unreadable PDF: "), reason), 1, 160))
        .when(~readable, F.concat(kind, F.lit(" template is not yet mapped to logical fields")))
        .alias("issue"))
