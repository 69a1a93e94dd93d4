"""The approved amount in a letter: the figure CMS states, not just any figure."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.binding import Steps, staged
from evenkeel.functions.money import DOLLARS, dollars_text, sentence_cents
from evenkeel.functions.text import one_line

# The wordings under which a letter states its amount.
PHRASES = {
    "separate_payment_term": r"separate payment term (?:amount )?(?:of )?(?:up to )?",
    "payment_term_is": r"payment term for this state directed payment is (?:up to )?",
    "risk_based_adjustment": r"risk[- ]based (?:rate )?adjustment (?:of )?(?:up to )?",
    "total_dollar_amount": r"total (?:dollar )?amount of (?:up to )?",
    "amount_of_up_to": r"(?:in an? )?amount of up to ",
    "not_to_exceed": r"not to exceed ",
}
# What tells the kinds of document apart.
PHASE_DOWN = r"grandfathered SDP|section 71116|phase[ -]?down|Public Law 119-21"
APPROVED = r"\bis approved\b"
FORM_START = r"SECTION I\b"


@dataclass(frozen=True)
class Reach:
    """How far a letter is read: so many pages, and a form's mark within so many characters."""

    pages: int | None = None
    form_start: int | None = None


WHOLE = Reach()
# The reach that the published readings have.
PUBLISHED = Reach(pages=3, form_start=2500)

APPROVAL = "approval"
PHASE_DOWN_TYPE = "phase_down_determination"
FORM_ONLY = "form_only_no_letter"

FIELDS = ("letter_type", "amount_cents", "raw_text", "matched_phrase", "all_amounts_cents",
          "letter_pages_read", "issue")
NO_AMOUNT = "no dollar amount in the approval letter"


def letter_type(text: Column, reach: Reach = WHOLE) -> Column:
    front = text if reach.form_start is None else F.substring(text, 1, reach.form_start)
    return (
        F.when(F.rlike(text, F.lit(f"(?iu){PHASE_DOWN}")), PHASE_DOWN_TYPE)
        .when(F.rlike(text, F.lit(f"(?iu){APPROVED}")), APPROVAL)
        .when(F.rlike(front, F.lit(f"(?iu){FORM_START}")), FORM_ONLY)
        .otherwise(APPROVAL)
    )


def all_amounts(text: Column) -> Column:
    """Every distinct amount in the text, in ascending order."""
    found = F.regexp_extract_all(text, F.lit(f"(?iu){DOLLARS}"), F.lit(0))
    cents = F.transform(found, sentence_cents)
    return F.array_sort(F.array_distinct(F.filter(cents, lambda c: c.isNotNull())))


def anchored_amounts(text: Column) -> Column:
    """The first match of each phrase as ``{at, phrase, cents, raw}``.

    A phrase's first match is also the first occurrence of the matched text, so
    its position is found by a plain search and each pattern runs once.
    """
    def first(name: str, wording: str) -> Column:
        raw = F.regexp_extract(text, f"(?iu){wording}{DOLLARS}", 0)
        return F.struct(raw.alias("raw"), F.lit(name).alias("phrase"))

    matched = F.filter(F.array(*[first(n, w) for n, w in PHRASES.items()]),
                       lambda m: m["raw"] != "")
    return F.transform(matched, lambda m: F.struct(
        F.call_function("locate", m["raw"], text).alias("at"), m["phrase"].alias("phrase"),
        sentence_cents(m["raw"]).alias("cents"), F.trim(m["raw"]).alias("raw")))


_CAP_NOTE = ("figure is a grandfathering cap under Public Law 119-21, not an approved amount")


def _steps(reach: Reach) -> Steps:
    def read(pages: Column) -> Column:
        return pages if reach.pages is None else F.slice(pages, 1, reach.pages)

    return [
        ("text", lambda at: one_line(F.array_join(read(at("input")), " "))),
        ("pages", lambda at: F.size(read(at("input")))),
        ("type", lambda at: letter_type(at("text"), reach)),
        *_READING,
    ]


_READING: Steps = [
    ("all", lambda at: all_amounts(at("text"))),
    ("anchored", lambda at: F.when(at("type") != FORM_ONLY, anchored_amounts(at("text")))
        .otherwise(F.array().cast("array<struct<at:int,phrase:string,cents:bigint,raw:string>>"))),
    # The approving statement comes first in a letter; a restatement follows it.
    ("chosen", lambda at: F.array_min(at("anchored"))),
    ("others", lambda at: F.array_sort(F.array_distinct(F.filter(
        F.transform(at("anchored"), lambda m: m["cents"]),
        lambda c: c != at("chosen")["cents"])))),
]


def _fields(at) -> dict[str, Column]:
    chosen = at("chosen")
    elsewhere = F.when(F.size(at("others")) > 0, F.concat(
        F.lit("letter states a different amount elsewhere ("),
        F.array_join(F.transform(at("others"), dollars_text), ", "), F.lit(")")))
    cap = F.when(at("type") == PHASE_DOWN_TYPE, _CAP_NOTE)
    issue = (
        F.when(at("type") == FORM_ONLY, "document is the preprint form with no approval letter")
        .when(chosen.isNotNull(), F.nullif(F.concat_ws("; ", elsewhere, cap), F.lit("")))
        .when(F.size(at("all")) > 0, F.concat(
            F.size(at("all")).cast("string"),
            F.lit(" amount(s) in the letter, none under a recognised phrase")))
        .otherwise(NO_AMOUNT)
    )
    return {
        "letter_type": at("type"),
        "amount_cents": chosen["cents"],
        "raw_text": chosen["raw"],
        "matched_phrase": chosen["phrase"],
        "all_amounts_cents": at("all"),
        "letter_pages_read": at("pages"),
        "issue": issue,
    }


def with_letter_amount(df: DataFrame, pages: str, reach: Reach = WHOLE) -> DataFrame:
    """Adds what a letter states, from an array column with the text of its pages."""
    return staged(df, F.col(pages), _steps(reach), _fields)
