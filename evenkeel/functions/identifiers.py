"""Control names of arrangements: STATE_PAYMENT_CLASS_REVIEW_START-END.

Published names break the convention in several ways. Each repair is recorded on
the row it was applied to; what cannot be resolved stays NULL and says why.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.binding import Names, Steps, staged, staged_items
from evenkeel.functions.text import SPACE, quoted, strip

# The words that name a review type or a payment type.
REVIEW_WORDS = ("new", "renewal", "amend", "amendment", "amend1", "amend2", "amend3")
PAYMENT_WORDS = ("fee", "vbp", "proposal")

# The forms that dates and suffixes take in a published name.
_DATES = rf"(\d{{6,9}}){SPACE}*-{SPACE}*(\d{{6,9}})"
_RANGE = rf"{_DATES}{SPACE}*$"
_YEARS = rf"((?:19|20)\d{{2}}){SPACE}*-{SPACE}*((?:19|20)\d{{2}}){SPACE}*$"
_WITH_SUFFIX = rf"(?d)(\d{{6,9}}{SPACE}*-{SPACE}*\d{{6,9}}){SPACE}+(\S.*)$"
_IN_TEXT = rf"(?d)[A-Za-z]{{2}}[_\-][A-Za-z.]+[_\-].*?\d{{6,9}}{SPACE}*-{SPACE}*\d{{6,9}}"

FIELDS = (
    "state_code", "payment_type", "payment_type_normalised", "provider_class", "review_type",
    "review_type_normalised", "rating_period_start", "rating_period_end",
    "identifier_suffix", "identifier_parsed", "identifier_issue", "identifier_repairs")
COMPONENTS = ("state", "payment_type", "provider_class", "review_type", "rating_period_start",
              "rating_period_end")


def _year(text: Column) -> Column:
    return text.try_cast("int").between(1990, 2100)


def read_date(token: Column) -> Column:
    """One date token as ``{iso, repair}``; the calendar is not validated.

    Eight digits are YYYYMMDD, or MMDDYYYY when the first four cannot be a year.
    Any other length is a typing error that nobody can repair with certainty.
    """
    def part(start: int, length: int) -> Column:
        return F.substring(token, start, length)

    dash = F.lit("-")
    eight = F.length(token) == 8
    iso = F.when(eight & _year(part(1, 4)), F.concat(part(1, 4), dash, part(5, 2), dash, part(7, 2))
                 ).when(eight & _year(part(5, 4)),
                        F.concat(part(5, 4), dash, part(1, 2), dash, part(3, 2)))
    repair = F.when(
        ~eight, F.concat(F.lit("date has "), F.length(token).cast("string"),
                         F.lit(" digits, expected 8"))
    ).when(_year(part(1, 4)), None).when(_year(part(5, 4)), "date read as MMDDYYYY").otherwise(
        "8 digits but neither half is a plausible year")
    return F.struct(iso.alias("iso"), repair.alias("repair"))


def _capitalised(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))


def _review(word: Column) -> Column:
    return F.when(F.startswith(F.lower(word), F.lit("amend")), "Amendment").otherwise(
        _capitalised(word))


def _present(items: Column) -> Column:
    return F.filter(items, lambda item: item != "")


def _sorted_payment(token: Column) -> Column:
    parts = F.array_sort(_present(F.split(F.upper(token), r"\.")))
    return F.nullif(F.array_join(parts, "."), F.lit(""))


STEPS: Steps = [
    ("trimmed", lambda at: strip(at("input"))),
    ("text", lambda at: F.regexp_replace(at("trimmed"), r"^[\\/ \t.]+", "")),
    ("has_suffix", lambda at: F.rlike(at("text"), F.lit(_WITH_SUFFIX))),
    ("suffix", lambda at: F.when(
        at("has_suffix"), strip(F.regexp_extract(at("text"), _WITH_SUFFIX, 2)))),
    ("body", lambda at: F.when(
        at("has_suffix"), strip(F.regexp_replace(at("text"), _WITH_SUFFIX, "$1"))
    ).otherwise(at("text"))),
    ("by_date", lambda at: F.rlike(at("body"), F.lit(_RANGE))),
    ("by_year", lambda at: ~at("by_date") & F.rlike(at("body"), F.lit(_YEARS))),
    ("dated", lambda at: at("by_date") | at("by_year")),
    ("start", lambda at: F.when(at("by_date"), read_date(F.regexp_extract(at("body"), _RANGE, 1)))),
    ("end", lambda at: F.when(at("by_date"), read_date(F.regexp_extract(at("body"), _RANGE, 2)))),
    ("period_start", lambda at: F.when(at("by_date"), at("start")["iso"]).when(
        at("by_year"), F.concat(F.regexp_extract(at("body"), _YEARS, 1), F.lit("-01-01")))),
    ("period_end", lambda at: F.when(at("by_date"), at("end")["iso"]).when(
        at("by_year"), F.concat(F.regexp_extract(at("body"), _YEARS, 2), F.lit("-12-31")))),
    ("front", lambda at: strip(F.regexp_replace(strip(F.when(
        at("by_date"), F.regexp_replace(at("body"), _RANGE, "")
    ).otherwise(F.regexp_replace(at("body"), _YEARS, ""))), r"[_\-]+$", ""))),
    ("state", lambda at: F.nullif(
        F.regexp_extract(F.concat(at("front"), F.lit("_")), r"^([A-Za-z]{2})[_\-]", 1),
        F.lit(""))),
    ("fields", lambda at: F.when(
        at("state").isNotNull(),
        F.regexp_replace(F.substr(at("front"), F.lit(3)), r"^[_\-]+", "")
    ).otherwise(at("front"))),
    ("hyphened", lambda at: F.contains(at("fields"), F.lit("-"))
        & ~F.contains(at("fields"), F.lit("_"))),
    ("words", lambda at: _present(F.split(
        F.when(at("hyphened"), F.replace(at("fields"), F.lit("-"), F.lit("_"))).otherwise(
            at("fields")), f"(?:_|{SPACE})+"))),
    ("last", lambda at: F.try_element_at(at("words"), F.lit(-1))),
    ("review", lambda at: F.when(F.lower(at("last")).isin(*REVIEW_WORDS), at("last"))),
    ("named", lambda at: F.when(
        at("review").isNotNull(), F.slice(at("words"), 1, F.size(at("words")) - 1)
    ).otherwise(at("words"))),
    ("split_payment", lambda at: (F.size(at("named")) > 2) & F.lower(
        F.try_element_at(at("named"), F.lit(2))).isin(*PAYMENT_WORDS)),
    ("tokens", lambda at: F.when(at("split_payment"), F.concat(
        F.array(F.concat(F.get(at("named"), F.lit(0)), F.lit("."), F.get(at("named"), F.lit(1)))),
        F.slice(at("named"), 3, F.greatest(F.size(at("named")) - 2, F.lit(0))))
    ).otherwise(at("named"))),
    ("payment", lambda at: F.get(at("tokens"), F.lit(0))),
    ("fused", lambda at: F.coalesce(
        (F.size(at("tokens")) == 1) & F.contains(at("payment"), F.lit(".")), F.lit(False))),
    # The wordings of the repairs.
    ("repairs", lambda at: F.filter(F.array(
        F.when(at("text") != at("trimmed"), "leading stray character removed from the identifier"),
        F.when(at("by_year"), "rating period given as years only; assumed full calendar years"),
        at("start")["repair"],
        F.when(~at("end")["repair"].eqNullSafe(at("start")["repair"]), at("end")["repair"]),
        F.when(at("state") != F.upper(at("state")), "state code was not upper case"),
        F.when(at("hyphened"), "fields were hyphen separated"),
        F.when(at("review").isNull(), "no review type in the identifier"),
        F.when(at("split_payment"), "combined payment type was split across two tokens"),
        F.when(at("fused"), "payment type and provider class were one token"),
    ), lambda repair: repair.isNotNull())),
    ("parsed", lambda at: at("state").isNotNull() & at("period_start").isNotNull()
        & at("period_end").isNotNull()),
]


def _fields(at: Names) -> dict[str, Column]:
    """The twelve parsed fields. Without a rating period only the suffix is known."""
    def known(column: Column) -> Column:
        return F.when(at("dated"), column)

    tokens, payment = at("tokens"), at("payment")
    rest = F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))
    after_dot = F.substring(payment, F.instr(payment, ".") + 1, F.length(payment))
    provider = F.when(at("fused"), after_dot).when(F.size(tokens) > 1, F.array_join(rest, "_"))
    repairs = F.when(at("dated"), at("repairs")).otherwise(F.array().cast("array<string>"))
    stated = F.coalesce(
        F.nullif(F.array_join(at("repairs"), "; "), F.lit("")),
        F.lit("could not resolve required fields"))
    return {
        "state_code": known(F.upper(at("state"))),
        "payment_type": known(F.when(at("fused"), F.substring_index(payment, ".", 1)).otherwise(
            payment)),
        "payment_type_normalised": known(_sorted_payment(payment)),
        "provider_class": known(provider),
        "review_type": known(at("review")),
        "review_type_normalised": known(_review(at("review"))),
        "rating_period_start": at("period_start"),
        "rating_period_end": at("period_end"),
        "identifier_suffix": at("suffix"),
        "identifier_parsed": F.coalesce(at("parsed") & at("dated"), F.lit(False)),
        "identifier_issue": F.when(~at("dated"), "no rating period found in the identifier").when(
            ~at("parsed"), stated),
        "identifier_repairs": repairs,
    }


def with_parsed_identifier(df: DataFrame, column: str) -> DataFrame:
    """Adds the parsed fields of an identifier column."""
    return staged(df, F.col(column), STEPS, _fields)


def version_rank(review_type: Column) -> Column:
    """Order of a filing among the filings of its arrangement; NULL when unknown.

    A bare amendment is the first one, so it ties with an amendment numbered one.
    """
    word = F.lower(strip(review_type))
    number = F.regexp_extract(word, r"^amend(?:ment)?(\d*)$", 1)
    return F.when(word == "new", 0).when(word == "renewal", 1).when(
        F.rlike(word, F.lit(r"^amend(?:ment)?\d*$")),
        1 + F.when(number == "", 1).otherwise(number.try_cast("int")))


def _components(item: Column) -> Column:
    """A parsed name reduced to what may be compared: spelling variants are folded."""
    parsed = _fields(item.__getitem__)
    empty = F.lit("")
    spelled = F.replace(
        F.upper(F.coalesce(parsed["provider_class"], empty)), F.lit("_"), F.lit("."))
    folded = F.regexp_replace(
        F.regexp_replace(spelled, r"\bIPH(\d*)", "IP$1"), r"\bOPH(\d*)", "OP$1")
    return F.struct(
        item["own"].alias("own"),
        parsed["state_code"].alias("c0"),
        F.coalesce(parsed["payment_type_normalised"], empty).alias("c1"),
        folded.alias("c2"),
        F.coalesce(parsed["review_type_normalised"], empty).alias("c3"),
        parsed["rating_period_start"].alias("c4"),
        parsed["rating_period_end"].alias("c5"))


def _differs(a: Column, b: Column) -> list[Column]:
    return [~a[f"c{i}"].eqNullSafe(b[f"c{i}"]) for i in range(len(COMPONENTS))]


def _named_in(text: Column, own: bool) -> Column:
    """Identifiers written anywhere in a text, which may name several."""
    hits = F.transform(F.split(text, "[/;]"), lambda chunk: F.struct(
        F.lit(own).alias("own"), F.regexp_extract(chunk, _IN_TEXT, 0).alias("input")))
    return F.coalesce(
        F.filter(hits, lambda hit: hit["input"] != ""),
        F.array().cast("array<struct<own:boolean,input:string>>"))


def with_cross_check(df: DataFrame, identifier: str, stated: str, out: str) -> DataFrame:
    """Adds what stands between a document's name and the identifier inside it.

    NULL when they agree or nothing is stated. A field may name several
    identifiers; agreeing with any of them is agreement, and otherwise the
    closest one decides which components are reported.
    """
    work, name, field = "__named", F.col(identifier), strip(F.col(stated))
    parsed = staged_items(
        df.withColumn(work, F.concat(_named_in(name, True), _named_in(F.col(stated), False))),
        work, STEPS)
    compared = parsed.withColumn(work, F.filter(
        F.transform(work, _components), lambda item: item["c0"].isNotNull()))
    own_first = F.get(F.filter(work, lambda item: item["own"]), F.lit(0))
    documents = F.filter(work, lambda item: ~item["own"])

    def distance(document: Column, position: Column) -> Column:
        own = F.col("__own")
        names = F.filter(F.array(*[
            F.when(differs, label) for differs, label in zip(_differs(own, document), COMPONENTS)
        ]), lambda label: label.isNotNull())
        return F.struct(F.size(names).alias("n"), position.alias("at"), names.alias("names"))

    closest = F.array_min(F.transform("__documents", distance))
    message = (
        F.when(F.coalesce(field, F.lit("")) == "", None)
        .when(F.size("__documents") == 0, F.concat(
            F.lit("CMS ID field holds no identifier: "), quoted(F.substring(field, 1, 60))))
        .when(F.col("__own").isNotNull() & (F.col("__closest")["n"] > 0), F.concat(
            F.lit("document disagrees on "), F.array_join(F.col("__closest")["names"], ", "),
            F.lit(": filename "), quoted(F.substring(strip(name), 1, 50)),
            F.lit(", document "), quoted(F.substring(field, 1, 50))))
    )
    return (
        compared.withColumn("__own", own_first)
        .withColumn("__documents", documents)
        .withColumn("__closest", closest)
        .withColumn(out, message)
        .drop(work, "__own", "__documents", "__closest")
    )
