"""Money written by people, read as exact integer cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions.binding import let
from evenkeel.functions.text import SPACE, strip

# Zeros that a scale word adds.
SCALE_ZEROS = {"thousand": 3, "k": 3, "million": 6, "m": 6, "billion": 9, "b": 9}
# Fixed value: no single arrangement is worth more than a hundred billion dollars.
IMPLAUSIBLE_ABOVE_CENTS = 100_000_000_000 * 100

NUMBER = r"\d[\d,]*(?:\.\d+)?"
# A dollar amount inside a sentence.
DOLLARS = rf"\$\s?({NUMBER})\s*(thousand|million|billion)?"
# A free-form answer: the currency sign is optional and the scale may be a letter.
_WORD_END = r"(?![\p{L}\p{N}_])"
_ANSWER = (rf"(?iu)\$?{SPACE}?({NUMBER}){SPACE}*"
           rf"(million|billion|thousand|M{_WORD_END}|B{_WORD_END}|K{_WORD_END})?")

AMOUNT = "cents bigint, raw string, ambiguous_unit boolean, implausible boolean, issue string"


def scale_zeros(word: Column) -> Column:
    """Zeros of a scale word in any case; zero for none."""
    zeros = F.lit(0)
    for name, count in SCALE_ZEROS.items():
        zeros = F.when(F.lower(word) == name, count).otherwise(zeros)
    return zeros


def exact_cents(number: Column, zeros: Column) -> Column:
    """Cents as a whole decimal, by moving the point in the text.

    Nothing passes through floating point. Without a scale word, digits after the
    second decimal are cut off; with one, more decimals than reach a cent cannot
    be represented and give NULL.
    """
    plain = F.replace(number, F.lit(","), F.lit(""))
    whole = F.substring_index(plain, ".", 1)
    decimals = F.when(F.contains(plain, F.lit(".")), F.substring_index(plain, ".", -1)).otherwise("")
    places = zeros + 2
    digits = F.concat(whole, F.rpad(decimals, places, "0"))
    fits = (zeros == 0) | (F.length(decimals) <= places)
    return F.when(fits, digits.try_cast("decimal(38,0)"))


def sentence_cents(match: Column) -> Column:
    """Cents of text matched by ``DOLLARS``."""
    number = F.regexp_extract(match, f"(?iu){DOLLARS}", 1)
    scale = F.regexp_extract(match, f"(?iu){DOLLARS}", 2)
    return exact_cents(number, scale_zeros(scale)).try_cast("bigint")


def dollars_text(cents: Column) -> Column:
    """``$1,234`` rounded to whole dollars."""
    return F.concat(F.lit("$"), F.format_number(cents.cast("double") / 100, 0))


def _amount(cents=None, raw=None, ambiguous=None, implausible=None, issue=None) -> Column:
    none = F.lit(None)
    return F.struct(
        (none if cents is None else cents).cast("bigint").alias("cents"),
        (none if raw is None else raw).cast("string").alias("raw"),
        (F.lit(False) if ambiguous is None else ambiguous).alias("ambiguous_unit"),
        (F.lit(False) if implausible is None else implausible).alias("implausible"),
        (none if issue is None else issue).cast("string").alias("issue"))


def unread_amount() -> Column:
    return _amount(issue=F.lit("not read"))


def _read_answer(raw: Column) -> Column:
    def parts(match: Column) -> Column:
        number = F.regexp_extract(match, _ANSWER, 1)
        scale = F.regexp_extract(match, _ANSWER, 2)
        end = F.call_function("locate", match, raw) + F.length(match) - 1
        decimals = F.length(F.regexp_extract(number, r"\.(\d+)$", 1))
        zeros = scale_zeros(scale)
        return F.struct(
            match.alias("match"), exact_cents(number, zeros).alias("cents"),
            ((scale != "") & (decimals > zeros)).alias("too_fine"),
            (~F.contains(F.substring(raw, F.lit(1), end), F.lit("$")) & (scale == ""))
            .alias("ambiguous"))

    def judge(read: Column) -> Column:
        cents, ambiguous = read["cents"], read["ambiguous"]
        implausible = F.coalesce(cents > IMPLAUSIBLE_ABOVE_CENTS, F.lit(False))
        issue = F.when(implausible, F.concat(
            dollars_text(cents),
            F.lit(" exceeds any credible arrangement size; the field appears to combine a "
                  "full figure with a scale word"))
        ).when(ambiguous, "no currency symbol or scale word; unit assumed")
        return F.when(
            read["match"] == "", _amount(raw=raw, issue=F.lit("no number in the field"))
        ).when(
            read["too_fine"],
            _amount(raw=raw, issue=F.lit("more decimal places than the scale allows"))
        ).otherwise(_amount(cents.try_cast("bigint"), raw, ambiguous, implausible, issue))

    return let(F.regexp_extract(raw, _ANSWER, 0), lambda match: let(parts(match), judge))


def read_amount(answer: Column) -> Column:
    """A free-form answer as cents, with what is uncertain about it.

    An empty answer is not a zero. A bare number has no unit, a figure beyond any
    credible size is kept but marked, and neither is repaired.
    """
    return F.when(
        answer.isNull() | (strip(answer) == ""), _amount(issue=F.lit("field is empty"))
    ).otherwise(let(strip(answer), _read_answer))
