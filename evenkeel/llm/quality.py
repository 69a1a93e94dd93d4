"""Quality rules: base counts, and divergence from language references.

Everything is DataFrame functions. A document is described by two histograms: its
characters by class, and its words by the most frequent words of its language (all
other words in one bin). Both are compared with the histograms of the language,
gathered from all documents, by Jensen-Shannon distance. The limit on words is a share
of the distance of a text without any of the common words, which nothing readable comes
near, and is wider for short texts by what drawing few words adds to a distance.

Defined results: a null text counts as empty; an empty text has zero counts and
fails the base rules. A null language, or one that has no reference, is compared
with every reference, the nearest of which counts. Texts below the minimum
lengths are too short for a histogram and get no verdict from it. Rows are judged
one by one, so repeated rows and null ids each get a result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import BLANKS, packed, small, words
from evenkeel.session import stage

SYMBOLS = r"[#*$%&|<>]"
CLASSES = ("letter", "capital", "digit", "blank", "symbol", "mark")
ANY = ""  # key of the rows that are compared with every reference
MANY = 10_000  # languages; more of them are joined without a broadcast
SLOTS = 4_096  # of a table of word digests, which tells most words that are no common word


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 24          # words in a language's reference
    min_reference_words: int = 2000  # words a language needs to be a reference
    min_chars: int = 200            # in words; below: no verdict from the characters
    max_class_distance: float = 0.27
    word_share: float = 0.6         # of the divergence's root without common words, for long texts
    most_word_share: float = 0.9    # the same for texts of any length


def _settled(value: Column) -> Column:
    """The value, below which no filter is pushed.

    A filter that moves below the columns its value is made of would have these anew
    for every element of a lambda; it does not pass a column that numbers rows.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def _slot(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SLOTS)).cast("int")


def _taken(words: DataFrame) -> Column:
    """Which slots hold a word: an array of SLOTS booleans, so at most that many rows are read."""
    slots = {r[0] for r in words.select(_slot(F.col("word"))).distinct().collect()}
    return F.expr("array(" + ",".join("true" if i in slots else "false" for i in range(SLOTS)) + ")")


def _length_without(text: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(text, pattern, ""))


def _classes(total: Column, rest: Column, blanks: Column, capitals: Column, digits: Column,
             symbols: Column, letters: Column) -> Column:
    """Characters by class, in the order of CLASSES; the last takes what no other has."""
    known = [letters - capitals, capitals, digits, blanks, symbols]
    return F.array(*[c.cast("long") for c in (*known, total - letters - digits - blanks - symbols)])


def base_counts(docs: DataFrame, taken: Column | None = None) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Repeated windows are neighbours among the sorted digests; their starts give the
    covered words as the length of a union of intervals. The upper halves of the digests,
    sorted as numbers with the place in the lower half, leave the few windows whose whole
    digests are compared. Beside the counts come the
    character classes and the words whose slot is ``taken``, two spaces apart, for the
    histograms.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w, coded, s, rest = F.col("_words"), F.col("_coded"), F.col("_windows"), F.col("_rest")

    def in_rest(pattern: str) -> Column:
        return F.char_length(rest) - _length_without(rest, pattern)

    blanks = F.col("_total") - F.col("word_chars")
    capitals, digits, symbols = in_rest(r"\p{Lu}+"), in_rest(r"\p{Nd}+"), in_rest(SYMBOLS)
    letters = F.col("_total") - F.char_length(rest) - (blanks - in_rest(BLANKS)) + in_rest(r"\p{L}+")
    place = F.lit(2 ** 31 - 1).cast("long")  # the bits that hold a place, which any array has room for

    def digest(i: Column) -> Column:
        return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    codes = F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: digest(i).bitwiseAND(F.lit(-2 ** 31).cast("long")).bitwiseOR(i.cast("long")))

    def near(x: Column, other: Column) -> Column:
        return F.coalesce(x.bitwiseXOR(other) <= place, F.lit(False)) & (x.bitwiseXOR(other) >= 0)

    alike = F.filter(coded, lambda x, i: near(x, F.get(coded, i - 1)) | near(x, F.get(coded, i + 1)))
    windows = F.transform(F.transform(alike, lambda x: x.bitwiseAND(place).cast("int")),
                          lambda p: F.struct(digest(p).alias("h"), p.alias("p")))
    repeated = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"])
                        | (x["h"] == F.get(s, i + 1)["h"]))
    return (
        # The lower-case letters and spaces go in one pass; the little left is counted by class.
        docs.withColumns({
            "_words": words(F.col("text")), "_total": F.char_length(text),
            "_rest": F.regexp_replace(text, r"[\p{Ll} ]+", ""),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")})
        .withColumns({
            "n_words": F.size(w).cast("long"),
            "word_chars": F.char_length(F.array_join(w, "")).cast("long"),
            "_short": F.concat(F.lit(" "), F.array_join(w if taken is None else F.filter(
                w, lambda x: F.get(taken, _slot(x))), "  "), F.lit(" ")),
            "_coded": F.sort_array(codes)})
        .withColumn("_windows", F.sort_array(windows))
        .drop("_words", "_coded")
        .withColumns({
            "n_symbols": symbols.cast("long"),
            "_classes": _classes(F.col("_total"), rest, blanks, capitals, digits, symbols, letters),
            "_starts": F.sort_array(F.transform(repeated, lambda x: x["p"]))})
        .drop("_windows", "_total", "_rest")
        .withColumn("n_repeat_words", _settled(F.aggregate(
            F.transform("_starts", lambda p, i: F.coalesce(
                F.least(F.get("_starts", i + 1) - p, F.lit(3)), F.lit(3))),
            F.lit(0).cast("long"), lambda a, x: a + x)))
        .drop("_starts"))


def references(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(lang, classes, words): shares by class, and (word, share) of the common words.

    Counted over all documents with a language; counts combine before the shuffle.
    """
    known = docs.where("lang is not null and text is not null").select("lang", "text")
    rest = F.col("_rest")

    def in_rest(pattern: str) -> Column:
        return F.char_length(rest) - _length_without(rest, pattern)

    counts = known.select("lang", F.char_length("text").alias("_total"), F.regexp_replace(
        "text", r"\p{Ll}+", "").alias("_rest")).select("lang", _classes(
            F.col("_total"), rest, in_rest(BLANKS), in_rest(r"\p{Lu}+"), in_rest(r"\p{Nd}+"),
            in_rest(SYMBOLS), F.col("_total") - F.char_length(rest) + in_rest(r"\p{L}+")).alias("n"))
    sums = counts.groupBy("lang").agg(
        *[F.sum(F.col("n")[i]).alias(c) for i, c in enumerate(CLASSES)])
    chars = sum(F.col(c) for c in CLASSES)
    by_class = sums.where(chars > 0).select(
        "lang", F.array(*[F.col(c) / chars for c in CLASSES]).alias("classes"))
    counted = stage(known.select("lang", F.explode(F.split("text", BLANKS)).alias("word")).where(
        "word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total")).where(
        F.col("total") >= rules.min_reference_words)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counted.withColumn("rank", rank).where(
        F.col("rank") <= rules.common_words)
    by_word = top.join(totals, "lang").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct(
        "rank", "word", (F.col("n") / F.col("total")).alias("share")))).alias("words"))
    return by_class.join(by_word, "lang")


def js_divergence(pairs: Column) -> Column:
    """Jensen-Shannon divergence (base 2) of an array of (p, q) shares."""
    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    divergence = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + 0.5 * (
        part(x["p"], (x["p"] + x["q"]) / 2) + part(x["q"], (x["p"] + x["q"]) / 2)))
    return F.greatest(divergence, F.lit(0.0))


def js_distance(pairs: Column) -> Column:
    return F.sqrt(js_divergence(pairs))


def _class_pairs(profile: Column) -> Column:
    total = F.aggregate("_classes", F.lit(0).cast("long"), lambda a, x: a + x)
    return F.zip_with("_classes", profile["classes"], lambda n, q: F.struct(
        (n / F.greatest(total, F.lit(1))).alias("p"), q.alias("q")))


def _common_counts(profile: Column) -> Column:
    """Occurrences of each common word of a reference.

    Words are two spaces apart, so occurrences of ' word ' never overlap and removing
    them shortens the text by their bytes.
    """
    return F.transform(profile["words"], lambda w: (
        F.octet_length("_short") - F.octet_length(F.replace(
            F.col("_short"), F.concat(F.lit(" "), w["word"], F.lit(" ")), F.lit(""))))
        / (F.octet_length(w["word"]) + 2))


def _word_pairs(profile: Column, counts: Column) -> Column:
    """Share of each common word in the text and in the reference."""
    return F.zip_with(profile["words"], counts, lambda w, n: F.struct(
        (n / F.greatest(F.col("n_words"), F.lit(1))).alias("p"), w["share"].alias("q")))


def _with_rest(pairs: Column) -> Column:
    """The pairs and one for all other words."""
    rest = F.aggregate(pairs, F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("q")), lambda a, x: F.struct(
        (a["p"] - x["p"]).alias("p"), (a["q"] - x["q"]).alias("q")))
    return F.concat(pairs, F.transform(F.array(rest), lambda r: F.struct(
        F.greatest(r["p"], F.lit(0.0)).alias("p"), F.greatest(r["q"], F.lit(0.0)).alias("q"))))


def _limit(profile: Column, rules: Rules) -> Column:
    """The word distance that a text of n_words may have from a reference.

    The distance of a text drawn from the reference itself has the mean square
    bins / (8 n ln 2), which is added to the square of the share.
    """
    drawn = F.size(profile["words"]) / (8 * math.log(2) * F.greatest(F.col("n_words"), F.lit(1)))
    return F.sqrt(F.least(
        rules.most_word_share ** 2 * profile["most"],
        rules.word_share ** 2 * profile["most"] + drawn))


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents with their counts, distances, base_failed and kept added.

    ``word_excess`` is the word distance over its limit, for the nearest reference.
    """
    without = F.transform("words", lambda w: F.struct(F.lit(0.0).alias("p"), w["share"].alias("q")))
    refs = stage(references(docs, rules).withColumn("most", js_divergence(_with_rest(without))),
                 "language-references").select(
        F.col("lang").alias("_key"), F.struct("classes", "words", "most").alias("profile"))
    # One row a language, and one with all of them: as many rows as languages.
    every = refs.groupBy().agg(F.collect_list("profile").alias("_profiles")).select(
        F.lit(ANY).alias("_key"), "_profiles", F.lit(False).alias("_known"))
    profiles = refs.where(F.col("_key") != ANY).select(
        "_key", F.array("profile").alias("_profiles"), F.lit(True).alias("_known")
    ).unionByName(every)
    # Words in other slots are no common words; what else shares a slot is told by the search.
    taken = _taken(refs.select(F.explode("profile.words.word").alias("word")))
    known = small(profiles.where("_known").select(F.col("_key").alias("_lang"), "_known"), MANY)
    rows = docs.join(known, F.col("lang") == F.col("_lang"), "left").withColumn(
        "_key", F.when(F.col("_known"), F.col("lang")).otherwise(ANY)).drop("_known", "_lang")
    rows = base_counts(rows, taken).join(small(profiles.drop("_known"), MANY), "_key", "left")
    rows = rows.withColumn("_common", F.transform("_profiles", _common_counts)).withColumns({
        "class_distance": F.array_min(F.transform(
            "_profiles", lambda r: js_distance(_class_pairs(r)))),
        "_distances": F.transform(F.arrays_zip("_profiles", "_common"), lambda r: js_distance(
            _with_rest(_word_pairs(r["_profiles"], r["_common"])))),
    }).withColumns({
        "word_distance": F.array_min("_distances"),
        "word_excess": F.array_min(F.zip_with(
            "_distances", "_profiles", lambda d, r: d / _limit(r, rules))),
    })
    far = (
        ((F.col("word_chars") >= rules.min_chars)
         & (F.col("class_distance") > rules.max_class_distance))
        | ((F.col("n_words") >= rules.min_words)
           & (F.col("word_excess") > 1)))
    return (
        rows.withColumn("base_failed", (F.col("n_words") < rules.min_words) | (
            100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
        .withColumn("kept", _settled(~F.col("base_failed") & ~F.coalesce(far, F.lit(False))))
        .drop("_key", "_classes", "_short", "_profiles", "_common", "_distances"))


def keep(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their columns."""
    return judge(packed(docs, "lang", "text"), rules).where("kept").select("_row.*")
