"""Language identification, words first, then ever shorter character n-grams.

A word that was seen in training scores its log frequency in each language. One
that was not is read from left to right: at each place the longest known n-gram
counts, by its log frequency among the n-grams of its length.

Training reads a sample of the labelled rows: about ``docs_per_language`` of each
language, chosen by a digest of the id, or of the text where the id is null. Counts are made by Spark and the tables
hold ``entries`` rows over all languages, so the model has a fixed size.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so
is every text if nothing was learned. Equal scores go to the first language in
code-point order. Repeated rows each get a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from evenkeel.llm.common import sampled

UNKNOWN = "und"
WORDS = regex.compile(r"[\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Training:
    docs_per_language: int = 5_000
    entries: int = 40_000    # words, and n-grams, of each language
    longest: int = 5         # characters of an n-gram
    smoothing: float = 0.5


@dataclass(frozen=True)
class Model:
    languages: list[str]
    words: dict[str, int]          # row in word_scores
    word_scores: np.ndarray        # log frequency by row and language
    grams: dict[str, int]
    gram_scores: np.ndarray
    longest: int


def _top(counts: DataFrame, key: str, entries: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("n"), key)
    return counts.withColumn("_rank", F.row_number().over(order)).where(
        F.col("_rank") <= entries).drop("_rank")


def _scores(counts: pd.DataFrame, key: list[str], languages: list[str], smoothing: float):
    """Rows by key, and log frequencies within the rows that share key[1:]."""
    if counts.empty:
        return {}, np.zeros((0, len(languages)), np.float32)
    wide = counts.pivot_table(index=key, columns="lang", values="n", aggfunc="sum", fill_value=0)
    wide = wide.reindex(columns=languages, fill_value=0)
    values = wide.to_numpy(np.float64) + smoothing
    if len(key) > 1:
        groups = wide.index.get_level_values(1).to_numpy()
        for g in np.unique(groups):
            values[groups == g] /= values[groups == g].sum(axis=0)
        names = wide.index.get_level_values(0)
    else:
        values /= values.sum(axis=0)
        names = wide.index
    return {w: i for i, w in enumerate(names)}, np.log(values).astype(np.float32)


def train(rows: DataFrame, how: Training = Training()) -> Model | None:
    """A model from rows (doc_id, text, lang); None if they have no language."""
    rows = rows.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (
        lang, min(1.0, how.docs_per_language / sizes[lang]))])
    chosen = rows.where(sampled(
        F.col("doc_id"), shares[F.col("lang")], F.col("text"))).select(
        "lang", F.explode(F.split(F.regexp_replace(
            F.lower("text"), r"[^\p{L}\p{M}]+", " "), " ")).alias("word")).where("word <> ''")
    counts = chosen.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).persist()
    words = _top(counts, "word", how.entries).toPandas()
    padded = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    places = F.sequence(F.lit(1), F.char_length(padded))
    grams = counts.select("lang", "n", padded.alias("word"), F.explode(places).alias("at")).select(
        "lang", "n", "word", "at",
        F.explode(F.sequence(F.lit(1), F.lit(how.longest))).alias("size"),
    ).where("at + size - 1 <= char_length(word)").select(
        "lang", "n", "size", F.expr("substring(word, at, size)").alias("gram"))
    grams = grams.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).where("n > 1")
    grams = _top(grams, "gram", how.entries).toPandas()
    counts.unpersist()
    known, word_scores = _scores(words, ["word"], languages, how.smoothing)
    pieces, gram_scores = _scores(grams, ["gram", "size"], languages, how.smoothing)
    return Model(languages, known, word_scores, pieces, gram_scores, how.longest)


class Scorer:
    """Word scores with those of unseen words kept for reuse."""

    KEPT = 100_000

    def __init__(self, model: Model):
        self.model, self.base = model, len(model.words)
        self.table = np.concatenate([model.word_scores, np.zeros(
            (self.KEPT, len(model.languages)), np.float32)])
        self.unseen: dict[str, int] = {}

    def _spell(self, word: str) -> np.ndarray:
        """Score of an unseen word from the longest known n-gram at each place."""
        model, padded = self.model, f"<{word}>"
        found = []
        for at in range(len(padded)):
            for size in range(min(model.longest, len(padded) - at), 0, -1):
                row = model.grams.get(padded[at:at + size])
                if row is not None:
                    found.append(row)
                    break
        if not found:
            return np.zeros(len(model.languages), np.float32)
        return model.gram_scores[found].sum(axis=0) / model.longest

    def _row(self, word: str) -> int:
        row = self.unseen.get(word)
        if row is None:
            row = self.base + len(self.unseen)
            self.table[row] = self._spell(word)
            self.unseen[word] = row
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.model.languages or not LETTER.search(text):
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.languages), np.float64)
        known, words = self.model.words.get, WORDS.findall(text.lower())
        for i in range(0, len(words), self.KEPT // 2):
            if len(self.unseen) > self.KEPT // 2:
                self.unseen = {}
            rows = [r if (r := known(w)) is not None else self._row(w)
                    for w in words[i:i + self.KEPT // 2]]
            total += self.table[rows].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def _predictor(shipped: Broadcast):
    @pandas_udf("struct<lang_pred:string,score:double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shipped.value)
        for texts in batches:
            yield pd.DataFrame([scorer.predict(t) for t in texts], columns=["lang_pred", "score"])

    return run


def predict(text: Column, model: Model | None, df: DataFrame) -> Column:
    """struct(lang_pred, score) of a text of the frame."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return _predictor(df.sparkSession.sparkContext.broadcast(model))(text)
