"""Small document tables with the cases every operator has to bear."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

VOCABULARY = ("the of and to in is that river stone market letter window garden paper bridge winter "
              "music doctor silver station report village summer engine teacher question").split()


def words(draw: random.Random, n: int) -> str:
    return " ".join(draw.choices(VOCABULARY, k=n))


def table(spark, rows, extra=False):
    """rows of (doc_id, text, lang, source); extra adds columns with names of the operators'."""
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], DOCS)
    if extra:
        from pyspark.sql import functions as F
        for name in ("kept", "size", "copies", "_digest", "code", "n_words", "block", "Component_ID"):
            df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def awkward(draw: random.Random):
    """Nulls, blanks, ties, repeated rows, null ids and one very long text."""
    one, long_text = words(draw, 120), words(draw, 60_000)
    return [
        (1, one, "en", "a"), (2, one, "en", "b"), (2, one, "en", "b"), (3, None, None, None),
        (4, "", "en", "a"), (5, " \t\n ", None, "a"), (None, one, "en", "a"),
        (None, words(draw, 80), "xx", None), (6, long_text, "en", "c"), (7, long_text + " tail", "en", "a"),
        (8, "short text", "en", "b"), (8, words(draw, 90), "en", "b"), (9, "漢字 é x😀".encode(
            "utf-16", "surrogatepass").decode("utf-16"), "zh", "c"),
    ]
