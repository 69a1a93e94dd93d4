"""Column helpers that several operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these ASCII blanks; Java, RE2 and Python read both patterns alike.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and the whole row as ``_row``.

    So no column that an operator adds can meet one of the same name.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *needed)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public tokenizer's vocabulary lies, on the driver and the executors alike."""
    return public_tokenizers.path(name)


def words(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def small(df: DataFrame, most: int) -> DataFrame:
    """The frame with a broadcast hint if it has at most so many rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def word_blocks(text: str | None, lower: bool = False, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text as UTF-8, in lists from pieces of about so many bytes.

    ``bytes.split`` parts at the ASCII blanks and at nothing else, and ``bytes.lower``
    changes A to Z only. A piece ends at a
    blank, so that no word is cut and memory does not grow with the text.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    start = 0
    while start < len(raw):
        blank = _BLANK.search(raw, start + size)
        stop = blank.end() if blank else len(raw)
        piece = raw[start:stop]
        yield (piece.lower() if lower else piece).split()
        start = stop


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(
        F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def sampled(doc_id: Column, share: Column, text: Column | None = None) -> Column:
    """A repeatable choice of about the given share of the ids; null ids go by the text, if given."""
    digest = F.xxhash64(F.lit("sample"), doc_id)
    if text is not None:
        digest = F.when(doc_id.isNull(), F.xxhash64(F.lit("sample"), text)).otherwise(digest)
    return F.pmod(digest, F.lit(1 << 20)) < share * (1 << 20)
