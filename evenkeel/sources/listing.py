"""Listing pages to one record per advertised document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.text import text_lines

# The label each record starts with and the links that count.
LABEL = "SDP Identifier:"
HREF = r'href="((?:/medicaid/managed-care/downloads|/media/file)/[^"]*\.pdf)"'
BASE = "https://www.medicaid.gov"
DISALLOWED = ("/media/",)
EXCLUDED_NOTE = "medicaid.gov/robots.txt disallows /media/*"

_SCRIPTS = r"(?is)<script.*?</script>|<style.*?</style>"


def listing_records(
    pages: DataFrame, page: str, html: str, label: str = LABEL, href: str = HREF, base: str = BASE
) -> DataFrame:
    """Records of each page, in page order, with their text lines.

    A block without a matching link is not a record. Label and link pattern are
    parameters, because they are what a listing is recognised by.
    """
    cleaned = F.regexp_replace(html, _SCRIPTS, "")
    quoted = r"\Q" + label + r"\E"
    blocks = pages.select(page, F.posexplode(F.split(cleaned, quoted)).alias("position", "block"))
    link = F.regexp_extract("block", f"(?i){href}", 1)
    lines = blocks.where(F.col("position") > 0).withColumn("link", link).where(
        F.col("link") != "").withColumn("lines", text_lines(F.col("block")))

    def line(index: int) -> Column:
        return F.coalesce(F.get("lines", F.lit(index)), F.lit(""))

    return lines.where(F.size("lines") > 0).select(
        page, "position", line(0).alias("sdp_identifier"), line(1).alias("state_name"),
        line(2).alias("description"), F.concat(F.lit(base), F.col("link")).alias("pdf_url"))


def keyed_union(records: DataFrame, key: str, page: str, position: str) -> DataFrame:
    """One record per key: the first page wins, and on that page the last record.

    An aggregation, not a window, so a key repeated on very many pages is reduced
    where it is read.
    """
    rest = [c for c in records.columns if c not in (key, page, position)]
    best = F.min(F.struct(F.col(page), (-F.col(position)).alias("__back"), *rest))
    return records.groupBy(key).agg(best.alias("r")).select(
        key, F.col(f"r.{page}").alias(page), (-F.col("r.__back")).alias(position),
        *[F.col(f"r.{c}").alias(c) for c in rest])


def file_key(identifier: Column) -> Column:
    """Stable file name of a document: the identifier itself may hold any character."""
    return F.substring(F.sha2(F.encode(identifier, "UTF-8"), 256), 1, 24)


def exclusion_reason(url: Column, base: str = BASE) -> Column:
    """Why a document is listed but not fetched; the row stays."""
    path = F.replace(url, F.lit(base), F.lit(""))
    disallowed = F.lit(False)
    for prefix in DISALLOWED:
        disallowed = disallowed | F.startswith(path, F.lit(prefix))
    return F.when(disallowed, EXCLUDED_NOTE)
