"""Files of the document side: manifests, archives, binaries and measure exports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evenkeel.session import spread

# One entry of a manifest, as the listing describes a document.
MANIFEST_ENTRY = (
    "sdp_identifier string, state_name string, description string, pdf_url string, "
    "state_code string, payment_type string, provider_class string, review_type string, "
    "payment_type_normalised string, review_type_normalised string, "
    "rating_period_start string, rating_period_end string, identifier_suffix string, "
    "identifier_parsed boolean, identifier_issue string, identifier_repairs array<string>, "
    "content_sha256 string, retrieved_at string, fetch_provenance string, "
    "excluded_reason string")
ARCHIVE = (
    "sdp_identifier string, state_code string, state_name string, payment_type string, "
    "payment_type_normalised string, provider_class string, review_type string, "
    "review_type_normalised string, rating_period_start string, rating_period_end string, "
    "identifier_suffix string, description string, document_type string, "
    "form_template string, amount_cents bigint, amount_usd double, amount_source string, "
    "total_amount_cents bigint, total_amount_usd double, total_amount_raw string, "
    "federal_share_cents bigint, federal_share_raw string, nonfederal_share_cents bigint, "
    "nonfederal_share_raw string, grandfathered_cap_cents bigint, "
    "grandfathered_cap_usd double, letter_amount_cents bigint, letter_matched_phrase string, "
    "amount_is_publishable boolean, amount_unit_assumed boolean, amount_implausible boolean, "
    "amount_issue string, form_unit_assumed boolean, form_implausible boolean, "
    "cms_id_in_document string, identifier_mismatch string, cms_id_unusable string, "
    "identifier_repairs string, identifier_issue string, source_url string, "
    "source_sha256 string, retrieved_at string, excluded_reason string, "
    "extraction_version string")
READINESS = (
    "state_name string, dq_assessment string, reports_usably boolean, dq_assessment_year int")
STATE_ROW = "state string, dq_assessment string, reports_usably boolean"
TOPIC_MARKER = "Supplemental_Pmts"
HEADER_START = '"State"'


def read_manifest(spark: SparkSession, path: str, limit: int | None = None,
                  one_a_line: bool = False) -> DataFrame:
    """Entries of manifest files, with the retrieval time of their manifest.

    A file is one document and one task, or has a document on each line and is split.
    """
    schema = f"retrieved_at string, preprints array<struct<{_nested(MANIFEST_ENTRY)}>>"
    manifest = spark.read.schema(schema).option("multiLine", not one_a_line).json(path)
    entries = manifest.select(
        F.col("retrieved_at").alias("manifest_retrieved_at"),
        F.posexplode("preprints").alias("position", "entry"))
    rows = entries.select("manifest_retrieved_at", "position", "entry.*")
    return rows if limit is None else rows.orderBy("position").limit(limit)


def _nested(fields: str) -> str:
    return ", ".join(f.strip().replace(" ", ":", 1) for f in fields.split(", "))


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A published CSV with its declared types; nothing is inferred, an empty text is no text."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option(
        "multiLine", True).csv(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ARCHIVE)


def read_readiness(spark: SparkSession, path: str | None) -> DataFrame:
    """State assessments of a readiness document; none at all is a typed empty frame."""
    if path is None:
        return spark.createDataFrame([], READINESS)
    view = spark.read.schema(
        f"newest_year int, states array<struct<{_nested(STATE_ROW)}>>"
    ).option("multiLine", True).json(path)
    return view.select("newest_year", F.explode("states").alias("s")).select(
        F.col("s.state").alias("state_name"), "s.dq_assessment", "s.reports_usably",
        F.col("newest_year").alias("dq_assessment_year"))


BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def read_binaries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Document files with their content hash; a file that is no PDF is marked."""
    files = spark.read.format("binaryFile").load(path) if path else spark.createDataFrame([], BINARY)
    return files.select(
        "path", "length", F.sha2("content", 256).alias("content_sha256"),
        (F.substring("content", 1, 4) == F.lit("%PDF").cast("binary")).alias("is_pdf"))


NO_KEY = "__HIVE_DEFAULT_PARTITION__"  # stands for a null in a file's name


def _file_task(folder: str, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = fs.FileSystem.from_uri(folder)
        attempt, held, out, files = uuid.uuid4().hex, None, None, 0
        for batch in batches:
            for number, value in zip(batch.column("key").to_pylist(), batch.column("value")):
                if out is None or number != held:
                    if out is None:
                        target.create_dir(f"{root}/{attempt}", recursive=True)
                    else:
                        out.close()
                    name = NO_KEY if number is None else number
                    out = target.open_output_stream(f"{root}/{attempt}/{key}={name}", compression=None)
                    held, files = number, files + 1
                out.write(value.as_buffer())
                out.write(b"\n")
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"folder": pa.array([attempt]), "files": pa.array([files], pa.int64())})

    return run


def write_files(rows: DataFrame, folder: str, key: str, value: str) -> list[str]:
    """A file for each key, a number, with its texts as lines; the folders that hold them.

    Tasks write below a folder of their own attempt and report it, so files of lost attempts
    are in none of the folders returned, of which there is one a task. A committer would
    instead create, move and grant rights to a folder and a file for each key.
    """
    found = spread(rows.select(F.col(key).alias("key"), F.coalesce(value, F.lit("")).cast("binary").alias("value")),
                   "key").sortWithinPartitions("key", "value")
    found.mapInArrow(_file_task(f"{folder}/files", key), "folder string, files bigint").write.parquet(
        f"{folder}/written")
    written = rows.sparkSession.read.schema("folder string, files bigint").parquet(f"{folder}/written")
    return sorted(f"{folder}/files/{r['folder']}" for r in written.collect())


def read_measures(spark: SparkSession, path: str) -> DataFrame:
    """Measure exports: a CSV whose payload column holds JSON with a whole file."""
    return spark.read.schema("tafVersionId string, measureId string, payload string").option(
        "header", True).option("escape", '"').option("multiLine", True).csv(path)


def topic_files(measures: DataFrame, payload: str = "payload") -> DataFrame:
    """Files of the topic with their year; a payload that is not JSON is skipped."""
    parsed = F.from_json(payload, "fileName string, fileContent string", {"mode": "PERMISSIVE"})
    name = F.coalesce(F.col("p.fileName"), F.lit(""))
    return (
        measures.select(parsed.alias("p"))
        .where(F.contains(name, F.lit(TOPIC_MARKER)))
        .select(
            F.regexp_extract(name, r"_(\d{4})_", 1).try_cast("int").alias("year"),
            name.alias("file_name"),
            F.coalesce(F.col("p.fileContent"), F.lit("")).alias("content"))
        .where(F.col("year").isNotNull())
    )


def newest_file(files: DataFrame) -> DataFrame:
    """The file of the latest year. Only names compete; the content rides along."""
    return files.agg(F.max(F.struct("year", "file_name", "content")).alias("f")).select(
        "f.*").where(F.col("year").isNotNull())


# Quoted cells hold commas, doubled quotes and line ends. Every loop is possessive, so a cell
# of any length takes one pass and no stack; a quote that is never closed runs to the end.
_QUOTED = r'"(?:[^"]++|"")*+(?:"|\z)'
_RECORD = rf"(?:{_QUOTED}[^,\n]*+|[^,\n]*+)(?:,(?:{_QUOTED}[^,\n]*+|[^,\n]*+))*+"


def _records(text: Column) -> Column:
    """Records of a CSV text, each without its line ends; empty ones are left out."""
    found = F.regexp_extract_all(text, F.lit(_RECORD), F.lit(0))
    bare = F.transform(found, lambda r: F.rtrim(F.replace(F.replace(r, F.lit("\r")), F.lit("\n"))))
    return F.filter(bare, lambda r: r != "")


def _cells(line: Column) -> Column:
    """Cells of one record, quotes removed."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(
        r',("(?:[^"]++|"")*+"|[^,]*+)'), F.lit(1))

    def bare(cell: Column) -> Column:
        inner = F.substring(cell, F.lit(2), F.greatest(F.length(cell) - 2, F.lit(0)))
        return F.when(F.startswith(cell, F.lit('"')), F.replace(inner, F.lit('""'), F.lit('"'))
                      ).otherwise(cell)

    return F.transform(cells, bare)


def topic_rows(files: DataFrame) -> DataFrame:
    """Rows below the real header line, as cells beside the header that names them.

    Title lines precede the header; quotes in them open no cell. A file without a header
    has no rows. The lines of a quoted cell are joined as they stand, blank ones dropped.
    """
    start = F.instr(F.concat(F.lit("\n"), F.col("content")), F.lit("\n" + HEADER_START))
    rows = (
        files.withColumn("start", start)
        .where(F.col("start") > 0)
        .withColumn("records", _records(F.regexp_replace(
            F.expr("substring(content, start)"), r"\n\s*(?=\n)", "")))
        .withColumn("header", _cells(F.get("records", F.lit(0))))
        .select("year", "file_name", "header", F.explode(F.slice(
            F.col("records"), F.lit(2), F.greatest(F.size("records") - 1, F.lit(0)))).alias("line"))
        .withColumn("cells", _cells(F.col("line")))
    )
    return rows.select("year", "file_name", "header", "cells")


def cell(name: str) -> Column:
    """Value of a named column in a topic row; NULL when the file has no such column."""
    return F.get("cells", F.array_position("header", name).cast("int") - 1)


def write_csv(df: DataFrame, path: str, *order: str) -> None:
    """CSV files; with an order, sorted within and from one file to the next."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
