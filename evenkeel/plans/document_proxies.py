"""Document inputs derived from a star schema of orders.

Every order files a document. Its control name, its letter, its form answers and
the identifier inside it are written from the order's own attributes, with the
irregularities that published names and answers have. A name filed by several
orders is one document, as a listing that repeats a name is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions import letters
from evenkeel.functions.identifiers import with_parsed_identifier
from evenkeel.operators import archive, extracts
from evenkeel.plans.proxies import cents, orders_by_customer, read
from evenkeel.session import spread
from evenkeel.sources import documents, listing

RETRIEVED = "2001-09-01T00:00:00Z"
ANSWERS_IN_OTHER_FORMS = 13


def _choose(key: Column, cases: dict, otherwise: Column) -> Column:
    chosen = otherwise
    for value, result in cases.items():
        chosen = F.when(key == value, result if isinstance(result, Column) else F.lit(result)
                        ).otherwise(chosen)
    return chosen


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the texts of its document."""
    region = read(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name")
    day, year = F.dayofmonth("order_date"), F.year("order_date").cast("string")
    key = F.col("o_orderkey").cast("string")
    base = orders_by_customer(spark, sf_dir).join(region, "n_regionkey").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_name", "n_name", "order_date",
        "o_totalprice", year.alias("y"), day.alias("day"), F.month("order_date").alias("m"),
        (F.dayofweek("order_date") - 1).alias("w"), cents("o_totalprice").alias("c"),
        F.upper(F.substring("r_name", 1, 2)).alias("st"),
        _choose(F.col("o_orderpriority"), {
            "1-URGENT": "Fee", "2-HIGH": "VBP", "3-MEDIUM": "Fee.VBP",
            "4-NOT SPECIFIED": "VBP.fee"}, F.lit("FEE")).alias("pay"),
        _choose(F.col("c_mktsegment"), {
            "AUTOMOBILE": "IPH.OPH1", "BUILDING": "IPH_OPH", "FURNITURE": "NF2",
            "HOUSEHOLD": "BHO"}, _text("HCBS", F.col("c_nationkey").cast("string"))).alias("cls"),
        F.when(F.col("o_orderstatus") == "F", "Renewal").when(
            F.col("o_orderstatus") == "P", "New").otherwise(_choose(
                F.quarter("order_date"), {1: "Amend", 2: "Amend1", 3: "Amend2"},
                F.lit("Amendment"))).alias("rev"))
    # A file may be one scan task; texts are written and parsed by as many as there are cores.
    base = spread(base, "o_orderkey")
    st, pay, cls, rev, y = (F.col(n) for n in ("st", "pay", "cls", "rev", "y"))
    dates = _text(y, "0101-", y, "1231")
    named = _text(st, "_", pay, "_", cls, "_", rev, "_")
    standard = _text(named, dates)
    dashed = F.replace(cls, F.lit("_"), F.lit("-"))
    following = (y.cast("int") + 1).cast("string")
    swapped = _text(named, "0101", y, "-1231", y)
    identifier = _choose(F.col("day"), {
        1: swapped, 2: swapped,
        20: _text(named, " ", y, "0101 - ", y, "1231"),
        21: _text(st, "-VBP-Fee-", dashed, "-", rev, "-", dates),
        22: _text(st, "_Fee.IPH.OPH5_", rev, "_", dates),
        23: _text(st, "_Proposal ", cls, " ", y, "_", rev),
        24: _text(F.lower(st), "_", pay, "_", cls, "_", rev, "_", dates),
        25: _text(standard, " ", F.col("c_name")),
        26: _text("\\", standard),
        27: _text(st, "_", pay, "_", cls, "_", dates),
        28: _text(st, "-", pay, "-", dashed, "-", rev, "-", dates),
        29: _text(named, y, "-", following),
        30: _text(named, y, "0101-", y, "123"),
        31: _text(named, y, "10101-", y, "1231"),
    }, standard)
    named_rows = base.withColumn("standard", standard).withColumn("sdp_identifier", identifier)

    c = F.col("c")
    whole, thousands = F.expr("c div 100"), F.expr("c div 100000")
    tail = F.lpad((c % 100).cast("string"), 2, "0")
    money = _text("$", F.format_number("o_totalprice", 2))
    total = F.when(
        F.col("o_orderpriority") == "5-LOW", _text("$", whole.cast("string"), ".5M")
    ).otherwise(_choose(F.col("w"), {
        0: money,
        1: _text("Approximately $", thousands.cast("string"), ".", (c % 10).cast("string"),
                 " million"),
        2: _text(whole.cast("string"), ".", tail),
        3: "",
        4: _text("$1.", F.lpad(c.cast("string"), 9, "0"), " thousand"),
        5: "see attachment",
    }, _text("$", whole.cast("string"), " (including fees)")))
    standard_name, own = F.col("standard"), F.col("sdp_identifier")
    earlier = _text(st, "_", pay, "_", cls, "_", rev, "_",
                    (y.cast("int") - 1).cast("string"), "0101-",
                    (y.cast("int") - 1).cast("string"), "1231")
    stated = _choose(F.col("w"), {
        0: own, 1: earlier, 2: "C", 3: " ",
        4: F.replace(F.replace(own, F.lit("IPH"), F.lit("IP")), F.lit("OPH"), F.lit("OP")),
        5: _text(st, "_Fee_BHO_Amend_", dates, " /", own),
    }, _text("Note (", standard_name, "), it's"))
    scaled = _text("$", thousands.cast("string"), " thousand")
    letter = _choose(F.col("m"), {
        1: _text("This proposal is approved: a separate payment term of up to ", money, "."),
        2: _text("It is approved through a risk-based rate\n adjustment of up to ", scaled,
                 ". The state asked for a total dollar amount of ", money),
        3: "The proposal is approved. No figure is stated.",
        4: _text("The phase-down begins; payments are not to exceed ", money),
        5: "SECTION I: State information, for example $4 per claim, not to exceed $5",
        6: _text("It is approved. Costs were $5,000 and ", money),
        7: _text("The payment term for this state directed payment is $",
                 thousands.cast("string"), ".5 million"),
        8: "A grandfathered SDP with a total amount of $0",
        9: _text("is approved in an amount of up to ", money, "; total amount of $7"),
    }, _text("is approved: Separate  Payment\n Term amount ", money))
    others = {f"f{i}": "x" for i in range(ANSWERS_IN_OTHER_FORMS)}
    question = "Total amounts transferred by this entity and the date of the transfer"

    def fields(**answers) -> Column:
        items = [v if isinstance(v, Column) else F.lit(v) for kv in answers.items() for v in kv]
        return F.create_map(*items)

    partial, priority = F.col("o_orderstatus") == "P", F.col("o_orderpriority")
    form = (
        F.when(partial & (priority == "4-NOT SPECIFIED"), fields(f1="x"))
        .when(partial & (priority == "3-MEDIUM"), fields(**{**others, question: "x"}))
        .when(partial & (priority == "2-HIGH"), fields(**others))
        .otherwise(fields(**{
            "0.1-State": st, "0.2-CMS ID": stated, "4-Text": total,
            "4.a-Text": _text("$", F.expr("c div 200").cast("string")),
            "4.b-Text": "unknown"}))
    )
    folder = F.when(F.col("o_orderpriority") == "1-URGENT", "/media/file/").otherwise(
        "/medicaid/managed-care/downloads/")
    return named_rows.select(
        "o_orderkey", F.col("y").cast("int").alias("page"), "sdp_identifier",
        F.col("n_name").alias("state_name"), _text("Order of ", F.col("c_name")).alias("description"),
        _text(listing.BASE, folder, key, ".pdf").alias("pdf_url"),
        F.sha2(key, 256).alias("content_sha256"),
        F.when(partial, F.col("order_date").cast("string")).alias("retrieved_at"),
        F.array(letter, F.lit("Page two"), F.col("c_name")).alias("pages"),
        F.map_entries(form).alias("answers"))


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per name: the earliest page, and the last filing on it."""
    rows = listing.keyed_union(filings(spark, sf_dir), "sdp_identifier", "page", "o_orderkey")
    return rows.withColumn("fields", F.map_from_entries("answers")).drop("answers")


def manifest(listed_rows: DataFrame) -> DataFrame:
    described = listed_rows.drop("pages", "fields", "page", "o_orderkey")
    return (
        with_parsed_identifier(described, "sdp_identifier")
        .withColumn("excluded_reason", listing.exclusion_reason(F.col("pdf_url")))
        .withColumn("manifest_retrieved_at", F.lit(RETRIEVED))
    )


def records(listed_rows: DataFrame) -> DataFrame:
    """Readings of the documents that could be fetched."""
    fetched = listed_rows.where(listing.exclusion_reason(F.col("pdf_url")).isNull())
    return archive.extraction_records(
        fetched.select("sdp_identifier", "pages", "fields", F.col("o_orderkey").alias("position")),
        "sdp_identifier", "pages", "fields", reach=letters.PUBLISHED)


def archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listed(spark, sf_dir)
    return archive.archive_rows(manifest(rows), records(rows))


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic files per order year, written as text from yearly sums per nation.

    A file lists one line per nation, so its text is bounded by that dimension.
    """
    orders = orders_by_customer(spark, sf_dir)
    per_state = orders.groupBy(F.year("order_date").alias("y"), "n_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("p"))
    grade = F.when(F.col("p") * 4 < F.col("n"), "Low concern").when(
        F.col("p") * 3 < F.col("n"), "Medium concern").otherwise("Unclassified")
    # A cell with a comma, quotes and a broken line, which a reader must not take for rows.
    note = _text(F.col("n_name"), ', ""', F.col("n").cast("string"), '"" records\r\n\n"",""', grade, '""')
    line = _text('"', F.col("n_name"), '","', F.col("y").cast("string"), '","', note, '","', grade, '","',
                 F.format_number("n", 0), '","', F.col("p").cast("string"), '"')
    header = ('"Title: Explore by Topic",,,\n\n"State","Data Year","Note","DQ Assessment",'
              '"# Supplemental Payment Records",'
              '"% Supplemental Payment Records with Missing or Zero Payment"\n')
    content = F.concat(F.lit(header), F.array_join(F.array_sort(F.collect_list(line)), "\n"))
    return per_state.groupBy("y").agg(content.alias("content")).select(
        F.to_json(F.struct(
            _text("TAF_DQ_Supplemental_Pmts_", F.col("y").cast("string"), "_Release_1.csv")
            .alias("fileName"), F.col("content").alias("fileContent"))).alias("payload"))


def assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = documents.topic_files(measures(spark, sf_dir))
    return extracts.assessed_states(documents.topic_rows(documents.newest_file(files)))


def readiness_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assessments as the extract reads them back."""
    return assessed(spark, sf_dir).select(
        F.col("state").alias("state_name"), "dq_assessment", "reports_usably",
        F.col("newest_year").alias("dq_assessment_year"))


def letters_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts as letters: the whole text, with what their source states."""
    n = F.col("n_chars")
    money = _text("$", F.format_number(n, 0))
    source, text = F.col("source"), F.col("text")
    body = _choose(source, {
        "src0": _text(text, "\nA separate payment term of up to ", money, "."),
        "src1": _text("It is approved, not to exceed ", money, ". ", text,
                      " The total amount of $12.5 million."),
        "src2": _text(text, " Public Law 119-21: not to exceed $", n.cast("string"), " thousand"),
        "src3": _text("SECTION I ", text, " total amount of $9"),
        "src4": _text(text, " is approved. Risk  based\tadjustment of $", n.cast("string"), ".257"),
        "src5": _text(text, " was $3 or ", money),
    }, text)
    rows = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    return spread(rows, "doc_id").select("doc_id", F.array(body).alias("pages"))
