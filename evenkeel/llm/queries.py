"""One registered query for each operator, over its whole table, and their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.llm import (
    conversation_trie, decontaminate, extraction, language, mixing, oracle, personal_data, quality,
    simhash, substrings, token_alignment, token_files, toxicity, warc)
from evenkeel.llm.common import held_out, table, tokenizer_path
from evenkeel.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_gray_order_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def op2_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion record of every page's response record."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.derive(warc.responses(pages)).drop("record")


def op4_min_cost_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document; a document has one source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, F.array("source"))
    return mixed.select(
        "doc_id", "size", F.col("per_source")[0]["source_size"].alias("source_size"),
        F.col("per_source")[0]["target"].alias("target"), "taken")


def op5_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of every document and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op6_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_passages(docs, with_text=False).drop("kept")


def op7_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs.where(~out), table(spark, sf_dir, "labels").where(~out))
    return docs.select(
        "doc_id", out.alias("held_out"), toxicity.score(F.col("text"), model, docs).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, as read back from the files."""
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), folder,
                      tokenizer_path())
    return token_files.read(spark, folder, with_ids=False).drop("ids")


def op9_tree_model_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extraction.main_text(F.col("html"), extraction.train(), pages)
    return pages.select("page_id", "url", found.alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def op10_word_first_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs.where(~out))
    return docs.select("doc_id", out.alias("held_out"), language.predict(
        F.col("text"), model, docs).alias("_found")).select(
        "doc_id", "held_out", "_found.lang_pred", "_found.score")


def personal_data_of(docs: DataFrame) -> DataFrame:
    """Numbers and digest of the base spans of every document, and all its spans as a string."""
    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["base"])
    return personal_data.find(docs).select(
        "doc_id", *map(number, personal_data.KINDS),
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op11_weakly_supervised_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: exact rules, and what a weakly supervised classifier adds."""
    return personal_data_of(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the two tokenizations of every document are linked, and how often the pairs are corpus-wide."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))[0]


def rebuilt(turns: DataFrame) -> DataFrame:
    """Digested turns of conversations that begin as the first one of their hundred does.

    Conversation c has the first h turns of conversation c - c % 100, and then its own
    without its first h; h is crc32 of the decimal id, modulo 6.
    """
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    ranked = turns.withColumn("place", F.row_number().over(
        Window.partitionBy("conv_id").orderBy(*order)).cast("long"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    own = ranked.where(F.col("place") > taken)
    heads = ranked.where((F.pmod("conv_id", F.lit(100)) == 0) & (F.col("place") < 6)).withColumnRenamed(
        "conv_id", "base")
    begun = turns.select("conv_id").distinct().withColumn(
        "base", F.col("conv_id") - F.pmod("conv_id", F.lit(100))).join(heads, "base").where(
        F.col("place") <= taken)
    columns = ["conv_id", F.col("place").alias("turn"), "role", "digest", "chars"]
    return own.select(*columns).unionByName(begun.select(*columns))


def prefix_trie(turns: DataFrame) -> DataFrame:
    digested = conversation_trie.digested(turns)
    tree, ends = conversation_trie.trie(rebuilt(digested), digested.select("conv_id"))
    hashed = conversation_trie.ends_digests(ends)
    return tree.join(hashed, "node", "left").fillna(conversation_trie.NO_TURNS, ["ends_sha256"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_gray_order_simhash,
        op2_qgram_decontamination,
        op3_warc_derivatives,
        op4_min_cost_mix,
        op5_distribution_divergence,
        op6_suffix_automata,
        op7_factorization_machine,
        op8_seekable_token_files,
        op9_tree_model_extraction,
        op10_word_first_language,
        op11_weakly_supervised_pii,
        op12_token_alignment,
        op13_conversation_trie,
    )}


def statements() -> dict[str, str]:
    return oracle.STATEMENTS
