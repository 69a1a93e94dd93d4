"""A run of the pipeline against plain Python and SQL, stage by stage."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from evenkeel.llm import decontaminate, oracle
from evenkeel.llm.common import table, tokenizer_path
from tests.llm import rows
from tests.llm.test_shingles import near
from tests.llm.test_simhash import brute_code, brute_groups

SMALL = "/root/testdata/sf0.001"


def least_edits(item, text):
    """Least edits of the item anywhere in the text, row by row over the whole matrix."""
    d = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, x in enumerate(item.tolist(), 1):
        new = np.r_[i, np.minimum(row[1:] + 1, row[:-1] + (text != x))]
        row = np.minimum.accumulate(new - d) + d
    return int(row.min())


def survivors(docs, benchmark):
    con = duckdb.connect()
    con.register("documents", docs)
    kept = {r[0] for r in con.sql(
        f"SELECT doc_id FROM ({oracle.STATEMENTS['op5_distribution_divergence']}) WHERE kept").fetchall()}
    docs = docs[docs.doc_id.isin(kept)].sort_values("doc_id")
    groups = brute_groups([brute_code(t) for t in docs.text])
    docs = docs[[g == i for i, g in enumerate(groups)]]
    # Of these, a text goes that is 0.8 alike to an earlier one, by whole sets of five-word shingles.
    stays = []
    for doc_id, text in zip(docs.doc_id, docs.text):
        if not any(near(text, other) for _, other in stays):
            stays.append((doc_id, text))
    docs = docs[docs.doc_id.isin([i for i, _ in stays])]
    how = decontaminate.Matching()
    items = [(x[1], x[3]) for x in decontaminate.Items(benchmark, how).items]
    texts = [decontaminate.Normal(t).points for t in docs.text]
    return docs[[all(least_edits(i, t) > most for i, most in items) for t in texts]]


def test_run_equals_brute_force(spark):
    docs = table(spark, SMALL, "documents").toPandas()
    benchmark = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
    left = survivors(docs, benchmark)
    assert 0 < len(left) < len(docs)
    con = duckdb.connect()
    con.register("documents", left)
    taken = con.sql(oracle.STATEMENTS["op4_min_cost_mix"]).df()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    text, want, at = dict(zip(left.doc_id, left.text)), [], 0
    for r in taken.sort_values("doc_id").itertuples():
        ids = np.array(tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids + [0], "<u4")
        for _ in range(r.taken // r.size):
            want.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()), key=lambda r: r[1])
    assert got == want


def test_names_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "benchmark decontamination", "mixing to target weights",
        "token-ID files"]
    docs = rows.table(spark, [(i, rows.words(random.Random(i), 120), "en", "a")
                              for i in range(20)], extra=True)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SMALL).columns == docs.columns


@pytest.mark.parametrize("position", range(5))
def test_stages_bear_an_empty_table(spark, position):
    step = corpus_pipeline.STAGES[position][1]
    assert step(spark, rows.table(spark, [], extra=True), SMALL).count() == 0
