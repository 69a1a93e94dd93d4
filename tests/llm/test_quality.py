import random

import duckdb
import pytest

from evenkeel.llm import oracle, quality
from evenkeel.llm.common import table
from tests.llm import rows


def compare(spark, made):
    docs = rows.table(spark, made)
    got = sorted((tuple(r) for r in quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept").collect()), key=str)
    con = duckdb.connect()
    con.register("given", docs.toPandas().astype({"text": "object"}))
    con.sql("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text, "
            "CAST(lang AS VARCHAR) AS lang FROM given")
    want = sorted(con.sql(oracle.STATEMENTS["op5_distribution_divergence"]).fetchall(), key=str)
    assert got == want
    return got


def test_counts_and_verdicts_equal_sql(spark):
    draw = random.Random(9)
    made = rows.awkward(draw)
    for i in range(100, 180):
        text = rows.words(draw, draw.randint(0, 300))
        if i % 9 == 0:
            text = text.upper().replace(" ", "!! ")
        if i % 7 == 0:
            text = "\n".join([text[:50]] * 6)
        if i % 5 == 0:
            text = " ".join(f"{w}$#" for w in text.split())
        made.append((i, text, draw.choice(("en", "en", "de", None)), "a"))
    got = compare(spark, made)
    assert {r[-1] for r in got} == {True, False}


def test_repeated_windows_by_hand(spark):
    docs = rows.table(spark, [(1, "a b c d a b c x", "en", "a"), (2, "a a a a", "en", "a"),
                              (3, "a b\na b\n\na b \n c", "en", "a"), (4, "x y z", "en", "a")])
    found = {r["doc_id"]: r for r in quality.base_counts(docs).collect()}
    assert found[1]["n_repeat_words"] == 6 and found[2]["n_repeat_words"] == 4
    assert found[4]["n_repeat_words"] == 0
    assert found[3]["n_dup_lines"] == 1 and found[3]["n_words"] == 7 and found[3]["word_chars"] == 7


def test_other_language_and_other_characters_are_far(spark):
    draw = random.Random(2)
    other = "zq vx kj wy qz xv jk".split()
    made = [(i, rows.words(draw, 200), "en", "a") for i in range(40)]
    made.append((50, " ".join(draw.choices(other, k=200)), "en", "a"))
    made.append((51, rows.words(draw, 200).upper(), "en", "a"))
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(rows.table(spark, made)).collect()}
    assert all(kept[i] for i in range(40)) and not kept[50] and not kept[51]


def test_keep_returns_the_columns(spark):
    made = rows.awkward(random.Random(3))
    docs = rows.table(spark, made, extra=True)
    left = quality.keep(docs)
    assert left.columns == docs.columns
    judged = quality.judge(rows.table(spark, made)).where("kept").count()
    assert left.count() == judged > 0
    assert {r["kept"] for r in left.collect()} == {"own kept"}


@pytest.mark.parametrize("rows_", [[], [(1, None, None, None)]])
def test_empty(spark, rows_):
    docs = rows.table(spark, rows_)
    assert [(r["n_words"], r["kept"]) for r in quality.judge(docs).collect()] == [(0, False)] * len(rows_)


def test_no_python_in_the_plan(spark):
    docs = rows.table(spark, [(1, "a b c", "en", "a")])
    plan = quality.keep(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_gibberish_and_other_languages_are_rejected_clean_texts_are_not(spark):
    given = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    draw = random.Random(5)
    kept = [r for r in quality.judge(given).where("kept").collect()]
    assert len(kept) > 0.7 * given.count()
    langs = sorted({r["lang"] for r in kept})
    odd = [(10_000 + i, " ".join("".join(draw.choices("bcdfghjklmnpqrstvwxz", k=draw.randint(2, 9)))
                                 for _ in range(200)), langs[i % len(langs)]) for i in range(20)]
    moved = [(20_000 + i, r["text"], langs[(langs.index(r["lang"]) + 1 + i % (len(langs) - 1)) % len(langs)])
             for i, r in enumerate(draw.sample(kept, 60))]
    more = given.unionByName(spark.createDataFrame(odd + moved, "doc_id long, text string, lang string"))
    found = {r["doc_id"]: r["kept"] for r in quality.judge(more).select("doc_id", "kept").collect()}
    assert not any(found[r[0]] for r in odd)
    assert sum(found[r[0]] for r in moved) <= 0.05 * len(moved)
    assert sum(not found[r["doc_id"]] for r in kept) <= 2
