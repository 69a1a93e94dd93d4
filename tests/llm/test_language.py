import random

from pyspark.sql import functions as F

from evenkeel.llm import language
from evenkeel.llm.common import held_out, table
from tests.llm import rows

SMALL = "/root/testdata/sf0.01"


def predicted(docs, model):
    return [tuple(r) for r in docs.select(
        "doc_id", language.predict(F.col("text"), model, docs).alias("p")).select("doc_id", "p.*").collect()]


def test_held_out_accuracy(spark):
    docs = table(spark, SMALL, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs.where(~out))
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    found = predicted(docs.where(out), model)
    assert sum(truth[i] == lang for i, lang, _ in found) >= 0.98 * len(found)
    assert all(0 <= s <= 1 for *_, s in found)


def test_unseen_words_fall_back_to_ngrams(spark):
    made = [(1, "walking talking singing ringing", "en", "a"), (2, "marcher parler chanter sonner", "fr", "a")]
    model = language.train(rows.table(spark, made * 3))
    scorer = language.Scorer(model)
    assert scorer.predict("flinging")[0] == "en" and scorer.predict("planter")[0] == "fr"
    assert "flinging" in scorer.unseen and "walking" in model.words
    # the longest known n-gram at a place counts, then shorter ones
    assert "king>" in model.grams and "flin" not in model.grams


def test_undetermined_and_ties(spark):
    model = language.train(rows.table(spark, [(1, "abc", "x", "a"), (2, "abc", "b", "a")]))
    scorer = language.Scorer(model)
    for text in (None, "", "  ", "12 ?! ½ ４"):
        assert scorer.predict(text) == ("und", 0.0)
    assert scorer.predict("abc") == ("b", 0.5)
    assert scorer.predict("漢")[0] == "b"


def test_nothing_learned_and_awkward_rows(spark):
    made = rows.awkward(random.Random(3))
    docs = rows.table(spark, made, extra=True)
    assert language.train(docs.where("false")) is None
    assert {r[1:] for r in predicted(docs, None)} == {("und", 0.0)}
    found = predicted(docs, language.train(docs))
    assert len(found) == len(made)
    assert all(lang in ("en", "xx", "zh", "und") for _, lang, _ in found)
    assert all(lang == "und" for i, lang, _ in found if i in (3, 4, 5))


def test_unseen_words_are_forgotten_in_time(spark):
    model = language.train(rows.table(spark, [(1, "abc abd", "x", "a"), (2, "xyz xyw", "b", "a")]))
    scorer = language.Scorer(model)
    scorer.KEPT = 8
    scorer.table = scorer.table[:len(model.words) + 8]
    assert scorer.predict(" ".join(f"ab{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)))[0] == "x"
