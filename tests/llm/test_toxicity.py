import random

import numpy as np
from pyspark.sql import functions as F

from evenkeel.llm import toxicity
from evenkeel.llm.common import held_out, table
from tests.llm import rows

SMALL = "/root/testdata/sf0.01"


def labels(spark, made):
    return spark.createDataFrame(made, "doc_id long, toxic int")


def test_pairs_weigh_what_terms_alone_do_not(spark):
    """Toxic only if the insult and the group meet; each alone is as common in clean texts."""
    draw = random.Random(1)
    made, marks = [], []
    for i in range(1200):
        insult, group = i % 2, i // 2 % 2
        text = rows.words(draw, 12).split() + ["wretched"] * insult + ["strangers"] * group
        draw.shuffle(text)
        made.append((i, " ".join(text), "en", "a"))
        marks.append((i, insult & group))
    docs = rows.table(spark, made)
    model = toxicity.train(docs.where("doc_id < 900"), labels(spark, marks))
    found = docs.where("doc_id >= 900").select(
        "doc_id", toxicity.score(F.col("text"), model, docs).alias("s")).collect()
    assert np.mean([(r["s"] >= 0.5) == dict(marks)[r["doc_id"]] for r in found]) > 0.98
    a, b = (model.slots[toxicity.slot(w)] for w in ("wretched", "strangers"))
    assert model.factors[a] @ model.factors[b] > 0


def test_pairs_of_words_that_tell_nothing_alone(spark):
    """Toxic if exactly one of two words is there: each alone is as frequent with either label."""
    draw = random.Random(2)
    made, marks = [], []
    for i in range(3000):
        one, two = i % 2, i // 2 % 2
        text = rows.words(draw, 12).split() + ["wretched"] * one + ["strangers"] * two
        draw.shuffle(text)
        made.append((i, " ".join(text), "en", "a"))
        marks.append((i, one ^ two))
    docs = rows.table(spark, made)
    model = toxicity.train(docs.where("doc_id < 2400"), labels(spark, marks))
    assert {toxicity.slot("wretched"), toxicity.slot("strangers")} <= set(model.slots)
    found = docs.where("doc_id >= 2400").select(
        "doc_id", toxicity.score(F.col("text"), model, docs).alias("s")).collect()
    assert np.mean([(r["s"] >= 0.5) == dict(marks)[r["doc_id"]] for r in found]) > 0.98


def test_scores_equal_the_double_sum_over_pairs(spark):
    docs, marks = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    model = toxicity.train(docs, marks)
    got = {r["doc_id"]: r["s"] for r in docs.select(
        "doc_id", toxicity.score(F.col("text"), model, docs).alias("s")).collect()}
    assert len(model.slots) > 5
    for r in docs.collect():
        words = {toxicity.slot(w) for w in toxicity.WORDS.findall((r["text"] or "").lower())}
        terms = [model.slots[s] for s in words if s in model.slots]
        total = model.bias + sum(model.weights[t] for t in terms)
        for i, a in enumerate(terms):
            for b in terms[i + 1:]:
                total += sum(float(x) * float(y) for x, y in zip(model.factors[a], model.factors[b]))
        assert abs(got[r["doc_id"]] - 1 / (1 + np.exp(-min(30, max(-30, total))))) < 1e-9


def test_held_out_accuracy(spark):
    docs, marks = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs.where(~out), marks.where(~out))
    found = docs.where(out).join(marks, "doc_id").select(
        "toxic", toxicity.score(F.col("text"), model, docs).alias("s")).collect()
    right = [(r["s"] >= 0.5) == bool(r["toxic"]) for r in found]
    assert np.mean(right) >= 0.9
    assert not any(r["s"] >= 0.5 for r in found if not r["toxic"])


def test_same_model_from_any_order(spark):
    docs, marks = table(spark, SMALL, "documents").limit(300), table(spark, SMALL, "labels")
    one = toxicity.train(docs, marks)
    two = toxicity.train(docs.repartition(5), marks.repartition(3))
    assert one.slots == two.slots and np.array_equal(one.weights, two.weights)


def test_one_label_or_none(spark):
    docs = rows.table(spark, rows.awkward(random.Random(3)), extra=True)
    for made in ([], [(1, 0)], [(1, 1), (2, 1)], [(None, 1), (3, None)]):
        model = toxicity.train(docs, labels(spark, made))
        scores = {round(r["s"], 6) for r in docs.select(
            toxicity.score(F.col("text"), model, docs).alias("s")).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1
    empty = rows.table(spark, [])
    assert empty.select(toxicity.score(F.col("text"), toxicity.train(empty, labels(spark, [])), docs)).count() == 0


def test_awkward_rows(spark):
    made = rows.awkward(random.Random(3))
    docs = rows.table(spark, made, extra=True)
    model = toxicity.train(docs, labels(spark, [(1, 1), (1, 0), (2, 0), (6, 0), (8, 0), (4, 0), (3, 0)]))
    found = docs.select("doc_id", toxicity.score(F.col("text"), model, docs).alias("s")).collect()
    assert len(found) == len(made) and all(0 <= r["s"] <= 1 for r in found)
    blank = {r["s"] for r in found if r["doc_id"] in (3, 4, 5)}
    assert len(blank) == 1
