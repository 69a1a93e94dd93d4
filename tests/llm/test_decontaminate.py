import random

import numpy as np

from evenkeel.llm import decontaminate as D
from tests.llm import rows


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def brute(item, text, most):
    """Least edits of the item in the text, by the full matrix."""
    a, b = D.Normal(item.strip()).points, D.Normal(text).points
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a.tolist(), 1):
        new = [i]
        for j, y in enumerate(b.tolist(), 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row) if min(row) <= most else None


def edited(draw, text, n):
    chars = list(text)
    for _ in range(n):
        at = draw.randrange(len(chars))
        kind = draw.choice("sid")
        if kind == "s":
            chars[at] = "#"
        elif kind == "i":
            chars.insert(at, "#")
        else:
            del chars[at]
    return "".join(chars)


def test_equals_full_alignment(spark):
    draw = random.Random(4)
    items = [(i, rows.words(draw, draw.choice((4, 8, 30, 60)))) for i in range(12)]
    docs = []
    for i in range(80):
        text = rows.words(draw, draw.randint(0, 60))
        if draw.random() < 0.7:
            item = draw.choice(items)[1]
            text += " " + edited(draw, item, draw.randint(0, len(item) // 15)) + " " + rows.words(draw, 20)
        docs.append((i, text, "en", "a"))
    how = D.Matching()
    got = {(r["doc_id"], r["item_id"]): min(r["edits"], 99) for r in D.matches(
        rows.table(spark, docs), bench(spark, items), how).collect()}
    best = {}
    for r in D.matches(rows.table(spark, docs), bench(spark, items), how).collect():
        key = r["doc_id"], r["item_id"]
        best[key] = min(best.get(key, 99), r["edits"])
    index = D.Items(items, how)
    want = {}
    for item_id, points, _, budget, _ in index.items:
        item = dict(items)[item_id]
        for doc_id, text, *_ in docs:
            edits = brute(item, text, budget)
            if edits is not None:
                want[doc_id, item_id] = edits
    assert set(got) == set(want) and best == want
    assert any(want.values()) and not all(want.values())


def test_places_and_normal_form(spark):
    item = "The quick brown fox jumps over the lazy dog tonight"
    text = "prefix \n THE  quick\tbrown fox\njumps OVER the lazy dog tonight. suffix"
    r, = D.matches(rows.table(spark, [(1, text, "en", "a")]), bench(spark, [(7, item)])).collect()
    assert text[r["start"]:r["stop"]].split() == text.split()[1:-2] + ["tonight"]
    assert r["edits"] == 0


def test_every_passage_of_a_document(spark):
    item = rows.words(random.Random(8), 30)
    found = D.matches(rows.table(spark, [(1, f"{item} and then {item}", "en", "a")]),
                      bench(spark, [(7, item), (7, item)])).collect()
    assert len({r["start"] for r in found}) == 2 and len(found) == 4


def test_shards_give_the_same(spark):
    draw = random.Random(6)
    items = [(i, rows.words(draw, 20)) for i in range(9)]
    docs = rows.table(spark, [(i, items[i][1] + " x", "en", "a") for i in range(9)])
    whole = sorted(D.matches(docs, bench(spark, items)).collect())
    assert whole == sorted(D.matches(docs, bench(spark, items), D.Matching(shard_chars=200)).collect())
    assert len(whole) == 9


def test_a_task_holds_one_shard(spark):
    draw = random.Random(7)
    items = [(i, rows.words(draw, 20)) for i in range(9)]
    docs = rows.table(spark, [(i, items[i][1] + " x", "en", "a") for i in range(0, 9, 2)] + [(20, "free", "en", "a")])
    how = D.Matching(shard_chars=200)
    assert [r["doc_id"] for r in D.clean(docs, bench(spark, items), how).collect()] == [20]
    for frame in (D.clean(docs, bench(spark, items), how), D.matches(docs, bench(spark, items), how)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        # One search over each scan: branches of a union, or the last of several passes.
        assert plan.count("ArrowEvalPython") == plan.count("Scan ") >= 1


def test_awkward_rows_and_clean(spark):
    docs = rows.table(spark, rows.awkward(random.Random(3)), extra=True)
    one = rows.awkward(random.Random(3))[0][1]
    left = D.clean(docs, bench(spark, [(1, one[:300]), (2, None), (3, "short"), (None, one[50:200])]))
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [
        3, 4, 5, 6, 7, 8, 8, 9]
    assert D.clean(docs, bench(spark, [])).count() == docs.count()
    assert D.matches(rows.table(spark, []), bench(spark, [(1, one)])).count() == 0


def test_alignment_keeps_to_its_band():
    item = np.arange(1, 40, dtype=np.uint32)
    text = np.concatenate([np.zeros(10, np.uint32), item[:20], item[21:], np.zeros(5, np.uint32)])
    assert D.align(item, text, 8, 4, 2) == (1, 10, 48)
    assert D.align(item, text, 30, 4, 2) is None


def test_texts_are_aligned_once(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "a question long enough to be an item")], "item_id long, text string")
    plan = D.matches(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
