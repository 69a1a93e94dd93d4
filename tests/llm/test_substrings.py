import hashlib
import random

import pytest

from evenkeel.llm import substrings as S
from tests.llm import rows


def brute(made, window):
    first = {}
    for doc_id, text, *_ in sorted((r for r in made if r[0] is not None), key=lambda r: r[0]):
        w = (text or "").encode().split()
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), doc_id)
    out = []
    for doc_id, text, *_ in made:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[i:i + window])] < doc_id:
                gone[i:i + window] = [True] * window
        left = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(left).hexdigest(), left.decode()))
    return sorted(out, key=str)


def corpus(draw, n):
    passages = [rows.words(draw, k) for k in (50, 51, 60, 90, 200)]
    made = []
    for i in range(n):
        parts = [rows.words(draw, draw.randint(0, 70)) for _ in range(draw.randint(1, 3))]
        for _ in range(draw.randint(0, 2)):
            parts.insert(draw.randint(0, len(parts)), draw.choice(passages))
        if draw.random() < 0.2 and made:
            parts = [draw.choice(made)[1]]
            if draw.random() < 0.5:
                words = parts[0].split()
                if words:
                    words[draw.randrange(len(words))] = "changed"
                parts = [" ".join(words)]
        if draw.random() < 0.1:
            parts = [" ".join([draw.choice(("the of", "river"))] * 150)]
        made.append((i, " ".join(parts), "en", "a"))
    draw.shuffle(made)
    return made


@pytest.mark.parametrize("shard", [512, 3])
def test_equals_brute_force(spark, shard):
    made = corpus(random.Random(shard), 160)
    got = sorted((tuple(r) for r in S.remove_passages(
        rows.table(spark, made), S.Passages(shard_segments=shard)).collect()), key=str)
    assert got == brute(made, 50)
    assert sum(r[2] for r in got) > 1000


def test_a_passage_in_every_document(spark):
    draw = random.Random(2)
    passage = rows.words(draw, 55)
    made = [(i, f"{rows.words(draw, 40)} {passage} {rows.words(draw, 40)}", "en", "a") for i in range(300)]
    got = sorted((tuple(r) for r in S.remove_passages(
        rows.table(spark, made), S.Passages(shard_segments=64)).collect()), key=str)
    assert got == brute(made, 50)


def test_two_texts_under_one_id(spark):
    draw = random.Random(4)
    shared, own = rows.words(draw, 80), " ".join(f"own{i}" for i in range(80))
    made = [(1, shared, "en", "a"), (2, shared, "en", "a"), (2, own, "en", "a"), (2, own, "en", "a"),
            (3, f"{own} {shared}", "en", "a")]
    got = sorted((tuple(r) for r in S.remove_passages(rows.table(spark, made)).collect()), key=str)
    assert got == brute(made, 50)
    assert [r[2] for r in got] == [0, 0, 0, 80, 160]


@pytest.mark.parametrize("shard", [1, 4])
def test_large_shards_are_halved(spark, shard):
    """Texts that share parts of one passage around an anchor, of many lengths; some repeat its grams."""
    draw = random.Random(shard)
    passage = [f"p{i}" for i in range(120)]
    made = []
    for i in range(90):
        a, b = sorted(draw.sample(range(121), 2))
        middle = " ".join(passage[a:b])
        again = " ".join(passage[20:32]) if i % 7 == 0 else ""
        made.append((i // 2 if i % 11 == 0 else i, f"{rows.words(draw, 30)} {middle} {again} {rows.words(draw, 30)}",
                     "en", "a"))
    got = sorted((tuple(r) for r in S.remove_passages(
        rows.table(spark, made), S.Passages(shard_segments=shard)).collect()), key=str)
    assert got == brute(made, 50)


def test_automaton_knows_the_first_document():
    draw = random.Random(7)
    for _ in range(60):
        texts = [[draw.choice("ab") for _ in range(draw.randint(0, 30))] for _ in range(5)]
        automaton, k = S.Automaton(), draw.randint(1, 5)
        for doc, text in enumerate(texts):
            want = [next((d for d in range(doc) for j in range(len(texts[d]) - k + 1)
                          if texts[d][j:j + k] == text[i:i + k]), None) for i in range(len(text) - k + 1)]
            assert automaton.first_with(text, k) == want
            automaton.add(text, doc)


def test_awkward_rows(spark):
    made = rows.awkward(random.Random(3))
    docs = rows.table(spark, made, extra=True)
    found = [tuple(r) for r in S.remove_passages(docs).collect()]
    assert len(found) == len(made)
    by_id = {}
    for r in found:
        by_id.setdefault(r[0], []).append(r[1:3])
    assert by_id[1] == [(120, 0)] and by_id[2] == [(120, 120)] * 2
    assert by_id[3] == by_id[4] == by_id[5] == [(0, 0)]
    assert sorted(by_id[None]) == [(80, 0), (120, 0)]  # a null id comes after no other
    assert by_id[6] == [(60_000, 0)] and by_id[7] == [(60_001, 60_000)]
    assert S.remove_passages(rows.table(spark, [])).count() == 0
