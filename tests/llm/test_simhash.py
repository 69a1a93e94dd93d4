import random
import re

import numpy as np
import pytest
import xxhash

from evenkeel.llm import simhash
from evenkeel.llm.components import components
from tests.llm import rows


def brute_code(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    code = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return code - (1 << 64) if code >> 63 else code


def brute_groups(codes, within=2):
    codes = [c & (2 ** 64 - 1) for c in codes]
    parent = list(range(len(codes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(codes):
        for j in range(i):
            if bin(a ^ codes[j]).count("1") <= within:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(codes))]


def test_fingerprints_and_components_equal_brute_force(spark):
    draw = random.Random(5)
    made = []
    for i in range(60):
        text = rows.words(draw, draw.choice((0, 1, 2, 3, 60, 400)))
        made.append((2 * i, text, "en", "a"))
        if draw.random() < 0.5:  # a near copy
            made.append((2 * i + 1, text.upper() + draw.choice(("", " the", " x y")), "en", "a"))
    found = {r["doc_id"]: r for r in simhash.near_duplicates(rows.table(spark, made)).collect()}
    codes = [brute_code(r[1]) for r in made]
    assert [found[r[0]]["code"] for r in made] == codes
    groups = brute_groups(codes)
    assert [found[r[0]]["component_id"] for r in made] == [
        min(r[0] for r, g in zip(made, groups) if g == own) for own in groups]


def test_long_text_is_read_in_pieces_as_one():
    text = rows.words(random.Random(1), 400_000)
    assert len(text) > 2 << 20
    got = simhash._majority(text, 3)
    assert (got - (1 << 64) if got >> 63 else got) == brute_code(text)


def test_links_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 100)
    draw = np.random.default_rng(2)
    base = draw.integers(0, 2 ** 64, 700, dtype=np.uint64)
    one = np.uint64(1)
    near = base[draw.integers(0, 700, 500)] ^ (one << draw.integers(0, 64, 500).astype(np.uint64))
    near ^= one << draw.integers(0, 64, 500).astype(np.uint64)
    codes = np.unique(np.r_[base, near]).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(c,) for c in codes], "code long"))
    named = {r["node"]: r["component"] for r in components(edges).collect()}
    got = [named.get(c, c) for c in codes]
    want = brute_groups(codes)
    pairs = {(g, w) for g, w in zip(got, want)}
    assert len(pairs) == len(set(got)) == len(set(want)) < len(codes)


def test_a_group_is_pruned_by_its_shared_bits():
    codes = np.arange(256, dtype=np.uint64) << np.uint64(8)
    index = simhash.GrayIndex(codes, codes)
    query, found = index.search(np.array([0b11 << 8], np.uint64), 1)
    assert sorted(codes[found].tolist()) == sorted(
        [0b11 << 8] + [(0b11 ^ (1 << b)) << 8 for b in range(8)])


def test_components_of_long_chains_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 400)]
    hub = [(1, i) for i in range(1000, 1500)]
    named = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(chain + hub + [(7, 7)], "a long, b long")).collect()}
    assert {named[i] for i in range(100, 401)} == {100}
    assert {named[i] for i in range(1000, 1500)} == {1}
    assert 7 not in named


def test_awkward_rows(spark):
    made = rows.awkward(random.Random(3))
    found = simhash.near_duplicates(rows.table(spark, made, extra=True)).collect()
    assert len(found) == len(made)
    assert {r["component_id"] for r in found if r["doc_id"] in (1, 2)} == {1}
    assert {r["code"] for r in found if r["doc_id"] in (3, 4, 5)} == {0}
    assert {r["component_id"] for r in found if r["doc_id"] in (3, 4, 5)} == {3}
    assert any(r["doc_id"] is None and r["component_id"] == 1 for r in found)
    assert any(r["doc_id"] is None and r["component_id"] is None for r in found)


def test_one_of_each_group_stays_with_its_columns(spark):
    docs = rows.table(spark, rows.awkward(random.Random(3)), extra=True)
    left = simhash.keep_one(docs)
    assert left.columns == docs.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in left.collect())
    # 6 and 7 differ in one of 60,000 words; both rows of 8 are groups of their own
    assert [i for none, i in ids if not none] == [1, 3, 6, 8, 8, 9]
    assert sum(none for none, _ in ids) == 1
    twice = rows.table(spark, [(1, "a b c d", "en", "a")] * 5)
    assert simhash.keep_one(twice).count() == 1


@pytest.mark.parametrize("call", [simhash.near_duplicates, simhash.keep_one])
def test_empty_table(spark, call):
    assert call(rows.table(spark, [])).count() == 0


def test_one_row_of_a_group_without_ids_stays(spark):
    draw = random.Random(8)
    one, other = rows.words(draw, 300), rows.words(draw, 300)
    made = [(None, one, "en", "a")] * 3 + [(None, one.upper(), "en", "a"), (None, other, "en", "a")]
    left = simhash.keep_one(rows.table(spark, made)).collect()
    assert sorted(r["text"].lower() for r in left) == sorted([one, other])
