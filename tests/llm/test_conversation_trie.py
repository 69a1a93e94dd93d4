import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm import conversation_trie, queries
from evenkeel.llm.common import table

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]


def brute_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own.setdefault(conv, []).append(((turn is not None, turn or 0, role.encode(), key), (role, text)))
    own = {c: [x for _, x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def sums(path):
        below = [sums(p) for p in children.get(path, [])]
        saved = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        return (sum(b[0] for b in below) if below else 1), saved + sum(b[1] for b in below)

    out = []
    for path, who in members.items():
        ends = sorted(c for c in who if len(convs[c]) == len(path))
        leaves, saved = sums(path)
        out.append((min(who), len(path), min(members[path[:-1]]) if path else None, len(who),
                    len(children.get(path, [])), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def made(draw, n):
    """Conversations that share first turns, of very different lengths."""
    said = [("user" if i % 2 == 0 else "assistant", f"text {i} " * draw.randint(0, 3)) for i in range(6)]
    rows = []
    for i in range(n):
        conv, turns = draw.randrange(0, 400), draw.choice((0, 1, 2, 3, 4, 5, 8, 9, 13, 30))
        shared = draw.randint(0, turns)
        for turn in range(turns):
            role, text = said[turn % 6] if turn < shared else draw.choice(said)
            rows.append((conv, None if draw.random() < 0.02 else turn,
                         None if draw.random() < 0.05 else role, None if draw.random() < 0.05 else text))
    rows += [(None, 1, "user", "no conversation"), (100, 0, "user", "é😀"), (100, 0, "user", "é😀")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, block", [(1, 4), (2, 4), (3, 1), (4, 7)])
def test_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    monkeypatch.setattr(conversation_trie, "ENDS_BYTES", 5)
    rows = made(random.Random(seed), 150)
    df = spark.createDataFrame(rows, TURNS).withColumn("node", F.lit("own")).withColumn("n", F.lit(1))
    assert found(queries.prefix_trie(df)) == brute_trie(brute_rebuilt(rows))


def test_given_conversations(spark):
    df = table(spark, "/root/testdata/sf0.01", "conversations")
    want = brute_trie(brute_rebuilt([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]))
    assert found(queries.op13_conversation_trie(spark, "/root/testdata/sf0.01")) == want


def test_a_long_conversation_and_many_copies(spark):
    rows = [(c * 100, t, "user", f"turn {t}") for c in range(40) for t in range(60)]
    rows += [(7, t, "user", f"turn {t}") for t in range(400)]
    df = spark.createDataFrame(rows, TURNS)
    assert found(queries.prefix_trie(df)) == brute_trie(brute_rebuilt(rows))


def test_empty_tables(spark):
    assert queries.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    convs = spark.createDataFrame([(5,), (3,), (5,), (None,)], "conv_id long")
    tree, ends = conversation_trie.trie(conversation_trie.digested(spark.createDataFrame([], TURNS)), convs)
    row, = tree.collect()
    assert (row["depth"], row["conv_id"], row["n_convs"], row["n_leaves"]) == (0, 3, 2, 1)
    assert sorted(r["conv_id"] for r in ends.collect()) == [3, 5]
