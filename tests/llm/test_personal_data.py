import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from evenkeel.llm import personal_data as P
from evenkeel.llm import queries
from evenkeel.llm.common import table
from tests.llm import rows

RULES = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def checksum(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(sum(map(int, str(x))) for x in doubled) % 10 == 0


def brute_base(text):
    out = []
    for kind, rule in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == 2 and 13 <= len(digits) <= 19 and checksum(digits)
                    or kind == 3 and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def text_of(base):
    return ",".join(f"{P.KINDS[k]}:{s}:{e}" for k, s, e in base)


def card(draw):
    body = "4" + "".join(draw.choices("0123456789", k=14))
    return next(body + d for d in "0123456789" if checksum(body + d))


def phone(draw):
    return f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}"


def ip(draw):
    return ".".join(str(draw.randint(1, 223)) for _ in range(4))


def private(draw, n):
    """Texts with personal data, with numbers that are none, and clean ones."""
    made = []
    for i in range(n):
        word = lambda k: rows.words(draw, k)
        what = draw.choice(("email", "ip", "card", "phone", "hex", "version", "wrong", "clean"))
        middle = {
            "email": f"mail.{i}@mail{i}.example.com", "ip": ip(draw), "card": card(draw), "phone": phone(draw),
            "hex": 'token = "%s"' % "".join(draw.choices("0123456789abcdef", k=8) + draw.choices("0123456789", k=16)
                                           + ["f"]),
            "version": f"Version {draw.randint(1, 9)}.0.", "wrong": str(int(card(draw)) + 1), "clean": ""}[what]
        made.append((i, f"{word(20)} {middle} {word(20)}", "en", what))
    return made


def test_base_rules_on_random_strings():
    draw = random.Random(5)
    for size, letters in ((14, "a@.-_1"), (30, "12. +()-"), (60, "0123456789 -"), (40, "a.@b1 +-2é"), (24, "25.0")):
        for _ in range(4000):
            text = "".join(draw.choices(letters, k=draw.randint(0, size)))
            assert P.base_spans(text) == brute_base(text), text
    for _ in range(300):
        text = " ".join(draw.choice((card, phone, ip))(draw) for _ in range(draw.randint(1, 4)))
        assert P.base_spans(text) == brute_base(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 200_000, "a" * 300_000 + "@", "+1" + "(" * 300_000, "a@" * 200_000,
                 "1 " * 200_000, "+1 " * 100_000, "a dot " * 20_000):
        P.read_text(text)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = queries.op11_weakly_supervised_pii(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts)
    for r in got:
        base = brute_base(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x[0] == i for x in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(text_of(base).encode()).hexdigest()
        assert {*text_of(base).split(",")} - {""} <= {*r["spans"].split(",")}


def test_counts_stand_for_rows():
    """Expectation-maximisation over counts is that over every single candidate."""
    draw = np.random.default_rng(3)
    true = draw.random(4000) < 0.6
    cast = np.where(draw.random((4000, 7)) < 0.3, 1, np.where(draw.random((4000, 7)) < 0.85, 2 * true[:, None], 2 - 2 * true[:, None]))
    codes = (cast * 3 ** np.arange(6, -1, -1)).sum(axis=1)
    kinds = draw.integers(0, 4, 4000)
    rows_true, shares, rates = P.reliabilities(kinds, codes, np.ones(4000))
    keys, at, numbers = np.unique(np.stack([kinds, codes]), axis=1, return_inverse=True, return_counts=True)
    counted, other_shares, other_rates = P.reliabilities(*keys, numbers)
    assert np.allclose(counted[at.ravel()], rows_true) and np.allclose(shares, other_shares)
    assert np.allclose(rates, other_rates)
    # As good as with the rates that the votes were drawn from: all labelers alike, shares of 0.6.
    best = (cast - 1).sum(axis=1) * np.log(0.85 / 0.15) + np.log(0.6 / 0.4) > 0
    assert ((rows_true > 0.5) == true).mean() > (best == true).mean() - 0.005
    assert abs(rates[1, 0, 2] / (rates[1, 0, 2] + rates[1, 0, 0]) - 0.85) < 0.03


def test_planted_cases(spark):
    draw = random.Random(9)
    made = private(draw, 1200)
    joined = {}
    for i in range(2000, 2060):  # the rules drop both
        a, b = phone(draw), card(draw)
        text = f"{rows.words(draw, 9)} {a} {b} {rows.words(draw, 9)}"
        if not brute_base(text):
            joined[i] = text_of([(2, text.index(b), text.index(b) + 16), (3, text.index(a), text.index(a) + len(a))])
            made.append((i, text, "en", "joined"))
    made.append((3000, f"{rows.words(draw, 5)} write to jane.doe [at] example [dot] com {rows.words(draw, 5)}", "en", "spoken"))
    got = {r["doc_id"]: r for r in queries.personal_data_of(rows.table(spark, made, extra=True)).collect()}
    assert len(joined) > 30
    assert all(got[i]["spans"] == want for i, want in joined.items())
    assert got[3000]["spans"].startswith("email:")
    for i, text, _, what in made:
        base = text_of(brute_base(text))
        if what in ("hex", "version", "wrong", "clean"):
            assert got[i]["spans"] == base, text
        elif what in P.KINDS:
            assert got[i]["spans"] == base and base.startswith(what)


def test_awkward_rows_and_empty_table(spark):
    draw = random.Random(3)
    long_text = "a " * 50_000 + card(draw) + " b" * 50_000
    made = rows.awkward(draw) + [(70, long_text, "en", "a"), (71, "😀 é x@y.de", None, None), (71, "+49 30 1234567", "de", "a")]
    docs = rows.table(spark, made, extra=True).withColumn("spans", F.lit("own"))
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["base_sha256"]) for r in queries.personal_data_of(docs).collect())
    assert got == sorted((i is not None, i or 0, hashlib.sha256(text_of(brute_base(t or "")).encode()).hexdigest())
                         for i, t, *_ in made)
    assert queries.personal_data_of(rows.table(spark, [])).count() == 0
