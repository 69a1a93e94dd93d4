import hashlib
import random
import re
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from evenkeel.llm import queries, token_alignment
from evenkeel.llm.common import table, tokenizer_path
from tests.llm import rows

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in kept}
        for b in range(256):
            if b not in kept:
                byte[chr(256 + len(byte) - len(kept))] = b
        self.byte = byte

    def tokens(self, text):
        encoded = self.a.encode(f" {text}", add_special_tokens=False)
        a = [(i, bytes(self.byte[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            code = re.fullmatch(r"<0x(..)>", piece)
            b.append((i, bytes.fromhex(code[1]) if code else piece.replace("▁", " ").encode()))
        want = f" {text}".encode()
        return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])

    def document(self, text):
        a, b = self.tokens(text) if text else ([], [])
        spans, ends = [], []
        for side in (a, b):
            at, found = 0, []
            for i, raw in side:
                found.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(found)
            ends.append({e for _, _, e in found})
        links, j = [], 0
        for i, s, e in spans[0]:
            while j < len(spans[1]) and spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        groups, at = [], [0, 0]
        for cut in sorted(ends[0] & ends[1]):
            sides = []
            for s in (0, 1):
                part = []
                while at[s] < len(spans[s]) and spans[s][at[s]][2] <= cut:
                    part.append(str(spans[s][at[s]][0]))
                    at[s] += 1
                sides.append(",".join(part))
            groups.append("|".join(sides))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        return len(a), len(b), len(groups), links, digest

    def table(self, made):
        found = [(doc_id, self.document(text)) for doc_id, text in made]
        held = Counter(p for _, x in found for p in set(x[3]))
        most = {}
        for (a, _), n in held.items():
            most[a] = max(most.get(a, 0), n)
        out = [(doc_id, n_a, n_b, n_groups, len(links), sum(held[p] == most[p[0]] for p in links),
                sum(held[p] for p in links), digest) for doc_id, (n_a, n_b, n_groups, links, digest) in found]
        return sorted(out, key=str), {(*p, n, n == most[p[0]]) for p, n in held.items()}


brute = Brute()


def found(figures):
    return sorted((tuple(r[c] for c in COLUMNS) for r in figures.collect()), key=str)


def texts(draw, n):
    """Texts with odd blanks, marks, control characters, special tokens, and repeats."""
    odd = ["▁", "a▁b", "<s>", "<unk>", "<0x41>", "<|endoftext|>", "\t", "  ", "\n\n", " ", "　",
           "😀", "漢字", "é", "\x00", "﻿", "don't", "x,", "1234567", "...", "\r\n", "-----", " ", "ﬁ"]
    made = []
    for i in range(n):
        parts = [draw.choice(odd) if draw.random() < 0.15 else rows.words(draw, 1) for _ in range(draw.randint(1, 30))]
        made.append((i, draw.choice((" ", " ", "\n", "")).join(parts)))
    return made


@pytest.mark.parametrize("how", [
    token_alignment.Counting(),
    token_alignment.Counting(run_records=60, radix_bits=2, fan_in=2, block_pairs=5)])
def test_equals_brute_force(spark, monkeypatch, how):
    monkeypatch.setattr(token_alignment, "CHUNK", 300)
    made = texts(random.Random(how.fan_in), 150)
    made += [(3, made[3][1]), (None, made[4][1]), (None, None), (500, None), (501, ""), (502, " "), (503, "\n"),
             (504, "word " * 700), (505, "a " * 300 + "b")]
    docs = rows.table(spark, [(i, t, "en", "a") for i, t in made], extra=True).repartition(3)
    want, pairs = brute.table(made)
    figures, counted = token_alignment.align(docs, A, B, how)
    assert found(figures) == want
    assert {tuple(r) for r in counted.collect()} == pairs


def test_given_documents(spark):
    made = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    assert found(queries.op12_token_alignment(spark, "/root/testdata/sf0.001")) == brute.table(made)[0]


def test_marks_leave_a_text_without_tokens():
    assert brute.document("a▁b") == (0, 0, 0, [], "")
    assert brute.document("<|endoftext|>")[0] > 1


def test_awkward_rows_and_empty_table(spark):
    made = rows.awkward(random.Random(3))
    docs = rows.table(spark, made, extra=True)
    assert found(token_alignment.align(docs, A, B)[0]) == brute.table([r[:2] for r in made])[0]
    figures, counted = token_alignment.align(rows.table(spark, []), A, B)
    assert figures.count() == counted.count() == 0
