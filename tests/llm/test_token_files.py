import io
import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from evenkeel.llm import token_files as T
from evenkeel.llm.common import tokenizer_path
from evenkeel.session import shared_folder
from tests.llm import rows

ODD = ["", "\n", " ", "a\n", "\na", "  a", " a ", "x\n\ny", "x\n\n\ny", "a,b.", "a,\n.b", "\xa0\na", "a \tb",
       "<|endoftext|> x", "it's 'll. we'll, 12. 3,4 é. 漢。", "a\r\nb", "x.\nY, z"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture()
def folder(spark):
    return f"{shared_folder(spark)}/test-{uuid.uuid4().hex}"


def test_pieces_give_the_ids_of_whole_texts(library):
    draw = random.Random(3)
    letters = [*"ab ,.\n \t\r'sé漢1 -\x1c\x85\x0b\n", "'s", "the ", "Of", " and"]
    texts = ODD + ["".join(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(1500)]
    texts += [rows.words(draw, draw.randint(0, 200)) for _ in range(200)]
    encoder = T.Encoder(tokenizer_path())
    encoder.KEPT = 50  # so that pieces are forgotten on the way
    for i in range(0, len(texts), 100):
        got = encoder.encode(pa.array(texts[i:i + 100]))
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library(t) for t in texts[i:i + 100]]


@pytest.mark.parametrize("plain", [False, True])
def test_new_words_go_to_the_model_at_once(plain):
    draw = random.Random(5)
    letters = [*"abcdefgtsoOnN", *"\u00e9\u00df\u0142\u03b1\u0416\u00aa\u6f22\u05d0\u0301\u02b0\U00010400", *"'19"]
    signs = [*"$$&!?*'_.,;)>|", "<|endoftext|>", "'s", "\u3002"]

    def word():
        return draw.choice(["", "", "(", "'"]) + "".join(draw.choices(letters[:16], k=draw.randint(1, 14))) + \
            "".join(draw.choices(letters, k=draw.choice([0, 0, 0, 3]))) + \
            "".join(draw.choices(signs, k=draw.choice([0, 0, 1, 3, 9])))
    texts = ["".join(word() + draw.choice("  \n") for _ in range(40)) + "z" for _ in range(300)]
    encoder = T.Encoder(tokenizer_path(), plain)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = plain
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    calls, model = [], encoder.whole
    encoder.whole = lambda items: calls.extend(items) or model(items)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))] == want
    words = [f"q{w}" for w in ("abcd", "\u00e9t\u00e9", "\u0416\u0416", "x\u03b1")]
    calls.clear()
    got, = encoder.encode(pa.array([" ".join(["a", *words, "\n".join(words)])]))
    assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(
        " ".join(["a", *words, "\n".join(words)]), add_special_tokens=False).ids
    assert not any(w in c for w in words for c in calls)


def test_round_trip_of_awkward_rows(spark, folder, library):
    made = rows.awkward(random.Random(3)) + [(20 + i, t, "en", "a") for i, t in enumerate(ODD)]
    docs = rows.table(spark, made, extra=True)
    T.write(docs, folder, tokenizer_path(), T.Layout(frame_bytes=2_000, file_bytes=20_000))
    found = T.read(spark, folder).orderBy("start").collect()
    want = sorted((r[0] is not None, r[0] or 0, tuple(library(r[1] or "") + [0])) for r in made)
    got = [(r["doc_id"] is not None, r["doc_id"] or 0, tuple(np.frombuffer(r["ids"], "<u4").tolist()))
           for r in found]
    assert sorted(got) == want
    assert [g[:2] for g in got] == sorted(g[:2] for g in got)
    at = 0
    for r in found:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]) // 4)
        assert r["ids_crc32"] == zlib.crc32(r["ids"])
        at += r["n_tokens"]
    assert T.manifest_of(spark, folder).count() > 1


def test_a_reader_takes_only_the_frames_it_needs(spark, folder, library):
    made = [(i, rows.words(random.Random(i), 50), "en", "a") for i in range(200)]
    T.write(rows.table(spark, made), folder, tokenizer_path(), T.Layout(frame_bytes=4_000))
    files = [r["file"] for r in T.manifest_of(spark, folder).collect()]
    found = T.read_documents(folder, files, {7, 190})
    assert {k: v.tolist() for k, v in found.items()} == {k: library(made[k][1]) + [0] for k in (7, 190)}


def written(raws, layout=T.Layout(frame_bytes=64)):
    class Kept(io.BytesIO):
        def close(self):
            self.content = self.getvalue()
    out = Kept()
    writer = T.FileWriter(out, layout)
    for i, raw in enumerate(raws):
        writer.add(i, raw)
    writer.close()
    return out.content


def test_frames_read_and_checksums():
    raws = [np.arange(n, dtype="<u4").tobytes() for n in (3, 40, 1, 0, 100, 5)]
    content = written(raws)

    class Counting(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            got = super().read(n)
            self.taken += len(got)
            return got

    reader = T.FileReader(Counting(content))
    assert [x[2] for x in reader.documents()] == raws
    few = T.FileReader(Counting(content))
    before = few.source.taken
    assert [x[0] for x in few.documents({2})] == [2]
    assert few.source.taken - before == few.entries[int(few.home[2])][0]
    # any zstandard reader sees the frames, and skips the seek table
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
    assert plain.startswith(b"".join(raws))
    broken = bytearray(content)
    broken[reader.entries[0][0] - 6] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(T.FileReader(io.BytesIO(bytes(broken))).documents())
    with pytest.raises(ValueError):
        T.FileReader(io.BytesIO(content[:-1]))


def test_files_of_lost_attempts_are_not_read(spark, folder):
    T.write(rows.table(spark, [(1, "a b", "en", "a")]), folder, tokenizer_path())
    file, = [r["file"] for r in T.manifest_of(spark, folder).collect()]
    from pyarrow import fs
    target, root = fs.FileSystem.from_uri(f"{folder}/files")
    with target.open_output_stream(f"{root}/part-000000-0000-other{T.SUFFIX}", compression=None) as out:
        out.write(b"cut off in the mid")
    assert [r["doc_id"] for r in T.read(spark, folder).collect()] == [1]


def test_empty_table(spark, folder):
    T.write(rows.table(spark, []), folder, tokenizer_path())
    assert T.read(spark, folder).count() == 0
