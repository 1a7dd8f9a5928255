from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
from tokenizers import Tokenizer

from skyledger.llm import packed_ids
from skyledger.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
DOCS = "doc_id long, text string, start string, path string"


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 2, 7, 8, 15, 16, 17, 20, 31, 32])
def test_packing_is_undone(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 32 * 129, dtype=np.uint64)
    data = packed_ids.pack(ids, bits)
    assert len(data) == 129 * 4 * bits
    assert (packed_ids.unpack(data, bits) == ids).all()
    plain = sum(int(v) << (bits * k) for k, v in enumerate(ids[:64]))
    assert data[: 8 * bits] == plain.to_bytes(8 * bits, "little")


def test_ids_of_every_code_point_between_letters():
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or c % 97 == 0)]
    known = packed_ids.Encoder(PATH)
    assert known.apart
    texts = ["a" + chr(c) + "b " + chr(c) + " Xy" + chr(c) for c in points]
    got = [np.frombuffer(b, "<u4").tolist() for b in map(known.of, texts)]
    want = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert [hex(c) for c, g, w in zip(points, got, want, strict=True) if g != w] == []


@pytest.mark.parametrize("text", ["", " ", "a<|endoftext|>b <|startoftext|>", "It's 12 o'clock, DON'T", "a\x1cb\x1f c", "é ́x", "x" * 5000])
def test_ids_are_those_of_the_tokenizer(text):
    assert np.frombuffer(packed_ids.encoder(PATH).of(text), "<u4").tolist() == ids_of(text)


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packed_ids, "REMEMBERED", 3)
    known = packed_ids.Encoder(PATH)
    texts = ["one two three four five", "six one seven two", "eight one"]
    assert [np.frombuffer(b, "<u4").tolist() for b in map(known.of, texts)] == [ids_of(t) for t in texts]


def expected(rows, end=2):
    """Brute force over ``(doc_id, text)``: start, number of ids and their crc32, in order of ids."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*ids_of(text), end], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    return out


def test_documents_come_back(spark, frame, monkeypatch):
    chance = random.Random(3)
    words = ["alpha", "Beta", "gamma's", "naïve", "42", "…", "deltaepsilon"]
    rows = [(k * 7 % 101, " ".join(chance.choices(words, k=chance.randint(0, 60)))) for k in range(101)]
    rows += [(None, "lost"), (200, None), (201, ""), (202, "word " * 30_000)]
    monkeypatch.setattr(packed_ids, "FILE_IDS", 500)
    folder = scratch_dir(spark, "test-ids")
    manifest = packed_ids.write(frame(DOCS, *[(d, t, "clash", "clash") for d, t in rows]), PATH, folder)
    files = manifest.orderBy("start").collect()
    assert len(files) > 5
    assert [f.start for f in files] == [sum(f.ids for f in files[:k]) for k in range(len(files))]
    got = sorted(packed_ids.read(manifest, folder).collect(), key=lambda r: r.start)
    want = expected(rows)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, np.frombuffer(r.ids, "<u4").tolist()) for r in got] == want
    # Random access: every range of ids that a file is asked for, across blocks and documents.
    every = [i for *_, ids in want for i in ids]
    store, _ = pyarrow.fs.FileSystem.from_uri(folder)
    for row in files:
        with store.open_input_file(row.path) as file:
            opened = packed_ids.IdFile(file)
            for _ in range(5):
                a, b = sorted(chance.randint(0, opened.n_ids) for _ in range(2))
                assert opened.ids(a, b).tolist() == every[row.start + a : row.start + b]
            doc = chance.randrange(opened.n_docs)
            a, b = opened.bounds(doc)
            assert opened.document(doc).tolist() == every[row.start + a : row.start + b]


def test_repeated_rows_and_ids(frame):
    rows = [(1, "same text"), (1, "same text"), (1, "other"), (0, "z")]
    got = packed_ids.round_trip(frame(DOCS, *[(d, t, "", "") for d, t in rows]), PATH).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(ids_of(t)) + 1 for _, t in rows)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [0, 1, 1, 1]
    assert [r.start for r in ordered] == [sum(r.n_tokens for r in ordered[:k]) for k in range(4)]


def test_no_documents(frame):
    assert packed_ids.round_trip(frame(DOCS), PATH).collect() == []


def test_damage_is_found(spark, frame):
    folder = scratch_dir(spark, "test-ids")
    manifest = packed_ids.write(frame(DOCS, (1, "some words here", "", "")), PATH, folder)
    path = manifest.first().path
    with open(path, "r+b") as file:
        file.write(b"\xff")
    with pytest.raises(Exception, match="damaged"):
        packed_ids.read(manifest, folder).collect()


def test_other_tokenizers_and_ids_that_do_not_fit(spark, frame):
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = Tokenizer.from_file(path).encode("Some  text\n here", add_special_tokens=False).ids
    got = packed_ids.round_trip(frame(DOCS, (1, "Some  text\n here", "", "")), path, end_id=70_000).first()
    assert got.ids_crc32 == zlib.crc32(np.array([*want, 70_000], "<u4").tobytes())
    with pytest.raises(ValueError, match="does not fit"):
        packed_ids.FileWriter(4).add(1, np.array([16], "<u4"))
