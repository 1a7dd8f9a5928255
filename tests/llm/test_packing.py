from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyledger.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, length string, grp long"


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    ["", "a", " a", "a ", "a  b", "a\n\nb c", "one two\nthree. it's 9'll", "é ü ☃ 日本", "<|endoftext|> x", "a<|endoftext|>b",
     "x" * 3000, " a b", "don't, stop!! ..a 12ab"],
)
def test_ids_are_those_of_the_tokenizer(text):
    assert np.frombuffer(packing.word_ids(PATH).of(text), "<u4").tolist() == ids_of(text)


def test_tree_places_as_plain_first_fit():
    chance = random.Random(1)
    lengths = [chance.randint(1, 2048) for _ in range(700)]
    room, want = [], {}
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        at = next((b for b, free in enumerate(room) if free >= lengths[k]), len(room))
        if at == len(room):
            room.append(2048)
        room[at] -= lengths[k]
        want[k] = at
    assert packing.first_fit_decreasing(lengths, 2048) == [want[k] for k in range(len(lengths))]
    assert packing.first_fit_decreasing([], 2048) == []


def check(rows, texts):
    """Every id in exactly one piece, sequences gapless and never too long."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        ids = ids_of(texts[doc] or "") + [1]
        pieces.sort(key=lambda r: r.start)
        at = 0
        for r in pieces:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : at], "<u4").tobytes())
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_round_trip_with_odd_rows(frame):
    chance = random.Random(2)
    texts = {k: " ".join("w" * chance.randint(1, 9) for _ in range(chance.randint(1, 400))) for k in range(60)}
    texts |= {100: None, 101: "", 102: "long " * 20_000}
    docs = frame(DOCS, *[(k, t, "clash", 7) for k, t in texts.items()])
    check(packing.digests(docs, PATH).collect(), texts)


def test_repeated_rows_null_ids_and_no_rows(frame):
    docs = frame("doc_id long, text string", (1, "a b"), (1, "a b"), (None, "c"))
    rows = packing.digests(docs, PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.length) for r in rows) == [(False, 1, 3), (False, 1, 3), (True, 0, 2)]
    assert packing.pack(frame("doc_id long, text string").where("false"), PATH).count() == 0


def test_little_padding(frame):
    """Never more sequences than the method's bound allows: 11/9 of the fewest possible, and one."""
    chance = random.Random(3)
    docs = frame("doc_id long, text string", *[(k, "word " * chance.randint(1, 1900)) for k in range(600)])
    rows = packing.pack(docs, PATH).groupBy("sequence_id").sum("length").collect()
    fewest = -(-sum(r[1] for r in rows) // 2048)
    assert len(rows) <= fewest * 11 / 9 + 1


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 4)
    ids = packing.WordIds(PATH)
    for k in range(60):
        text = f"often once{k} here, there!! number{k}"
        assert np.frombuffer(ids.of(text), "<u4").tolist() == ids_of(text)
        assert len(ids) <= 5


def test_checksums_are_those_of_the_ids(frame):
    docs = frame(DOCS, *[(k, "some text here " * k, "", 0) for k in range(0, 900, 90)])
    whole = {(r.doc_id, r.start): zlib.crc32(r.ids) for r in packing.pack(docs, PATH).collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in packing.digests(docs, PATH).collect()} == whole
