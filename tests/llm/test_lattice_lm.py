from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skyledger.llm import lattice_lm as lm
from skyledger.llm.common import remainder

PATH = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, word string, chunk long"


@pytest.fixture(scope="module")
def vocabulary():
    return lm.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def pieces():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return {model.id_to_piece(k): k for k in range(3, model.get_piece_size())}


def paths(word: str, logs: np.ndarray, pieces: dict[str, int]) -> list[tuple[float, list[int]]]:
    """Every segmentation, one by one."""
    if not word:
        return [(0.0, [])]
    out = []
    for n in range(1, len(word) + 1):
        own = [pieces[word[:n]]] if word[:n] in pieces else None
        if own is None and n == 1:
            own = [pieces[f"<0x{b:02X}>"] for b in word[0].encode()]
        if own:
            out += [(sum(logs[k] for k in own) + p, own + rest) for p, rest in paths(word[n:], logs, pieces)]
    return out


WORDS = ["the", "tion", "a", "été", "☃x", "日本", "theorem", "zz\u0000z", "ing☃ing"]


def test_forward_sums_over_all_segmentations(vocabulary, pieces):
    got = lm.word_log_probabilities(WORDS, vocabulary.prior, vocabulary)
    want = [np.logaddexp.reduce([p for p, _ in paths("▁" + w, vocabulary.prior, pieces)]) for w in WORDS]
    assert got == pytest.approx(want)


def test_expected_counts_are_those_of_all_segmentations(vocabulary, pieces):
    times = np.arange(1.0, len(WORDS) + 1)
    want = np.zeros(len(vocabulary.prior))
    for word, n in zip(WORDS, times, strict=True):
        found = paths("▁" + word, vocabulary.prior, pieces)
        total = np.logaddexp.reduce([p for p, _ in found])
        for p, used in found:
            for k in used:
                want[k] += n * math.exp(p - total)
    assert lm.expected_counts(WORDS, times, vocabulary.prior, vocabulary) == pytest.approx(want)


def test_long_words_do_not_underflow(vocabulary):
    assert np.isfinite(lm.word_log_probabilities(["ab☃" * 20_000], vocabulary.prior, vocabulary)).all()


def test_scores_against_brute_force(frame, vocabulary):
    texts = {k: f"the Cat {'sat ' * (k % 5)}on mat{k % 7} ÉTÉ" for k in range(40)}
    texts |= {100: None, 101: "", 102: "  \t ", 103: "the " * 20_000, 104: "unseen" * 3000}
    docs = frame(DOCS, *[(k, t, "clash", 3) for k, t in texts.items()])
    rows = {r.doc_id: r for r in lm.score(docs, remainder("doc_id", 7) == 2, PATH, rounds=1).collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    words = {k: (t or "").encode().lower().split() + [b"\n"] for k, t in texts.items()}
    counts = Counter(w for k, own in words.items() if not held[k] for w in own)
    total, distinct = sum(counts.values()), len(counts)
    known = {w: n for w, n in counts.items() if w != b"\n"}
    expected = lm.expected_counts([w.decode() for w in known], np.array(list(known.values()), float), vocabulary.prior, vocabulary)
    expected = np.where(np.isfinite(vocabulary.prior), expected + lm.SMOOTHING, 0)
    end = counts[b"\n"] + lm.SMOOTHING
    with np.errstate(divide="ignore"):
        logs = np.log(expected / (expected.sum() + end))
    for k, own in words.items():
        r = rows[k]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[k], len(own), total)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert r.base_score == pytest.approx(base)
        each = lm.word_log_probabilities([w.decode() for w in own[:-1]], logs, vocabulary)
        assert r.score == pytest.approx((each.sum() + math.log(end / (expected.sum() + end))) / math.log(10))


def test_training_makes_seen_words_likelier(frame, vocabulary):
    rows = [(k, "zyxwv qqqq") for k in range(50)]
    docs = frame("doc_id long, text string", *rows)
    trained = lm.score(docs, F.lit(False), PATH, rounds=2).first().score
    assert trained > lm.word_log_probabilities(["zyxwv", "qqqq"], vocabulary.prior, vocabulary).sum() / math.log(10)


def test_repeated_rows_null_ids_and_no_rows(frame):
    taught = next(k for k in range(9) if zlib.crc32(str(k).encode()) % 7 != 2)
    docs = frame("doc_id long, text string", (taught, "a b"), (taught, "a b"), (None, "c"))
    rows = lm.score(docs, remainder("doc_id", 7) == 2, PATH, rounds=1).collect()
    assert len(rows) == 3 and {r.held_out for r in rows} == {False}
    assert {r.train_tokens for r in rows} == {8}
    assert lm.score(docs.where("false"), F.lit(False), PATH, rounds=1).count() == 0
