from __future__ import annotations

import random

import numpy as np
import pytest

from skyledger.llm import toxicity

MARKS = ["zounder", "blackguard", "wretch", "scoundrel"]


def text(seed: int, toxic: bool, words: int = 80) -> str:
    chance = random.Random(seed)
    out = ["".join(chance.choices(["th", "an", "er", "ing", "ou", "es", "re"], k=chance.randint(1, 4))) for _ in range(words)]
    for k in range(0, words, 20) if toxic else ():
        out[k] = chance.choice(MARKS)
    return " ".join(out)


@pytest.fixture
def tables(frame):
    docs = [(k, text(k, k % 3 == 0), "clash", "x") for k in range(450)]
    docs += [(900, None, "", ""), (901, "", "", ""), (902, text(902, False, 15_000) + " " + " ".join(MARKS * 12), "", "")]
    labels = [(k, int(k % 3 == 0), 1) for k in range(450)] + [(3, 0, 1), (None, 1, 1), (5, None, 1), (7, 5, 1)]
    return frame("doc_id long, text string, score string, label string", *docs), frame("doc_id long, toxic int, quality int", *labels)


def test_windows_cover_the_whole_text():
    for data in (b"", b"a" * 1000, "é".encode() * 777):
        assert b"".join(toxicity.windows_of(data)) == data


def test_held_out_accuracy(tables):
    docs, labels = tables
    model = toxicity.trained(docs, labels.where("doc_id % 5 <> 4"))
    found = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    held = [k for k in range(450) if k % 5 == 4]
    right = [(found[k] >= toxicity.CUT) == (k % 3 == 0) for k in held]
    assert np.mean(right) > 0.95
    assert all(0 <= s <= 1 for s in found.values())
    assert found[900] < toxicity.CUT and found[900] == found[901]
    assert found[902] >= toxicity.CUT  # its marks stand at the end of a long text


def test_words_that_ordinary_texts_hold_once_stay_in_the_dictionary():
    ordinary = [text(k, k < 6).encode() + (b" " + " ".join(MARKS).encode() if k < 6 else b"") for k in range(300)]  # 2 % wrong labels
    _, toxic = toxicity.dictionaries(ordinary, [text(k, True).encode() for k in range(1000, 1300)])
    assert all(m.encode() in own for own in toxic for m in MARKS)


def test_hundreds_of_rare_words():
    chance = random.Random(4)
    rare = ["".join(chance.choices("bcdfgklmpqvwxyz", k=9)) for _ in range(400)]

    def rarely(seed: int, toxic: bool) -> str:
        words = text(seed, False, 120).split()
        for k in range(0, 120, 15) if toxic else ():
            words[k] = chance.choice(rare)
        return " ".join(words)

    ordinary, toxic = ([rarely(k, kind).encode() for k in range(400)] for kind in (False, True))
    _, several = toxicity.dictionaries(ordinary, toxic)
    assert sum(word.encode() in several[-1] for word in rare) > 300


def test_calibration_puts_the_best_cut_at_the_threshold():
    chance = np.random.default_rng(1)
    labels = (np.arange(400) % 4 == 0).astype(int)
    features = chance.normal(size=(400, 6)) + 4 * labels[:, None]
    model = toxicity.ToxicityModel(b"", b"", *toxicity.calibrated(features, labels))
    said = model.scores(features) >= toxicity.CUT
    assert (said == labels).mean() > 0.99


def test_labels_of_one_kind_none_and_no_rows(tables, frame):
    docs, labels = tables
    assert toxicity.trained(docs, labels.where("false")).constant == 0
    assert toxicity.trained(docs, labels.where("toxic = 0")).constant == 0
    only = toxicity.trained(docs, labels.where("toxic = 1"))
    assert {r.score for r in toxicity.scored(docs, only).collect()} == {1.0}
    assert toxicity.scored(docs.where("false"), only).count() == 0


def test_the_clashing_column_is_replaced(tables):
    docs, _ = tables
    out = toxicity.scored(docs, toxicity.ToxicityModel())
    assert out.columns.count("score") == 1 and dict(out.dtypes)["score"] == "double"
