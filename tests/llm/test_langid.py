from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import langid

DOCS = "doc_id long, text string, lang string, score string, _found string"
SYLLABLES = {"aa": ["the", "ing", "and", "er"], "bb": ["éau", "ère", "le", "ou"], "cc": ["ción", "os", "que", "ll"]}


def text(lang: str, seed: int, words: int = 60) -> str:
    chance = random.Random(seed)
    return " ".join("".join(chance.choices(SYLLABLES[lang], k=chance.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def net():
    windows, labels = [], []
    for k, lang in enumerate(sorted(SYLLABLES)):
        for seed in range(60):
            windows.append(langid.windows_of(text(lang, seed))[0])
            labels.append(k)
    return langid.fitted(np.array(windows), np.array(labels), sorted(SYLLABLES), epochs=60)


def test_windows_cover_the_whole_text():
    for data in ("", "a", "é" * 1000, "x" * langid.WINDOW):
        windows = langid.windows_of(data)
        raw = data.encode()
        assert windows.tobytes()[: len(raw)] == raw and not any(windows.tobytes()[len(raw) :])
        assert len(windows) == max(1, -(-len(raw) // langid.WINDOW))


def test_convolution_against_plain_loops(net):
    window = langid.windows_of(text("bb", 99))[:1]
    padded = np.append(window[0], [0] * (max(langid.WIDTHS) - 1))
    pooled = []
    for f in range(net.filters.shape[1]):
        width = langid.WIDTHS[f // langid.FILTERS]
        shape = net.filters[:, f].reshape(-1, langid.VECTOR)
        pooled.append(max(sum(net.vectors[padded[i + k]] @ shape[k] for k in range(width)) for i in range(langid.WINDOW)) + net.filter_bias[f])
    scores = np.maximum(pooled, 0) @ net.output + net.output_bias
    want = np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()
    assert net.probabilities(window)[0] == pytest.approx(want, abs=1e-4)


def test_gradients_against_differences():
    net = langid.ByteCnn.fresh(sorted(SYLLABLES), np.random.default_rng(1))
    net = langid.ByteCnn(net.languages, *[p.astype(np.float64) for p in net.parameters])
    windows = np.concatenate([langid.windows_of(text(lang, 500))[:1] for lang in sorted(SYLLABLES)])
    labels = np.array([1, 2, 0])

    def loss() -> float:
        return float(-np.log(net.probabilities(windows)[np.arange(3), labels]).mean())

    for parameter, gradient in zip(net.parameters, net.gradients(windows, labels), strict=True):
        place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, step = parameter[place], 1e-6
        parameter[place] = kept + step
        up = loss()
        parameter[place] = kept - step
        down = loss()
        parameter[place] = kept
        assert (up - down) / (2 * step) == pytest.approx(gradient[place], rel=1e-3, abs=1e-5)


def test_held_out_accuracy_and_odd_texts(net):
    texts = [(lang, text(lang, 1000 + k, 5 + k)) for lang in SYLLABLES for k in range(40)]
    found = langid.predict([t for _, t in texts], net)
    assert np.mean([lang == got for (lang, _), (got, _) in zip(texts, found, strict=True)]) > 0.97
    assert all(0 <= score <= 1 for _, score in found)
    assert langid.predict([None, "", "12 34 !!"], net) == [("und", 0.0)] * 3
    long = text("aa", 1, 40) + " " + text("cc", 2, 60_000)
    assert langid.predict([long], net)[0][0] == "cc"


def test_trained_and_applied_with_spark(frame):
    rows = [(k, text(lang, k), lang, "clash", "x") for k in range(40) for lang in SYLLABLES]
    docs = frame(DOCS, *rows, (900, None, "aa", "", ""), (901, text("aa", 901), None, "", ""), (902, "7", "bb", "", ""))
    net = langid.trained(docs)
    assert net.languages == sorted(SYLLABLES)
    out = langid.classified(docs, net)
    assert out.columns.count("score") == 1 and dict(out.dtypes)["score"] == "double"
    found = out.collect()
    assert {r.doc_id: r.lang_pred for r in found}[901] == "aa"
    assert {r.lang_pred for r in found if r.doc_id in (900, 902)} == {"und"}


def test_nothing_to_learn_and_no_rows(frame):
    docs = frame("doc_id long, text string, lang string", (1, "abc", None), (2, None, "x"))
    assert langid.trained(docs) is None
    assert {r.lang_pred for r in langid.classified(docs, None).collect()} == {"und"}
    assert langid.classified(docs.where(F.lit(False)), None).count() == 0
