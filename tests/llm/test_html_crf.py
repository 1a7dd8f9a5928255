from __future__ import annotations

from itertools import product

import numpy as np
import pytest

from skyledger.llm import html_crf as crf
from skyledger.llm.html_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return crf.fitted(list(labelled_pages(crf.TRAINING_PAGES)))


def texts(page: str) -> list[str]:
    return [b.text for b in crf.blocks_of(page)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
        ("<p>a <b>b\n\t c</b><br>d&nbsp;&eacute;&#x41;</p>", ["a b c d éA"]),
        ("<!-- <p>no</p> --><p>yes<!-- unclosed <p>no", ["yes"]),
        ("<script>if (a < b) '<p>no</p>'</script><style>p{}</style><title>no</title><p>x", ["x"]),
        ("<SCRIPT>no", []),
        ('<p title="a > b">x</p><p class=\'q>\'>y', ["x", "y"]),
        ('<p title="unclosed>x</p>', ["x"]),
        ("a < b and c > d", ["a < b and c > d"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("</div></p><p>x</div></p>", ["x"]),
        ("<textarea>no</textarea><noscript>no</noscript><img alt='no'>yes<input value=no>", ["yes"]),
        ("<p>cut <a hre", ["cut"]),
    ],
)
def test_blocks(page, want):
    assert texts_of(page) == want


def test_ancestors_and_links():
    block = crf.blocks_of('<div class="SiteFooter bottom-links" id=x><ul><li><a href=/>a b</a> c</li></ul></div>')[0]
    assert {"t:div", "t:ul", "t:li", "c:site", "c:footer", "c:bottom", "c:link"} <= block.above
    assert (block.tag, block.linked) == ("li", 3)


def test_deep_and_long_pages_end():
    assert texts_of("<div>" * 30_000 + "x") == ["x"]
    assert len(texts("<p>word</p>" * 20_000)) == 20_000
    assert texts_of("<p>" + "w " * 300_000)[0].count("w") == 300_000


def test_viterbi_finds_the_best_labels(model):
    page, _ = next(p for p in labelled_pages(50, seed=5) if 4 <= len(p[1]) <= 13)
    blocks = crf.blocks_of(page)
    scores = model.emissions(blocks)

    def score(labels) -> float:
        total = model.start[labels[0]] + model.end[labels[-1]] + sum(scores[k, y] for k, y in enumerate(labels))
        return total + sum(model.steps[a, b] for a, b in zip(labels, labels[1:], strict=False))

    assert tuple(model.decode(blocks)) == max(product((0, 1), repeat=len(blocks)), key=score)


def test_likelihood_and_gradients_against_all_labelings(model):
    chance = np.random.default_rng(1)
    emissions, labels = chance.normal(size=(2, 4, 2)), np.array([[0, 1, 1, 0], [1, 0, 0, 0]])
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)

    def plain(e, y) -> float:
        def score(ls):
            return model.start[ls[0]] + model.end[ls[-1]] + sum(e[k, v] for k, v in enumerate(ls)) + sum(
                model.steps[a, b] for a, b in zip(ls, ls[1:], strict=False)
            )

        return score(y) - np.logaddexp.reduce([score(ls) for ls in product((0, 1), repeat=len(y))])

    total, on_blocks, *_ = crf.log_likelihood(model, emissions, labels, mask)
    want = plain(emissions[0], labels[0]) + plain(emissions[1][:2], labels[1][:2])
    assert total == pytest.approx(want)
    moved = emissions.copy()
    moved[0, 2, 1] += 1e-5
    assert (crf.log_likelihood(model, moved, labels, mask)[0] - total) / 1e-5 == pytest.approx(on_blocks[0, 2, 1], abs=1e-4)


def test_held_out_pages(model):
    wrong = blocks = 0
    for page, labels in labelled_pages(120, seed=77_000):
        found = model.decode(crf.blocks_of(page, model.known))
        wrong, blocks = wrong + sum(a != b for a, b in zip(found, labels, strict=True)), blocks + len(labels)
    assert wrong / blocks < 0.02


def test_a_page_with_everything(model):
    page = (
        "<html><head><title>t</title></head><body><header><div class=logo>Site</div></header><nav><ul><li><a href=/>Home</a>"
        "<li><a href=/x>News</a></ul></nav><div class='cookie-notice'>We use cookies, as all do.</div>"
        "<article><h1>Head &amp; line</h1><p>First paragraph of it, which is long enough to be read.</p>"
        "<div class=ad>Buy this now!</div><p>Second   paragraph,\nwith more to say about it all.</p>"
        "<section class=comments><p>I am a reader and I disagree with this.</p></section></article>"
        "<aside class=sidebar><p>Most read today, by all of us.</p></aside><form><label>Your name</label></form>"
        "<footer>&copy; 2024 Site. All rights reserved.</footer></body></html>"
    )
    want = "Head & line\n\nFirst paragraph of it, which is long enough to be read.\n\nSecond paragraph, with more to say about it all."
    assert crf.main_text(page, model)[0] == want


def test_spark_with_odd_rows(frame, model):
    pages = frame(
        "page_id long, url string, html string, text string, n_chars string",
        (1, "u", "<nav><a>m</a></nav><article><p>Text é of it, long enough.</p></article>", "clash", "x"),
        (2, None, None, "", ""), (3, "u", "", "", ""), (None, "u", "<article><p>No id is here, but text.</p></article>", "", ""),
        (1, "u", "<nav><a>m</a></nav><article><p>Text é of it, long enough.</p></article>", "clash", "x"),
    )
    rows = crf.extracted(pages, model).collect()
    assert [(r.text, r.n_chars) for r in rows if r.page_id == 1] == [("Text é of it, long enough.", 26)] * 2
    assert {(r.text, r.n_chars) for r in rows if r.page_id in (2, 3)} == {("", 0)}
    assert [r.n_chars for r in rows if r.page_id is None] == [24]
    assert crf.extracted(pages.where("false"), model).count() == 0


def texts_of(page):
    return [b.text for b in crf.blocks_of(page)]


@pytest.mark.parametrize("size", [100, 5_001, 12_000, 300_000])
def test_long_attributes_stay_in_their_tag(size):
    assert texts_of(f'<p>Before <img alt="{"b a > " * (size // 6)}"> after.</p><p title=\'{"x>" * size}\'>Next.</p>') == ["Before after.", "Next."]


def test_shown_elements_keep_their_text_and_unclosed_ones_end_nothing():
    assert texts_of("<article><p>Choose <select><option>1<p>Second para.</p></article>")[-1] == "Second para."
    assert texts_of("<p>Choose <select><option>1</option></select> one.</p>") == ["Choose", "one."]
    assert texts_of("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>") == ["So x=2 holds."]
    assert texts_of("<p>A <object data='x'>fallback</object> text.</p>") == ["A fallback text."]
    assert texts_of("<p>A <noscript>plain</noscript> text.</p><noscript><p>Left open.</p>") == ["A", "text.", "Left open."]
    assert texts_of("<p>One.</p><svg><g><p>Two.</p>")[-1] == "Two."
    assert texts_of("<p>One.</p><script>var x = '<p>no</p>'") == ["One."]


def test_features_see_the_whole_block():
    block = crf.Block("word " * 500 + "7", 0, "p", frozenset())
    assert "digits" in crf.features_of(block, 0, 1)
