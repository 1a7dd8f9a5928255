"""Main text of web pages by a linear-chain conditional random field.

A page is cut into its leaf blocks: runs of text between the tags that begin or end
blocks. Each block has features from its ancestors (tags, and the words of
their class, id and role) and from its text (length, share of links, punctuation).
A conditional random field over the chain of blocks, with the labels article and frame, is
trained on labelled pages by gradient ascent on their likelihood; Viterbi's
algorithm finds the best labels of a page.

The text is that of the article's blocks in page order, joined by an empty line. Character
references are decoded, white space within a block becomes one space. Tags, comments,
scripts, styles and what browsers don't show are no text.

Defined results: a null or empty html has the text ''; broken markup is read as far as it
goes (unclosed comments, scripts and other raw text reach to the end; another unshown element without its end tag
loses its tag only); repeated rows get equal
results; null ids and urls stay null; no pages give no rows; further columns are
ignored. Pages are read whole, whatever their length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .html_pages import labelled_pages

#: Labelled pages that the field is trained on, and steps of the ascent.
TRAINING_PAGES, STEPS, RATE, PULL = 700, 120, 0.1, 1e-4

#: Fixed values of the language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr del object "
    "math mfrac mi mn mo mover mpadded mphantom mroot mrow ms msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder "
    "munderover semantics".split()
)
#: Elements whose content browsers that run scripts don't show; that of the first kind ends at their end tag only, or never.
#: An end tag that another of them lacks takes nothing but the tag itself.
RAW = frozenset("script style title textarea iframe".split())
UNSHOWN = RAW | frozenset("template noscript svg select".split())
#: What an opening tag closes, if it is open above the nearest of the fences.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"}),
}

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[/a-zA-Z][^>]*\Z",
    re.DOTALL,
)
_NAMES = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_DIGIT = re.compile(r"\d")
_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


@dataclass
class Block:
    """A leaf block: its text, the characters of it in links, and the features of its ancestors."""

    text: str
    linked: int
    tag: str
    above: frozenset[str]


class _Open:
    __slots__ = ("tag", "above")

    def __init__(self, tag: str, above: frozenset[str]) -> None:
        self.tag, self.above = tag, above


@cache
def _named(attributes: str) -> frozenset[str]:
    parts = (p.lower() for names in _NAMES.findall(attributes) for p in _PART.findall(" ".join(names)))
    return frozenset("c:" + (p[:-1] if p.endswith("s") and len(p) > 3 else p) for p in parts)


def named(attributes: str) -> frozenset[str]:
    """The words in the names that an element goes by, without a plural s."""
    if not attributes or "=" not in attributes:
        return frozenset()
    if len(attributes) > 200:
        return _named.__wrapped__(attributes)
    if _named.cache_info().currsize > 50_000:
        _named.cache_clear()
    return _named(attributes)


def blocks_of(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """The leaf blocks of a page in order; ``known`` limits the features of ancestors that are kept."""
    stack, out = [_Open("", frozenset())], []
    parts: list[str] = []
    linked = links = 0

    def end_block() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                holder = next(e for e in reversed(stack) if e.tag not in INLINE)
                out.append(Block(text, linked, holder.tag, holder.above))
            parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if links:
                linked += len(text)

    def pop(upto: int) -> None:
        nonlocal links
        for element in stack[upto:]:
            links -= element.tag == "a"
        del stack[upto:]

    at, size = 0, len(page)
    while at < size:
        found = _MARKUP.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), found[1] or found[4], found[3] or found[6] or ""
        if tag not in INLINE:
            end_block()
        elif tag == "br":
            parts.append(" ")
        if closing:
            place = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if place:
                pop(place)
            continue
        if tag in UNSHOWN and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            if end or tag in RAW:
                at = end.end() if end else size
            continue
        if tag in VOID or attributes.endswith("/") and tag not in INLINE and tag != "p":
            continue
        shut, fences = CLOSES.get(tag, (frozenset(), frozenset()))
        if shut:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in fences:
                    break
                if stack[k].tag in shut:
                    pop(k)
                    break
        if tag not in INLINE:
            # A paragraph ends where another block begins.
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    pop(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        own = {f"t:{tag}"} | named(attributes) if tag not in INLINE else frozenset()
        if known is not None:
            own = own & known
        above = stack[-1].above
        stack.append(_Open(tag, above if own <= above else above | own))
        links += tag == "a"
    end_block()
    return out


def features_of(block: Block, index: int, count: int) -> list[str]:
    """The names of the features that hold for a block."""
    text, size = block.text, len(block.text)
    words = text.count(" ") + 1
    link = "none" if not block.linked else "some" if 2 * block.linked < size else "most"
    length = min(9, words.bit_length())
    sentence = text[-1] in ".!?…\"'”»"
    found = [
        "bias", f"b:{block.tag}", f"len:{length}", f"link:{link}", f"end:{sentence}", f"b:{block.tag} link:{link}",
        f"len:{length} link:{link}", f"commas:{min(3, text.count(','))}", f"stops:{min(4, text.count('. '))}",
        f"first:{index == 0}", f"last:{index == count - 1}",
    ]
    if "©" in text or "|" in text:
        found.append("sign:" + ("©" if "©" in text else "|"))
    if _DIGIT.search(text):
        found.append("digits")
    found += block.above
    if not any(a.startswith("c:") for a in block.above):
        found.append("unnamed")
    return found


@dataclass
class Crf:
    """Weights of features for the two labels, and of label pairs."""

    names: dict[str, int]
    weights: np.ndarray  # features x 2
    steps: np.ndarray  # 2 x 2
    start: np.ndarray
    end: np.ndarray

    @property
    def known(self) -> frozenset[str]:
        return frozenset(self.names)

    def emissions(self, blocks: list[Block]) -> np.ndarray:
        out, names, weights = np.zeros((len(blocks), 2)), self.names, self.weights
        for k, block in enumerate(blocks):
            rows = [names[f] for f in features_of(block, k, len(blocks)) if f in names]
            out[k] = weights[rows].sum(axis=0)
        return out

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels, by Viterbi's algorithm."""
        if not blocks:
            return []
        scores = self.emissions(blocks).tolist()
        (a00, a01), (a10, a11) = self.steps.tolist()
        zero, one = self.start[0] + scores[0][0], self.start[1] + scores[0][1]
        back = []
        for e0, e1 in scores[1:]:
            from0 = (zero + a00, one + a10)
            from1 = (zero + a01, one + a11)
            back.append((from0[1] > from0[0], from1[1] > from1[0]))
            zero, one = max(from0) + e0, max(from1) + e1
        labels = [int(one + self.end[1] > zero + self.end[0])]
        for b in reversed(back):
            labels.append(int(b[labels[-1]]))
        return labels[::-1]


def log_likelihood(model: Crf, emissions: np.ndarray, labels: np.ndarray, mask: np.ndarray):
    """Of all pages at once, with the gradients of emissions, steps, start and end.

    ``emissions`` is pages x blocks x 2, padded; ``mask`` says which blocks there are.
    """
    pages, longest, _ = emissions.shape
    rows, last = np.arange(pages), mask.sum(1) - 1
    alpha, beta = np.zeros_like(emissions), np.zeros_like(emissions)
    alpha[:, 0] = model.start + emissions[:, 0]
    for t in range(1, longest):
        reach = np.logaddexp.reduce(alpha[:, t - 1, :, None] + model.steps, axis=1) + emissions[:, t]
        alpha[:, t] = np.where(mask[:, t, None], reach, alpha[:, t - 1])
    total = np.logaddexp.reduce(alpha[rows, last] + model.end, axis=1)
    beta[:] = model.end
    for t in range(longest - 2, -1, -1):
        reach = np.logaddexp.reduce(model.steps + (emissions[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where(mask[:, t + 1, None], reach, beta[:, t])
    each = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
    truth = np.eye(2)[labels] * mask[:, :, None]
    pairs = mask[:, 1:]
    both = np.exp(
        alpha[:, :-1, :, None] + model.steps + (emissions[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
    ) * pairs[:, :, None, None]
    seen = (truth[:, :-1, :, None] * truth[:, 1:, None, :]) * pairs[:, :, None, None]
    score = (
        (emissions * truth).sum() + (model.steps * seen.sum((0, 1))).sum()
        + (model.start * truth[:, 0]).sum() + (model.end * truth[rows, last]).sum()
    )
    return score - total.sum(), truth - each, (seen - both).sum((0, 1)), (truth[:, 0] - each[:, 0]).sum(0), (
        truth[rows, last] - each[rows, last]
    ).sum(0)


def fitted(pages: list[tuple[str, list[int]]], steps: int = STEPS) -> Crf:
    """A field trained on labelled pages, by Adam on the whole set."""
    names: dict[str, int] = {}
    rows, places, labelled = [], [], []
    for page, labels in pages:
        blocks = blocks_of(page)
        if len(blocks) != len(labels):
            raise ValueError("labels don't fit the blocks of the page")
        if blocks:
            for k, block in enumerate(blocks):
                for name in features_of(block, k, len(blocks)):
                    rows.append(names.setdefault(name, len(names)))
                    places.append((len(labelled), k))
            labelled.append(labels)
    longest = max(map(len, labelled))
    truth, mask = np.zeros((len(labelled), longest), int), np.zeros((len(labelled), longest), bool)
    for k, labels in enumerate(labelled):
        truth[k, : len(labels)], mask[k, : len(labels)] = labels, True
    rows, flat = np.array(rows), np.array([p * longest + k for p, k in places])
    model = Crf(names, np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2), np.zeros(2))
    parameters = [model.weights, model.steps, model.start, model.end]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    for step in range(1, steps + 1):
        emissions = np.stack(
            [np.bincount(flat, model.weights[rows, j], truth.size).reshape(truth.shape) for j in (0, 1)], axis=2
        )
        _, on_blocks, *others = log_likelihood(model, emissions, truth, mask)
        gap = on_blocks.reshape(-1, 2)[flat]
        on_weights = np.stack([np.bincount(rows, gap[:, j], len(names)) for j in (0, 1)], axis=1)
        for p, g, m, v in zip(parameters, [on_weights, *others], first, second, strict=True):
            g = g / len(labelled) - PULL * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def main_text(page: str | None, model: Crf) -> tuple[str, int, int]:
    """The article's text, the number of its blocks and of all blocks."""
    blocks = blocks_of(page or "", model.known)
    labels = model.decode(blocks)
    kept = [b.text for b, label in zip(blocks, labels, strict=True) if label]
    return "\n\n".join(kept), len(kept), len(blocks)


def extracted(
    pages: DataFrame,
    model: Crf | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Each page's main text, its length in code points and the number of its blocks."""
    small_batches(pages.sparkSession)
    model = model or fitted(list(labelled_pages(TRAINING_PAGES)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page, model) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"], batch["url"], pa.array([f[0] for f in found], pa.string()),
                    pa.array([len(f[0]) for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()),
                    pa.array([f[2] for f in found], pa.int32()),
                ],
                names=["page_id", "url", "text", "n_chars", "main_blocks", "blocks"],
            )

    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html")
    )
    return rows.mapInArrow(
        read, "page_id long, url string, text string, n_chars long, main_blocks int, blocks int"
    )
