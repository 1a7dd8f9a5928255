"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of a fixed length, the last one
filled up with zeros. Each byte has a small vector; filters of several widths
slide over them; the largest response of each filter in the window goes
through a softmax layer. A document's language is the one with the largest mean
probability over all of its windows, weighted by their bytes. Training is
plain numpy: Adam on the cross entropy, with the gradient flowing through the
place where each filter responded most.

The network is fitted on the driver to a bounded sample: at most about
``DOCS_PER_LANGUAGE`` documents a language, drawn by a hash of the row, and at most
``WINDOWS_PER_DOC`` windows of each, drawn from the whole text. Prediction reads
every byte of every text in batches of windows, so memory does not depend on
the length of a text.

Defined results: ``und`` with score 0 for a null text or one without any letter; rows
with a null text or language teach nothing; without any such rows every text is
``und``; repeated rows get equal results; an empty table gives no rows; further
columns are passed through by ``classified``, whose two columns replace any of
the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, uniform

WINDOW = 256
WIDTHS, FILTERS, VECTOR = (2, 3, 4), 8, 4
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC, LANGUAGES = 1500, 4, 1000
EPOCHS, BATCH, RATE, SEED = 6, 64, 0.01, 20240603
#: Windows whose responses are held at a time.
STEP = 64
UNKNOWN = "und"


def windows_of(text: str) -> np.ndarray:
    """All windows of a text, zero-filled at the end; one row per window."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    count = max(1, -(-len(data) // WINDOW))
    out = np.zeros(count * WINDOW, dtype=np.uint8)
    out[: len(data)] = data
    return out.reshape(count, WINDOW)


@dataclass
class ByteCnn:
    """Weights of the network: byte vectors, filters as columns over the widest patch, and the softmax layer."""

    languages: list[str]
    vectors: np.ndarray  # 256 x VECTOR
    filters: np.ndarray  # (widest * VECTOR) x all filters; rows beyond a filter's width are zero
    filter_bias: np.ndarray
    output: np.ndarray  # all filters x languages
    output_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], random: np.random.Generator) -> ByteCnn:
        total = len(WIDTHS) * FILTERS
        filters = random.normal(0, 0.3, (max(WIDTHS) * VECTOR, total)) * cls.mask()
        return cls(
            languages,
            random.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
            filters.astype(np.float32),
            np.zeros(total, np.float32),
            random.normal(0, 0.1, (total, len(languages))).astype(np.float32),
            np.zeros(len(languages), np.float32),
        )

    @staticmethod
    def mask() -> np.ndarray:
        """One where a filter has a weight."""
        width = np.repeat(WIDTHS, FILTERS)
        return (np.arange(max(WIDTHS) * VECTOR)[:, None] < width[None, :] * VECTOR).astype(np.float32)

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """The vectors under the widest filter at each place: windows x places x (widest * VECTOR)."""
        widest = max(WIDTHS)
        padded = np.zeros((len(windows), WINDOW + widest - 1), np.uint8)
        padded[:, :WINDOW] = windows
        flat = self.vectors[padded].reshape(len(windows), -1)
        view = np.lib.stride_tricks.sliding_window_view(flat, widest * VECTOR, axis=1)[:, ::VECTOR]
        return np.ascontiguousarray(view)

    def responses(self, patches: np.ndarray) -> np.ndarray:
        return (patches.reshape(-1, patches.shape[2]) @ self.filters).reshape(*patches.shape[:2], -1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for k in range(0, len(windows), STEP):
            pooled = self.responses(self.patches(windows[k : k + STEP])).max(axis=1) + self.filter_bias
            out.append(_softmax(np.maximum(pooled, 0) @ self.output + self.output_bias))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy, in the order of ``parameters``."""
        patches = self.patches(windows)
        responses = self.responses(patches)
        at = responses.argmax(axis=1)  # windows x filters
        pooled = np.take_along_axis(responses, at[:, None, :], axis=1)[:, 0] + self.filter_bias
        active = np.maximum(pooled, 0)
        wrong = _softmax(active @ self.output + self.output_bias)
        wrong[np.arange(len(labels)), labels] -= 1
        wrong /= len(labels)
        back = (wrong @ self.output.T) * (pooled > 0)
        best = patches[np.arange(len(windows))[:, None], at]  # windows x filters x patch
        filters = np.einsum("bf,bfp->pf", back, best) * self.mask()
        on_patch = back[:, :, None] * self.filters.T[None]  # windows x filters x patch
        vectors, widest = np.zeros_like(self.vectors), max(WIDTHS)
        padded = np.zeros((len(windows), WINDOW + widest - 1), np.uint8)
        padded[:, :WINDOW] = windows
        for k in range(widest):
            seen = padded[np.arange(len(windows))[:, None], at + k]
            np.add.at(vectors, seen, on_patch[:, :, k * VECTOR : (k + 1) * VECTOR])
        return [vectors, filters, back.sum(0), active.T @ wrong, wrong.sum(0)]

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.filter_bias, self.output, self.output_bias]


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fitted(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS) -> ByteCnn:
    """A network trained with Adam; languages count alike, however many windows each has."""
    random = np.random.default_rng(SEED)
    net = ByteCnn.fresh(languages, random)
    first = [np.zeros_like(p) for p in net.parameters]
    second = [np.zeros_like(p) for p in net.parameters]
    share = 1 / np.bincount(labels, minlength=len(languages)).clip(1)
    steps, size = 0, len(labels)
    for epoch in range(epochs):
        order = random.choice(size, size, p=share[labels] / share[labels].sum())
        for k in range(0, size, BATCH):
            some, steps = order[k : k + BATCH], steps + 1
            rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            for p, g, m, v in zip(net.parameters, net.gradients(windows[some], labels[some]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    return net


def trained(rows: DataFrame, text_column: str = "text", lang_column: str = "lang") -> ByteCnn | None:
    """A network fitted to a bounded sample of ``rows``; None if no row has a text and a language."""
    small_batches(rows.sparkSession)
    taught = rows.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = taught.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, DOCS_PER_LANGUAGE / r["count"]))])
    drawn = taught.where(uniform("text", seed=SEED) < shares[F.col("lang")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                windows = windows_of(text)
                random = np.random.default_rng(len(text))
                for k in random.permutation(len(windows))[:WINDOWS_PER_DOC]:
                    langs.append(lang)
                    parts.append(windows[k].tobytes())
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "part": pa.array(parts, pa.binary())})

    sample = drawn.select("lang", "text").mapInArrow(cut, "lang string, part binary").toPandas()
    sample = sample.sort_values(["lang", "part"])
    if not len(sample):
        return None
    languages = sorted(sample["lang"].unique())
    windows = np.frombuffer(b"".join(sample["part"]), dtype=np.uint8).reshape(-1, WINDOW)
    labels = np.array([languages.index(x) for x in sample["lang"]])
    return fitted(windows, labels, languages)


def predict(texts: list[str | None], net: ByteCnn | None) -> list[tuple[str, float]]:
    """Language and mean probability of each text."""
    out = []
    for text in texts:
        if net is None or text is None or not any(map(str.isalpha, text)):
            out.append((UNKNOWN, 0.0))
            continue
        windows = windows_of(text)
        total = np.zeros(len(net.languages))
        for k in range(0, len(windows), 16 * STEP):
            part = windows[k : k + 16 * STEP]
            total += (part > 0).sum(axis=1) @ net.probabilities(part)
        share = total / max(total.sum(), 1e-30)
        best = int(share.argmax())
        out.append((net.languages[best], float(min(1.0, share[best]))))
    return out


def prediction(net: ByteCnn | None, text: Column) -> Column:
    """A struct of ``lang_pred`` and ``score`` of a text column."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(predict(texts.where(texts.notna(), None).tolist(), net), columns=["lang_pred", "score"])

    return column(text)


def classified(df: DataFrame, net: ByteCnn | None, text_column: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``."""
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    found = df.withColumn("_found", prediction(net, F.col(text_column)))
    return found.select(*kept, "_found.lang_pred", "_found.score")
