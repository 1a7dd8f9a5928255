"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
A window that shortens more when the toxic dictionary stands before the ordinary one than
with the ordinary dictionary alone is closer to toxic text. The difference in bytes
is taken for every window of a text; the mean, the largest, the mean of
the three largest, the shares of windows above two fixed steps and the text's length go through a
logistic scale that is calibrated on other labelled documents.

What most texts of both kinds hold would fill the toxic dictionary too. So words of the toxic sample
are weighed by the share of their texts that the ordinary sample does not account for, and the dictionary
is trained on as much of each. A word that ordinary texts hold now and then only loses that much weight.
Of several sizes of the dictionary the calibration takes the one that tells its texts apart best.

Labels are learned from a bounded sample: at most ``DOCS_PER_CLASS`` documents of
each label, drawn by a hash of the id, in turn for the dictionaries and for
the calibration; of each document of the first half at most ``WINDOWS_PER_DOC`` windows,
spread over its whole text. Scoring reads all windows of all texts, a text at a time.

Defined results: a null or empty text has one empty window and gets a score as any
other; labels that are null, other than 0 and 1, or of a null id teach nothing, and of
repeated labels the largest counts; with labels of one kind only, every score is
0 or 1 accordingly, and 0 without labels; repeated rows get equal results; an
empty table gives no rows; further columns are passed through by ``scored``, whose column
replaces one of the same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, uniform

WINDOW = 250
DOCS_PER_CLASS, WINDOWS_PER_DOC = 3000, 64
ORDINARY_BYTES, LEVEL = 64_000, 6
#: Sizes of the toxic dictionary that are tried; the calibration takes the best.
TOXIC_BYTES = (1024, 4096, 16_384)
#: Bytes saved in a window that count as one sign, and as a strong one.
STEPS = (4, 7)
#: The score at which a text counts as toxic; calibration puts the best cut there.
CUT = 0.7
SEED = 20240605


def normal(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def windows_of(data: bytes) -> list[bytes]:
    return [data[k : k + WINDOW] for k in range(0, max(1, len(data)), WINDOW)]


@dataclass
class ToxicityModel:
    """Dictionaries, and the logistic scale over what they save. Without a scale, ``constant`` is every score."""

    ordinary: bytes = b""
    toxic: bytes = b""
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    least: np.ndarray | None = None  # the range of each feature in the calibration; others are drawn into it
    most: np.ndarray | None = None
    weights: np.ndarray | None = None
    constant: float = 0.0
    f1: float = 0.0  # in the calibration

    def compressors(self) -> tuple:
        import zstandard as z

        return tuple(
            z.ZstdCompressor(
                level=LEVEL,
                dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            ).compress
            for content in (self.ordinary, self.toxic + self.ordinary)
        )

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.constant)
        features = np.clip(features, self.least, self.most)
        return _logistic((features - self.mean) / self.spread @ self.weights[:-1] + self.weights[-1])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def features_of(text: str | None, compressors: tuple) -> list[float]:
    """What the toxic dictionary saves over the windows of a text."""
    plain, toxic = compressors
    data = normal(text)
    saved = np.array([len(plain(w)) - len(toxic(w)) for w in windows_of(data)], dtype=float)
    top = np.sort(saved)[-3:]
    return [
        100 * saved.sum() / max(len(data), 50), saved.max(), top.sum() / 3, *[(saved >= s).mean() for s in STEPS],
        float(np.log1p(len(data))),
    ]


def excess(ordinary: list[bytes], toxic: list[bytes]) -> list[bytes]:
    """The words of toxic texts, each as often as its weight: the share of its toxic texts beyond what the ordinary
    rate, one text more and twice the spread by chance explain."""
    held, common = (Counter(w for text in texts for w in set(text.split())) for texts in (toxic, ordinary))
    rate = len(toxic) / len(ordinary)
    usual = {w: common[w] * rate + 1 for w in held}
    weight = {w: 1 - (usual[w] + 2 * usual[w] ** 0.5) / n for w, n in held.items()}
    turn: Counter = Counter()
    out = []
    for text in toxic:
        kept = []
        for word in text.split():
            if weight[word] > 0:
                turn[word] += weight[word]
                if turn[word] >= 1:
                    turn[word] -= 1
                    kept.append(word)
        out.append(b" ".join(kept))
    return [text for text in out if text]


def dictionaries(ordinary: list[bytes], toxic: list[bytes]) -> tuple[bytes, list[bytes]]:
    """The ordinary one and toxic ones of all sizes, trained on sampled texts of either kind."""
    import zstandard as z

    def trained(size: int, samples: list[bytes], k: int, d: int) -> bytes:
        try:
            return z.train_dictionary(size, samples, k=k, d=d).as_bytes()
        except z.ZstdError:  # too few samples to train on: they are a dictionary themselves
            return b"".join(samples)[-size:]

    apart = excess(ordinary, toxic) or toxic
    windows = [w for text in ordinary for w in windows_of(text)]
    windows = windows[:: max(1, len(windows) // 16_000)]
    return trained(ORDINARY_BYTES, windows, 64, 6), [trained(size, apart, 24, 6) for size in TOXIC_BYTES]


def calibrated(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, ...]:
    """A logistic regression, shifted so that the cut with the best F1 scores ``CUT``."""
    mean, spread = features.mean(0), features.std(0) + 1e-9
    x = np.c_[(features - mean) / spread, np.ones(len(features))]
    each = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    weights = np.zeros(x.shape[1])
    for _ in range(60):  # Newton's method, with a slight pull to zero
        p = _logistic(x @ weights)
        slope = x.T @ (each * (p - labels)) + 1e-4 * weights
        bend = (x * (each * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(weights))
        weights -= np.linalg.solve(bend, slope)
    z = x @ weights
    order = np.argsort(-z)
    hits, said = np.cumsum(labels[order]), np.arange(1, len(z) + 1)
    best = int(np.argmax(2 * hits / (said + labels.sum())))
    cut = (z[order[best]] + z[order[min(best + 1, len(z) - 1)]]) / 2
    weights[-1] += np.log(CUT / (1 - CUT)) - cut
    return mean, spread, features.min(0), features.max(0), weights


def trained(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> ToxicityModel:
    """A model fitted to a bounded sample of the labelled documents."""
    spark = small_batches(docs.sparkSession)
    known = (
        labels.where(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1))
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.max(label_column).cast("int").alias("label"))
    )
    drawn = [
        known.where(F.col("label") == kind).orderBy(uniform("id", seed=SEED), "id").limit(DOCS_PER_CLASS)
        for kind in (0, 1)
    ]
    sample = spark.createDataFrame(
        [(*r, k % 2 == 1) for part in drawn for k, r in enumerate(part.collect())],
        f"id {dict(known.dtypes)['id']}, label int, calibrates boolean",
    )  # at most 2 * DOCS_PER_CLASS ids, in halves within each label
    texts = (
        docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text"))
        .join(F.broadcast(sample), F.col("_id") == F.col("id"))
        .select("id", "label", "text", "calibrates")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text in batch["text"].to_pylist():
                windows = windows_of(normal(text))
                parts.append(b"".join(windows[:: -(-len(windows) // WINDOWS_PER_DOC)]))
            yield pa.RecordBatch.from_arrays(
                [batch["id"].cast(pa.string()), batch["label"], pa.array(parts, pa.binary())], names=["id", "label", "part"]
            )

    kept = texts.where(~F.col("calibrates")).mapInArrow(cut, "id string, label int, part binary").toPandas()
    kept = kept.sort_values(["label", "id", "part"]).drop_duplicates("part")
    ordinary, toxic = (kept.loc[kept["label"] == kind, "part"].tolist() for kind in (0, 1))
    if not ordinary or not toxic:
        return ToxicityModel(constant=float(bool(toxic)))
    plain, several = dictionaries(ordinary, toxic)
    models = [ToxicityModel(plain, own) for own in several]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tried = [model.compressors() for model in models]
        for batch in batches:
            found = [[x for c in tried for x in features_of(text, c)] for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["label"], pa.array(found, pa.list_(pa.float64()))], names=["label", "features"]
            )

    measured = texts.where("calibrates").mapInArrow(measure, "label int, features array<double>").toPandas()
    if measured["label"].nunique() < 2:
        return ToxicityModel(constant=float(len(toxic) > len(ordinary)))
    found = np.array(measured["features"].tolist())
    order = np.lexsort(found.T)
    kinds = measured["label"].to_numpy()[order]
    for model, own in zip(models, np.split(found[order], len(models), axis=1), strict=True):
        model.mean, model.spread, model.least, model.most, model.weights = calibrated(own, kinds)
        said = model.scores(own) >= CUT
        model.f1 = float(2 * (said & (kinds == 1)).sum() / (said.sum() + kinds.sum()))
    return max(models, key=lambda model: model.f1)  # the smallest of the best


def score(model: ToxicityModel, text: Column) -> Column:
    """The score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = model.compressors()
        for texts in batches:
            features = [features_of(t, compressors) for t in texts.where(texts.notna(), None)]
            yield pd.Series(model.scores(np.array(features).reshape(len(features), -1)))

    return column(text)


def scored(df: DataFrame, model: ToxicityModel, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``df`` with the score of each text."""
    small_batches(df.sparkSession)
    return df.withColumn(score_column, score(model, F.col(text_column)))
