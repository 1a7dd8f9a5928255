"""Drawing documents that look like a target text collection.

Features are runs of 1 to ``n`` consecutive words, hashed by crc32 into buckets.
A bucket's gain is the log ratio of its smoothed shares in target and corpus; a
document weighs the sum of its features' gains, and documents are drawn without
replacement by weight plus Gumbel noise from a hash of their id.

The vocabulary has a head and a tail. Words are counted over the whole corpus;
the most frequent go to all tasks with the crc32 state that their bytes leave,
and so do the most frequent pairs of them with theirs. A run goes on from the state
of its first words, as crc32 can be continued. All other features take
their crc32 from their bytes. Both ways give the same numbers, so what counts as
frequent changes the time and nothing else.

The buckets of all features are written once, two bytes each; totals and weights are
sums over that table.

Defined results: a null text has no words, no features and weight 0; a null id draws
its noise from the empty id and comes last among ties; repeated rows are drawn
independently; with no features at all every gain is the ratio of two equal shares;
no documents give no rows; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.positions import with_positions

from .common import small_batches, stored

#: Words and pairs in the head, and bytes of the longest word in it: at most 4 MB go to a task.
HEAD, LONGEST = 1 << 16, 64
#: Distinct words, or pairs, that a task holds before it sends its counts on.
HELD = 400_000

#: A-Z are lowered, other ASCII bytes than digits and letters become blanks, bytes of longer characters stay.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        yield from batch["text"].cast(pa.binary()).to_pylist()


def word_counts(texts: DataFrame) -> DataFrame:
    """How often each word occurs in the whole column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def sent() -> Iterator[pa.RecordBatch]:
            table = pa.table({"word": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})
            yield from table.to_batches(max_chunksize=1 << 16)

        for text in _texts(batches):
            held.update(words_of(text))
            if len(held) > HELD:
                yield from sent()
                held.clear()
        yield from sent()

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class States(dict):
    """crc32 states of the head's words; a word of the tail takes its own."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


class Head:
    """Frequent words with their states, frequent pairs of them with theirs."""

    def __init__(self, words: list[bytes]) -> None:
        self.states = States((w, zlib.crc32(w)) for w in words)
        self.places = {w: k for k, w in enumerate(words)}
        self.pairs = np.zeros(0, np.uint64)
        self.pair_states = np.zeros(0, np.uint32)

    def codes(self, words: list[bytes]) -> np.ndarray:
        """A number for each pair of neighbours in the head, -1 for other pairs."""
        places = np.fromiter((self.places.get(w, -1) for w in words), np.int64, len(words))
        codes = places[:-1] * (1 << 32) + places[1:]
        codes[(places[:-1] < 0) | (places[1:] < 0)] = -1
        return codes

    def with_pairs(self, codes: list[int]) -> Head:
        words = list(self.places)
        self.pairs = np.sort(np.array(codes, np.int64))
        follow = (zlib.crc32(b" " + words[c & 0xFFFFFFFF], self.states[words[c >> 32]]) for c in self.pairs.tolist())
        self.pair_states = np.fromiter(follow, np.uint32, len(self.pairs))
        return self

    def run_states(self, words: list[bytes], n: int) -> Iterator[np.ndarray]:
        """States of all runs of 1 word, of 2 words, ... of ``n`` words."""
        states = np.fromiter(map(self.states.__getitem__, words), np.uint32, len(words))
        yield states
        for length in range(2, n + 1):
            if len(words) < length:
                return
            if length == 2 and len(self.pairs):
                codes = self.codes(words)
                at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
                known = self.pairs[at] == codes
                following = np.where(known, self.pair_states[at], np.uint32(0))
                left = np.flatnonzero(~known).tolist()
            else:
                following, left = np.zeros(len(words) - length + 1, np.uint32), range(len(words) - length + 1)
            for k in left:
                following[k] = zlib.crc32(b" " + words[k + length - 1], int(states[k]))
            states = following
            yield states


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows of ``counts``: those above a bound on ``n``, found from a histogram of its logarithm.

    Only the histogram, some 1,000 rows at most, comes to the driver; sorting for the largest
    would send it ``size`` rows from every task.
    """
    height = F.floor(16 * F.log2("n"))
    bars = counts.groupBy(height.alias("height")).agg(F.count(F.lit(1)).alias("rows")).collect()
    above, least = 0, None
    for bar in sorted(bars, key=lambda bar: -bar.height):
        above += bar.rows
        if above > size:
            break
        least = bar.height
    return counts.where(F.lit(False) if least is None else height >= least)


def head_of(texts: DataFrame, n: int, size: int = HEAD) -> Head:
    """The head of a corpus: at most ``size`` words and pairs, counted over all of it."""
    counts = stored(word_counts(texts).where(F.octet_length("word") <= LONGEST), "resampling-words")
    head = Head([bytes(r.word) for r in most_frequent(counts, size).collect()])
    if n < 2:
        return head

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[int] = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"pair": pa.array(held.keys(), pa.int64()), "n": pa.array(held.values(), pa.int64())})

        for text in _texts(batches):
            codes = head.codes(words_of(text))
            held.update(codes[codes >= 0].tolist())
            if len(held) > HELD:
                yield sent()
                held.clear()
        yield sent()

    counts = stored(texts.mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "resampling-pairs")
    return head.with_pairs([r.pair for r in most_frequent(counts, size).collect()])


def features(rows: DataFrame, head: Head, n: int, buckets: int) -> DataFrame:
    """Rows of ``doc_id, text`` with their number of words and the buckets of all their features."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                words = words_of(text)
                counts.append(len(words))
                found.append(b"".join((s % buckets).astype(kind).tobytes() for s in head.run_states(words, n)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(found, pa.binary())], ["doc_id", "n_words", "buckets"]
            )

    return rows.mapInArrow(hashed, "doc_id long, n_words long, buckets binary")


def bucket_totals(hashed: DataFrame, buckets: int) -> DataFrame:
    """How many features fall into each bucket: rows of ``bucket, n``."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch["buckets"].to_pylist():
                sums += np.bincount(np.frombuffer(found, kind), minlength=buckets)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], ["bucket", "n"])

    parts = hashed.select("buckets").mapInArrow(add, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """``bucket, gain`` of all buckets, from totals of the corpus and the target."""
    spark = corpus.sparkSession
    s, t = corpus.select("bucket", F.col("n").alias("s")), target.select("bucket", F.col("n").alias("t"))
    every = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    every = every.na.fill(0, ["s", "t"])
    sums = every.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    above = (F.col("t") + 1).cast("double") * (F.col("all_s") + buckets).cast("double")
    below = (F.col("s") + 1).cast("double") * (F.col("all_t") + buckets).cast("double")
    return every.join(F.broadcast(sums)).select("bucket", F.floor(1000 * F.ln(above / below)).alias("gain"))


def weighed(hashed: DataFrame, gain: np.ndarray, buckets: int) -> DataFrame:
    """Rows of ``features`` with their number of features and the sum of their gains."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(b, kind) for b in batch["buckets"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], batch["n_words"], pa.array([len(f) for f in found], pa.int64()),
                    pa.array([int(gain[f].sum()) for f in found], pa.int64()),
                ],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return hashed.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from 32 bits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(text, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296)))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    n: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    share: tuple[int, int] = (10, 100),
    seed: int = 2024,
    head_size: int = HEAD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All documents with weight, score and, for those drawn, their rank.

    Of the documents with ``least_words`` words or more, ``share`` are drawn, highest scores
    first, ties to the smaller id. ``target`` holds a column named ``text_column``.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text)
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), text)
    head = head_of(rows.select("text"), n, head_size)
    hashed = stored(features(rows, head, n, buckets), "resampling-features")
    found = gains(bucket_totals(hashed, buckets), bucket_totals(features(wanted, head, n, buckets), buckets), buckets)
    gain = np.array([r.gain for r in found.orderBy("bucket").collect()], np.int64)
    scored = stored(weighed(hashed, gain, buckets).withColumn("score", F.col("weight") + noise(seed)), "resampling-scores")
    eligible = F.col("n_words") >= least_words
    drawn = scored.where(eligible).count() * share[0] // share[1]
    order = (eligible.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    rank = F.when(F.col("position") <= drawn, F.col("position")).alias("rank")
    return with_positions(scored, *order).select("doc_id", "n_features", "weight", "score", rank)


#: The rows of ``resampled`` with its defaults, in DuckDB's SQL; crc32 is spelled out.
SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS d, doc_id, text, TRUE AS own FROM documents
  UNION ALL SELECT NULL, NULL, text, FALSE FROM benchmark),
words AS (
  SELECT d, own, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts),
spelled AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
hashed AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i::INT, 2))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295) % 10000 AS bucket
  FROM spelled),
totals AS (
  SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM words JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM totals),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM totals, sums),
weights AS (SELECT d, count(*) AS n, sum(gain)::BIGINT AS w FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE own GROUP BY d),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight,
    coalesce(w, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (d) WHERE own),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS eligible
  FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
FROM ranked
"""
