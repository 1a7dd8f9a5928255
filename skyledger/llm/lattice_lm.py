"""Scoring documents by the marginal probability of their subword lattices.

Every way to cut a word into pieces of an existing vocabulary is a path through
a lattice. A unigram model over pieces gives each path a probability, and a
forward recursion in log space sums over all of them. Pieces begin words with
``▁`` and never cross white space, so a document's lattice falls apart into
those of its words: its log probability is the sum of theirs and of the end
token's. So the recursion runs once for each distinct word of the corpus,
for many words of one length at a time, and documents look their words up.

The vocabulary and the order of its scores come from a public file. The scores
of that file are ranks, so the first weights are 1 / (rank + 1); they are then
re-estimated by expectation maximisation over the counts of all words of all
training documents. A character without a piece is spelled in byte pieces.

How it runs: documents are taken in chunks of consecutive rows. Each chunk
gives its distinct words with their training counts; these are summed over all
chunks, scored, and sent back to the chunks that have them, where the texts
meet them. So a word costs a row per chunk and not one per occurrence, and no
task holds more than the words of a chunk. Only the vocabulary's expected
counts, of fixed size, go through the driver.

Defined results: a null or empty text is its end token alone; rows with a null
id are training rows; repeated rows count once each; an empty table gives no rows; further
columns are ignored. Words and texts of any length are scored whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored

#: Consecutive rows in a chunk, as a power of two.
CHUNK_BITS = 12
#: Distinct words after which a chunk's counts are handed on and begun afresh.
MOST_WORDS = 1_000_000
#: Words that a task gathers before the recursion, and characters of words that go through the recursion at a time.
WORDS_AT_ONCE, CELLS = 50_000, 300_000
ROUNDS = 3
FILTER_BITS = 20
SMOOTHING = 0.1

_PRIME = np.uint64(0x9E3779B97F4A7C15)
START = "▁"

SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, piece_sum double"
)


@dataclass
class Vocabulary:
    """Pieces by length, as sorted hashes with their numbers; byte pieces by their byte."""

    hashes: dict[int, np.ndarray]
    numbers: dict[int, np.ndarray]
    bytes: np.ndarray
    prior: np.ndarray  # log of the first weights, by piece
    likely: np.ndarray  # whether any piece's hash begins with these bits; most of a word's substrings stop here

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        scores = np.array([model.get_score(k) for k in range(size)])
        usable = [k for k in range(size) if not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k))]
        rank = np.empty(size)
        rank[np.argsort(-scores, kind="stable")] = np.arange(size)
        weights = np.zeros(size)
        weights[usable] = 1 / (rank[usable] + 1)
        by_length: dict[int, list[tuple[int, int]]] = {}
        spelled = np.full(256, -1)
        for k in usable:
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                spelled[int(piece[3:5], 16)] = k
            else:
                by_length.setdefault(len(piece), []).append((_hash_of(piece), k))
        hashes = {n: np.array([h for h, _ in sorted(x)], dtype=np.uint64) for n, x in sorted(by_length.items())}
        numbers = {n: np.array([k for _, k in sorted(x)]) for n, x in sorted(by_length.items())}
        with np.errstate(divide="ignore"):
            prior = np.log(weights / weights.sum())
        likely = np.zeros(1 << FILTER_BITS, bool)
        for known in hashes.values():
            likely[(known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        return cls(hashes, numbers, spelled, prior, likely)


def _hash_of(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_PRIME) + ord(c) + 1) % (1 << 64)
    return h


@dataclass
class Lattice:
    """The pieces in a batch of words of one length.

    ``arcs`` has (length, words, starts, numbers of pieces); ``spelled`` has the
    places of characters without a piece, and their characters.
    """

    words: int
    length: int
    arcs: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]
    spelled: tuple[np.ndarray, np.ndarray, np.ndarray]

    @classmethod
    def of(cls, codes: np.ndarray, vocabulary: Vocabulary) -> Lattice:
        """``codes``: a row of code points per word, the word mark included."""
        count, length = codes.shape
        plain = codes.astype(np.uint64) + np.uint64(1)
        rolling, arcs, covered = np.zeros_like(plain), [], np.zeros(codes.shape, bool)
        for n in range(1, min(length, max(vocabulary.hashes)) + 1):
            rolling = rolling[:, : length - n + 1] * _PRIME + plain[:, n - 1 :]
            if n in vocabulary.hashes:
                known = vocabulary.hashes[n]
                word, start = np.nonzero(vocabulary.likely[(rolling >> np.uint64(64 - FILTER_BITS)).astype(np.int32)])
                own = rolling[word, start]
                at = np.searchsorted(known, own)
                at[at == len(known)] = 0
                found = np.flatnonzero(known[at] == own)
                word, start = word[found], start[found]
                arcs.append((n, word, start, vocabulary.numbers[n][at[found]]))
                if n == 1:
                    covered[word, start] = True
        word, start = np.nonzero(~covered)
        return cls(count, length, arcs, (word, start, codes[word, start]))

    def weighted(self, logs: np.ndarray, vocabulary: Vocabulary) -> dict[int, np.ndarray]:
        """For each piece length the log weight of the piece at each start, or minus infinity."""
        weights = {}
        for n, word, start, number in self.arcs:
            if len(word):
                weights[n] = np.full((self.length - n + 1, self.words), -np.inf)
                weights[n][start, word] = logs[number]
        word, start, code = self.spelled
        if len(code):
            weights.setdefault(1, np.full((self.length, self.words), -np.inf))
            distinct, at = np.unique(code, return_inverse=True)
            own = np.array([logs[vocabulary.bytes[list(chr(c).encode("utf-8", "replace"))]].sum() for c in distinct])
            weights[1][start, word] = own[at]
        return weights


def _summed(ways: list[np.ndarray]) -> np.ndarray:
    """Log of the sum of the exponentials of the ways."""
    if len(ways) == 1:
        return ways[0]
    top = np.maximum.reduce(ways)
    top = np.where(np.isfinite(top), top, 0)
    total = np.exp(ways[0] - top)
    for way in ways[1:]:
        total += np.exp(way - top)
    with np.errstate(divide="ignore"):
        return top + np.log(total)


def forward(weights: dict[int, np.ndarray], words: int, length: int) -> np.ndarray:
    """Log of the summed probability of all segmentations of each prefix."""
    alpha = np.full((length + 1, words), -np.inf)
    alpha[0] = 0
    for j in range(1, length + 1):
        alpha[j] = _summed([alpha[j - n] + w[j - n] for n, w in weights.items() if n <= j])
    return alpha


def backward(weights: dict[int, np.ndarray], words: int, length: int) -> np.ndarray:
    """The same of each suffix."""
    beta = np.full((length + 1, words), -np.inf)
    beta[length] = 0
    for j in range(length - 1, -1, -1):
        beta[j] = _summed([beta[j + n] + w[j] for n, w in weights.items() if n <= length - j])
    return beta


def batches_of(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of words, their code points with the word mark), words of one length at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for n in np.unique(lengths):
        places = order[np.searchsorted(lengths[order], n) : np.searchsorted(lengths[order], n, side="right")]
        step = max(1, CELLS // (int(n) + 1))
        for k in range(0, len(places), step):
            part = places[k : k + step]
            text = "".join([START + words[i] for i in part])
            yield part, np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4").reshape(len(part), -1)


def word_log_probabilities(words: list[str], logs: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Natural log of the probability of each word, over all its segmentations."""
    out = np.empty(len(words))
    for places, codes in batches_of(words):
        lattice = Lattice.of(codes, vocabulary)
        weights = lattice.weighted(logs, vocabulary)
        out[places] = forward(weights, lattice.words, lattice.length)[-1]
    return out


def expected_counts(words: list[str], counts: np.ndarray, logs: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """How often each piece is expected in the segmentations of the counted words."""
    out = np.zeros(len(logs))
    for places, codes in batches_of(words):
        lattice = Lattice.of(codes, vocabulary)
        weights = lattice.weighted(logs, vocabulary)
        alpha = forward(weights, lattice.words, lattice.length)
        beta = backward(weights, lattice.words, lattice.length)
        times = counts[places]
        for n, word, start, number in lattice.arcs:
            if not len(word):
                continue
            share = np.exp(alpha[start, word] + weights[n][start, word] + beta[start + n, word] - alpha[-1, word])
            out += np.bincount(number, share * times[word], len(out))
        word, start, code = lattice.spelled
        if len(code):
            share = np.exp(alpha[start, word] + weights[1][start, word] + beta[start + 1, word] - alpha[-1, word])
            for c, s in zip(code, share * times[word], strict=True):
                np.add.at(out, vocabulary.bytes[list(chr(c).encode("utf-8", "replace"))], s)
    return out


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Words in tables of some size: the recursion takes all words of one length together."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= WORDS_AT_ONCE:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary_at(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary.load(path)
    return _vocabularies[path]


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case; both methods mind ASCII only."""
    return text.lower().split()


def chunked(docs: DataFrame, held_out: Column, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS).alias("chunk"),
        F.col(id_column).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )


def _chunk_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each chunk, with their number in training documents."""
    chunk, counts = None, Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        table = pa.table(
            {
                "chunk": pa.array(np.full(len(counts), chunk if counts else 0, np.int64)),
                "word": pa.array(list(counts), pa.binary()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )
        yield from table.to_batches(max_chunksize=100_000)

    for batch in batches:
        for own, held, text in zip(*(batch[c].to_pylist() for c in ("chunk", "held_out", "text")), strict=True):
            if own != chunk or len(counts) > MOST_WORDS:
                yield from flush()
                chunk, counts = own, Counter()
            words = words_of(text)
            if held:
                for word in words:
                    counts.setdefault(word, 0)
            else:
                counts.update(words)
    yield from flush()


def trained(words: DataFrame, documents: int, path: str, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log weights of the pieces and of the end token, from the counts of all training words."""
    spark = words.sparkSession
    prior = Vocabulary.load(path).prior
    logs, end = prior, np.log(0.01)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(logs)  # as large as the vocabulary

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary, total = vocabulary_at(path), np.zeros(len(shared.value))
            for batch in _gathered(batches):
                known = [w.decode("utf-8", "replace") for w in batch["word"].to_pylist()]
                total += expected_counts(known, batch["c"].to_numpy().astype(float), shared.value, vocabulary)
            some = np.nonzero(total)[0]
            yield pa.RecordBatch.from_pydict({"piece": pa.array(some, pa.int32()), "n": pa.array(total[some])})

        found = words.where("c > 0").mapInArrow(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = np.where(np.isfinite(prior), SMOOTHING, 0)
        for row in found.collect():  # at most a row per piece
            counts[row["piece"]] += row["n"]
        total = counts.sum() + documents + SMOOTHING
        with np.errstate(divide="ignore"):
            logs, end = np.log(counts / total), float(np.log((documents + SMOOTHING) / total))
    return logs, end


def score(
    docs: DataFrame,
    held_out: Column,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """Log10 probability of each document under the lattice model, and under a plain word model.

    Learns from rows for which ``held_out`` is not true. ``vocabulary`` is the
    path of a piece model that every executor has.
    """
    spark = small_batches(docs.sparkSession)
    rows = chunked(docs, held_out, id_column, text_column)
    pairs = stored(rows.mapInArrow(_chunk_words, "chunk long, word binary, n long"), "lm-pairs")
    words = stored(pairs.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    documents = rows.where(~F.col("held_out")).count()
    tokens, distinct = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, distinct = tokens + documents, distinct + (documents > 0)
    logs, end = trained(words, documents, vocabulary, rounds)
    shared = spark.sparkContext.broadcast(logs)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary_at(vocabulary)
        for table in _gathered(batches):
            text = [w.decode("utf-8", "replace") for w in table["word"].to_pylist()]
            s = word_log_probabilities(text, shared.value, known) / np.log(10)
            yield from table.select(["word", "c"]).append_column("s", pa.array(s)).combine_chunks().to_batches()

    by_word = words.mapInArrow(scored, "word binary, c long, s double").withColumnRenamed("word", "_word")
    back = pairs.select("chunk", "word").join(by_word, F.col("word") == F.col("_word")).drop("_word")

    def looked_up(texts: pa.Table, known: pa.Table) -> pa.Table:
        place = {w: k for k, w in enumerate(known["word"].to_pylist())}
        c, s = known["c"].to_numpy().astype(float), known["s"].to_numpy()
        base = np.log10(c + 1)
        out: dict[str, list] = {"n_tokens": [], "n_known": [], "base_sum": [], "piece_sum": []}
        for text in texts["text"].to_pylist():
            at = np.fromiter(map(place.__getitem__, words_of(text)), np.int64)
            out["n_tokens"].append(len(at) + 1)
            out["n_known"].append(int((c[at] > 0).sum()))
            out["base_sum"].append(float(base[at].sum()))
            out["piece_sum"].append(float(s[at].sum()))
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"]} | out)

    sums = rows.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(looked_up, SCORES)
    base_end, per_token = float(np.log10(documents + 1)), float(np.log10(tokens + distinct + 1))
    return sums.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + int(documents > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_sum") + base_end - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("piece_sum") + end / float(np.log(10))).alias("score"),
    )
