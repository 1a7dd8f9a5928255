"""Jaccard similarity join of word n-gram sets by token-combination prefixes.

Tokens (hashes of n-grams) are put in one order for all documents, rare ones
first. Two sets that reach the threshold differ in few tokens, so the first
tokens of either, its prefix, must have some in common. Rare tokens are indexed
one by one. Tokens of frequent classes would lead to long lists, so they are indexed as
pairs or triples, and prefixes are extended by the tokens that this takes:
with t tokens that may be missing, the prefix is the shortest for which the sum over classes
of (tokens in the class - tokens in a combination + 1) is above t. Then in some class both prefixes share
a whole combination. Large sets have several classes of each kind, dealt by
hash, so the number of combinations stays in proportion to the prefix.

Frequencies come from a table of ``2 ** BUCKET_BITS`` counters over the hashes
of all documents' tokens, of fixed size at any input. The order only has to be the same for all
documents: collisions cost time, never a link.

Documents with equal sets are one class from the start. Sets that share a
combination are compared with one of them, the hub (the one with the fewest rare tokens), and the components of these
links are formed. What is still apart after that is found in two ways. In short lists all pairs are taken. In longer ones the
tokens in which a member differs from the hub are found. Of two similar sets in different components at most one is similar to the
hub, so that their differences from it add up to more than similar sets may differ in: they must share some. Prefixes
of the differences therefore meet on a token, rare ones first, and members that merely stand around one text don't. So
groups of copies cost a comparison or two per copy, and no link is lost.

Before texts are fetched, pairs are dropped whose signatures differ in more bits than similar sets differ in
tokens: a bit is the parity of the number of tokens of its slot, so each token that only one set has turns one bit.
Comparisons use the exact sets, of 64-bit hashes.

Defined results: a null text or one without words has no n-grams, no links and itself as
its component; fewer words than n are one n-gram; rows with equal ids and equal
sets are in one component, as all equal sets; a null id is in the component of its equal sets,
which is null if all their ids are; an empty table gives no rows; further columns are ignored. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, temporary
from .components import components

BUCKET_BITS, SLICES = 20, 64
#: A bucket that stands so many spreads above the mean makes its tokens frequent (pairs) or very frequent (triples).
FREQUENT, VERY_FREQUENT, LEAST_SPREAD = 4, 32, 6
#: Tokens of a size band for each class of pairs or triples.
TOKENS_PER_CLASS = 64
CANDIDATE_BITS = 22
#: Bits of a signature, and the 64-bit words that remain of it in rows that are joined by token.
SIGNATURE_BITS, FOLDED_WORDS = 1024, 4
#: In lists with no more members all pairs are taken.
SHORT_LIST = 16
#: Pairs of texts that a worker holds as sets at a time.
PAIR_ROWS = 64

_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_VALUES[65:91] = _BYTE_VALUES[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """All bits of each number spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class NgramHasher:
    """Sets of hashed n-grams of whole texts, many texts at a time."""

    def __init__(self, n: int) -> None:
        self.n, self.powers, self.unpowers = n, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _reach(self, size: int) -> None:
        if len(self.powers) < size:
            exponents = np.full(size - 1, _BASE), np.full(size - 1, _UNBASE)
            one = np.ones(1, np.uint64)
            self.powers, self.unpowers = (np.concatenate([one, np.cumprod(e, dtype=np.uint64)]) for e in exponents)

    def word_hashes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of each word."""
        codes = np.frombuffer(data, np.uint8)
        space = _SPACE[codes]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        self._reach(len(codes) + 1)
        running = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[codes] * self.powers[: len(codes)], out=running[1:])
        return _mixed((running[ends] - running[starts]) * self.unpowers[starts]), starts

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The sorted distinct n-gram hashes of each text."""
        out: list[np.ndarray] = []
        first = 0
        while first < len(texts):  # so many texts that they have a quarter of a megabyte, or one
            upto, size = first, 0
            while upto < len(texts) and (upto == first or size + len(texts[upto] or b"") < 1 << 18):
                size += len(texts[upto] or b"") + 1
                upto += 1
            out += self._sets([t or b"" for t in texts[first:upto]])
            first = upto
        return out

    def _sets(self, texts: list[bytes]) -> list[np.ndarray]:
        words, starts = self.word_hashes(b" ".join(texts))
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        bounds = np.searchsorted(starts, begins)
        grams = words[: max(0, len(words) - self.n + 1)].copy()
        for k in range(1, self.n):
            grams = _mixed(grams * _BASE + words[k : k + len(grams)])
        out = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= self.n:
                out.append(np.unique(grams[a : b - self.n + 1]))
            elif b > a:
                short = np.array([b - a], np.uint64)
                for k in range(a, b):
                    short = _mixed(short * _BASE + words[k : k + 1])
                out.append(short)
            else:
                out.append(np.empty(0, np.uint64))
        return out


class Prefixes:
    """Which combinations of a set's tokens are indexed."""

    def __init__(self, levels: np.ndarray, share: tuple[int, int]) -> None:
        self.levels, self.share = levels, share  # class (0, 1, 2) and order of each bucket of tokens

    def missing(self, size: int) -> int:
        """How many tokens of a set of this size a similar set may lack."""
        part, whole = self.share
        return size + (-part * size) // whole

    def bands(self, size: int) -> set[int]:
        """Size bands of the larger set of any pair with this set."""
        part, whole = self.share
        return {size.bit_length(), (size * whole // part).bit_length()}

    def combinations_of(self, tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """Keys of the indexed combinations, and the number of rare tokens if all of them are indexed, else -1.

        ``tokens`` are distinct hashes. Keys of single tokens are even, others odd.
        """
        level = self.levels[(tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
        # The order: level, then hash. Levels 0 to 255; classes follow from the level.
        keys = np.sort((level.astype(np.uint64) << np.uint64(56)) | (tokens >> np.uint64(8)))
        needed, out = self.missing(len(keys)) + 1, []
        rare = int(np.searchsorted(keys, np.uint64(1 << 62)))
        for band in sorted(self.bands(len(keys))):
            salt = np.uint64(band * 0x2545F4914F6CDD1D % (1 << 64))
            out.append(_mixed(keys[: min(rare, needed)] + salt) & ~np.uint64(1))
            if rare < needed:
                out.append(self._frequent(keys[rare:], needed - rare, band, salt) | np.uint64(1))
        return np.unique(np.concatenate(out)), rare if rare < needed else -1

    @staticmethod
    def _frequent(keys: np.ndarray, needed: int, band: int, salt: np.uint64) -> np.ndarray:
        """Pairs and triples of the shortest prefix of frequent tokens that gives ``needed``."""
        classes = max(1, (1 << band) // TOKENS_PER_CLASS)
        held: dict[tuple[int, int], list[int]] = {}
        for key in keys.tolist():
            width = 2 if key < 1 << 63 else 3
            own = held.setdefault((width, key % classes), [])
            own.append(key)
            needed -= len(own) >= width
            if not needed:
                break
        sums = [
            (sum((i + 1) * k for i, k in enumerate(c)) * 0x9E3779B97F4A7C15 + width) % (1 << 64)
            for (width, _), own in held.items()
            for c in combinations(own, width)
        ]
        return _mixed(np.array(sums, dtype=np.uint64) + salt)


def _levels(counts: np.ndarray) -> np.ndarray:
    """Order of the buckets as numbers up to 255: rare below 64, frequent below 128, very frequent above.

    What counts is how far a bucket stands out from the mean, in units of the spread that
    chance gives buckets. So lists of rare tokens hardly grow with the input.
    """
    mean = counts.mean()
    above = (counts - mean) / max(LEAST_SPREAD, np.sqrt(mean))
    out = np.where(
        above < FREQUENT, np.clip(32 + 7 * above, 0, 63),
        np.where(above < VERY_FREQUENT, np.minimum(127, 64 + 2 * above), 128 + np.minimum(127, 8 * np.log2(1 + above))),
    )
    return out.astype(np.uint8)


def frequency_levels(texts: DataFrame, n: int) -> np.ndarray:
    """Levels of all buckets, from the counts of the distinct n-grams of every text.

    Each task sums its texts into one table of counters and hands it on in slices.
    """
    width = (1 << BUCKET_BITS) // SLICES

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = NgramHasher(n), np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for tokens in hasher.sets(batch["text"].to_pylist()):
                np.add.at(counts, (tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
        parts = [counts[k * width : (k + 1) * width].astype("<u4").tobytes() for k in range(SLICES)]
        yield pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "counts": parts})

    def summed(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for part in table["counts"]:
            total += np.frombuffer(part.as_py(), "<u4")
        return pa.table({"slice": table["slice"][:1], "counts": [total.tobytes()]})

    tables = texts.mapInArrow(counted, "slice int, counts binary").groupBy("slice")
    found = tables.applyInArrow(summed, "slice int, counts binary").collect()  # 8 MB at any input
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for row in found:
        counts[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["counts"], np.int64)
    return _levels(counts)


def indexed(texts: DataFrame, n: int, share: tuple[int, int], levels: np.ndarray) -> DataFrame:
    """Each document's set size, a 128-bit hash of its set, its combinations, what ``combinations_of`` counts, and a signature."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)  # 1 MB at any input

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, prefixes = NgramHasher(n), Prefixes(shared.value, share)
        for batch in batches:
            sets = hasher.sets(batch["text"].to_pylist())
            least = _least_size(share)
            found = [prefixes.combinations_of(s) if len(s) >= least else (np.empty(0), -1) for s in sets]
            combos, rare = [keys.astype(np.int64) for keys, _ in found], [n for _, n in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array(combos, pa.list_(pa.int64())), pa.array(rare, pa.int32()),
                    pa.array([_signature(s) if len(s) >= least else None for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "size", "digest", "combos", "rare", "signature"],
            )

    return texts.mapInArrow(made, "doc_id long, size long, digest binary, combos array<long>, rare int, signature array<long>")


def _signature(tokens: np.ndarray) -> np.ndarray:
    """Parities of the numbers of tokens in each slot, as 64-bit words."""
    slots = (tokens & np.uint64(SIGNATURE_BITS - 1)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=SIGNATURE_BITS).astype(np.uint8) & 1).view(np.int64)


def _differing(one: str, other: str, words: int):
    """In how many bits two signatures differ."""
    return sum((F.bit_count(F.col(one)[k].bitwiseXOR(F.col(other)[k])) for k in range(words)), F.lit(0))


def _folded(signature: str):
    """A shorter signature of the same set."""
    words = [
        [F.col(signature)[k] for k in range(first, SIGNATURE_BITS // 64, FOLDED_WORDS)] for first in range(FOLDED_WORDS)
    ]
    return F.array(*[reduce(lambda x, y: x.bitwiseXOR(y), own) for own in words])


def _least_size(share: tuple[int, int]) -> int:
    """The smallest size for which a different set can be similar."""
    part, whole = share
    return next(k for k in range(1, whole + 2) if part * (k + 1) <= whole * k)


class Texts:
    """Fetches the texts of the documents that are to be compared.

    Texts are shuffled, not sets: packed, they take a third of the room.
    """

    def __init__(self, texts: DataFrame) -> None:
        self.texts = texts.where("doc_id IS NOT NULL")

    def likely(self, ids: DataFrame) -> DataFrame:
        """``id`` and ``text`` of the documents with these ids, and of few others.

        A bitmap of fixed size keeps most other documents from being shuffled.
        """
        bits, spark = 1 << CANDIDATE_BITS, self.texts.sparkSession
        slot = F.pmod(F.xxhash64("id"), F.lit(bits)).alias("slot")

        def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(bits, bool)
            for batch in batches:
                seen[batch["slot"].to_numpy()] = True
            yield pa.RecordBatch.from_pydict({"part": pa.array([0], pa.int32()), "bitmap": [np.packbits(seen).tobytes()]})

        def joined(table: pa.Table) -> pa.Table:
            seen = np.zeros(bits // 8, np.uint8)
            for part in table["bitmap"]:
                seen |= np.frombuffer(part.as_py(), np.uint8)
            return pa.table({"part": table["part"][:1], "bitmap": [seen.tobytes()]})

        parts = ids.select(slot).mapInArrow(marked, "part int, bitmap binary")
        parts = parts.select((F.spark_partition_id() % 16).alias("part"), "bitmap")
        bitmap = np.zeros(bits // 8, np.uint8)
        for row in parts.groupBy("part").applyInArrow(joined, "part int, bitmap binary").collect():  # 16 rows at most
            bitmap |= np.frombuffer(row["bitmap"], np.uint8)
        shared = spark.sparkContext.broadcast(bitmap)  # half a megabyte

        def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.unpackbits(shared.value).astype(bool)
            for batch in batches:
                yield batch.filter(pa.array(seen[batch["slot"].to_numpy()]))

        rows = self.texts.select(F.col("doc_id").alias("id"), "text").select("id", "text", slot)
        return rows.mapInArrow(wanted, "id long, text binary, slot long").select("id", "text")


def _digest(tokens: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(tokens.tobytes())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few pairs: both sets of each are held, and compared documents may be long."""
    for batch in batches:
        for first in range(0, batch.num_rows, PAIR_ROWS):
            yield batch.slice(first, PAIR_ROWS)


def _pairs_of_sets(hasher: NgramHasher, batch: pa.RecordBatch) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
    """The rows of a batch that count, and the two sets of each row.

    Rows of one id may have several texts; those that are not meant don't count.
    """
    one, other = (hasher.sets(batch[c].to_pylist()) for c in ("text_a", "text_b"))
    meant = [
        k for k, (d, e) in enumerate(zip(batch["digest_a"].to_pylist(), batch["digest_b"].to_pylist(), strict=True))
        if _digest(one[k]) == d and _digest(other[k]) == e
    ]
    return meant, one, other


def _compared(n: int):
    """Sizes of what the two sets of each row have in common and in all."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = NgramHasher(n)
        for batch in _slices(batches):
            meant, one, other = _pairs_of_sets(hasher, batch)
            both = [len(np.intersect1d(one[k], other[k], assume_unique=True)) for k in meant]
            union = [len(one[k]) + len(other[k]) - c for k, c in zip(meant, both, strict=True)]
            kept = pa.array(meant, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["a"].take(kept), batch["b"].take(kept), pa.array(both, pa.int64()), pa.array(union, pa.int64())],
                names=["a", "b", "both", "all"],
            )

    return compared


class Differences:
    """The tokens in which the members of a list differ from its hub."""

    def __init__(self, levels: np.ndarray, share: tuple[int, int]) -> None:
        self.levels, self.share = levels, share

    def of(self, hub: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, int, int, bool]:
        """The indexed tokens in order, how many meet any member that is not linked with the hub, how many tokens differ, and
        whether the member is linked with the hub.

        With d(x) tokens between x and the hub, similar x and y share (d(x) + d(y) - d(x, y)) / 2 of them, and
        d(x, y) <= c (|x| + |y|), c = (1 - share) / (1 + share). If both are linked with the hub, they need not meet. Else
        they share one at least, and no fewer than d(x) - d(x, y). If y is not linked, d(y) > c (|y| + |hub|), so
        they share more than (d(x) + c (|hub| - |x|)) / 2. The tokens that must be shared make the prefix shorter.
        """
        part, whole = self.share
        beside, lacked = (np.setdiff1d(x, y, assume_unique=True) for x, y in ((member, hub), (hub, member)))
        differ = len(beside) + len(lacked)
        linked = differ * (whole + part) <= (whole - part) * (len(member) + len(hub))
        most = len(member) * (whole - part) // part  # tokens between it and any similar set
        any_shared = max(1, differ - most)
        shared = max(any_shared, (differ * (whole + part) + (whole - part) * (len(hub) - len(member))) // (2 * (whole + part)) + 1)
        few = max(0, differ - shared + 1)
        length = few if linked else differ - any_shared + 1
        return self._ordered(beside, lacked)[:length], few, differ, linked

    def _ordered(self, beside: np.ndarray, lacked: np.ndarray) -> np.ndarray:
        """All tokens, those first in which few members should differ from the hub: rare ones of their own, then frequent ones of
        the hub, then frequent ones that the hub lacks, then rare ones of the hub."""
        tokens = np.concatenate([beside, lacked])
        level = self.levels[(tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.int64)
        own, frequent = np.arange(len(tokens)) < len(beside), level >= 64
        rank = np.select([own & ~frequent, ~own & frequent, own], [0, 1, 2], 3)
        return tokens[np.lexsort((tokens, np.where(own, level, -level), rank))]


def _differences(n: int, share: tuple[int, int], levels):
    """``Differences`` of each row's second set from its first, the hub's."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, differences = NgramHasher(n), Differences(levels.value, share)
        for batch in _slices(batches):
            meant, one, other = _pairs_of_sets(hasher, batch)
            rows = [differences.of(one[k], other[k]) for k in meant]
            kept = pa.array(meant, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["a"].take(kept), batch["b"].take(kept),
                    pa.array([r[0].astype(np.int64) for r in rows], pa.list_(pa.int64())),
                    *[pa.array([r[k] for r in rows], kind) for k, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.bool_()))],
                ],
                names=["a", "b", "tokens", "few", "differ", "linked"],
            )

    return found


class Join:
    """The links between representatives of equal sets."""

    def __init__(self, texts: DataFrame, n: int, share: tuple[int, int], levels: np.ndarray) -> None:
        self.share, self.n, self.texts, self.levels = share, n, Texts(texts), levels
        part, whole = share
        with temporary(texts.sparkSession):
            members = stored(self._members(self._representatives(texts)), "ngram-members", 1)
        self.lists = stored(self._with_hubs(members), "ngram-lists")
        self.fits = lambda x, y: (x * whole >= y * part) & (y * whole >= x * part)

    def _representatives(self, texts: DataFrame) -> DataFrame:
        """One document of each class of equal sets with its combinations.

        Combinations take the most room. Those of all documents go once the representatives are stored, and theirs at the end of
        the block around this.
        """
        with temporary(texts.sparkSession):
            base = stored(indexed(texts, self.n, self.share, self.levels), "ngram-base")
            self.rows = stored(base.select("doc_id", "size", "digest"), "ngram-rows", 2)
            classes = self.rows.where("size > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
            self.classes = stored(classes.where("rep IS NOT NULL"), "ngram-classes", 2)
            firsts = self.classes.select(F.col("digest").alias("_digest"), "rep")
            reps = base.where(F.size("combos") > 0).join(
                firsts, (F.col("doc_id") == F.col("rep")) & (F.col("digest") == F.col("_digest"))
            )
            return stored(reps.select("rep", "size", "digest", "combos", "rare", "signature"), "ngram-reps", 1)

    def _members(self, reps: DataFrame) -> DataFrame:
        """Combinations that several representatives have, with each of these."""
        rare = F.when(F.col("rare") >= 0, F.col("rare")).alias("rare")
        self.reps = stored(reps.select("rep", "size", "digest", rare, "signature"), "ngram-signatures", 1)
        postings = reps.select(F.explode("combos").alias("combo"), "rep")
        # Grouped by more than the join needs: the result is dealt out again, and the join can split hot combinations.
        shared = postings.groupBy("combo", F.pmod("combo", F.lit(5))).agg(F.count("*").alias("n")).where("n > 1")
        shared = shared.select(F.col("combo").alias("_combo"))
        return postings.join(shared, F.col("combo") == F.col("_combo")).select("combo", "rep")

    def _with_hubs(self, members: DataFrame) -> DataFrame:
        """Lists with their length and hub: the member with the fewest rare tokens, as it is nearest to the others."""
        known = self.reps.select(F.col("rep").alias("_rep"), "size", "rare")
        rows = stored(members.join(known, F.col("rep") == F.col("_rep")).drop("_rep"), "ngram-sized")
        first = F.min(F.struct(F.coalesce("rare", F.lit(2**31)).alias("rank"), "rep", "size", "rare")).alias("first")
        hubs = rows.groupBy("combo", F.pmod("combo", F.lit(5))).agg(first, F.count("*").alias("members"))
        hubs = hubs.select(F.col("combo").alias("_combo"), "first", "members")
        return rows.join(hubs, F.col("combo") == F.col("_combo")).select(
            "combo", "rep", "size", "rare", F.col("first.rep").alias("hub"), F.col("first.size").alias("hub_size"),
            F.col("first.rare").alias("hub_rare"), "members",
        )

    def _apart(self, combo, size_a, rare_a, size_b, rare_b):
        """Whether two sets need no comparison for sharing ``combo``.

        Of a combination of frequent tokens, with all rare tokens of both sets indexed: if they shared one of those, they
        would meet there. Else either lacks all rare tokens of the other; with the difference of the sizes this is a
        bound of how many tokens only one of them has, which for similar sets is at most
        (1 - share) / (1 + share) of both sizes together.
        """
        part, whole = self.share
        differ = F.greatest(2 * rare_a - size_a + size_b, 2 * rare_b - size_b + size_a)
        known = rare_a.isNotNull() & rare_b.isNotNull() & (combo % 2 != 0)
        return known & (differ * (whole + part) > (size_a + size_b) * (whole - part))

    def _near(self, differ, size_a, size_b):
        """Whether sets that differ in at least so many tokens can be similar."""
        part, whole = self.share
        return differ * (whole + part) <= (size_a + size_b) * (whole - part)

    def sized(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with the digests of their sets, their sizes and signatures."""
        one, two = (
            self.reps.select(*[F.col(c).alias(f"{c}_{x}") for c in ("rep", "digest", "size", "signature")]) for x in ("a", "b")
        )
        return pairs.join(one, F.col("a") == F.col("rep_a")).join(two, F.col("b") == F.col("rep_b"))

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that their signatures don't rule out, with the digests of their sets."""
        differ = _differing("signature_a", "signature_b", SIGNATURE_BITS // 64)
        return self.sized(pairs).where(self._near(differ, F.col("size_a"), F.col("size_b")))

    def fetched(self, pairs: DataFrame) -> DataFrame:
        """Pairs with the texts of both."""
        pairs = stored(pairs.select("a", "b", "digest_a", "digest_b"), "ngram-pairs")
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        texts = self.texts.likely(ids)
        one = pairs.join(texts.select(F.col("id").alias("_a"), F.col("text").alias("text_a")), F.col("a") == F.col("_a"))
        two = one.drop("_a").join(
            texts.select(F.col("id").alias("_b"), F.col("text").alias("text_b")), F.col("b") == F.col("_b")
        )
        return two.select("a", "b", "digest_a", "digest_b", "text_a", "text_b")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of distinct pairs (a, b) that are similar."""
        found = self.fetched(self.likely(pairs)).mapInArrow(_compared(self.n), "a long, b long, both long, all long")
        part, whole = self.share
        return stored(found.where(F.col("both") * whole >= F.col("all") * part).select("a", "b"), "ngram-linked")

    def hub_pairs(self) -> DataFrame:
        """Every member of a list that may be linked with the list's hub, with the hub, once."""
        sizes = F.col("hub_size"), F.col("size")
        apart = self._apart(F.col("combo"), sizes[0], F.col("hub_rare"), sizes[1], F.col("rare"))
        rows = self.lists.where((F.col("hub") != F.col("rep")) & self.fits(*sizes) & ~apart)
        return rows.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()

    def open_lists(self, parts: DataFrame) -> DataFrame:
        """The lists whose members are in several components, with each member's component."""
        lists = self.lists.where("members > 2")  # of two, one is the hub
        named = lists.join(
            parts.select(F.col("node").alias("_node"), F.col("component").alias("part")), F.col("rep") == F.col("_node"), "left"
        )
        named = stored(named.withColumn("part", F.coalesce("part", "rep")).drop("_node"), "ngram-named")
        several = named.groupBy("combo", F.pmod("combo", F.lit(5))).agg(
            F.min("part").alias("least"), F.max("part").alias("most")
        )
        several = several.where("least <> most").select(F.col("combo").alias("_combo"))
        return stored(named.join(several, F.col("combo") == F.col("_combo")).drop("_combo"), "ngram-open")

    def pairs_of_short_lists(self, lists: DataFrame) -> DataFrame:
        """All pairs (a, b) of the short lists that are in different components and may be similar."""
        folded = self.reps.select(F.col("rep").alias("_rep"), _folded("signature").alias("bits"))
        rows = lists.where(F.col("members") <= SHORT_LIST).where("hub <> rep").select("combo", "rep", "size", "rare", "part")
        rows = stored(rows.join(folded, F.col("rep") == F.col("_rep")).drop("_rep"), "ngram-short")
        other = rows.select(*[F.col(c).alias(f"{c}_b") for c in rows.columns])
        pairs = rows.join(
            other,
            (F.col("combo") == F.col("combo_b")) & (F.col("rep") < F.col("rep_b")) & (F.col("part") != F.col("part_b"))
            & self.fits(F.col("size"), F.col("size_b"))
            & ~self._apart(F.col("combo"), F.col("size"), F.col("rare"), F.col("size_b"), F.col("rare_b"))
            & self._near(_differing("bits", "bits_b", FOLDED_WORDS), F.col("size"), F.col("size_b")),
        )
        return pairs.select(F.col("rep").alias("a"), F.col("rep_b").alias("b"))

    def stars(self, lists: DataFrame) -> DataFrame:
        """Hubs of the longer lists (a) and their members (b), with what ``Differences`` finds."""
        longer = lists.where((F.col("members") > SHORT_LIST) & (F.col("hub") != F.col("rep")))
        pairs = longer.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
        levels = self.reps.sparkSession.sparkContext.broadcast(self.levels)  # 1 MB at any input
        found = self.fetched(self.sized(pairs)).mapInArrow(
            _differences(self.n, self.share, levels), "a long, b long, tokens array<long>, few long, differ long, linked boolean"
        )
        return stored(found, "ngram-stars")

    def pairs_of_stars(self, stars: DataFrame, parts: DataFrame) -> DataFrame:
        """Pairs (a, b) of members of a hub, not both linked with it, that share a token of their differences from it and
        may be similar."""
        known = self.reps.select(F.col("rep").alias("_rep"), "size", _folded("signature").alias("bits"))
        parts = parts.select(F.col("node").alias("_node"), F.col("component").alias("part"))
        members = stars.join(known, F.col("b") == F.col("_rep")).join(parts, F.col("b") == F.col("_node"), "left")
        rows = members.select(
            F.col("a").alias("hub"), F.col("b").alias("rep"), "size", "bits", F.coalesce("part", "b").alias("part"), "linked",
            "few", "differ", F.posexplode("tokens").alias("place", "token"),
        )
        # Tokens after this one, with it: no more can be shared if it is the first.
        rows = rows.select(
            "hub", "token", "rep", "size", "bits", "part", "linked", (F.col("place") < F.col("few")).alias("early"), "differ",
            (F.col("differ") - F.col("place")).alias("after"),
        )
        rows = stored(rows, "ngram-differences")
        other = rows.where("NOT linked").select(*[F.col(c).alias(f"{c}_b") for c in rows.columns])
        sizes = F.col("size"), F.col("size_b")
        pairs = rows.where("early").join(
            other,
            (F.col("hub") == F.col("hub_b")) & (F.col("token") == F.col("token_b")) & (F.col("part") != F.col("part_b"))
            & (F.col("linked") | (F.col("early_b") & (F.col("rep") < F.col("rep_b"))))
            & self.fits(*sizes) & self._near(F.abs(F.col("differ") - F.col("differ_b")), *sizes)
            & self._near(F.col("differ") + F.col("differ_b") - 2 * F.least("after", "after_b"), *sizes)
            & self._near(_differing("bits", "bits_b", FOLDED_WORDS), *sizes),
        )
        return pairs.select(F.least("rep", "rep_b").alias("a"), F.greatest("rep", "rep_b").alias("b"))

    def links(self) -> DataFrame:
        """Links (a, b) whose components are those of all links."""
        near = self.linked(self.hub_pairs())
        parts = stored(components(near), "ngram-parts")
        left = self.open_lists(parts)
        stars = self.stars(left)
        pairs = self.pairs_of_short_lists(left).unionByName(self.pairs_of_stars(stars, parts))
        rest = self.linked(pairs.distinct())
        return near.unionByName(stars.where("linked").select("a", "b")).unionByName(rest)


def similar_groups(
    docs: DataFrame,
    share: tuple[int, int] = (8, 10),
    n: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_shingles and component_id of each document.

    Two documents are linked if the Jaccard similarity of their sets of word
    ``n``-grams is at least ``share`` (a fraction: part, whole). A component's id is
    its smallest doc_id.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    levels = frequency_levels(texts.select("text"), n)
    join = Join(texts, n, share, levels)
    parts = components(join.links()).select(F.col("node").alias("_node"), "component")
    classes = join.classes.join(parts, F.col("rep") == F.col("_node"), "left").select(
        F.col("digest").alias("_digest"), F.coalesce("component", "rep").alias("component_id")
    )
    rows = join.rows.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("digest")).alias("digest"))
    return rows.join(classes, F.col("digest") == F.col("_digest"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
