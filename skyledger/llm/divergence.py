"""How far the sources of a language differ in the words they use.

Words are found on UTF-8 bytes: one ``bytes.translate`` lowers A-Z and blanks
every other ASCII byte, ``bytes.split`` cuts, and a ``Counter`` per document
gives how often each term occurs. Tasks add these up by Arrow before anything is
shuffled, so a task sends one row per group and term, however many documents it
read.

Terms in at least ``least_docs`` documents of a language are kept, ``V`` of them. A group
(a source of a language, or the whole language) gives term t the probability

    p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))

with N its occurrences of kept terms. ``SCALE`` and all sums are whole numbers.

The distance of two sources is the sum of |p - q| over all kept terms. With p0 the
value of a term that does not occur, that is V * |p0 - q0| plus, for terms that
one of them has, |p - q| - |p0 - q0|. The second part is summed in tiles: terms of a
language in buckets, sources in blocks of ``BLOCK`` sources, so a tile has a bounded
size whatever the language, and gives one row per pair of sources in it.

Defined results: null text, language and source are ''; a group without terms has
N = 0; a language without kept terms has V = 0 and distances 0; one source alone has
no pairs; repeated documents count each time; no documents give no rows; other
columns are ignored, whatever their names. Texts are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

SCALE, SMOOTH = 1_000_000_000, 5
#: Rows that a task adds up before it sends some on.
HELD_ROWS = 2_000_000
#: Sources in a block, rows in a bucket of terms, and terms compared in one numpy call.
BLOCK, BUCKET_ROWS, CHUNK_TERMS = 128, 10_000, 1024
#: Groups that are sent to all tasks at most: some 10 MB; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000

#: ASCII letters are lowered, other ASCII bytes become blanks, bytes of longer characters stay.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
COUNTS = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def _added(parts: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(parts).group_by(["grp", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return table.rename_columns(["grp", "term", "n", "docs"])


def counted(docs: DataFrame) -> DataFrame:
    """Occurrences and documents of each term by language and source, added up within tasks only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held: list[pa.Table] = []

        def sent(table: pa.Table) -> Iterator[pa.RecordBatch]:
            langs, sources = pa.array([g[0] for g in groups], pa.string()), pa.array([g[1] for g in groups], pa.string())
            for batch in table.to_batches(max_chunksize=1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [langs.take(batch["grp"]), sources.take(batch["grp"]), batch["term"].cast(pa.string()), batch["n"], batch["docs"]],
                    ["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            terms: list[bytes] = []
            counts: list[int] = []
            codes, sizes = [], []
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts, strict=True):
                found = Counter(terms_of(text))
                terms.extend(found)
                counts.extend(found.values())
                codes.append(groups.setdefault((lang, source), len(groups)))
                sizes.append(len(found))
            table = pa.table(
                {
                    "grp": pa.array(np.repeat(np.array(codes, np.int32), sizes)),
                    "term": pa.array(terms, pa.binary()),
                    "n": pa.array(counts, pa.int64()),
                    "docs": pa.array(np.ones(len(terms), np.int64)),
                }
            )
            held.append(table)
            if sum(map(len, held)) > HELD_ROWS:
                held = [_added(held)]
                if len(held[0]) > HELD_ROWS // 2:
                    yield from sent(held[0])
                    held, groups = [], {}
        if held:
            yield from sent(_added(held))

    return docs.mapInArrow(count, COUNTS)


def probability(n: Column, total: Column, kept: Column) -> Column:
    """The whole number that stands for a probability; decimals, as products may exceed a long."""
    above = F.lit(SCALE).cast("decimal(19,0)") * (n + SMOOTH).cast("decimal(19,0)")
    below = (total + SMOOTH * kept).cast("decimal(19,0)")
    return 1 + F.call_function("div", above, F.nullif(below, F.lit(0).cast("decimal(19,0)")))


def _joined(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    """Join on few groups, which go to all tasks only if they are few; adaptive execution splits hot keys of others."""
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    return rows.join(F.broadcast(groups) if few else groups, on)


class Audit:
    """Counts, groups and both reports of a table of documents.

    ``counts``: one row per language, source and kept term. ``groups``: one per language
    and source with N, V and ``zero``, the value of a term that does not occur.
    """

    def __init__(self, docs: DataFrame, least_docs: int = 30, text="text", lang="lang", source="source") -> None:
        small_batches(docs.sparkSession)
        docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))])
        # One exchange by language and term serves the sums per source and per language.
        sums = counted(docs).repartition("lang", "term").groupBy("lang", "term", "source")
        sums = sums.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        term = Window.partitionBy("lang", "term")
        sums = sums.select(
            "lang", "source", "term", "n",
            F.sum("docs").over(term).alias("lang_docs"),
            F.sum("n").over(term).alias("lang_n"),
            (F.min("source").over(term) == F.col("source")).alias("first"),
        )
        self.counts = stored(sums.where(F.col("lang_docs") >= least_docs).drop("lang_docs"), "divergence-counts")
        langs = self.counts.groupBy("lang").agg(
            F.count_if("first").alias("kept"), F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("rows")
        )
        used = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        every = docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left")
        place = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")
        sizes = every.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
        sizes = sizes.join(langs, "lang", "left").na.fill(0, ["kept", "lang_total", "rows"])
        sizes = stored(
            sizes.withColumn("blocks", F.ceil(F.col("sources") / BLOCK)).withColumn("buckets", 1 + F.floor(F.col("rows") / BUCKET_ROWS)),
            "divergence-langs",
        )
        groups = _joined(every.na.fill(0, ["total"]).withColumn("place", place), sizes, ["lang"])
        zero = F.coalesce(probability(F.lit(0).cast("long"), F.col("total"), F.col("kept")), F.lit(0).cast("long"))
        self.groups = stored(
            groups.select("*", F.floor(F.col("place") / BLOCK).alias("block"), zero.alias("zero")), "divergence-groups"
        )
        found = _joined(self.counts, self.groups, ["lang", "source"])
        self.terms = stored(
            found.select(
                "lang", "source", "term", "place", "block", "blocks", "buckets", "zero",
                probability(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
                probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
            ),
            "divergence-terms",
        )

    def excess_terms(self, most: int = 50) -> DataFrame:
        """Terms that a source has more than its language, the ``most`` largest excesses of each source."""
        excess = self.terms.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return excess.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= most)

    def _tile_sums(self) -> DataFrame:
        """Per pair of places a < b of a language: the sum over occurring terms of |p - q| - |p0 - q0|."""
        bucket = F.pmod(F.xxhash64("term"), F.col("buckets"))
        seen = self.terms.select("lang", "place", "block", "blocks", bucket.alias("bucket"), "term", "p")
        # The value of absent terms of every source, once in each bucket; a null term tells them apart.
        absent = self.groups.where("kept > 0").select(
            "lang", "place", "block", "blocks",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"),
            F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"),
        )
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
        rows = seen.unionByName(absent).select("*", other)
        rows = rows.select(
            "lang", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "place", "block", "term", "p"
        )

        def tile(table: pa.Table) -> pa.Table:
            lang, low, high = (table[c][0].as_py() for c in ("lang", "low", "high"))
            none = table["term"].is_null().to_numpy(zero_copy_only=False)
            absent, seen = table.filter(pa.array(none)), table.filter(pa.array(~none))
            order = np.argsort(absent["place"].to_numpy())
            places, zeros = absent["place"].to_numpy()[order], absent["p"].to_numpy()[order]
            blocks = absent["block"].to_numpy()[order]
            left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
            terms = seen["term"].combine_chunks().dictionary_encode()
            column, row, p = terms.indices.to_numpy(), np.searchsorted(places, seen["place"].to_numpy()), seen["p"].to_numpy()
            by_column = np.argsort(column, kind="stable")
            column, row, p = column[by_column], row[by_column], p[by_column]
            sums = np.zeros((len(left), len(right)), np.int64)
            base = np.abs(zeros[left][:, None] - zeros[right][None, :])
            for first in range(0, len(terms.dictionary), CHUNK_TERMS):
                last = min(first + CHUNK_TERMS, len(terms.dictionary))
                a, b = np.searchsorted(column, [first, last])
                values = np.repeat(zeros[:, None], last - first, axis=1)
                values[row[a:b], column[a:b] - first] = p[a:b]
                theirs = values[right]
                for k, place in enumerate(left):
                    sums[k] += np.abs(theirs - values[place]).sum(axis=1) - base[k] * (last - first)
            a, b = np.repeat(places[left], len(right)), np.tile(places[right], len(left))
            wanted = a < b
            return pa.table(
                {"lang": pa.array([lang] * int(wanted.sum()), pa.string()), "a": a[wanted], "b": b[wanted], "part": sums.reshape(-1)[wanted]}
            )

        tiles = rows.groupBy("lang", "bucket", "low", "high").applyInArrow(tile, "lang string, a long, b long, part long")
        return tiles.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))

    def distances(self) -> DataFrame:
        """Every source of a language against every other, nearest last.

        The pairs are the result itself. They meet in tiles of two blocks, so no
        task gets all pairs of a language.
        """
        g = self.groups.select("lang", "source", "place", "block", "blocks", "kept", "zero")
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        left = g.select("lang", F.col("block").alias("low"), other.alias("high"), F.col("source").alias("sa"), F.col("place").alias("a"), F.col("zero").alias("za"), "kept")
        right = g.select("lang", other.alias("low"), F.col("block").alias("high"), F.col("source").alias("sb"), F.col("place").alias("b"), F.col("zero").alias("zb"))
        pairs = left.join(right, ["lang", "low", "high"]).where("a < b")
        pairs = pairs.join(self._tile_sums(), ["lang", "a", "b"], "left")
        value = F.col("kept") * F.abs(F.col("za") - F.col("zb")) + F.coalesce("part", F.lit(0))
        both = F.explode(F.array(F.struct(F.col("sa").alias("source"), F.col("sb").alias("item")), F.struct(F.col("sb").alias("source"), F.col("sa").alias("item"))))
        found = pairs.select("lang", both.alias("p"), value.alias("value")).select("lang", "p.source", "p.item", "value")
        return found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def report(docs: DataFrame, least_docs: int = 30, most_terms: int = 50) -> DataFrame:
    """Both reports in one table, told apart by ``part``."""
    audit = Audit(docs, least_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = audit.distances().withColumn("part", F.lit("pair")).select(columns)
    return pairs.unionByName(audit.excess_terms(most_terms).withColumn("part", F.lit("term")).select(columns))


#: The rows of ``report`` in DuckDB's SQL.
SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
kept AS (SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
cnt AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (
  SELECT g.lang, g.source, coalesce(sum(cnt.c), 0)::HUGEINT AS n
  FROM grp g LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source GROUP BY ALL),
p AS (
  SELECT t.lang, t.source, k.term, coalesce(cnt.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(cnt.c, 0) + 5)) // (t.n + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.c + 5)) // (l.n + 5 * l.v) AS q
  FROM tot t JOIN langs l ON l.lang = t.lang JOIN kept k ON k.lang = t.lang
  LEFT JOIN cnt ON cnt.lang = t.lang AND cnt.source = t.source AND cnt.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q),
found AS (SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term', * FROM terms),
ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
