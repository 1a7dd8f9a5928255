"""Document fingerprints: threshold-scaled sketches of word shingles.

A document's shingles are its runs of five words. Those whose 64-bit hash lies
below a fixed fraction of all hashes make up its sketch, whatever the length of the
document. So the sketch of a union is the union of the sketches, and the share
of a sketch that another holds estimates how much of the document the other
contains, however unequal the two are. A document that would have an empty
sketch keeps its smallest hash (the smallest of a union is that of its parts).

Only DataFrame functions are used. Each text is shuffled once, to meet the
beginning of the text that follows it.

Defined results: a null or empty text has an empty sketch; two empty sketches
are alike (1), an empty and another are not (0); fewer than five words are one
shingle; rows are in the order of their id, null first, and rows of one id in
the order of the input; the row after the last is the first, so a single row
follows itself; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.barrier import computed_once

from .common import partitions_for, stored

SHINGLE = 5
#: One in so many hashes is kept.
SCALE = 8
_WHITE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sketch(text: Column, scale: int = SCALE, shingle: int = SHINGLE) -> Column:
    """The sorted hashes of ``text`` that lie in the lowest 1/``scale`` of all hashes."""
    limit = -(1 << 63) + (1 << 64) // scale

    def hashes(words: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(words) - shingle),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(shingle)]),
        )
        return (
            F.when(F.size(words) >= shingle, runs)
            .when(F.size(words) > 0, F.array(F.xxhash64(F.concat_ws(" ", words))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    def kept(every: Column) -> Column:
        below = F.filter(every, lambda h: h < limit)
        return F.when((F.size(below) == 0) & (F.size(every) > 0), F.array(F.array_min(every))).otherwise(
            F.sort_array(F.array_distinct(below))
        )

    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), _WHITE), "")
    return _let(_let(words, hashes), kept)


def printed(hashes: Column) -> Column:
    """16 hexadecimal digits for each hash."""
    return F.concat_ws("", F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")))


def containment(part: Column, whole: Column) -> Column:
    """The estimated share of one document's shingles that the other has too."""
    return F.when(F.size(part) == 0, F.when(F.size(whole) == 0, 1.0).otherwise(0.0)).otherwise(
        F.size(F.array_intersect(part, whole)) / F.size(part)
    )


def followers(rows: DataFrame, id_column: str) -> DataFrame:
    """For each ``row`` the ``next_row`` in the order of the id, over the whole table.

    Rows are dealt by ranges, put in order within each range, and the last of a
    range is followed by the first of the next range.
    """
    n = partitions_for(rows.sparkSession)
    ranged = rows.repartitionByRange(n, F.col(id_column).asc_nulls_first(), F.col("row").asc())
    ranged = ranged.withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "order")
    order = [F.col(id_column).asc_nulls_first(), F.col("row").asc()]
    firsts = ranged.groupBy("part").agg(F.min(F.struct(id_column, "row"))["row"].alias("first_row"))
    parts = Window.orderBy("part")
    after = firsts.select(
        F.col("part").alias("_part"),
        F.coalesce(
            F.lead("first_row").over(parts),
            F.first("first_row").over(parts.rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("after"),
    )
    within = ranged.withColumn("next_row", F.lead("row").over(Window.partitionBy("part").orderBy(*order)))
    return (
        within.join(after, F.col("part") == F.col("_part"))
        .withColumn("next_row", F.coalesce("next_row", "after"))
        .drop("part", "_part", "after")
    )


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scale: int = SCALE, shingle: int = SHINGLE
) -> DataFrame:
    """Each document's sketch: id, ``hashes`` and their printed form ``fingerprint``."""
    sketched = docs.select(id_column, sketch(F.col(text_column), scale, shingle).alias("hashes"))
    return computed_once(sketched).withColumn("fingerprint", printed(F.col("hashes")))


def edited_fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", scale: int = SCALE, shingle: int = SHINGLE
) -> DataFrame:
    """Fingerprints of the texts and of their edited forms, and how alike they are.

    The edited form has its last quarter replaced by as much of the beginning
    of the next document, or by all of that.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    lengths = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.length(text_column), F.lit(0)).alias("n"),
    )
    # The ids travel with the order, so that both joins read the same columns of the texts from one shuffle.
    following = stored(
        followers(lengths, "doc_id").select(
            F.col("row").alias("_row"), "doc_id", "next_row", F.floor(F.col("n") / 4).cast("int").alias("_cut")
        ),
        "following",
    )
    heads = texts.join(following, F.col("row") == F.col("next_row")).select(
        "_row",
        "doc_id",
        "_cut",
        F.substring("text", F.lit(1), F.col("_cut")).alias("_head"),
        sketch(F.col("text"), scale, shingle).alias("next_hashes"),
    )
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("_cut"))
    edited = texts.join(heads, F.col("row") == F.col("_row")).select(
        "doc_id", "text", F.concat(kept, F.col("_head")).alias("edited"), "next_hashes"
    )
    sketched = edited.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch(F.col("text"), scale, shingle).alias("hashes"),
        sketch(F.col("edited"), scale, shingle).alias("edited_hashes"),
        "next_hashes",
    )
    return computed_once(sketched).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("hashes")).alias("fingerprint"),
        printed(F.col("edited_hashes")).alias("edited_fingerprint"),
        containment(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        containment(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )
