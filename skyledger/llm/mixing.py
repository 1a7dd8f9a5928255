"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same number of copies on average, the
source's target over its words: a whole part that all get, and a fraction.
The fractions are rounded in pairs: words move at random from one document to
the other, with equal odds on balance, until one of the two is at nought or
one. What is left of the other meets the next document. As words move and none
are lost, a source's words stay at its target up to one document.

A reduction tree does this at any size: blocks of about 64 documents drawn by
hash are folded each to one left-over document, and the left-overs are folded
again until a source has one, which is rounded by chance. Documents with more than
1/64 of their source's words, fewer than 64 a source, come first, and the
others make up for their rounding; so a huge document does not bend the mix.

Only DataFrame functions are used. No source is ever gathered in one task.

Defined results: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own, the last in order; repeated rows and repeated
ids are documents of their own; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.positions import with_positions

from .common import WORD, stored, uniform

#: Documents in a block, on average.
BLOCK = 64
SEED = 20240609

_UNIT = "struct<row:bigint,size:bigint,base:int,p:double>"
_STATE = "struct<row:bigint,size:bigint,base:int,p:double,done:array<struct<row:bigint,copies:int>>>"


def word_count(text_column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")


def units_of(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    carried: Sequence[str] = (),
) -> DataFrame:
    """The rows to mix with the columns ``carried``, numbered in the order of source, id and a hash of the text.

    All draws hang on that number. It follows from the rows alone, so reruns agree however
    the input is split; rows that are equal in all three are interchangeable.
    """
    units = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        word_count(text_column).alias("size"),
        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("hash"),
        *carried,
    )
    order = (F.col("source").asc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("hash"))
    # Stored first: words are counted once, not again to find the ranges.
    return with_positions(stored(units, "mix-sizes"), *order, name="row").drop("hash")


def targets(units: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: its words and its target.

    The target is the least of ``most`` times the source's words and its weight
    times a level that all sources share. In the order of the level at which
    sources reach their limit, the level follows from running sums.
    """
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    )
    ranked = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    from_here = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) * float(share) - before) / from_here
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select("source", "source_size", "n", F.least("limit", F.col("weight") * F.col("level")).alias("target"))
    )


def _met(state: Column, unit: Column) -> Column:
    """The state after its left-over document has met ``unit``."""
    one, other = state["size"] * state["p"], unit["size"] * unit["p"]
    given = F.least(one, unit["size"] * (1 - unit["p"]))  # words that can go to the unit
    taken = F.least(state["size"] * (1 - state["p"]), other)  # and from it
    forth = uniform(state["row"], unit["row"], seed=SEED) * (given + taken) < taken
    # Which of the two is integral now, at which value, and the other's fraction.
    unit_stays = (forth & (given >= one)) | (~forth & (taken >= state["size"] * (1 - state["p"])))
    state_is = F.when(forth, F.lit(0)).otherwise(F.lit(1))
    unit_is = F.when(forth, F.lit(1)).otherwise(F.lit(0))
    moved = F.when(forth, given).otherwise(-taken)
    p = F.when(unit_stays, (other + moved) / unit["size"]).otherwise((one - moved) / state["size"])
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))
    settled = F.when(
        unit_stays,
        F.struct(state["row"].alias("row"), (state["base"] + state_is).cast("int").alias("copies")),
    ).otherwise(F.struct(unit["row"].alias("row"), (unit["base"] + unit_is).cast("int").alias("copies")))

    def left(field: str) -> Column:
        return F.when(unit_stays, unit[field]).otherwise(state[field]).alias(field)

    first = F.struct(
        unit["row"].alias("row"), unit["size"].alias("size"), unit["base"].alias("base"), unit["p"].alias("p"),
        state["done"].alias("done"),
    )
    met = F.struct(
        left("row"), left("size"), left("base"), p.alias("p"), F.concat(state["done"], F.array(settled)).alias("done")
    )
    return F.when(state["row"].isNull(), first.cast(_STATE)).otherwise(met.cast(_STATE))


def folded(units: Column) -> Column:
    """An array of units reduced to its left-over unit and the copies of all others."""
    start = F.expr(f"CAST(named_struct('row', NULL, 'size', NULL, 'base', NULL, 'p', NULL, 'done', array()) AS {_STATE})")
    return F.aggregate(units, start, _met)


def _unit(rate: Column) -> Column:
    base = F.floor(rate)
    return F.struct("row", "size", base.cast("int").alias("base"), (rate - base).alias("p")).cast(_UNIT)


def _last(state: str) -> Column:
    """Copies of a left-over unit, rounded by chance."""
    up = uniform(F.col(state)["row"], seed=SEED + 1) < F.col(state)["p"]
    return F.struct(
        F.col(state)["row"].alias("row"), (F.col(state)["base"] + up.cast("int")).cast("int").alias("copies")
    )


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def mix(
    units: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """How often each unit is taken: its columns, its source's size and target, and ``copies``.

    ``units`` has row (distinct), doc_id, source and size. Sources weigh
    ``weights`` in turn and share ``share`` of all words; none gives more than
    ``most`` times its own.
    """
    units = stored(units, "mix-units")
    aims = stored(targets(units, weights, share, most), "mix-targets")

    def join_aims(df: DataFrame, table: DataFrame) -> DataFrame:
        return df.join(table.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop(
            "_source"
        )

    full = join_aims(units.where("size > 0"), aims)
    is_large = F.col("size") * BLOCK > F.col("source_size")
    rate = F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))
    large = (
        full.where(is_large)
        .groupBy("source")
        .agg(
            F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("o"), _unit(rate).alias("u")))).alias("us"),
            F.sum("size").alias("large_size"),
            F.count("*").alias("large_n"),
        )
        .withColumn("state", folded(F.transform("us", lambda x: x["u"])))
        .withColumn("done", F.concat(F.col("state.done"), F.array(_last("state"))))
        .withColumn("size_of", F.map_from_entries(F.transform("us", lambda x: F.struct(x["u"]["row"], x["u"]["size"]))))
        .withColumn(
            "large_taken",
            F.aggregate("done", F.lit(0).cast("long"), lambda a, d: a + d["copies"] * F.col("size_of")[d["row"]]),
        )
        .select("source", "large_size", "large_n", "large_taken", "done")
    )
    large = stored(large, "mix-large")
    of_large = large.drop("done").withColumnRenamed("source", "_source")
    rest = F.col("source_size") - F.coalesce("large_size", F.lit(0))
    aims_rest = aims.join(of_large, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source",
        "source_size",
        (F.col("n") - F.coalesce("large_n", F.lit(0))).alias("n"),
        F.when(
            rest > 0,
            F.least(
                F.lit(float(most)),
                F.greatest(F.lit(0.0), (F.col("target") - F.coalesce("large_taken", F.lit(0))) / rest),
            ),
        ).otherwise(0.0).alias("rate"),
    )
    aims_rest = stored(aims_rest, "mix-rest")
    open_units = (
        join_aims(units.where("size > 0"), aims_rest)
        .where(~is_large)
        .select("source", F.ceil(F.col("n") / BLOCK).alias("blocks"), _unit(F.col("rate")).alias("u"))
    )
    settled = [large.select(F.explode("done").alias("d"))]
    most_blocks = aims_rest.agg(F.coalesce(F.max(F.ceil(F.col("n") / BLOCK)), F.lit(0))).first()[0]
    level = 0
    while most_blocks >= 1:
        level += 1
        block = F.pmod(F.xxhash64(F.lit(SEED + 10 + level), F.col("u.row")), F.greatest(F.lit(1), F.col("blocks")))
        blocks = (
            open_units.groupBy("source", "blocks", block.alias("block"))
            .agg(F.sort_array(F.collect_list("u")).alias("us"))
            .select("source", "blocks", folded(F.col("us")).alias("state"))
        )
        blocks = stored(blocks, "mix-level")
        settled.append(blocks.select(F.explode("state.done").alias("d")))
        finished = F.col("blocks") <= 1
        settled.append(blocks.where(finished).select(_last("state").alias("d")))
        open_units = blocks.where(~finished).select(
            "source",
            F.ceil(F.col("blocks") / BLOCK).alias("blocks"),
            F.struct("state.row", "state.size", "state.base", "state.p").cast(_UNIT).alias("u"),
        )
        most_blocks = 0 if most_blocks <= 1 else -(-most_blocks // BLOCK)
    copies = settled[0]
    for part in settled[1:]:
        copies = copies.unionByName(part)
    copies = copies.select(F.col("d.row").alias("_row"), F.col("d.copies").alias("copies"))
    mixed = units.join(copies, F.col("row") == F.col("_row"), "left").drop("_row")
    mixed = mixed.withColumn("copies", F.coalesce("copies", F.lit(0)))
    return join_aims(mixed, aims.drop("n"))


def digests(mixed: DataFrame) -> DataFrame:
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )
