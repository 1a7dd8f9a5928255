"""Splitting off keys that hold too many rows for one task.

A window over one key runs in one task. That is the cheapest plan while every
key is small, so only keys above a row threshold leave it for a two-level plan
that spreads them over time bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key that one task sorts comfortably in memory.
HOT_ROWS = 5_000_000


def split_hot(df: DataFrame, key: str, hot_rows: int | None) -> tuple[DataFrame, DataFrame]:
    """``(cold, hot)`` rows, hot being those of keys with more than ``hot_rows`` rows.

    The counting pass reads one column and combines before its shuffle. At most
    ``rows / hot_rows`` keys can be hot, 200,000 long values for 10^12 rows,
    which bounds the broadcast; with a smaller threshold there may be more, and
    Spark chooses by size. ``hot_rows=None`` counts nothing and calls every key hot.
    """
    if hot_rows is None:
        return df.filter(F.lit(False)), df
    hot_keys = df.groupBy(key).count().filter(F.col("count") > hot_rows).select(key)
    hot_keys = F.broadcast(hot_keys) if hot_rows >= HOT_ROWS else hot_keys
    return df.join(hot_keys, key, "left_anti"), df.join(hot_keys, key, "left_semi")


def bin_of(micros: Column, bin_seconds: int) -> Column:
    return F.call_function("div", micros, F.lit(bin_seconds * 1_000_000))


def carry_in(df: DataFrame, key: str, bin_column: str, sums: dict[str, Column]) -> DataFrame:
    """Per (key, bin): each sum over all earlier bins of that key, 0 in the first.

    The window sees one row per bin, so a key's group is as long as its time
    span has bins, however many rows they hold.
    """
    earlier = Window.partitionBy(key).orderBy(bin_column).rowsBetween(Window.unboundedPreceding, -1)
    per_bin = df.groupBy(key, bin_column).agg(*[F.sum(col).alias(name) for name, col in sums.items()])
    return per_bin.select(
        key, bin_column, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums]
    )
