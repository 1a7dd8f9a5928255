"""Runs of consecutive readings above a threshold, per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import rounded_mean, unscaled
from .skew import HOT_ROWS, bin_of, carry_in, split_hot


def streaks(
    readings: DataFrame,
    value: str,
    threshold: int,
    *,
    key: str = "city_id",
    ts: str = "reading_ts",
    tie_break: list[str] | None = None,
    min_length: int = 3,
    scale: int = 0,
    digits: int = 1,
    hot_rows: int | None = HOT_ROWS,
    bin_seconds: int = 3600,
) -> DataFrame:
    """One row per run of at least ``min_length`` readings with ``value > threshold``.

    Readings without a value are left out before runs are formed, so they do not
    break one. A run is identified by how many readings at or below the
    threshold precede it: that needs one running count instead of the difference
    of two row numbers, hence one sort. Runs are collapsed by an ordinary
    aggregate that combines before its shuffle, so one endless run is no problem.
    """
    order = [ts, *(tie_break or [])]
    valued = readings.filter(F.col(value).isNotNull()).select(key, *order, value)
    breaks = (F.col(value) <= threshold).cast("bigint")

    def numbered(df: DataFrame, group: list[str], base):
        before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select(key, ts, value, (base + F.sum(breaks).over(before)).alias("_island"))

    cold, hot = split_hot(valued, key, hot_rows)
    hot = hot.withColumn("_bin", bin_of(F.unix_micros(F.col(ts).cast("timestamp")), bin_seconds))
    carried = carry_in(hot, key, "_bin", {"_breaks_in": breaks})
    islands = numbered(hot.join(carried, [key, "_bin"]), [key, "_bin"], F.col("_breaks_in"))
    if hot_rows is not None:
        islands = numbered(cold, [key], F.lit(0)).unionByName(islands)

    units = unscaled(F.col(value), scale)
    return (
        islands.filter(F.col(value) > threshold)
        .groupBy(key, "_island")
        .agg(
            F.min(ts).alias("streak_start"),
            F.max(ts).alias("streak_end"),
            F.count(F.lit(1)).alias("consecutive_readings"),
            F.sum(units).alias("_total"),
            F.max(value).alias("peak"),
        )
        .filter(F.col("consecutive_readings") >= min_length)
        .select(
            key,
            "streak_start",
            "streak_end",
            "consecutive_readings",
            rounded_mean(F.col("_total"), F.col("consecutive_readings"), scale, digits).alias("mean"),
            "peak",
            (F.col("streak_end") - F.col("streak_start")).alias("streak_duration"),
            (
                F.unix_seconds(F.col("streak_end").cast("timestamp"))
                - F.unix_seconds(F.col("streak_start").cast("timestamp"))
            ).alias("streak_seconds"),
        )
    )
