"""Rolling mean over a trailing time range, per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import rounded_mean, unscaled
from .skew import HOT_ROWS, bin_of, carry_in, split_hot


def rolling_mean(
    readings: DataFrame,
    value: str,
    *,
    key: str = "city_id",
    ts: str = "reading_ts",
    hours: int = 24,
    scale: int = 2,
    digits: int = 2,
    mean_name: str = "rolling_mean",
    count_name: str = "readings_in_window",
    hot_rows: int | None = HOT_ROWS,
    bin_seconds: int = 3600,
) -> DataFrame:
    """Add the mean of ``value`` and the number of readings in the last ``hours``.

    The range is ``[ts - hours, ts]``, both ends included. The mean ignores null
    values, the count does not. ``value`` is a decimal of ``scale`` digits. Give
    only the needed columns: all of them travel through the shuffle.
    """
    cold, hot = split_hot(readings, key, hot_rows)
    parts = [_swept(hot, value, key, ts, hours, scale, bin_seconds)]
    if hot_rows is not None:
        parts.insert(0, _windowed(cold, value, key, ts, hours, scale))
    summed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return summed.select(
        *readings.columns,
        rounded_mean(F.col("_total"), F.col("_valued"), scale, digits).alias(mean_name),
        F.col("_readings").alias(count_name),
    )


def _windowed(df: DataFrame, value: str, key: str, ts: str, hours: int, scale: int) -> DataFrame:
    """One sort per key; the frame is a range on the timestamp itself, exact to the microsecond."""
    frame = f"(PARTITION BY `{key}` ORDER BY `{ts}` RANGE BETWEEN INTERVAL {hours} HOURS PRECEDING AND CURRENT ROW)"
    return df.withColumn("_units", unscaled(F.col(value), scale)).select(
        *df.columns,
        F.expr(f"sum(_units) OVER {frame}").alias("_total"),
        F.expr(f"count(_units) OVER {frame}").alias("_valued"),
        F.expr(f"count(1) OVER {frame}").alias("_readings"),
    )


def _swept(df: DataFrame, value: str, key: str, ts: str, hours: int, scale: int, bin_seconds: int) -> DataFrame:
    """The same sums without one task per key.

    Every reading enters the range at its own time and leaves it ``hours``
    later. Laying both moments on one axis turns the range sum into a running
    sum of entries minus exits, and a running sum splits into time bins: what
    earlier bins carry in, plus the rows of the bin up to here. Axis positions
    are doubled, with exits on the odd ones, because a reading exactly ``hours``
    old still counts.
    """
    shift = hours * 3600 * 1_000_000
    units = unscaled(F.col(value), scale)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    entry = F.struct(
        (at * 2).alias("_pos"),
        F.lit(1).cast("bigint").alias("_n"),
        units.isNotNull().cast("bigint").alias("_c"),
        F.coalesce(units, F.lit(0).cast("bigint")).alias("_v"),
        F.struct(*df.columns).alias("_row"),
    )
    exit_ = F.struct(
        ((at + shift) * 2 + 1).alias("_pos"),
        F.lit(-1).cast("bigint").alias("_n"),
        (-units.isNotNull().cast("bigint")).alias("_c"),
        (-F.coalesce(units, F.lit(0).cast("bigint"))).alias("_v"),
        F.lit(None).cast(df.select(F.struct(*df.columns).alias("_row")).schema["_row"].dataType).alias("_row"),
    )
    moves = (
        df.select(F.col(key).alias("_key"), F.explode(F.array(entry, exit_)).alias("_move"))
        .select("_key", "_move.*")
        .withColumn("_bin", bin_of(F.col("_pos"), 2 * bin_seconds))
    )
    carried = carry_in(
        moves, "_key", "_bin", {"_n_in": F.col("_n"), "_c_in": F.col("_c"), "_v_in": F.col("_v")}
    )
    so_far = Window.partitionBy("_key", "_bin").orderBy("_pos")
    return (
        moves.join(carried, ["_key", "_bin"])
        .select(
            "_row",
            (F.col("_v_in") + F.sum("_v").over(so_far)).alias("_total"),
            (F.col("_c_in") + F.sum("_c").over(so_far)).alias("_valued"),
            (F.col("_n_in") + F.sum("_n").over(so_far)).alias("_readings"),
        )
        .filter(F.col("_row").isNotNull())
        .select("_row.*", "_total", "_valued", "_readings")
    )
