"""The three analytical reports.

Dimension joins carry no broadcast hint: a dimension grows with the business,
so its size decides. Only the date spine, fixed at a few thousand rows, is
always broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numbers import rounded_mean, unscaled
from ..operators.rolling import rolling_mean
from ..operators.skew import HOT_ROWS
from ..operators.streaks import streaks

# Air-quality index bands, upper bound inclusive.
AQI_BANDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
AQI_TOP_BAND = "Hazardous"
UNHEALTHY_ABOVE = 150


# The orders of the reports; give them to ``operators.positions`` to carry the place in a column.
def rolling_order() -> list[Column]:
    return [F.col("city_name"), F.desc("reading_ts")]


def streak_order() -> list[Column]:
    return [F.desc("consecutive_readings"), F.desc("avg_aqi_in_streak"), F.col("city_id"), F.col("streak_start")]


def leaderboard_order() -> list[Column]:
    return [F.desc("year"), F.desc("week_of_year"), F.col("rank_worst_aqi"), F.col("city_name")]


def aqi_category(value: Column) -> Column:
    (first, name), *rest = AQI_BANDS
    label = F.when(value <= first, name)
    for upper, name in rest:
        label = label.when(value <= upper, name)
    return label.otherwise(AQI_TOP_BAND)


def rolling_24h_average(
    weather: DataFrame,
    dim_city: DataFrame,
    since: Column | None = None,
    *,
    scale: int = 2,
    ordered: bool = True,
    hot_rows: int | None = HOT_ROWS,
    bin_seconds: int = 3600,
) -> DataFrame:
    """Each reading from ``since`` on with the mean of the 24 hours up to it.

    The time filter comes before the window, so frames on the first day are cut
    off. ``since`` defaults to seven days ago; a scalar subquery works too and
    still reaches the scan. Where the fact is stored by ``reading_day``, whole
    days are pruned.
    """
    since = F.current_timestamp() - F.expr("INTERVAL 7 DAYS") if since is None else since
    recent = weather.filter(F.col("reading_ts") >= since)
    if "reading_day" in weather.columns:
        recent = recent.filter(F.col("reading_day") >= since.cast("date"))
    averaged = rolling_mean(
        recent.select("city_id", "reading_ts", "temperature_c"),
        "temperature_c",
        scale=scale,
        mean_name="rolling_24h_avg_temp_c",
        hot_rows=hot_rows,
        bin_seconds=bin_seconds,
    )
    report = averaged.join(dim_city.select("city_id", "city_name", "state"), "city_id").select(
        "city_name",
        "state",
        "reading_ts",
        F.col("temperature_c").alias("raw_temperature_c"),
        "rolling_24h_avg_temp_c",
        "readings_in_window",
    )
    return report.orderBy(*rolling_order()) if ordered else report


def unhealthy_streaks(
    air_quality: DataFrame,
    dim_city: DataFrame,
    *,
    threshold: int = UNHEALTHY_ABOVE,
    min_length: int = 3,
    scale: int = 0,
    tie_break: list[str] | None = None,
    ordered: bool = True,
    hot_rows: int | None = HOT_ROWS,
    bin_seconds: int = 3600,
) -> DataFrame:
    """Runs of at least ``min_length`` consecutive readings above ``threshold``, longest first."""
    runs = streaks(
        air_quality,
        "aqi_value",
        threshold,
        tie_break=tie_break,
        min_length=min_length,
        scale=scale,
        hot_rows=hot_rows,
        bin_seconds=bin_seconds,
    )
    report = runs.join(dim_city.select("city_id", "city_name", "state"), "city_id").select(
        "city_id",
        "city_name",
        "state",
        "streak_start",
        "streak_end",
        "consecutive_readings",
        F.col("mean").alias("avg_aqi_in_streak"),
        F.col("peak").alias("peak_aqi"),
        "streak_duration",
        "streak_seconds",
    )
    if not ordered:
        return report
    return report.orderBy(*streak_order())


def weekly_leaderboard(
    air_quality: DataFrame,
    dim_date: DataFrame,
    dim_city: DataFrame,
    *,
    top: int = 5,
    scale: int = 0,
    ordered: bool = True,
) -> DataFrame:
    """Per week, the cities with the worst mean index, ranks up to ``top`` (ties share a rank).

    Weeks are (calendar year, ISO week) as the date dimension has them, and the
    start date is the first day with a reading. The rank limit prunes within
    each task before the ranking shuffle, and names are looked up for the few
    rows that remain.
    """
    days = dim_date.select("date_key", "full_date", "year", "week_of_year")
    weekly = (
        air_quality.filter(F.col("aqi_value").isNotNull())
        .select("city_id", "date_key", unscaled(F.col("aqi_value"), scale).alias("_units"))
        .join(days, "date_key")
        .groupBy("city_id", "year", "week_of_year")
        .agg(
            F.min("full_date").alias("week_start_date"),
            F.sum("_units").alias("_total"),
            F.count(F.lit(1)).alias("readings_count"),
        )
        .withColumn("avg_aqi", rounded_mean(F.col("_total"), F.col("readings_count"), scale, 1))
    )
    worst_first = Window.partitionBy("year", "week_of_year").orderBy(F.desc("avg_aqi"))
    report = (
        weekly.withColumn("rank_worst_aqi", F.rank().over(worst_first))
        .filter(F.col("rank_worst_aqi") <= top)
        .join(dim_city.select("city_id", "city_name", "state"), "city_id")
        .select(
            "year",
            "week_of_year",
            "week_start_date",
            "rank_worst_aqi",
            "city_name",
            "state",
            "avg_aqi",
            "readings_count",
            aqi_category(F.col("avg_aqi")).alias("aqi_category"),
        )
    )
    if not ordered:
        return report
    return report.orderBy(*leaderboard_order())
