"""The orders of the reports, as places that each row carries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.dimension import active
from skyledger.operators.positions import with_positions
from skyledger.plans import analytics

from .analytics import ORACLES as REPORTS
from .analytics import STREAK_THRESHOLD, spine_over
from .standins import as_text, before_latest_event, dim_city, readings, table


def rolling_24h_avg_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City by city, latest reading first."""
    report = analytics.rolling_24h_average(
        readings(spark, sf_dir, "temperature_c"), dim_city(spark, sf_dir), before_latest_event(spark, sf_dir, "7 DAYS"), ordered=False
    )
    placed = with_positions(report, *analytics.rolling_order(), F.col("raw_temperature_c"))
    return placed.select(
        "position", "city_name", as_text("reading_ts").alias("reading_ts"),
        F.col("raw_temperature_c").cast("double").alias("raw_temperature_c"),
        F.col("rolling_24h_avg_temp_c").cast("double").alias("rolling_24h_avg_temp_c"),
    )


def unhealthy_streaks_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest first, then the worse; equal ones by city and start."""
    report = analytics.unhealthy_streaks(
        readings(spark, sf_dir, "aqi_value"), dim_city(spark, sf_dir), threshold=STREAK_THRESHOLD, scale=2, tie_break=["event_id"], ordered=False
    )
    return with_positions(report, *analytics.streak_order()).select(
        "position", "city_id", as_text("streak_start").alias("streak_start"), "consecutive_readings",
        F.col("avg_aqi_in_streak").cast("double").alias("avg_aqi_in_streak"),
    )


def weekly_leaderboard_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest week first, worst city first; equal ranks by name."""
    report = analytics.weekly_leaderboard(
        readings(spark, sf_dir, "aqi_value"), spine_over(table(spark, sf_dir, "events"), "ts"), dim_city(spark, sf_dir), scale=2, ordered=False
    )
    return with_positions(report, *analytics.leaderboard_order()).select(
        "position", F.col("year").cast("bigint").alias("year"), F.col("week_of_year").cast("bigint").alias("week_of_year"),
        F.col("rank_worst_aqi").cast("bigint").alias("rank_worst_aqi"), "city_name",
    )


def active_entities_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities to fetch readings for, by number."""
    return with_positions(active(dim_city(spark, sf_dir)), F.col("city_id")).select("position", "city_id", "city_name")


QUERIES = {
    "rolling_24h_avg_order": rolling_24h_avg_order,
    "unhealthy_streaks_order": unhealthy_streaks_order,
    "weekly_leaderboard_order": weekly_leaderboard_order,
    "active_entities_order": active_entities_order,
}


def _placed(columns: str, order: str, report: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) AS position, {columns} FROM ({report})"


ORACLES = {
    "rolling_24h_avg_order": _placed(
        "city_name, reading_ts, raw_temperature_c, rolling_24h_avg_temp_c",
        "city_name, reading_ts DESC, raw_temperature_c", REPORTS["rolling_24h_avg"],
    ),
    "unhealthy_streaks_order": _placed(
        "city_id, streak_start, consecutive_readings, avg_aqi_in_streak",
        "consecutive_readings DESC, avg_aqi_in_streak DESC, city_id, streak_start", REPORTS["unhealthy_streaks"],
    ),
    "weekly_leaderboard_order": _placed(
        "year, week_of_year, rank_worst_aqi, city_name",
        "year DESC, week_of_year DESC, rank_worst_aqi, city_name", REPORTS["weekly_leaderboard"],
    ),
    "active_entities_order": """
SELECT row_number() OVER (ORDER BY c_custkey) AS position, c_custkey AS city_id, c_name AS city_name
FROM customer WHERE c_acctbal >= 0
""",
}
