"""The three reports and the date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.calendar import spine_over
from skyledger.operators.skew import HOT_ROWS
from skyledger.plans import analytics

from .standins import as_text, before_latest_event, dim_city, readings, table

# The events' values rarely pass 150, so streaks are taken above 50.
STREAK_THRESHOLD = 50


def _rolling(spark: SparkSession, sf_dir: str, hot_rows: int | None) -> DataFrame:
    report = analytics.rolling_24h_average(
        readings(spark, sf_dir, "temperature_c"),
        dim_city(spark, sf_dir),
        before_latest_event(spark, sf_dir, "7 DAYS"),
        hot_rows=hot_rows,
    )
    return report.select(
        "city_name",
        "state",
        as_text("reading_ts").alias("reading_ts"),
        F.col("raw_temperature_c").cast("double").alias("raw_temperature_c"),
        F.col("rolling_24h_avg_temp_c").cast("double").alias("rolling_24h_avg_temp_c"),
        "readings_in_window",
    )


def rolling_24h_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir, HOT_ROWS)


def rolling_24h_avg_all_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir, None)


def rolling_24h_avg_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolling(spark, sf_dir, 16)


def _streaks(spark: SparkSession, sf_dir: str, hot_rows: int | None) -> DataFrame:
    report = analytics.unhealthy_streaks(
        readings(spark, sf_dir, "aqi_value"),
        dim_city(spark, sf_dir),
        threshold=STREAK_THRESHOLD,
        scale=2,
        tie_break=["event_id"],
        hot_rows=hot_rows,
    )
    return report.select(
        "city_id",
        "city_name",
        "state",
        as_text("streak_start").alias("streak_start"),
        as_text("streak_end").alias("streak_end"),
        "consecutive_readings",
        F.col("avg_aqi_in_streak").cast("double").alias("avg_aqi_in_streak"),
        F.col("peak_aqi").cast("double").alias("peak_aqi"),
        "streak_seconds",
    )


def unhealthy_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streaks(spark, sf_dir, HOT_ROWS)


def unhealthy_streaks_all_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streaks(spark, sf_dir, None)


def weekly_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = analytics.weekly_leaderboard(
        readings(spark, sf_dir, "aqi_value"),
        spine_over(table(spark, sf_dir, "events"), "ts"),
        dim_city(spark, sf_dir),
        scale=2,
    )
    return report.select(
        F.col("year").cast("bigint").alias("year"),
        F.col("week_of_year").cast("bigint").alias("week_of_year"),
        F.col("week_start_date").cast("string").alias("week_start_date"),
        F.col("rank_worst_aqi").cast("bigint").alias("rank_worst_aqi"),
        "city_name",
        "state",
        F.col("avg_aqi").cast("double").alias("avg_aqi"),
        "readings_count",
        "aqi_category",
    )


def weekly_leaderboard_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report over seven years of orders: year ends and many weeks."""
    from skyledger.functions.times import date_key

    orders = table(spark, sf_dir, "orders")
    facts = orders.select(
        F.col("o_custkey").alias("city_id"),
        date_key(F.col("o_orderdate")).alias("date_key"),
        (F.col("o_totalprice") / 1000).cast("decimal(12,2)").alias("aqi_value"),
    )
    report = analytics.weekly_leaderboard(facts, spine_over(orders, "o_orderdate"), dim_city(spark, sf_dir), scale=2)
    return report.select(
        F.col("year").cast("bigint").alias("year"),
        F.col("week_of_year").cast("bigint").alias("week_of_year"),
        F.col("week_start_date").cast("string").alias("week_start_date"),
        F.col("rank_worst_aqi").cast("bigint").alias("rank_worst_aqi"),
        "city_name",
        F.col("avg_aqi").cast("double").alias("avg_aqi"),
        "readings_count",
        "aqi_category",
    )


def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the orders' span with its attributes and its number of orders."""
    orders = table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    days = spine_over(orders, "o_orderdate").join(per_day, "full_date", "left")
    numbers = ["date_key", "day_of_week", "day_of_month", "day_of_year", "week_of_year", "month", "quarter", "year"]
    return days.select(
        *[F.col(name).cast("bigint").alias(name) for name in numbers],
        F.col("full_date").cast("string").alias("full_date"),
        "day_name",
        "month_name",
        "is_weekend",
        F.coalesce("orders", F.lit(0)).alias("orders"),
    )


QUERIES = {
    "rolling_24h_avg": rolling_24h_avg,
    "rolling_24h_avg_all_hot": rolling_24h_avg_all_hot,
    "rolling_24h_avg_mixed": rolling_24h_avg_mixed,
    "unhealthy_streaks": unhealthy_streaks,
    "unhealthy_streaks_all_hot": unhealthy_streaks_all_hot,
    "weekly_leaderboard": weekly_leaderboard,
    "weekly_leaderboard_orders": weekly_leaderboard_orders,
    "date_spine": date_spine,
}

_ROLLING = """
WITH fact AS (
  SELECT user_id, ts, cast(round(value * 100) AS bigint) AS cents
  FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS
), summed AS (
  SELECT *, sum(cents) OVER w AS s, count(*) OVER w AS n FROM fact
  WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)
)
SELECT c_name AS city_name, n_name AS state, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS reading_ts,
       cents / 100.0 AS raw_temperature_c,
       cast((2 * s + n) // (2 * n) AS bigint) / 100.0 AS rolling_24h_avg_temp_c,
       n AS readings_in_window
FROM summed JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

_STREAKS = f"""
WITH numbered AS (
  SELECT user_id, ts, event_id, value, cast(round(value * 100) AS bigint) AS cents,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
         - row_number() OVER (PARTITION BY user_id, value > {STREAK_THRESHOLD} ORDER BY ts, event_id) AS island
  FROM events WHERE value IS NOT NULL
), runs AS (
  SELECT user_id, min(ts) AS a, max(ts) AS b, count(*) AS n, sum(cents) AS s, max(cents) AS peak
  FROM numbered WHERE value > {STREAK_THRESHOLD} GROUP BY user_id, island HAVING count(*) >= 3
)
SELECT user_id AS city_id, c_name AS city_name, n_name AS state,
       strftime(a, '%Y-%m-%d %H:%M:%S.%f') AS streak_start, strftime(b, '%Y-%m-%d %H:%M:%S.%f') AS streak_end,
       n AS consecutive_readings, cast((2 * s + 10 * n) // (20 * n) AS bigint) / 10.0 AS avg_aqi_in_streak,
       peak / 100.0 AS peak_aqi,
       epoch_us(b) // 1000000 - epoch_us(a) // 1000000 AS streak_seconds
FROM runs JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def _leaderboard(fact: str, state: str) -> str:
    return f"""
WITH fact AS ({fact}), weekly AS (
  SELECT city_id, cast(year(d) AS bigint) AS year, cast(week(d) AS bigint) AS week_of_year,
         min(cast(d AS date)) AS start, sum(cents) AS s, count(*) AS n
  FROM fact GROUP BY ALL
), averaged AS (
  SELECT *, cast((2 * s + 10 * n) // (20 * n) AS bigint) / 10.0 AS avg_aqi FROM weekly
), ranked AS (
  SELECT *, rank() OVER (PARTITION BY year, week_of_year ORDER BY avg_aqi DESC) AS r FROM averaged
)
SELECT year, week_of_year, cast(start AS varchar) AS week_start_date, r AS rank_worst_aqi,
       c_name AS city_name, {state} avg_aqi, n AS readings_count,
       CASE WHEN avg_aqi <= 50 THEN 'Good' WHEN avg_aqi <= 100 THEN 'Moderate'
            WHEN avg_aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN avg_aqi <= 200 THEN 'Unhealthy'
            WHEN avg_aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS aqi_category
FROM ranked JOIN customer ON city_id = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE r <= 5
"""


ORACLES = {
    "rolling_24h_avg": _ROLLING,
    "rolling_24h_avg_all_hot": _ROLLING,
    "rolling_24h_avg_mixed": _ROLLING,
    "unhealthy_streaks": _STREAKS,
    "unhealthy_streaks_all_hot": _STREAKS,
    "weekly_leaderboard": _leaderboard(
        "SELECT user_id AS city_id, ts AS d, cast(round(value * 100) AS bigint) AS cents FROM events",
        "n_name AS state,",
    ),
    "weekly_leaderboard_orders": _leaderboard(
        "SELECT o_custkey AS city_id, o_orderdate AS d, "
        "cast(round(o_totalprice * 100 / 1000) AS bigint) AS cents FROM orders",
        "",
    ),
    "date_spine": """
WITH days AS (
  SELECT unnest(generate_series(min(o_orderdate)::date::timestamp, max(o_orderdate)::date::timestamp,
                                INTERVAL 1 DAY)) AS d FROM orders
), per_day AS (SELECT o_orderdate::date AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT cast(strftime(d, '%Y%m%d') AS bigint) AS date_key, cast(d::date AS varchar) AS full_date,
       dayofweek(d) AS day_of_week, dayname(d) AS day_name, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
       week(d) AS week_of_year, month(d) AS month, monthname(d) AS month_name, quarter(d) AS quarter,
       year(d) AS year, dayofweek(d) IN (0, 6) AS is_weekend, coalesce(n, 0) AS orders
FROM days LEFT JOIN per_day ON d::date = day
""",
}
