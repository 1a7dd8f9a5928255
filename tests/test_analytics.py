from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skyledger.operators.calendar import date_spine, spine_over
from skyledger.operators.rolling import rolling_mean
from skyledger.operators.skew import split_hot
from skyledger.operators.streaks import streaks
from skyledger.plans import analytics

T0 = datetime(2024, 9, 26)
READINGS = "city_id int, reading_ts timestamp, temperature_c decimal(5,2)"
AIR = "city_id int, date_key int, reading_ts timestamp, aqi_value smallint"
STRATEGIES = [5_000_000, None, 30]


@pytest.fixture
def cities(frame):
    return frame("city_id int, city_name string, state string", *[(i, f"City{i}", "S") for i in range(1, 9)])


def test_spine(spark):
    days = {r.full_date: r for r in date_spine(spark).collect()}
    assert len(days) == 4018
    assert (min(days), max(days)) == (date(2020, 1, 1), date(2030, 12, 31))
    day = days[date(2024, 12, 30)]
    assert (day.date_key, day.year, day.week_of_year, day.day_of_week, day.quarter) == (20241230, 2024, 1, 1, 4)
    assert (day.day_name, day.month_name, day.is_weekend, day.day_of_year) == ("Monday", "December", False, 365)
    assert days[date(2024, 9, 1)].day_of_week == 0 and days[date(2024, 9, 1)].is_weekend
    assert days[date(2021, 1, 1)].week_of_year == 53


def test_padded_names(spark):
    first = date_spine(spark, date(2024, 5, 6), date(2024, 5, 6), padded=True).first()
    assert (first.day_name, first.month_name) == ("Monday   ", "May      ")


def test_spine_over_nothing(frame):
    assert spine_over(frame("d date"), "d").count() == 0


@pytest.mark.parametrize("hot_rows", STRATEGIES)
def test_rolling_frame(frame, hot_rows):
    hours = timedelta(hours=1)
    df = frame(
        READINGS,
        (1, T0, Decimal("10.00")),
        (1, T0 + 24 * hours, Decimal("20.00")),
        (1, T0 + 24 * hours + timedelta(microseconds=1), None),
        (1, T0 + 30 * hours, Decimal("20.01")),
        (1, T0 + 90 * hours, None),
        (2, T0, Decimal("-0.01")),
        (2, T0 + hours, Decimal("-0.02")),
    )
    got = rolling_mean(df, "temperature_c", hot_rows=hot_rows).orderBy("city_id", "reading_ts")
    assert [(r.rolling_mean, r.readings_in_window) for r in got.collect()] == [
        (Decimal("10.00"), 1), (Decimal("15.00"), 2), (Decimal("20.00"), 2), (Decimal("20.01"), 3), (None, 1),
        (Decimal("-0.01"), 1), (Decimal("-0.02"), 2),
    ]


def random_readings(spark, n=600):
    """Half of the rows belong to one city; timestamps repeat."""
    rng = random.Random(3)
    rows = []
    for _ in range(n):
        city = 1 if rng.random() < 0.5 else rng.randint(2, 8)
        value = None if rng.random() < 0.1 else Decimal(rng.randint(-2000, 5000)) / 100
        rows.append((city, T0 + timedelta(minutes=10 * rng.randint(0, 900), microseconds=rng.randint(0, 1)), value))
    return spark.createDataFrame(rows, READINGS)


@pytest.mark.parametrize("bin_seconds", [600, 3600, 10**6])
def test_rolling_strategies_agree(spark, bin_seconds):
    df = random_readings(spark)
    plain, *others = [
        sorted(map(str, rolling_mean(df, "temperature_c", hot_rows=h, bin_seconds=bin_seconds).collect()))
        for h in STRATEGIES
    ]
    assert len(plain) == 600
    assert all(other == plain for other in others)


def test_split_hot(spark):
    df = random_readings(spark)
    cold, hot = split_hot(df, "city_id", 100)
    assert {r.city_id for r in hot.select("city_id").distinct().collect()} == {1}
    assert cold.count() + hot.count() == df.count()


@pytest.mark.parametrize("hot_rows", STRATEGIES)
def test_worked_streak(frame, cities, hot_rows):
    values = [80, 160, None, 175, 190, 95, 210]
    df = frame(AIR, *[(1, 20240926, T0 + timedelta(hours=3 * i), v) for i, v in enumerate(values)])
    rows = analytics.unhealthy_streaks(df, cities, hot_rows=hot_rows).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.city_name, row.consecutive_readings, row.avg_aqi_in_streak, row.peak_aqi) == ("City1", 3, Decimal("175.0"), 190)
    assert (row.streak_start, row.streak_end) == (T0 + timedelta(hours=3), T0 + timedelta(hours=12))
    assert row.streak_duration == timedelta(hours=9) and row.streak_seconds == 9 * 3600


def test_threshold_is_strict_and_length_counts(frame, cities):
    df = frame(AIR, *[(1, 1, T0 + timedelta(hours=i), v) for i, v in enumerate([151, 151, 150, 151, 151, 151])])
    rows = analytics.unhealthy_streaks(df, cities).collect()
    assert [r.consecutive_readings for r in rows] == [3]
    assert analytics.unhealthy_streaks(df, cities, min_length=2).count() == 2


@pytest.mark.parametrize("bin_seconds", [600, 7200])
def test_streak_strategies_agree(spark, bin_seconds):
    df = random_readings(spark).dropDuplicates(["city_id", "reading_ts"]).withColumn("v", F.abs("temperature_c").cast("int"))
    plain, *others = [
        sorted(map(str, streaks(df, "v", 10, hot_rows=h, bin_seconds=bin_seconds).collect())) for h in STRATEGIES
    ]
    assert len(plain) > 20
    assert all(other == plain for other in others)


def test_leaderboard(spark, frame, cities):
    facts = [(c, 20240902 + d, T0, v) for c, v in enumerate([300, 301, 200, 150, 100, 100, 50], 1) for d in (0, 2)]
    facts += [(8, 20240903, T0, None), (1, 20240909, T0, 10), (1, 20190909, T0, 10), (9, 20240909, T0, 500)]
    facts += [(2, 20240101, T0, 20), (2, 20241231, T0, 40)]
    rows = analytics.weekly_leaderboard(frame(AIR, *facts), date_spine(spark), cities).collect()
    first_week = [r for r in rows if r.week_of_year == 36]
    assert [(r.rank_worst_aqi, r.city_name) for r in first_week] == [
        (1, "City2"), (2, "City1"), (3, "City3"), (4, "City4"), (5, "City5"), (5, "City6"),
    ]
    assert [r.aqi_category for r in first_week] == [
        "Hazardous", "Very Unhealthy", "Unhealthy", "Unhealthy for Sensitive Groups", "Moderate", "Moderate",
    ]
    assert first_week[0].week_start_date == date(2024, 9, 2) and first_week[0].readings_count == 2
    # The days around New Year of one calendar year fall into one week 1.
    assert [(r.avg_aqi, r.readings_count) for r in rows if r.week_of_year == 1] == [(Decimal("30.0"), 2)]
    # An unknown city keeps its rank but has no name to show.
    assert [(r.rank_worst_aqi, r.city_name) for r in rows if r.week_of_year == 37] == [(2, "City1")]
    assert [r.week_of_year for r in rows] == sorted((r.week_of_year for r in rows), reverse=True)


def test_recent_readings_only(frame, cities):
    now = datetime.now()
    df = frame(READINGS, (1, now - timedelta(days=8), Decimal(1)), (1, now - timedelta(days=6), Decimal(2)),
               (9, now, Decimal(3)))
    assert [r.raw_temperature_c for r in analytics.rolling_24h_average(df, cities).collect()] == [Decimal("2.00")]


def test_report_order(frame, cities):
    df = frame(READINGS, *[(c, T0 + timedelta(hours=h), Decimal(1)) for c in (2, 1) for h in (0, 5, 3)])
    rows = analytics.rolling_24h_average(df, cities, F.lit(T0)).collect()
    assert [(r.city_name, r.reading_ts.hour) for r in rows] == [(c, h) for c in ("City1", "City2") for h in (5, 3, 0)]
