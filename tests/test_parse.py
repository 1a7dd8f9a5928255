from __future__ import annotations

from copy import deepcopy
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.functions.numbers import rounded_mean
from skyledger.functions.times import known_zones, local_minute, zoned_instant
from skyledger.operators import parse

WEATHER = {
    "timezone": "Asia/Kolkata",
    "current": {
        "time": "2024-08-19T15:00",
        "temperature_2m": 27.25,
        "relative_humidity_2m": 61,
        "precipitation": 3.5,
        "surface_pressure": 996.75,
        "wind_speed_10m": 8.4,
    },
}
AIR = {
    "status": "ok",
    "data": {
        "aqi": 143,
        "dominentpol": "pm10",
        "iaqi": {"pm25": {"v": 51.5}, "pm10": {"v": 98.0}, "no2": {"v": 18.75}, "so2": {"v": 7.5}, "co": {"v": 1.25},
                 "o3": {"v": 30.5}},
        "time": {"s": "2024-08-19 16:00:00", "tz": "+05:30"},
    },
}
MISSING = object()


def changed(payload, path, value):
    payload = deepcopy(payload)
    *parents, last = path.split(".")
    node = payload
    for parent in parents:
        node = node[parent]
    if value is MISSING:
        del node[last]
    else:
        node[last] = value
    return payload


def weather(documents, path=None, value=None):
    return parse.parse_weather(documents(changed(WEATHER, path, value) if path else WEATHER)).first()


def air(documents, path=None, value=None):
    return parse.parse_air_quality(documents(changed(AIR, path, value) if path else AIR)).first()


def each(documents, parser, payload, cases):
    """The parsed row of every case, (path, value, ...), in one job."""
    payloads = [changed(payload, path, value) for path, value, *_ in cases]
    return list(zip(cases, parser(documents(*payloads)).collect(), strict=True))


def test_weather_sample(documents):
    row = weather(documents)
    assert row.parse_status == "ok"
    assert (row.city_id, row.date_key) == (1, 20240819)
    assert row.reading_ts == datetime(2024, 8, 19, 9, 30)
    assert (row.temperature_c, row.humidity_pct, row.precipitation_mm) == (27.25, 61.0, 3.5)
    assert (row.pressure_hpa, row.wind_speed_kmh) == (996.75, 8.4)


def test_zones(documents):
    cases = [
        ("timezone", "America/New_York", datetime(2024, 8, 19, 19)),
        ("timezone", "Mars/Olympus", datetime(2024, 8, 19, 15)),
        ("timezone", "asia/kolkata", datetime(2024, 8, 19, 15)),
        ("timezone", "+05:30", datetime(2024, 8, 19, 15)),
        ("timezone", MISSING, datetime(2024, 8, 19, 15)),
        ("timezone", "ROC", datetime(2024, 8, 19, 7)),
        ("timezone", "EST", datetime(2024, 8, 19, 20)),
    ]
    for (_, zone, instant), row in each(documents, parse.parse_weather, WEATHER, cases):
        assert (row.reading_ts, row.date_key, row.parse_status) == (instant, 20240819, "ok"), zone


def test_every_zone_is_known_to_the_jvm(spark):
    zones = spark.createDataFrame([(z,) for z in known_zones()], "zone string")
    instants = zones.select(zoned_instant(F.lit("2024-07-01 12:00:00").cast("timestamp"), "zone").alias("t"))
    assert instants.filter("t IS NOT NULL").count() == len(known_zones()) > 500


def test_spoilt_weather(documents):
    cases = [
        ("timezone", None, "bad zone"),
        ("timezone", "", "bad zone"),
        ("timezone", 5, "bad zone"),
        ("current", MISSING, "no current block"),
        ("current", None, "no current block"),
        ("current", {}, "no current block"),
        ("current", [], "no current block"),
        ("current", [1], "no current block"),
        ("current", "sunny", "no current block"),
        ("current.time", MISSING, "bad time"),
        ("current.time", None, "bad time"),
        ("current.time", "", "bad time"),
        ("current.time", "not-a-time", "bad time"),
        ("current.time", "2024-09-26T14:00:00", "bad time"),
        ("current.time", "2024-09-26 14:00", "bad time"),
        ("current.time", "2024-02-30T14:00", "bad time"),
        ("current.time", "2024-09-26T24:00", "bad time"),
        ("current.time", "2024-009-26T14:00", "bad time"),
        ("current.time", 20240926, "bad time"),
    ]
    for case, row in each(documents, parse.parse_weather, WEATHER, cases):
        assert row.parse_status == case[2], case


def test_short_clock_fields(documents):
    assert weather(documents, "current.time", "2024-9-6T4:5").reading_ts == datetime(2024, 9, 5, 22, 35)


def test_local_date_key_differs_from_utc_day(documents):
    row = weather(documents, "current.time", "2024-09-27T01:00")
    assert (row.date_key, row.reading_ts) == (20240927, datetime(2024, 9, 26, 19, 30))


def test_weather_without_city_or_json(documents):
    assert parse.parse_weather(documents(WEATHER, city_id=None)).first().parse_status == "no city"
    rows = parse.parse_weather(documents(WEATHER, "{broken", "null", "[]", WEATHER))
    assert {r.parse_status: r.documents for r in parse.parse_counts(rows).collect()} == {
        "ok": 2, "unreadable": 1, "no current block": 2,
    }
    assert parse.parsed(rows).count() == 2


def test_measures_that_are_no_numbers(documents):
    values = [MISSING, None, "sensor_error", "1.5d", "NaN", "inf", "0x10", [1], {"v": 1}]
    cases = [("current.temperature_2m", value) for value in values]
    for case, row in each(documents, parse.parse_weather, WEATHER, cases):
        assert (row.parse_status, row.temperature_c, row.humidity_pct) == ("ok", None, 61.0), case


def test_measures_that_are_numbers(documents):
    values = [("31.5", 31.5), (" 31.5 ", 31.5), ("1_000", 1000.0), ("-1e2", -100.0), (".5", 0.5), ("5.", 5.0), (True, 1.0),
     (False, 0.0), (-3, -3.0), (1e-7, 1e-7)]
    cases = [("current.temperature_2m", *pair) for pair in values]
    for case, row in each(documents, parse.parse_weather, WEATHER, cases):
        assert row.temperature_c == case[2], case


def test_air_sample(documents):
    row = air(documents)
    assert row.parse_status == "ok"
    assert (row.aqi_value, row.date_key, row.reading_ts) == (143, 20240819, datetime(2024, 8, 19, 10, 30))
    assert (row.pm25, row.pm10, row.no2, row.so2, row.co, row.o3) == (51.5, 98.0, 18.75, 7.5, 1.25, 30.5)
    assert row.dominant_pollutant == "pm10"


def test_spoilt_air(documents):
    cases = [
        ("status", "error", "no station"),
        ("status", MISSING, "no station"),
        ("status", True, "no station"),
        ("data", MISSING, "no data"),
        ("data.aqi", "-", "no data"),
        ("data.aqi", None, "no data"),
        ("data.aqi", MISSING, "no data"),
        ("data.time", MISSING, "bad time"),
        ("data.time", None, "bad time"),
        ("data.time", {}, "bad time"),
        ("data.time.s", "", "bad time"),
        ("data.time.s", "2024-09-26T14:00:00", "bad time"),
        ("data.time.s", "2024-13-26 14:00:00", "bad time"),
        ("data.time.tz", None, "bad time"),
        ("data.time.tz", "", "bad time"),
        ("data.time.tz", "+05", "bad time"),
        ("data.time.tz", "IST", "bad time"),
        ("data.iaqi", None, "bad pollutant"),
        ("data.iaqi", [], "bad pollutant"),
        ("data.iaqi.co", None, "bad pollutant"),
        ("data.iaqi.o3", 5, "bad pollutant"),
    ]
    for case, row in each(documents, parse.parse_air_quality, AIR, cases):
        assert row.parse_status == case[2], case


def test_offsets(documents):
    offsets = [("+05:30", 10), ("+0530", 10), ("-03:00", 19), ("Z", 16), ("+00:00", 16), (MISSING, 16)]
    cases = [("data.time.tz", *pair) for pair in offsets]
    for case, row in each(documents, parse.parse_air_quality, AIR, cases):
        assert (row.reading_ts.hour, row.date_key) == (case[2], 20240819), case


def test_spaces_in_the_clock(documents):
    assert air(documents, "data.time.s", "2024-9-6  4:05:06").reading_ts == datetime(2024, 9, 5, 22, 35, 6)


def test_sparse_pollutants(documents):
    row = air(documents, "data.iaqi", {"pm25": {"v": "n/a"}, "co": {}, "no2": {"v": 7}})
    assert row.parse_status == "ok"
    assert (row.pm25, row.co, row.pm10, row.no2) == (None, None, None, 7.0)
    assert air(documents, "data.iaqi", MISSING).parse_status == "ok"


def test_index_values(documents):
    values = [(87.9, 87), ("87", 87), (" 87 ", 87), ("+8_7", 87), ("87.5", None), ("high", None), (True, 1), (-3.7, -3)]
    cases = [("data.aqi", *pair) for pair in values]
    for case, row in each(documents, parse.parse_air_quality, AIR, cases):
        assert (row.aqi_value, row.parse_status) == (case[2], "ok"), case


def test_attempts_are_classified(documents, frame):
    broken_data = {"status": "ok", "data": None}
    attempts = documents(AIR, {"status": "error"}, changed(AIR, "data.aqi", "-"), changed(AIR, "data.aqi", None),
                         "oops", "[]", broken_data, {"status": "ok"})
    attempts = attempts.unionByName(attempts.limit(1).withColumn("raw_response", F.lit(None).cast("string")))
    classified = parse.classify_attempts(attempts)
    assert [r.status for r in classified.select("status").collect()] == [
        "ok", "no_station", "no_data", "no_data", "error", "error", "error", "no_data", "error",
    ]
    assert parse.outcome_counts(classified).first().asDict() == {"stored": 1, "no_data": 4, "failed": 4}


def test_wide_numbers(spark, documents):
    assert weather(documents, "current.temperature_2m", 123456789012345678901234567890).temperature_c == 1.2345678901234568e29
    assert air(documents, "data.aqi", "99999999999").aqi_value is None


@pytest.mark.parametrize(
    "total, count, scale, digits, mean",
    [(201, 200, 2, 2, "0.01"), (-201, 200, 2, 2, "-0.01"), (100, 200, 2, 2, "0.01"), (99, 200, 2, 2, "0.00"),
     (5, 10, 0, 1, "0.5"), (1, 4, 0, 1, "0.3"), (-1, 4, 0, 1, "-0.3"), (1, 8, 0, 2, "0.13"), (1005, 1, 2, 1, "10.1")],
)
def test_means_round_half_away_from_zero(evaluate, total, count, scale, digits, mean):
    assert str(evaluate(rounded_mean(F.lit(total), F.lit(count), scale, digits))) == mean


def test_mean_of_nothing(evaluate):
    assert evaluate(rounded_mean(F.lit(None).cast("bigint"), F.lit(0), 2, 2)) is None


def test_local_minute_has_no_zone(evaluate):
    assert evaluate(local_minute(F.lit("2024-03-31T02:30"))) == datetime(2024, 3, 31, 2, 30)
