from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.operators import checks, gate
from skyledger.sources.tables import Warehouse

NOW = datetime(2024, 9, 26, 12)
WEATHER = (
    "reading_id bigint, city_id int, date_key int, reading_ts timestamp, temperature_c double, humidity_pct double, "
    "precipitation_mm double, pressure_hpa double, wind_speed_kmh double"
)
AIR = (
    "reading_id bigint, city_id int, date_key int, reading_ts timestamp, aqi_value int, pm25 double, pm10 double, "
    "no2 double, so2 double, co double, o3 double"
)
HOUR = timedelta(hours=1)


def weather_row(city=1, age=1 * HOUR, temperature=25.0, humidity=50.0, date_key=20240926, ts=True):
    return (1, city, date_key, NOW - age if ts else None, temperature, humidity, 0.0, 1000.0, 1.0)


def air_row(city=1, age=1 * HOUR, aqi=100, ts=True):
    return (1, city, 20240926, NOW - age if ts else None, aqi, *[1.0] * 6)


@pytest.fixture
def judge(spark, frame):
    """Status and metric of one check over the given tables."""

    def run(name, weather=None, air=None, cities=None, quarantined=0, load=None, drop=()):
        tables = {
            checks.WEATHER: frame(WEATHER, *([weather_row()] if weather is None else weather)).drop(*drop),
            checks.AIR_QUALITY: frame(AIR, *([air_row()] if air is None else air)),
            checks.CITIES: frame("is_active boolean", *([True] if cities is None else cities)),
            checks.QUARANTINE: frame("resolved boolean", *[False] * quarantined, True),
        }
        chosen = [check for check in checks.CHECKS if check.name == name]
        load = {"weather_loaded": 35, "aqi_loaded": 30} if load is None else load
        row = checks.evaluate(spark, tables, load, F.lit(NOW), chosen).first()
        return row.status, row.metric, row.details

    return run


def test_schema_presence(judge):
    assert judge("schema_presence")[:2] == ("pass", 0)
    status, metric, details = judge("schema_presence", drop=["temperature_c"])
    assert (status, metric) == ("fail", 1) and "fact_weather_reading.temperature_c" in details


@pytest.mark.parametrize(
    "age, status",
    [(HOUR, "pass"), (4 * HOUR, "pass"), (4 * HOUR + timedelta(seconds=1), "warn"), (5 * HOUR, "warn"),
     (6 * HOUR, "warn"), (6 * HOUR + timedelta(seconds=1), "fail"), (8 * HOUR, "fail")],
)
def test_freshness(judge, age, status):
    assert judge("freshness", weather=[weather_row(age=age), weather_row(age=age + HOUR)])[0] == status


def test_freshness_of_nothing(judge):
    assert judge("freshness", weather=[])[0] == "fail"


@pytest.mark.parametrize(
    "recent, total, status",
    [(34, 35, "pass"), (7, 10, "pass"), (20, 35, "warn"), (5, 10, "warn"), (10, 35, "fail"), (0, 0, "fail")],
)
def test_completeness(judge, recent, total, status):
    rows = [weather_row(c, age) for c in range(recent) for age in (HOUR, 2 * HOUR)] + [weather_row(99, 5 * HOUR)]
    assert judge("completeness", weather=rows, cities=[True] * total + [False])[0] == status


def test_completeness_window_is_inclusive(judge):
    rows = [weather_row(1, 4 * HOUR), weather_row(2, 4 * HOUR + timedelta(microseconds=1))]
    assert judge("completeness", weather=rows, cities=[True, True])[1] == 0.5


@pytest.mark.parametrize(
    "weather, air, count",
    [([], [], 0), ([weather_row(city=None)], [], 1), ([weather_row(date_key=None)] * 2, [air_row(aqi=None)], 3),
     ([weather_row(ts=False)], [air_row(ts=False), air_row(city=None)], 3), ([weather_row(temperature=None)], [], 0)],
)
def test_nulls(judge, weather, air, count):
    status, metric, _ = judge("null_critical_fields", weather=[weather_row(), *weather], air=[air_row(), *air])
    assert (status, metric) == ("fail" if count else "pass", count)


@pytest.mark.parametrize(
    "check, key, inside, outside, severity",
    [("range_temperature", "temperature", [-20.0, 60.0, None], [-20.01, 60.01, 99.0], "warn"),
     ("range_humidity", "humidity", [0.0, 100.0, None], [-0.5, 100.5], "fail")],
)
def test_weather_ranges(judge, check, key, inside, outside, severity):
    good = [weather_row(**{key: v}) for v in inside]
    bad = [weather_row(**{key: v}) for v in outside]
    assert judge(check, weather=good)[:2] == ("pass", 0)
    assert judge(check, weather=good + bad)[:2] == (severity, len(outside))


def test_aqi_range(judge):
    good = [air_row(aqi=v) for v in (0, 500, None)]
    assert judge("range_aqi", air=good)[0] == "pass"
    assert judge("range_aqi", air=[*good, air_row(aqi=501), air_row(aqi=-1)])[:2] == ("fail", 2)


@pytest.mark.parametrize(
    "weather, aqi, status", [(35, 30, "pass"), (10, 10, "pass"), (9, 30, "warn"), (35, 9, "warn"), (35, 0, "warn")]
)
def test_row_counts(judge, weather, aqi, status):
    assert judge("row_count_sanity", load={"weather_loaded": weather, "aqi_loaded": aqi})[0] == status


def test_row_counts_default_to_none(judge):
    assert judge("row_count_sanity", load={})[:2] == ("warn", 0)


@pytest.mark.parametrize("names, status", [(1, "pass"), (2, "pass"), (3, "warn"), (9, "warn"), (10, "fail"), (12, "fail")])
def test_city_resolution(judge, names, status):
    assert judge("city_resolution", quarantined=names)[:2] == (status, names)


def test_uniqueness(judge):
    one, other = weather_row(), weather_row(age=2 * HOUR)
    assert judge("uniqueness", weather=[one, other])[0] == "pass"
    assert judge("uniqueness", weather=[one, one, other, one], air=[air_row()] * 4)[:2] == ("fail", 5)
    nulls = [weather_row(city=None, age=HOUR), weather_row(city=None, age=HOUR), weather_row(city=None, age=2 * HOUR)]
    assert judge("uniqueness", weather=nulls)[1] == 1


def test_crashed_checks_fail_and_the_rest_go_on(spark, frame):
    tables = {
        checks.WEATHER: frame(WEATHER, weather_row()).drop("humidity_pct"),
        checks.CITIES: frame("is_active boolean", True),
        checks.QUARANTINE: frame("resolved boolean", True),
    }
    rows = checks.evaluate(spark, tables, {"weather_loaded": 10, "aqi_loaded": 10}, F.lit(NOW)).collect()
    assert [r.check_no for r in sorted(rows)] == list(range(1, 11))
    failed = {r.check_name: r.details for r in rows if r.status == "fail"}
    assert set(failed) == {"schema_presence", "null_critical_fields", "range_humidity", "range_aqi", "uniqueness"}
    assert failed["range_humidity"].startswith("check crashed") and "humidity_pct" in failed["range_humidity"]


def test_a_check_alone_without_its_table(spark):
    chosen = [check for check in checks.CHECKS if check.name == "range_aqi"]
    row = checks.evaluate(spark, {}, {}, F.lit(NOW), chosen).first()
    assert row.status == "fail" and row.details.startswith("check crashed")


def test_trend(frame):
    results = frame(
        "check_name string, status string, checked_at timestamp",
        ("a", "pass", NOW), ("a", "pass", NOW - 30 * 24 * HOUR), ("a", "pass", NOW - 31 * 24 * HOUR), ("b", "fail", NOW),
    )
    assert {(r.check_name, r.status): r.results for r in checks.trend(results, F.lit(NOW)).collect()} == {
        ("a", "pass"): 2, ("b", "fail"): 1,
    }


RUN = gate.Run("readings", "gate", date(2024, 9, 26), NOW)


def test_gate_records_then_raises(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(gate.GateFailed, match="freshness"):
        gate.run_gate(warehouse, {"weather_loaded": 12, "aqi_loaded": 8, "weather_rejected": 1, "aqi_rejected": 2}, RUN)
    with pytest.raises(gate.GateFailed):
        gate.run_gate(warehouse, {}, RUN)
    log = warehouse.read("pipeline_run_log").orderBy("run_id").collect()
    assert [(r.run_id, r.status, r.rows_loaded, r.rows_extracted, r.rows_rejected) for r in log] == [
        (1, "failure", 20, 20, 3), (2, "failure", 0, 0, 0),
    ]
    assert log[0].cities_failed == [] and log[0].ended_at is not None
    results = warehouse.read("dq_check_results")
    assert sorted(r.id for r in results.collect()) == list(range(1, 21))
    assert results.filter("run_id = 2").count() == 10


@pytest.mark.parametrize("warned, status", [(False, "success"), (True, "partial_success")])
def test_gate_passes(spark, tmp_path, warned, status):
    warehouse = Warehouse(spark, str(tmp_path))
    chosen = [c for c in checks.CHECKS if c.name in ("row_count_sanity", "range_aqi")]
    loaded = 5 if warned else 50
    results = gate.run_gate(warehouse, {"weather_loaded": loaded, "aqi_loaded": 50}, RUN, checks=chosen)
    assert [r.status for r in results] == ["pass", "warn" if warned else "pass"]
    assert warehouse.read("pipeline_run_log").first().status == status


def test_broken_file_fails_only_its_checks(spark, tmp_path, frame):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet at all")
    tables = {
        checks.WEATHER: frame(WEATHER, weather_row()),
        checks.AIR_QUALITY: frame(AIR, air_row()),
        checks.CITIES: frame("is_active boolean", True),
        checks.QUARANTINE: spark.read.schema("resolved boolean").parquet(str(bad)),
    }
    rows = gate.collect_results(spark, tables, {"weather_loaded": 10, "aqi_loaded": 10}, F.lit(NOW))
    assert {r.check_name for r in rows if r.status == "fail"} == {"city_resolution"}
    assert len(rows) == 10


def test_messages_round_as_the_exact_binary_value(spark):
    import random

    from skyledger.functions.numbers import fixed_text

    chance = random.Random(5)
    values = [4.25, 4.35, 0.05, 0.15, 0.25, 0.35, 0.45, 2.5, 3.5, 0.5, 1.5, 99.95, 9.95, 0.0, 1e-12, 2.0**-9, 2.0**-10, 0.004999, 0.005, 0.015,
              1e15 + 0.5, 2.0**53, 123456789.25, -4.25, -0.04]
    values += [chance.random() * 10 ** chance.randint(-3, 9) for _ in range(400)] + [k / 8 for k in range(400)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    for digits in (0, 1, 2):
        got = {r.x: r.text for r in df.select("x", fixed_text(F.col("x"), digits).alias("text")).collect()}
        assert {v: got[v] for v in values} == {v: f"{v:.{digits}f}" for v in values}
        assert got[None] is None


def test_counting_stored_keys_needs_no_exchange(spark, tmp_path):
    """Files are bucketed by the merge key, so copies of a key are in one task as they are read."""
    warehouse = Warehouse(spark, str(tmp_path / "bucketed"))
    rows = spark.range(400).select(
        (F.col("id") % 7).cast("int").alias("city_id"), F.timestamp_seconds(F.col("id") * 9000).alias("reading_ts"),
        F.lit(20240101).alias("date_key"), F.lit(1).cast("decimal(5,2)").alias("temperature_c"),
        *[F.lit(1).cast("decimal(6,2)").alias(c) for c in ("humidity_pct", "precipitation_mm", "pressure_hpa", "wind_speed_kmh")],
        F.timestamp_seconds(F.col("id")).alias("fetched_at"),
    )
    warehouse.merge_facts(checks.WEATHER, rows)
    warehouse.merge_facts(checks.WEATHER, rows.filter("id % 3 = 0"))
    facts = warehouse.read(checks.WEATHER)
    assert "UNION" in spark.sql(f"SHOW CREATE TABLE {warehouse.catalog.name(checks.WEATHER)}").first()[0].upper()
    copies = facts.groupBy("city_id", "reading_ts").agg(F.count(F.lit(1)).alias("copies"))
    plan = copies._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan
    found = checks.evaluate(spark, {checks.WEATHER: facts, checks.AIR_QUALITY: facts.withColumn("aqi_value", F.lit(1))}, {}, F.lit(NOW),
                            [c for c in checks.CHECKS if c.name == "uniqueness"]).first()
    assert (found.status, found.metric) == ("pass", 0.0)
    assert facts.count() == 400
