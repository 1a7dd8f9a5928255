from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skyledger.operators import constraints, dimension, merge
from skyledger.operators.numbering import number_rows
from skyledger.schemas import DIM_CITY, FACT_WEATHER, TABLE_RULES, Rules

T0 = datetime(2024, 1, 1)
FACT = "reading_id bigint, city_id int, date_key int, reading_ts timestamp, temperature_c double, fetched_at timestamp"
MEASURES = ["temperature_c", "fetched_at"]


def fact(city, hour, date_key, temperature, fetched):
    return (city * 100 + hour, city, date_key, T0 + timedelta(hours=hour), temperature, T0 + timedelta(minutes=fetched))


@pytest.fixture
def old(frame):
    return frame(FACT, fact(1, 0, 20240101, 10.0, 1), fact(1, 3, 20240101, 11.0, 1), fact(2, 0, 20240101, 20.0, 1))


@pytest.fixture
def new(frame):
    return frame(
        FACT,
        (777, 1, 20231231, T0, 15.0, T0 + timedelta(minutes=9)),
        (778, 1, 20231230, T0, 14.0, T0 + timedelta(minutes=5)),
        (779, 3, 20240105, T0, None, T0 + timedelta(minutes=7)),
        (780, 3, 20240104, T0, 33.0, T0 + timedelta(minutes=6)),
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_last_measures_first_date_key(old, new):
    got = {(r.city_id, r.reading_ts): r for r in merge.merge_readings(old, new, MEASURES).collect()}
    assert len(got) == 4
    updated = got[1, T0]
    assert (updated.temperature_c, updated.date_key, updated.reading_id) == (15.0, 20240101, 100)
    inserted = got[3, T0]
    assert (inserted.temperature_c, inserted.date_key, inserted.reading_id) == (None, 20240104, 780)
    assert got[2, T0].temperature_c == 20.0


def test_merging_twice_changes_nothing(old, new):
    once = merge.merge_readings(old, new, MEASURES)
    assert rows(merge.merge_readings(once, new, MEASURES)) == rows(once)


def test_merge_into_nothing(old, new):
    assert merge.merge_readings(old.limit(0), new, MEASURES).count() == 2


def test_ties_do_not_depend_on_input_order(frame, old):
    tied = [(1, 1, 1, T0, float(t), T0) for t in range(20)]
    forward = merge.merge_readings(old.limit(0), frame(FACT, *tied), MEASURES)
    backward = merge.merge_readings(old.limit(0), frame(FACT, *tied[::-1]).repartition(7), MEASURES)
    assert rows(forward) == rows(backward)


def test_latest_per_key_treats_nulls_as_equal(frame):
    df = frame("k string, o int, v string", (None, 1, "a"), (None, 2, "b"), ("x", 1, "c"))
    assert rows(merge.latest_per_key(df, ["k"], ["o"]).fillna("-")) == [("-", 2, "b"), ("x", 1, "c")]


def test_insert_absent_keeps_the_first(frame):
    old = frame("k string", "a")
    new = frame("k string, seq int, v string", ("a", 1, "x"), ("b", 3, "late"), ("b", 2, "early"))
    assert rows(merge.insert_absent(old, new, ["k"], ["seq"])) == [("b", 2, "early")]


def test_required_fields(frame):
    df = frame("city_id int, date_key int, reading_ts timestamp", (1, 1, T0), (None, 1, None), (1, None, T0))
    required = ["city_id", "date_key", "reading_ts"]
    valid, rejected = merge.split_required(df, required)
    assert valid.count() == 1 and valid.columns == df.columns
    assert sorted(r.missing for r in rejected.collect()) == [["city_id", "reading_ts"], ["date_key"]]
    assert merge.load_summary(df, required).first().asDict() == {"rows_loaded": 1, "rows_rejected": 2}


def test_reading_ids_are_distinct(spark):
    ids = spark.range(1000).select(
        merge.reading_id((F.col("id") % 10).cast("int"), F.timestamp_seconds(F.col("id") * 60 - 30000)).alias("i")
    )
    assert ids.distinct().count() == 1000


def test_numbering_is_dense_and_repeatable(spark):
    df = spark.range(500).select(F.concat(F.lit("city "), "id").alias("name"))
    numbered = number_rows(df, "n", ["name"], F.lit(40).cast("bigint"))
    assert sorted(r.n for r in numbered.collect()) == list(range(41, 541))
    assert rows(number_rows(df.repartition(9), "n", ["name"], F.lit(40).cast("bigint"))) == rows(numbered)


CITY = "city_name string, state string, latitude double, longitude double, tier int, population bigint"
JAN, FEB = datetime(2024, 1, 1), datetime(2024, 2, 1)


def test_city_upsert(spark, frame):
    empty = spark.createDataFrame([], DIM_CITY)
    first = dimension.merge_cities(empty, frame(CITY, ("A", "X", 1.0, 2.0, 1, 10), ("B", "X", 1.0, 2.0, None, None)), F.lit(JAN))
    assert sorted(r.city_id for r in first.collect()) == [1, 2]
    assert first.schema.simpleString() == DIM_CITY.simpleString()
    ids = {(r.city_name, r.state): r.city_id for r in first.collect()}
    closed = first.withColumn("is_active", F.col("city_name") != "A")
    second = dimension.merge_cities(
        closed, frame(CITY, ("A", "X", 5.1234567, 2.0, 2, 11), ("A", "Y", 7.0, 7.0, 3, 1)), F.lit(FEB)
    )
    got = {(r.city_name, r.state): r for r in second.collect()}
    a, b, fresh = got["A", "X"], got["B", "X"], got["A", "Y"]
    assert (a.city_id, a.is_active, a.tier, a.population) == (ids["A", "X"], False, 2, 11)
    assert a.latitude == Decimal("5.123457")
    assert (a.created_at, a.updated_at) == (JAN, FEB)
    assert (b.city_id, b.updated_at) == (ids["B", "X"], JAN)
    assert (fresh.city_id, fresh.is_active, fresh.created_at) == (3, True, FEB)


def test_alias_seeding(spark, frame):
    cities = frame("city_id int, city_name string, is_active boolean", (5, "Mumbai", True), (4, "Mumbai", True), (6, "Pune", False))
    seeds = frame(
        "ingest_seq int, raw_alias string, canonical string, match_method string",
        (1, "Bombay", "Mumbai", "exact"), (2, "Bombay", "Mumbai", "exact"), (3, "Poona", "Pune", "exact"),
        (4, "Bomaby", "Mumbai", "exact"),
    )
    attempted, unknown = dimension.seed_aliases(seeds, cities)
    assert attempted.count() == 3
    assert [r.raw_alias for r in unknown.collect()] == ["Poona"]
    old = spark.createDataFrame(
        [(7, "Bomaby", 99, "manual", T0)],
        "alias_id int, raw_alias string, canonical_city_id int, match_method string, created_at timestamp",
    )
    merged = {r.raw_alias: r for r in dimension.merge_aliases(old, attempted, ["ingest_seq"], F.lit(JAN)).collect()}
    assert {n: (r.alias_id, r.canonical_city_id, r.match_method) for n, r in merged.items()} == {
        "Bomaby": (7, 99, "manual"), "Bombay": (8, 4, "exact"),
    }


def test_active_cities(frame):
    cities = frame("city_id int, city_name string, is_active boolean", (5, "B", True), (4, "A", True), (6, "C", False))
    assert [r.city_id for r in dimension.active_cities(cities, ["city_id"]).collect()] == [4, 5]


WEATHER_IN = (
    "city_id int, date_key int, reading_ts timestamp, temperature_c double, humidity_pct double, "
    "precipitation_mm double, pressure_hpa double, wind_speed_kmh double, fetched_at timestamp"
)


def test_conform(frame):
    df = frame(
        WEATHER_IN,
        (1, 1, T0, 12.345, 50.0, 0.0, 1000.0, 1.0, T0),
        (1, 1, T0, 12345.6, 50.0, 0.0, 123456.0, 1.0, T0),
        (1, 1, T0, None, None, None, None, None, None),
    )
    valid, rejected = constraints.conform(df, FACT_WEATHER, TABLE_RULES["fact_weather_reading"])
    assert valid.first().temperature_c == Decimal("12.35") and valid.count() == 1
    assert [r.violations for r in rejected.orderBy("fetched_at").collect()] == [
        ["fetched_at: null"], ["temperature_c: does not fit", "pressure_hpa: does not fit"],
    ]
    with pytest.raises(constraints.ConstraintViolation):
        constraints.conform(df, FACT_WEATHER, TABLE_RULES["fact_weather_reading"], on_violation="fail")


def test_foreign_keys(frame):
    child, parent = frame("id int, c int", (1, 1), (2, 9), (3, None)), frame("k int", 1, 2)
    known, orphans = constraints.split_foreign(child, "c", parent, "k")
    assert sorted(r.id for r in known.collect()) == [1, 3]
    assert rows(orphans) == [(2, 9)]
    assert constraints.cascade_delete(child, "c", parent, "k").count() == 2


def test_audit(frame):
    tables = {
        "parent": frame("k int", 1, 2, 2),
        "child": frame("id int, c int, tier int, name string, amount double",
                       (1, 1, 1, "ok", 1.0), (1, 9, 7, "toolong", 12345.0), (None, 9, None, None, None), (None, None, 2, "x", 1.0)),
    }
    rules = {
        "parent": Rules(unique=[["k"]]),
        "child": Rules(not_null=["name"], unique=[["id"]], foreign={"c": ("parent", "k")}, domain={"tier": [1, 2, 3]},
                       max_length={"name": 4}),
    }
    from pyspark.sql import types as T

    schemas = {"child": T.StructType([T.StructField("amount", T.DecimalType(5, 2))])}
    got = {(r.table_name, r.kind, r.target): r.violations for r in constraints.audit(tables, rules, schemas).collect()}
    assert got == {
        ("parent", "unique", "k"): 1,
        ("child", "not null", "name"): 1,
        ("child", "domain", "tier"): 1,
        ("child", "length", "name"): 1,
        ("child", "fit", "amount"): 1,
        ("child", "unique", "id"): 1,
        ("child", "foreign", "c"): 2,
    }


def test_deletions_walk_the_foreign_keys(frame):
    from skyledger.operators.constraints import delete_rows
    from skyledger.schemas import Rules

    rules = {
        "city": Rules(),
        "alias": Rules(foreign={"city": ("city", "id")}, cascades=["city"]),
        "use": Rules(foreign={"alias": ("alias", "id")}, cascades=["alias"]),
        "fact": Rules(foreign={"city": ("city", "id")}),
        "note": Rules(foreign={"use": ("use", "id")}),
    }
    tables = {
        "city": frame("id int, gone boolean", (1, True), (2, True), (3, True), (4, False), (5, True), (None, True)),
        "alias": frame("id int, city int", (10, 1), (11, 1), (12, 2), (13, 3), (14, 4), (15, None)),
        "use": frame("id int, alias int", (100, 10), (101, 12), (102, 13), (103, 14), (103, 14)),
        "fact": frame("city int", 2, 2, 4, None),
        "note": frame("use int", 102, None),
    }
    out = delete_rows(tables, rules, "city", F.col("gone"))

    def ids(df):
        return sorted((r[0] for r in df.collect()), key=lambda x: (x is None, x))

    # 2 has facts; 3 has an alias with a use with a note: both are refused, and what hangs on them stays.
    assert set(out) == {"city", "alias", "use"}
    assert (ids(out["city"].kept), ids(out["city"].deleted), ids(out["city"].refused)) == ([2, 3, 4], [1, 5, None], [2, 3])
    assert (ids(out["alias"].kept), ids(out["alias"].deleted)) == ([12, 13, 14, 15], [10, 11])
    assert (ids(out["use"].kept), ids(out["use"].deleted)) == ([101, 102, 103, 103], [100])


def test_deletions_of_the_warehouse(frame):
    from skyledger.operators.constraints import delete_rows
    from skyledger.schemas import TABLE_RULES

    tables = {
        "dim_city": frame("city_id int", 1, 2, 3),
        "dim_city_alias": frame("alias_id int, canonical_city_id int", (1, 1), (2, 2), (3, 3)),
        "fact_weather_reading": frame("city_id int, date_key int", (2, 7)),
        "fact_air_quality_reading": frame("city_id int, date_key int"),
        "dim_date": frame("date_key int", 7, 8),
    }
    out = delete_rows(tables, TABLE_RULES, "dim_city", F.col("city_id") < 3)
    assert [r.city_id for r in out["dim_city"].refused.collect()] == [2]
    assert sorted(r.alias_id for r in out["dim_city_alias"].kept.collect()) == [2, 3]
    days = delete_rows(tables, TABLE_RULES, "dim_date", F.col("date_key") > 0)
    assert [r.date_key for r in days["dim_date"].deleted.collect()] == [8]
