"""The quality gate, its records and the constraint audit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.times import date_key
from skyledger.operators import checks, gate
from skyledger.operators.calendar import spine_over
from skyledger.operators.constraints import audit
from skyledger.operators.merge import load_summary
from skyledger.schemas import AIR_QUALITY_REQUIRED, DIM_CITY, FACT_AIR_QUALITY, TABLE_RULES, WEATHER_REQUIRED
from skyledger.session import scratch_dir
from skyledger.sources.catalog import Runs
from skyledger.sources.tables import READING_DAY, Warehouse

from .resolving import known_aliases, named_cities
from .standins import before_latest_event, dim_city, events, readings, table


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events as weather and as air quality, with every expected column."""
    base = readings(spark, sf_dir, "value", "k")
    weather = base.select(
        F.col("event_id").alias("reading_id"), "city_id", "date_key", "reading_ts",
        (F.col("value") - 30).alias("temperature_c"), F.col("k").alias("humidity_pct"),
        *[F.col("value").alias(c) for c in ("precipitation_mm", "pressure_hpa", "wind_speed_kmh")],
    )
    air = base.select(
        F.col("event_id").alias("reading_id"), "city_id", "date_key", "reading_ts", F.col("value").alias("aqi_value"),
        *[F.col("value").alias(c) for c in ("pm25", "pm10", "no2", "so2", "co", "o3")],
    )
    return weather, air


def _damage(weather: DataFrame, air: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nulls where the humidity is low, impossible values, repeated rows, a column gone."""
    broken = weather.withColumns(
        {
            "city_id": F.when(F.col("humidity_pct") >= 2, F.col("city_id")),
            "date_key": F.when(F.col("humidity_pct") >= 1, F.col("date_key")),
            "humidity_pct": F.col("humidity_pct") * 2 - 10,
        }
    )
    repeated = broken.unionByName(broken.filter(F.col("temperature_c") > 20))
    missing = air.withColumn("aqi_value", F.col("aqi_value") * 2 - 20).drop("reading_ts", "no2")
    return repeated, missing


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name per segment and activity: as many unresolved as active ones among them."""
    return dim_city(spark, sf_dir).groupBy("c_mktsegment", "is_active").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat_ws("-", "c_mktsegment", "is_active").alias("raw_name"), (~F.col("is_active")).alias("resolved")
    )


def _results(spark: SparkSession, sf_dir: str, damaged: bool, names: list[str] | None = None) -> DataFrame:
    weather, air = _facts(spark, sf_dir)
    if damaged:
        weather, air = _damage(weather, air)
    tables = {
        "fact_weather_reading": weather,
        "fact_air_quality_reading": air,
        "dim_city": dim_city(spark, sf_dir),
        "quarantine_unmatched_city_names": _quarantine(spark, sf_dir),
    }
    loaded = events(spark, sf_dir).agg(
        F.count_if(F.col("k") == 0).alias("weather_loaded"), F.count(F.lit(1)).alias("aqi_loaded")
    )
    as_of = before_latest_event(spark, sf_dir, "-5 HOURS" if damaged else "0 HOURS")
    chosen = [check for check in checks.CHECKS if names is None or check.name in names]
    return checks.evaluate(spark, tables, loaded, as_of, chosen)


def _shown(results: DataFrame) -> DataFrame:
    return results.select("check_name", "table_name", "status", F.round("metric", 6).alias("metric"))


def _damage_rows(weather: DataFrame, air: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both facts with all their columns: nulls in critical ones, and repeated rows."""
    weather, _ = _damage(weather, air)
    holes = air.withColumn("aqi_value", F.when(F.col("aqi_value") > 1, F.col("aqi_value")))
    return weather, holes.unionByName(holes.filter(F.col("aqi_value") > 50))


def dq_gate_damaged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted nulls and duplicates; now is an hour after the last error event."""
    weather, air = _damage_rows(*_facts(spark, sf_dir))
    as_of = events(spark, sf_dir).agg(F.max(F.when(F.col("event_type") == "error", F.col("ts"))) + F.expr("INTERVAL 1 HOUR"))
    chosen = ("freshness", "completeness", "null_critical_fields", "uniqueness")
    tables = {"fact_weather_reading": weather, "fact_air_quality_reading": air, "dim_city": dim_city(spark, sf_dir)}
    return _shown(checks.evaluate(spark, tables, {}, as_of.scalar(), [c for c in checks.CHECKS if c.name in chosen]))


def dq_schema_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored fact that lacks two columns, and one that was never stored."""
    warehouse = Warehouse(spark, scratch_dir(spark, "schema_presence"))
    weather, _ = _facts(spark, sf_dir)
    lacking = weather.withColumn(READING_DAY, F.col("reading_ts").cast("date")).drop("humidity_pct", "pressure_hpa")
    warehouse.catalog.add_run(checks.WEATHER, Runs(lacking.schema, [READING_DAY], ["reading_id"]), lacking)
    names = [checks.WEATHER, checks.AIR_QUALITY]
    chosen = [check for check in checks.CHECKS if check.name == "schema_presence"]
    stored = {name: warehouse.stored_columns(name) for name in names}
    found = checks.evaluate(spark, {name: warehouse.read(name) for name in names}, {}, F.lit(None), chosen, stored)
    return _shown(found).withColumn("rows", warehouse.read(checks.WEATHER).agg(F.count(F.lit(1))).scalar())


def _single(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _shown(_results(spark, sf_dir, False, [name]))


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_results(spark, sf_dir, False))


def dq_gate_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_results(spark, sf_dir, True))


def dq_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.run_status(_results(spark, sf_dir, False))


def dq_status_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.status_counts(_results(spark, sf_dir, True))


def dq_trend_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as recorded results: priority names the check, status the outcome."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("check_name"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("checked_at"),
    )
    return checks.trend(orders, orders.agg(F.max("checked_at")).scalar(), days=30)


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded and rejected rows per fact, where the damage leaves required fields empty."""
    weather, air = _facts(spark, sf_dir)
    air = air.withColumn("aqi_value", F.when(F.col("aqi_value") > 10, F.col("aqi_value")))
    weather, _ = _damage(weather, air)
    parts = [("weather", weather, WEATHER_REQUIRED), ("air quality", air, AIR_QUALITY_REQUIRED)]
    first, second = [load_summary(df, required).withColumn("fact", F.lit(name)) for name, df, required in parts]
    return first.unionByName(second)


def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds of constraints over a damaged copy of the warehouse."""
    cities = dim_city(spark, sf_dir).select(
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("city_id")).alias("city_id"),
        F.rpad("city_name", 95, "x").alias("name"),
        "state",
        (F.length("c_mktsegment") - 7).alias("tier"),
        (F.col("c_acctbal") * 10).alias("latitude"),
        F.lit(1.0).alias("longitude"),
        "is_active",
    ).select("city_id", F.concat("name", "state").alias("city_name"), F.when(F.col("state") != "NATION_3", F.col("state")).alias("state"),
             "tier", "latitude", "longitude", "is_active")
    air = events(spark, sf_dir).select(
        F.lit(1).alias("reading_id"),
        F.when(F.col("k") > 0, F.col("user_id")).alias("city_id"),
        date_key(F.col("ts")).alias("date_key"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp").alias("reading_ts"),
        (F.col("value") * 100).alias("aqi_value"),
        F.concat(F.lit("pol"), "event_type").alias("dominant_pollutant"),
        F.when(F.col("event_type") != "view", F.col("ts").cast("timestamp")).alias("fetched_at"),
    ).drop("reading_id")
    tables = {
        "dim_city": cities,
        "dim_date": spine_over(events(spark, sf_dir), "ts").filter(~F.col("is_weekend")),
        "fact_air_quality_reading": air,
    }
    schemas = {"dim_city": DIM_CITY, "fact_air_quality_reading": FACT_AIR_QUALITY}
    return audit(tables, TABLE_RULES, schemas)


def alias_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases whose city went away, and how often the names behind them occur."""
    from skyledger.operators.constraints import split_foreign

    aliases, cities = known_aliases(spark, sf_dir), named_cities(spark, sf_dir).filter("is_active")
    kept, orphans = split_foreign(aliases, "canonical_city_id", cities, "city_id")
    return (
        kept.select("raw_alias", F.lit("kept").alias("fate"))
        .unionByName(orphans.select("raw_alias", F.lit("deleted").alias("fate")))
        .groupBy("fate")
        .agg(F.count(F.lit(1)).alias("aliases"), F.min("raw_alias").alias("first_alias"))
    )


_SINGLE = [check.name for check in checks.CHECKS if check.name != "schema_presence"]

QUERIES = {
    **{f"dq_{name}": _single(name) for name in _SINGLE},
    "dq_gate": dq_gate,
    "dq_gate_damaged_rows": dq_gate_damaged_rows,
    "dq_schema_presence": dq_schema_presence,
    "dq_gate_damaged": dq_gate_damaged,
    "dq_run_summary": dq_run_summary,
    "dq_status_tallies": dq_status_tallies,
    "dq_trend_30d": dq_trend_30d,
    "load_counts": load_counts,
    "constraint_audit": constraint_audit,
    "alias_foreign_keys": alias_foreign_keys,
}

_FACTS = """
WITH e AS (SELECT *, cast(props ->> '$.k' AS int) AS k, cast(value AS decimal(12,2)) AS v FROM events),
weather AS (SELECT user_id AS city_id, ts, v - 30 AS t, k AS h, 1 AS d FROM e),
air AS (SELECT user_id AS city_id, ts, v AS aqi FROM e),
loaded AS (SELECT count(*) FILTER (k = 0) AS w, count(*) AS a FROM e),
cities AS (SELECT count(*) FILTER (c_acctbal >= 0) AS n FROM customer),
open_names AS (SELECT count(DISTINCT c_mktsegment) AS n FROM customer WHERE c_acctbal >= 0)
"""


def _gate_sql() -> str:
    return f"""{_FACTS}, metrics AS (
  SELECT 'freshness' AS check_name, 'fact_weather_reading' AS table_name, 0.0 AS metric, 4.0 AS warn, 6.0 AS fail
  UNION ALL SELECT 'null_critical_fields', NULL, 0, NULL, 0
  UNION ALL SELECT 'schema_presence', NULL, 0, NULL, 0
  UNION ALL SELECT 'range_temperature', 'fact_weather_reading',
                   (SELECT count(*) FROM weather WHERE t < -20 OR t > 60), 0, NULL
  UNION ALL SELECT 'range_humidity', 'fact_weather_reading',
                   (SELECT count(*) FROM weather WHERE h < 0 OR h > 100), NULL, 0
  UNION ALL SELECT 'range_aqi', 'fact_air_quality_reading',
                   (SELECT count(*) FROM air WHERE aqi < 0 OR aqi > 500), NULL, 0
  UNION ALL SELECT 'uniqueness', NULL, (SELECT 2 * (count(*) - count(DISTINCT (city_id, ts))) FROM weather), NULL, 0
  UNION ALL SELECT 'city_resolution', 'quarantine_unmatched_city_names', (SELECT n FROM open_names), 2.5, 9.5
), low AS (
  SELECT 'row_count_sanity' AS check_name, NULL AS table_name, (SELECT least(w, a) FROM loaded) AS metric,
         10.0 AS warn, NULL AS fail
  UNION ALL SELECT 'completeness', 'fact_weather_reading',
    (SELECT count(DISTINCT city_id) FROM weather WHERE ts >= (SELECT max(ts) FROM weather) - INTERVAL 4 HOURS)
    / (SELECT n FROM cities), 0.7, 0.5
), results AS (
  SELECT check_name, table_name, CASE WHEN metric > fail THEN 'fail' WHEN metric > warn THEN 'warn' ELSE 'pass' END
         AS status, cast(metric AS double) AS metric FROM metrics
  UNION ALL
  SELECT check_name, table_name, CASE WHEN metric < fail THEN 'fail' WHEN metric < warn THEN 'warn' ELSE 'pass' END,
         cast(metric AS double) FROM low
)
"""


def _damaged_sql() -> str:
    return f"""{_FACTS}, broken AS (
  SELECT CASE WHEN h >= 2 THEN city_id END AS city_id, ts, t, h * 2 - 10 AS h2, CASE WHEN h >= 1 THEN 1 END AS d
  FROM weather
), repeated AS (SELECT * FROM broken UNION ALL SELECT * FROM broken WHERE t > 20),
results AS (
  SELECT 'schema_presence' AS check_name, NULL AS table_name, 'fail' AS status, cast(2 AS double) AS metric
  UNION ALL SELECT 'freshness', 'fact_weather_reading', 'warn', 5
  UNION ALL SELECT 'null_critical_fields', NULL, 'fail', NULL
  UNION ALL SELECT 'uniqueness', NULL, 'fail', NULL
  UNION ALL (WITH bad AS (SELECT count(*) AS n FROM repeated WHERE t < -20 OR t > 60)
             SELECT 'range_temperature', 'fact_weather_reading', if(n > 0, 'warn', 'pass'), n FROM bad)
  UNION ALL (WITH bad AS (SELECT count(*) AS n FROM repeated WHERE h2 < 0 OR h2 > 100)
             SELECT 'range_humidity', 'fact_weather_reading', if(n > 0, 'fail', 'pass'), n FROM bad)
  UNION ALL (WITH bad AS (SELECT count(*) AS n FROM air WHERE aqi * 2 - 20 < 0 OR aqi * 2 - 20 > 500)
             SELECT 'range_aqi', 'fact_air_quality_reading', if(n > 0, 'fail', 'pass'), n FROM bad)
  UNION ALL (SELECT 'row_count_sanity', NULL, if(least(w, a) < 10, 'warn', 'pass'), least(w, a) FROM loaded)
  UNION ALL (SELECT 'city_resolution', 'quarantine_unmatched_city_names',
                    CASE WHEN n >= 10 THEN 'fail' WHEN n >= 3 THEN 'warn' ELSE 'pass' END, n FROM open_names)
  UNION ALL (WITH recent AS (
               SELECT count(DISTINCT city_id) AS n FROM repeated
               WHERE ts >= (SELECT max(ts) FROM weather) + INTERVAL 1 HOUR)
             SELECT 'completeness', 'fact_weather_reading', 'fail', recent.n / cities.n FROM recent, cities)
)
"""


_SHOWN = "SELECT check_name, table_name, status, round(metric, 6) AS metric FROM results"
_STATUSES = "SELECT status, count(*) AS checks FROM results GROUP BY 1"

ORACLES = {
    **{f"dq_{name}": f"{_gate_sql()}{_SHOWN} WHERE check_name = '{name}'" for name in _SINGLE},
    "dq_gate": _gate_sql() + _SHOWN,
    "dq_gate_damaged": _damaged_sql() + _SHOWN,
    "dq_gate_damaged_rows": f"""{_FACTS}, broken AS (
  SELECT CASE WHEN h >= 2 THEN city_id END AS city_id, ts, t, h FROM weather
), repeated AS (SELECT * FROM broken UNION ALL SELECT * FROM broken WHERE t > 20),
holes AS (SELECT city_id, ts, CASE WHEN aqi > 1 THEN aqi END AS aqi FROM air),
twice AS (SELECT * FROM holes UNION ALL SELECT * FROM holes WHERE aqi > 50),
clock AS (SELECT max(ts) FILTER (event_type = 'error') + INTERVAL 1 HOUR AS now, max(ts) AS latest FROM events),
metrics AS (
  SELECT 'null_critical_fields' AS check_name, NULL AS table_name, (SELECT count(*) FILTER (city_id IS NULL)
         + count(*) FILTER (h < 1) FROM repeated) + (SELECT count(*) FILTER (aqi IS NULL) FROM twice) AS metric
  UNION ALL SELECT 'uniqueness', NULL,
         (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM repeated GROUP BY city_id, ts))
         + (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM twice GROUP BY city_id, ts))
)
SELECT check_name, table_name, if(metric > 0, 'fail', 'pass') AS status, cast(metric AS double) AS metric FROM metrics
UNION ALL
SELECT 'freshness', 'fact_weather_reading', CASE WHEN h > 6 THEN 'fail' WHEN h > 4 THEN 'warn' ELSE 'pass' END, round(h, 6)
FROM (SELECT (epoch_us(now) - epoch_us(latest)) / 3.6e9 AS h FROM clock)
UNION ALL
SELECT 'completeness', 'fact_weather_reading', CASE WHEN r < 0.5 THEN 'fail' WHEN r < 0.7 THEN 'warn' ELSE 'pass' END, round(r, 6)
FROM (SELECT (SELECT count(DISTINCT city_id) FROM repeated, clock WHERE ts >= now - INTERVAL 4 HOURS) / n AS r FROM cities)
""",
    "dq_schema_presence": """
WITH missing AS (  -- two columns of the weather, all eleven of the air quality
  SELECT 2 + len(['reading_id', 'city_id', 'date_key', 'reading_ts', 'aqi_value', 'pm25', 'pm10', 'no2', 'so2', 'co', 'o3']) AS n
)
SELECT 'schema_presence' AS check_name, NULL AS table_name, if(n > 0, 'fail', 'pass') AS status,
       cast(n AS double) AS metric, (SELECT count(*) FROM events) AS rows FROM missing
""",
    "dq_run_summary": _gate_sql()
    + """SELECT count(*) FILTER (status = 'fail') AS failed, count(*) FILTER (status = 'warn') AS warned,
count(*) FILTER (status = 'pass') AS passed,
CASE WHEN failed > 0 THEN 'failure' WHEN warned > 0 THEN 'partial_success' ELSE 'success' END AS run_status FROM results""",
    "dq_status_tallies": _damaged_sql() + _STATUSES,
    "dq_trend_30d": """
SELECT o_orderpriority AS check_name, o_orderstatus AS status, count(*) AS results FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAYS GROUP BY ALL
""",
    "load_counts": f"""{_FACTS}
SELECT 'air quality' AS fact, count(*) FILTER (v > 10) AS rows_loaded,
       count(*) FILTER (v <= 10) AS rows_rejected FROM e
UNION ALL
SELECT 'weather', count(*) FILTER (k >= 2) + count(*) FILTER (k >= 2 AND v - 30 > 20),
       count(*) FILTER (k < 2) + count(*) FILTER (k < 2 AND v - 30 > 20) FROM e
""",
    "constraint_audit": """
WITH cities AS (
  SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS city_id,
         rpad(c_name, 95, 'x') || n_name AS city_name, CASE WHEN n_name <> 'NATION_3' THEN n_name END AS state,
         length(c_mktsegment) - 7 AS tier, c_acctbal * 10 AS latitude FROM customer JOIN nation ON c_nationkey = n_nationkey
), e AS (SELECT *, cast(props ->> '$.k' AS int) AS k FROM events), air AS (
  SELECT CASE WHEN k > 0 THEN user_id END AS city_id, cast(ts AS date) AS d, date_trunc('hour', ts) AS reading_ts,
         value * 100 AS aqi, length(event_type) + 3 AS n, event_type FROM e
), span AS (SELECT min(ts) AS a, max(ts) AS b FROM events),
days AS (
  SELECT d::date AS d FROM span, generate_series(date_trunc('day', a), date_trunc('day', b), INTERVAL 1 DAY) g(d)
  WHERE dayofweek(d) NOT IN (0, 6)
)
SELECT 'dim_city' AS table_name, 'not null' AS kind, x AS target,
       CASE x WHEN 'state' THEN (SELECT count(*) FROM cities WHERE state IS NULL) ELSE 0 END AS violations
  FROM unnest(['city_name', 'state', 'latitude', 'longitude', 'is_active']) u(x)
UNION ALL SELECT 'dim_city', 'domain', 'tier', (SELECT count(*) FROM cities WHERE tier NOT IN (1, 2, 3))
UNION ALL SELECT 'dim_city', 'length', x,
       CASE x WHEN 'city_name' THEN (SELECT count(*) FROM cities WHERE length(city_name) > 100) ELSE 0 END
  FROM unnest(['city_name', 'state']) u(x)
UNION ALL SELECT 'dim_city', 'fit', x,
       CASE x WHEN 'latitude' THEN (SELECT count(*) FROM cities WHERE abs(latitude) >= 1000) ELSE 0 END
  FROM unnest(['city_id', 'latitude', 'longitude', 'tier']) u(x)
UNION ALL SELECT 'dim_city', 'unique', 'city_id', 0
UNION ALL SELECT 'dim_city', 'unique', 'city_name, state', 0
UNION ALL SELECT 'dim_date', 'not null', x, 0 FROM unnest(['date_key', 'full_date', 'day_of_week', 'day_name',
  'day_of_month', 'day_of_year', 'week_of_year', 'month', 'month_name', 'quarter', 'year', 'is_weekend']) u(x)
UNION ALL SELECT 'dim_date', 'domain', 'quarter', 0
UNION ALL SELECT 'dim_date', 'length', x, 0 FROM unnest(['day_name', 'month_name']) u(x)
UNION ALL SELECT 'dim_date', 'unique', x, 0 FROM unnest(['date_key', 'full_date']) u(x)
UNION ALL SELECT 'fact_air_quality_reading', 'not null', x, CASE x
       WHEN 'city_id' THEN (SELECT count(*) FROM air WHERE city_id IS NULL)
       WHEN 'fetched_at' THEN (SELECT count(*) FROM air WHERE event_type = 'view') ELSE 0 END
  FROM unnest(['city_id', 'date_key', 'reading_ts', 'fetched_at']) u(x)
UNION ALL SELECT 'fact_air_quality_reading', 'length', 'dominant_pollutant', (SELECT count(*) FROM air WHERE n > 10)
UNION ALL SELECT 'fact_air_quality_reading', 'fit', x,
       CASE x WHEN 'aqi_value' THEN (SELECT count(*) FROM air WHERE trunc(aqi) > 32767) ELSE 0 END
  FROM unnest(['city_id', 'aqi_value']) u(x)
UNION ALL SELECT 'fact_air_quality_reading', 'unique', 'city_id, reading_ts',
       (SELECT count(*) - count(DISTINCT (city_id, reading_ts)) FROM air WHERE city_id IS NOT NULL)
UNION ALL SELECT 'fact_air_quality_reading', 'foreign', 'city_id',
       (SELECT count(*) FROM air WHERE city_id IS NOT NULL
        AND NOT EXISTS (FROM cities WHERE cities.city_id = air.city_id))
UNION ALL SELECT 'fact_air_quality_reading', 'foreign', 'date_key',
       (SELECT count(*) FROM air WHERE NOT EXISTS (FROM days WHERE days.d = air.d))
""",
    "alias_foreign_keys": """
WITH named AS (
  SELECT c_acctbal >= 0 AS is_active, translate(md5(cast(c_custkey AS varchar))[:12], '0123456789abcdef',
         'bcdfghjklmnprtvw') AS l FROM customer WHERE c_mktsegment = 'BUILDING'
)
SELECT if(is_active, 'kept', 'deleted') AS fate, count(*) AS aliases,
       min(' Old ' || upper(l[1]) || l[2:5] || ' ' || upper(l[6]) || l[7:]) AS first_alias FROM named GROUP BY 1
""",
}
