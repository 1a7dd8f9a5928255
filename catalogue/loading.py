"""Fact merges: in memory, through the stored warehouse, and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.times import date_key
from skyledger.operators.calendar import spine_over
from skyledger.operators.merge import latest_per_key, mark_missing, merge_readings
from skyledger.operators.parse import parse_air_quality, parse_weather, parsed
from skyledger.plans.readings_load import load_rows
from skyledger.schemas import AIR_QUALITY_MEASURES, AIR_QUALITY_REQUIRED, BRONZE, POLLUTANTS, WEATHER_MEASURES
from skyledger.session import scratch_dir
from skyledger.sources.tables import Warehouse
from skyledger.streaming.incremental import ingest_new_documents

from .parsing import EVENTS_CTE, MICROS, air_quality_payload, documents, weather_payload
from .standins import as_text, dim_city, events

MEASURES = ["temperature_c", "fetched_at"]
FIRST_TYPES = ["view", "click", "purchase"]
NEXT_TYPES = ["purchase", "signup", "error"]


def _rows(spark: SparkSession, sf_dir: str, factor: int, days_later: int, hours_later: int) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("reading_id"),
        F.col("user_id").alias("city_id"),
        date_key(F.date_add(ts.cast("date"), days_later)).alias("date_key"),
        ts.alias("reading_ts"),
        (F.col("value").cast("decimal(12,2)") * factor).cast("decimal(12,2)").alias("temperature_c"),
        F.timestamp_add("HOUR", F.lit(hours_later), ts).alias("fetched_at"),
        "event_type",
    )


def _old_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Three types are stored; three arrive, one of them known, each reading in three versions."""
    old = _rows(spark, sf_dir, 1, 0, 0).filter(F.col("event_type").isin(FIRST_TYPES)).drop("event_type")
    late = F.col("event_type").isin(NEXT_TYPES)
    new = (
        _rows(spark, sf_dir, 3, 1, 9)
        .unionByName(_rows(spark, sf_dir, 5, 2, 11))
        .unionByName(_rows(spark, sf_dir, 7, 3, 10))
        .filter(late)
        .drop("event_type")
    )
    return old, new


def _merged_shown(merged: DataFrame) -> DataFrame:
    return merged.select(
        "reading_id", "city_id", F.col("date_key").cast("bigint").alias("date_key"),
        as_text("reading_ts").alias("reading_ts"), F.col("temperature_c").cast("double").alias("temperature_c"),
        as_text("fetched_at").alias("fetched_at"),
    )


def fact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return _merged_shown(merge_readings(old, new, MEASURES))


def fact_merge_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return _merged_shown(merge_readings(merge_readings(old, new, MEASURES), new, MEASURES))


def aqi_fact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed air-quality documents of every nation-wide hour, merged on the second."""
    docs, early = documents(spark, sf_dir, air_quality_payload()), F.hour("fetched_at") < 12

    def rows(of: DataFrame) -> DataFrame:
        """Documents are picked before they are parsed: no filter gets below the parser."""
        read = parsed(parse_air_quality(of))
        return read.withColumns({"city_id": F.col("city_id") % 7, "reading_ts": F.date_trunc("hour", "reading_ts")})

    first = rows(docs.filter(early))
    morning = merge_readings(first.filter(F.lit(False)), first, AIR_QUALITY_MEASURES)
    merged = merge_readings(morning, rows(docs.filter(~early)), AIR_QUALITY_MEASURES)
    return merged.select(
        F.col("city_id").cast("bigint").alias("city_id"), as_text("reading_ts").alias("reading_ts"),
        F.col("aqi_value").cast("bigint").alias("aqi_value"), *POLLUTANTS, "dominant_pollutant",
        as_text("fetched_at").alias("fetched_at"),
    )


def copies_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each type: five keys hold all rows."""
    rows = events(spark, sf_dir).select("event_type", "ts", "event_id", "user_id", "value")
    return latest_per_key(rows, ["event_type"], ["ts"]).withColumn("ts", as_text("ts"))


def validate_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("k") >= 5, F.col("user_id")).alias("city_id"),
        F.when(F.col("event_type") != "error", F.col("ts")).alias("reading_ts"),
        F.when(F.col("k") < 90, F.col("k")).alias("date_key"),
        F.when(F.col("value") > 1, F.col("value")).alias("aqi_value"),
    )
    return mark_missing(rows, AIR_QUALITY_REQUIRED).select("event_id", F.array_join("missing", ",").alias("missing"))


def _stored_fact(warehouse: Warehouse) -> DataFrame:
    numbers = ["temperature_c", "humidity_pct", "precipitation_mm", "pressure_hpa", "wind_speed_kmh"]
    return warehouse.read("fact_weather_reading").select(
        "reading_id",
        F.col("city_id").cast("bigint").alias("city_id"),
        F.col("date_key").cast("bigint").alias("date_key"),
        as_text("reading_ts").alias("reading_ts"),
        *[F.col(c).cast("double").alias(c) for c in numbers],
        as_text("fetched_at").alias("fetched_at"),
        F.col("reading_day").cast("string").alias("reading_day"),
    )


def stored_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents in two loads, the second given twice, read back from the warehouse."""
    warehouse = Warehouse(spark, scratch_dir(spark, "facts"))
    docs = documents(spark, sf_dir, weather_payload())
    for batch in (FIRST_TYPES, NEXT_TYPES, NEXT_TYPES):
        rows = parsed(parse_weather(docs.filter(F.col("city_name").isin(batch))))
        load_rows(warehouse, "fact_weather_reading", rows, check_foreign=False)
    return _stored_fact(warehouse)


def stream_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents landed as files and loaded by two runs of the stream."""
    warehouse = Warehouse(spark, scratch_dir(spark, "streamed_facts"))
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "stream")
    docs = documents(spark, sf_dir, weather_payload())
    for batch in (FIRST_TYPES, NEXT_TYPES):
        landed = docs.filter(F.col("city_name").isin(batch))
        landed.select(*BRONZE.fieldNames()).write.mode("append").parquet(landing)
        ingest_new_documents(
            warehouse, landing, "fact_weather_reading", checkpoint, check_foreign=False
        ).awaitTermination()
    return _stored_fact(warehouse)


def _with_parents(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    """A warehouse that knows the active cities and the days of all events."""
    warehouse = Warehouse(spark, scratch_dir(spark, label))
    cities = dim_city(spark, sf_dir).filter("is_active")
    absent = {n: F.lit(None) for n in ("latitude", "longitude", "tier", "population", "created_at", "updated_at")}
    warehouse.replace("dim_city", cities.withColumns(absent))
    warehouse.replace("dim_date", spine_over(events(spark, sf_dir), "ts"))
    return warehouse


def _left_over(warehouse: Warehouse, path: str, loaded: int | None) -> DataFrame:
    """What a warehouse says became of its documents."""
    lost = warehouse.read("load_rejects").select("kind", F.explode("violations").alias("reason"))
    counted = lost.groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("documents"))
    stored = warehouse.read("fact_weather_reading").agg(
        F.lit("stored").alias("kind"), F.lit("").alias("reason"), F.count(F.lit(1)).alias("documents")
    )
    parts = counted.unionByName(stored)
    if loaded is not None:
        parts = parts.unionByName(
            warehouse.spark.range(1).select(
                F.lit("loaded").alias("kind"), F.lit("").alias("reason"), F.lit(loaded).cast("bigint").alias("documents")
            )
        )
    return parts.withColumn("path", F.lit(path))


def stored_load_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of every weather document, in two batches with the second given twice, and in a stream that is replayed."""
    docs, known = documents(spark, sf_dir, weather_payload()), "fact_weather_reading"
    warehouse = _with_parents(spark, sf_dir, "outcomes")
    loads = [
        load_rows(warehouse, known, parse_weather(docs.filter(F.col("city_name").isin(types))), name)
        for name, types in (("first", FIRST_TYPES), ("next", NEXT_TYPES), ("next", NEXT_TYPES))
    ]
    streamed = _with_parents(spark, sf_dir, "streamed_outcomes")
    landing = scratch_dir(spark, "landing")
    for types in (FIRST_TYPES, NEXT_TYPES):
        docs.filter(F.col("city_name").isin(types)).select(*BRONZE.fieldNames()).write.mode("append").parquet(landing)
    for _ in range(2):  # a stream that has lost its checkpoint starts from the first file again
        ingest_new_documents(streamed, landing, known, f"{scratch_dir(spark, 'run')}/outcomes").awaitTermination()
    return _left_over(warehouse, "batch", loads[0].loaded + loads[1].loaded).unionByName(_left_over(streamed, "stream", None))


def reading_ids_subsecond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored readings a few microseconds apart: as many ids as rows."""
    warehouse = Warehouse(spark, scratch_dir(spark, "subsecond"))
    shifted = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id"))
    rows = events(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("city_id"), shifted.alias("reading_ts"), date_key(F.col("ts")).cast("int").alias("date_key"),
        *[F.lit(None).cast("decimal(5,2)").alias(m) for m in WEATHER_MEASURES if m != "fetched_at"],
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )
    with warehouse.scratch() as stage:
        warehouse.merge_facts("fact_weather_reading", stage(rows, "rows"))
    return warehouse.read("fact_weather_reading").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_distinct("reading_id").alias("ids"),
        F.count_if(F.col("reading_id") < 0).alias("hashed_ids"),
    )


QUERIES = {
    "stored_load_outcomes": stored_load_outcomes,
    "reading_ids_subsecond": reading_ids_subsecond,
    "fact_merge": fact_merge,
    "fact_merge_twice": fact_merge_twice,
    "aqi_fact_merge": aqi_fact_merge,
    "copies_per_key": copies_per_key,
    "validate_required_fields": validate_required_fields,
    "stored_fact_load": stored_fact_load,
    "stream_incremental_merge": stream_incremental_merge,
}

_MERGED = f"""
SELECT event_id AS reading_id, user_id AS city_id,
       cast(strftime(CASE WHEN event_type IN ('signup', 'error') THEN ts + INTERVAL 1 DAY ELSE ts END, '%Y%m%d')
            AS bigint) AS date_key,
       strftime(ts, {MICROS}) AS reading_ts,
       cast(cast(value AS decimal(12,2)) * CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 5 END AS double)
         AS temperature_c,
       strftime(CASE WHEN event_type IN ('view', 'click') THEN ts ELSE ts + INTERVAL 11 HOURS END, {MICROS})
         AS fetched_at
FROM events
"""

# Readings are whole minutes, so events of a minute meet; the loads' order and the
# fetch time decide which one updates last and which came first.
_LOADED = f"""
WITH e AS ({EVENTS_CTE}), rows AS (
  SELECT *, date_trunc('minute', ts) AS clock,
    CASE event_type WHEN 'view' THEN INTERVAL 330 MINUTES WHEN 'click' THEN INTERVAL (-300) MINUTES
                    ELSE INTERVAL 0 MINUTES END AS shift,
    CASE WHEN k BETWEEN 25 AND 29 THEN 1.0 WHEN k BETWEEN 10 AND 14 OR k BETWEEN 20 AND 24 OR k BETWEEN 30 AND 36
         THEN NULL ELSE value END AS t,
    (event_type IN ('signup', 'error', 'purchase'))::int AS last_load,
    (event_type IN ('signup', 'error'))::int AS first_load
  FROM e WHERE k > 9
), keyed AS (SELECT *, clock - shift AS reading_ts FROM rows), merged AS (
  SELECT user_id, reading_ts, max_by({{t: t, k: k, ts: ts}}, (last_load, ts)) AS last,
         min_by(clock, (first_load, ts)) AS first_clock FROM keyed GROUP BY ALL
)
SELECT user_id * 4294967296 + epoch(reading_ts)::bigint AS reading_id, user_id AS city_id,
       cast(strftime(first_clock, '%Y%m%d') AS bigint) AS date_key, strftime(reading_ts, {MICROS}) AS reading_ts,
       last.t AS temperature_c, cast(last.k AS double) AS humidity_pct, cast(0 AS double) AS precipitation_mm,
       last.k + 0.5::double AS pressure_hpa, cast(10 AS double) AS wind_speed_kmh,
       strftime(last.ts, {MICROS}) AS fetched_at, cast(reading_ts::date AS varchar) AS reading_day
FROM merged
"""

ORACLES = {
    "stored_load_outcomes": f"""
WITH e AS ({EVENTS_CTE}), local AS (
  SELECT e.*, c_acctbal >= 0 AS known, if(event_type = 'purchase', 2, 1) AS times,
    date_trunc('minute', ts) - CASE event_type WHEN 'view' THEN INTERVAL 330 MINUTES
      WHEN 'click' THEN INTERVAL (-300) MINUTES ELSE INTERVAL 0 MINUTES END AS reading_ts,
    CASE WHEN k = 8 THEN 'unreadable' WHEN k IN (5, 6, 7) THEN 'no current block'
         WHEN k < 5 THEN 'bad time' WHEN k = 9 THEN 'bad zone' ELSE 'ok' END AS parse_status
  FROM e LEFT JOIN customer ON user_id = c_custkey
), found AS (
  SELECT 'spoilt' AS kind, parse_status AS reason, sum(times)::bigint AS documents FROM local
  WHERE parse_status <> 'ok' GROUP BY ALL
  UNION ALL SELECT 'rejected', 'city_id: unknown', sum(times)::bigint FROM local
  WHERE parse_status = 'ok' AND NOT coalesce(known, false) HAVING count(*) > 0
  UNION ALL SELECT 'stored', '', count(DISTINCT (user_id, reading_ts)) FROM local WHERE parse_status = 'ok' AND known
)
SELECT 'batch' AS path, * FROM found
UNION ALL SELECT 'batch', 'loaded', '', sum(times)::bigint FROM local WHERE parse_status = 'ok' AND known
UNION ALL SELECT 'stream', * FROM found
""",
    "reading_ids_subsecond": """
WITH r AS (SELECT DISTINCT user_id, ts + to_microseconds(event_id) AS t FROM events)
SELECT count(*) AS readings, count(*) AS ids, count(*) FILTER (epoch_us(t) % 1000000 <> 0) AS hashed_ids FROM r
""",
    "fact_merge": _MERGED,
    "fact_merge_twice": _MERGED,
    "aqi_fact_merge": f"""
WITH e AS ({EVENTS_CTE}), rows AS (
  SELECT user_id % 7 AS city_id, hour(ts) >= 12 AS late, ts, k, value,
    date_trunc('hour', ts - CASE event_type WHEN 'view' THEN INTERVAL 330 MINUTES
                                 WHEN 'click' THEN INTERVAL (-300) MINUTES ELSE INTERVAL 0 MINUTES END) AS reading_ts
  FROM e WHERE event_type <> 'error' AND k >= 15 AND k NOT BETWEEN 60 AND 67 AND k NOT BETWEEN 40 AND 49
)
SELECT city_id, strftime(reading_ts, {MICROS}) AS reading_ts,
       CASE WHEN k BETWEEN 20 AND 29 THEN NULL ELSE cast(floor(value) AS bigint) END AS aqi_value,
       CASE WHEN k NOT BETWEEN 55 AND 59 THEN value END AS pm25,
       CASE WHEN k NOT BETWEEN 30 AND 39 AND k NOT BETWEEN 55 AND 59 THEN cast(k AS double) END AS pm10,
       cast(NULL AS double) AS no2, CASE WHEN k < 50 THEN cast(2 AS double) END AS so2,
       cast(NULL AS double) AS co, cast(NULL AS double) AS o3, 'pm25' AS dominant_pollutant,
       strftime(ts, {MICROS}) AS fetched_at
FROM rows QUALIFY row_number() OVER (PARTITION BY city_id, reading_ts ORDER BY late DESC, ts DESC) = 1
""",
    "copies_per_key": f"""
SELECT event_type, strftime(ts, {MICROS}) AS ts, event_id, user_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
""",
    "validate_required_fields": f"""
WITH e AS ({EVENTS_CTE})
SELECT event_id, concat_ws(',', CASE WHEN k < 5 THEN 'city_id' END, CASE WHEN k >= 90 THEN 'date_key' END,
       CASE WHEN event_type = 'error' THEN 'reading_ts' END, CASE WHEN value <= 1 THEN 'aqi_value' END) AS missing
FROM e
""",
    "stored_fact_load": _LOADED,
    "stream_incremental_merge": _LOADED,
}
