"""Payloads made of events, then paired, stored and parsed like landed responses.

An event's type picks zone and offset, its number ``k`` the damage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import parse
from skyledger.schemas import POLLUTANTS
from skyledger.session import scratch_dir, spread
from skyledger.sources.landed import bronze_upsert, pair_batches, to_bronze
from skyledger.sources.tables import Warehouse

from .standins import as_text, events, table


def _cases(*cases: tuple[Column | None, Column | str]) -> Column:
    """The text of the first case that holds, nothing otherwise."""
    result = F.when(F.lit(False), "")
    for condition, text in cases:
        text = F.lit(text) if isinstance(text, str) else text
        if condition is None:
            return result.otherwise(text)
        result = result.when(condition, text)
    return result.otherwise("")


def _kind(name: str) -> Column:
    return F.col("event_type") == name


def _k(low: int, high: int) -> Column:
    return F.col("k").between(low, high)


def _number() -> Column:
    return F.col("value").cast("decimal(12,2)").cast("string")


def weather_payload() -> Column:
    zone = _cases(
        (_k(9, 9), '"timezone":null,'),
        (_kind("view"), '"timezone":"Asia/Kolkata",'),
        (_kind("click"), '"timezone":"America/New_York",'),
        (_kind("purchase"), '"timezone":"Europe/London",'),
        (_kind("signup"), '"timezone":"Mars/Olympus",'),
    )
    time = _cases(
        (_k(0, 2), ""),
        (_k(3, 4), "not-a-time"),
        (None, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")),
    )
    temperature = _cases(
        (_k(10, 14), '"temperature_2m":"sensor_error",'),
        (_k(15, 19), F.concat(F.lit('"temperature_2m":" '), _number(), F.lit(' ",'))),
        (_k(20, 24), ""),
        (_k(25, 29), '"temperature_2m":true,'),
        (_k(30, 34), '"temperature_2m":null,'),
        (_k(35, 36), F.concat(F.lit('"temperature_2m":"'), _number(), F.lit('f",'))),
        (None, F.concat(F.lit('"temperature_2m":'), _number(), F.lit(","))),
    )
    block = F.concat(
        F.lit('"current":{"time":"'), time, F.lit('",'), temperature,
        F.lit('"relative_humidity_2m":'), F.col("k").cast("string"),
        F.lit(',"precipitation":0,"surface_pressure":"'), F.col("k").cast("string"),
        F.lit('.5","wind_speed_10m":1e1}'),
    )
    current = _cases((_k(5, 5), '"current":null'), (_k(6, 6), '"current":{}'), (_k(7, 7), '"elevation":3'), (None, block))
    return F.concat(F.when(_k(8, 8), "{broken").otherwise("{"), zone, current, F.lit("}"))


def air_quality_payload() -> Column:
    index = _cases(
        (_k(0, 4), '"aqi":"-",'),
        (_k(5, 9), '"aqi":null,'),
        (_k(10, 14), ""),
        (_k(15, 19), F.concat(F.lit('"aqi":"'), F.floor("value").cast("string"), F.lit('",'))),
        (_k(20, 24), F.concat(F.lit('"aqi":"'), F.floor("value").cast("string"), F.lit('.5",'))),
        (_k(25, 29), '"aqi":"high",'),
        (None, F.concat(F.lit('"aqi":'), _number(), F.lit(","))),
    )
    pollutants = _cases(
        (_k(55, 59), ""),
        (None, F.concat(
            F.lit('"iaqi":{"pm25":{"v":'), _number(), F.lit("}"),
            _cases((_k(30, 39), ',"pm10":{"v":"n/a"}'), (None, F.concat(F.lit(',"pm10":{"v":"'), F.col("k").cast("string"), F.lit('"}')))),
            _cases((_k(40, 44), ',"co":null')),
            _cases((_k(45, 49), ',"o3":7')),
            _cases((_k(50, 99), ""), (None, ',"so2":{"v":2}')),
            F.lit("},"),
        )),
    )
    offset = _cases(
        (_k(60, 62), ',"tz":""'),
        (_k(63, 64), ',"tz":"+05"'),
        (_k(65, 65), ',"tz":null'),
        (_kind("view"), ',"tz":"+05:30"'),
        (_kind("click"), ',"tz":"-0500"'),
        (_kind("purchase"), ',"tz":"Z"'),
    )
    clock = _cases((_k(66, 67), ""), (None, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    status = F.when(_kind("error"), "error").otherwise("ok")
    return F.concat(
        F.lit('{"status":"'), status, F.lit('","data":{'), index, pollutants,
        F.lit('"dominentpol":"pm25","time":{"s":"'), clock, F.lit('"'), offset, F.lit("}}}"),
    )


def documents(spark: SparkSession, sf_dir: str, payload: Column) -> DataFrame:
    """Every event as a document fetched at its own time, in a run of half an hour."""
    half = F.when(F.minute("ts") < 30, "00").otherwise("30")
    attempts = spread(events(spark, sf_dir)).select(
        F.col("user_id").cast("int").alias("city_id"),
        F.col("event_type").alias("city_name"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.lit("api").alias("source_api"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:"), half).alias("run_id"),
        payload.alias("raw_response"),
    )
    return to_bronze(attempts)


def parse_weather_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.parsed(parse.parse_weather(documents(spark, sf_dir, weather_payload())))
    return rows.select(
        F.col("city_id").cast("bigint").alias("city_id"),
        F.col("date_key").cast("bigint").alias("date_key"),
        as_text("reading_ts").alias("reading_ts"),
        "temperature_c", "humidity_pct", "precipitation_mm", "pressure_hpa", "wind_speed_kmh",
        as_text("fetched_at").alias("fetched_at"),
    )


def parse_weather_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_counts(parse.parse_weather(documents(spark, sf_dir, weather_payload())))


def parse_aqi_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse.parsed(parse.parse_air_quality(documents(spark, sf_dir, air_quality_payload())))
    return rows.select(
        F.col("city_id").cast("bigint").alias("city_id"),
        F.col("date_key").cast("bigint").alias("date_key"),
        as_text("reading_ts").alias("reading_ts"),
        F.col("aqi_value").cast("bigint").alias("aqi_value"),
        *POLLUTANTS,
        "dominant_pollutant",
        as_text("fetched_at").alias("fetched_at"),
    )


def parse_aqi_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_counts(parse.parse_air_quality(documents(spark, sf_dir, air_quality_payload())))


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts, those of the highest ``k`` without an answer or with a cut one."""
    payload = (
        F.when(_k(98, 99), F.lit(None)).when(_k(95, 97), F.lit('{"status":')).when(_k(94, 94), F.lit("[]")).otherwise(air_quality_payload())
    )
    return spread(events(spark, sf_dir)).select("event_id", "user_id", payload.alias("raw_response"))


def classify_api_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.classify_attempts(_attempts(spark, sf_dir)).select("event_id", "status", "stored")


def api_outcome_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.outcome_counts(parse.classify_attempts(_attempts(spark, sf_dir)))


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Up to ten neighbouring events of one type make a batch. A batch's answer
    leaves out events with ``k`` of 97 and more; a batch of one is a bare object."""
    asked = events(spark, sf_dir).select(
        F.concat_ws("-", F.floor(F.col("event_id") / 10).cast("string"), "event_type").alias("batch_id"),
        "event_id", "user_id", "ts", "k",
    )
    # At most ten rows per batch, by construction.
    numbered = asked.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "user_id", "ts", "k"))).alias("all"))
    requests = numbered.select("batch_id", F.posexplode("all").alias("pos", "one")).select(
        "batch_id", "pos", F.col("one.event_id").alias("event_id"), F.col("one.user_id").alias("city_id")
    )
    answers = F.transform(
        F.filter("all", lambda e: e["k"] < 97),
        lambda e: F.concat(F.lit('{"event":'), e["event_id"].cast("string"), F.lit("}")),
    )
    listed = F.concat(F.lit("["), F.array_join(answers, ","), F.lit("]"))
    body = F.when((F.size("all") == 1) & (F.size(answers) == 1), answers[0]).otherwise(listed)
    return requests, numbered.select("batch_id", body.alias("body"), F.col("all")[0]["ts"].alias("fetched_at"))


def batch_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired, _rejected = pair_batches(*_batches(spark, sf_dir))
    return paired.select(
        "batch_id", F.col("pos").cast("bigint").alias("pos"), "event_id", "city_id",
        F.get_json_object("raw_response", "$.event").cast("bigint").alias("answered"),
    )


def batch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _paired, rejected = pair_batches(*_batches(spark, sf_dir))
    return rejected.select(
        "batch_id", F.col("pos").cast("bigint").alias("pos"), "event_id", "n_requests",
        F.col("n_responses").cast("bigint").alias("n_responses"),
    )


def _crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by nation instead of customer: many of them within one hour."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("city_id"), "c_nationkey")
    docs = documents(spark, sf_dir, weather_payload())
    return docs.join(customer, "city_id").withColumn("city_id", F.col("c_nationkey")).select(*docs.columns)


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _crowded(spark, sf_dir)
    first = F.col("city_name").isin("view", "click", "purchase")
    return bronze_upsert(docs.filter(first), docs.filter(~first))


def bronze_latest_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir).select(
        F.col("city_id").cast("bigint").alias("city_id"), "city_name",
        as_text("fetched_hour").alias("fetched_hour"), as_text("fetched_at").alias("fetched_at"), "run_id",
    )


def bronze_run_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents each run still owns: a run later in the hour takes them over."""
    return _upserted(spark, sf_dir).groupBy("run_id").agg(F.count(F.lit(1)).alias("documents"))


def incremental_run_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store all documents in two batches, then read the newest run's from the stored zone."""
    warehouse = Warehouse(spark, scratch_dir(spark, "bronze_zone"))
    docs = _crowded(spark, sf_dir)
    first = F.col("city_name").isin("view", "click", "purchase")
    warehouse.merge_bronze(docs.filter(first))
    warehouse.merge_bronze(docs.filter(~first))
    newest = docs.agg(F.max("run_id")).first()[0]
    return warehouse.run_documents("api", newest).select(
        F.col("city_id").cast("bigint").alias("city_id"), "city_name", as_text("fetched_at").alias("fetched_at"), "run_id"
    )


def bronze_rerun_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, then corrected ones of two types fetched at the same instant, by a run whose name sorts before."""
    docs = documents(spark, sf_dir, weather_payload())
    corrected = docs.filter(F.col("city_name").isin("signup", "error")).withColumn("run_id", F.lit("run-10"))
    merged = bronze_upsert(docs.withColumn("run_id", F.lit("run-9")), corrected)
    return merged.groupBy("run_id").agg(F.count(F.lit(1)).alias("documents"))


QUERIES = {
    "bronze_rerun_wins": bronze_rerun_wins,
    "parse_weather_payload": parse_weather_payload,
    "parse_weather_outcomes": parse_weather_outcomes,
    "parse_aqi_payload": parse_aqi_payload,
    "parse_aqi_outcomes": parse_aqi_outcomes,
    "classify_api_outcome": classify_api_outcome,
    "api_outcome_tallies": api_outcome_tallies,
    "batch_pairing": batch_pairing,
    "batch_rejects": batch_rejects,
    "bronze_latest_per_hour": bronze_latest_per_hour,
    "bronze_run_ownership": bronze_run_ownership,
    "incremental_run_scan": incremental_run_scan,
}

EVENTS_CTE = "SELECT *, cast(props ->> '$.k' AS int) AS k FROM events"
MICROS = "'%Y-%m-%d %H:%M:%S.%f'"

# The winter dates of the events make every zone a fixed offset.
_WEATHER = f"""
WITH e AS ({EVENTS_CTE}), local AS (
  SELECT *, date_trunc('minute', ts) AS clock,
    CASE event_type WHEN 'view' THEN INTERVAL 330 MINUTES WHEN 'click' THEN INTERVAL (-300) MINUTES
                    ELSE INTERVAL 0 MINUTES END AS shift,
    CASE WHEN k = 8 THEN 'unreadable' WHEN k IN (5, 6, 7) THEN 'no current block'
         WHEN k < 5 THEN 'bad time' WHEN k = 9 THEN 'bad zone' ELSE 'ok' END AS parse_status
  FROM e
)
"""
_AIR = f"""
WITH e AS ({EVENTS_CTE}), local AS (
  SELECT *, date_trunc('second', ts) AS clock,
    CASE event_type WHEN 'view' THEN INTERVAL 330 MINUTES WHEN 'click' THEN INTERVAL (-300) MINUTES
                    ELSE INTERVAL 0 MINUTES END AS shift,
    CASE WHEN event_type = 'error' THEN 'no station' WHEN k < 15 THEN 'no data'
         WHEN k BETWEEN 60 AND 67 THEN 'bad time' WHEN k BETWEEN 40 AND 49 THEN 'bad pollutant'
         ELSE 'ok' END AS parse_status
  FROM e
)
"""
_OUTCOMES = "SELECT parse_status, count(*) AS documents FROM local GROUP BY 1"
_CLASSIFIED = f"""
WITH e AS ({EVENTS_CTE}), classified AS (
  SELECT event_id, CASE WHEN k >= 94 THEN 'error' WHEN event_type = 'error' THEN 'no_station'
                        WHEN k < 15 THEN 'no_data' ELSE 'ok' END AS status FROM e
)
"""
_BATCHES = f"""
WITH e AS ({EVENTS_CTE}), asked AS (
  SELECT cast(event_id // 10 AS varchar) || '-' || event_type AS batch_id, event_id, user_id, k FROM e
), numbered AS (
  SELECT *, row_number() OVER b - 1 AS pos, count(*) OVER a AS n_requests,
         count(*) FILTER (k < 97) OVER a AS n_responses FROM asked
  WINDOW a AS (PARTITION BY batch_id), b AS (PARTITION BY batch_id ORDER BY event_id)
)
"""
_LATEST = f"""
WITH latest AS (
  SELECT c_nationkey AS city_id, event_type, ts, strftime(ts, '%Y-%m-%dT%H:')
         || CASE WHEN minute(ts) < 30 THEN '00' ELSE '30' END AS run_id
  FROM events JOIN customer ON user_id = c_custkey
  QUALIFY row_number() OVER (PARTITION BY c_nationkey, date_trunc('hour', ts)
                              ORDER BY event_type IN ('signup', 'error') DESC, ts DESC) = 1
)
"""

ORACLES = {
    "bronze_rerun_wins": """
WITH keys AS (
  SELECT bool_or(event_type IN ('signup', 'error')) AS corrected FROM events GROUP BY user_id, date_trunc('hour', ts)
)
SELECT if(corrected, 'run-10', 'run-9') AS run_id, count(*) AS documents FROM keys GROUP BY 1
""",
    "parse_weather_payload": f"""{_WEATHER}
SELECT user_id AS city_id, cast(strftime(clock, '%Y%m%d') AS bigint) AS date_key,
       strftime(clock - shift, {MICROS}) AS reading_ts,
       CASE WHEN k BETWEEN 25 AND 29 THEN 1.0 WHEN k BETWEEN 10 AND 14 OR k BETWEEN 20 AND 24 OR k BETWEEN 30 AND 36
            THEN NULL ELSE value END AS temperature_c,
       cast(k AS double) AS humidity_pct, cast(0 AS double) AS precipitation_mm, k + 0.5::double AS pressure_hpa,
       cast(10 AS double) AS wind_speed_kmh, strftime(ts, {MICROS}) AS fetched_at
FROM local WHERE parse_status = 'ok'
""",
    "parse_weather_outcomes": _WEATHER + _OUTCOMES,
    "parse_aqi_payload": f"""{_AIR}
SELECT user_id AS city_id, cast(strftime(clock, '%Y%m%d') AS bigint) AS date_key,
       strftime(clock - shift, {MICROS}) AS reading_ts,
       CASE WHEN k BETWEEN 20 AND 29 THEN NULL ELSE cast(floor(value) AS bigint) END AS aqi_value,
       CASE WHEN k NOT BETWEEN 55 AND 59 THEN value END AS pm25,
       CASE WHEN k NOT BETWEEN 30 AND 39 AND k NOT BETWEEN 55 AND 59 THEN cast(k AS double) END AS pm10,
       cast(NULL AS double) AS no2, CASE WHEN k < 50 THEN cast(2 AS double) END AS so2,
       cast(NULL AS double) AS co, cast(NULL AS double) AS o3, 'pm25' AS dominant_pollutant,
       strftime(ts, {MICROS}) AS fetched_at
FROM local WHERE parse_status = 'ok'
""",
    "parse_aqi_outcomes": _AIR + _OUTCOMES,
    "classify_api_outcome": _CLASSIFIED + "SELECT event_id, status, status = 'ok' AS stored FROM classified",
    "api_outcome_tallies": _CLASSIFIED
    + """SELECT count(*) FILTER (status = 'ok') AS stored, count(*) FILTER (status IN ('no_station', 'no_data')) AS no_data,
count(*) FILTER (status = 'error') AS failed FROM classified""",
    "batch_pairing": _BATCHES
    + """SELECT batch_id, pos, event_id, user_id AS city_id, event_id AS answered
FROM numbered WHERE n_requests = n_responses""",
    "batch_rejects": _BATCHES
    + "SELECT batch_id, pos, event_id, n_requests, n_responses FROM numbered WHERE n_requests <> n_responses",
    "bronze_latest_per_hour": f"""{_LATEST}
SELECT cast(city_id AS bigint) AS city_id, event_type AS city_name,
       strftime(date_trunc('hour', ts), {MICROS}) AS fetched_hour, strftime(ts, {MICROS}) AS fetched_at, run_id FROM latest
""",
    "bronze_run_ownership": _LATEST + "SELECT run_id, count(*) AS documents FROM latest GROUP BY 1",
    "incremental_run_scan": f"""{_LATEST}
SELECT cast(city_id AS bigint) AS city_id, event_type AS city_name, strftime(ts, {MICROS}) AS fetched_at, run_id
FROM latest WHERE run_id = (SELECT max(run_id) FROM latest)
""",
}
