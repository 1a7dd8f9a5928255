"""The gate with its records, and names resolved within the stored warehouse."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.times import date_key
from skyledger.operators import checks, gate
from skyledger.operators.constraints import audit, delete_rows
from skyledger.plans.name_load import resolve_and_store
from skyledger.schemas import TABLE_RULES
from skyledger.session import scratch_dir
from skyledger.sources.city_csv import read_city_csv
from skyledger.sources.tables import Warehouse

from .resolving import _BASE, known_aliases, named_cities, spelled_names
from .standins import before_latest_event, dim_city, events, table

FIRST_DAY = date(2024, 1, 31)


def _cities(spark: SparkSession, sf_dir: str, recent_only: bool) -> DataFrame:
    """Customers as the dimension; active are those with a recent event, or all."""
    recent = events(spark, sf_dir).filter(F.col("ts") >= before_latest_event(spark, sf_dir, "4 HOURS"))
    recent = recent.select(F.col("user_id").alias("city_id"), F.lit(True).alias("seen")).distinct()
    seen = F.coalesce("seen", F.lit(False)) if recent_only else F.lit(True)
    absent = {n: F.lit(None) for n in ("latitude", "longitude", "tier", "population", "created_at", "updated_at")}
    return dim_city(spark, sf_dir).join(recent, "city_id", "left").withColumn("is_active", seen).withColumns(absent)


def _air(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    absent = {n: F.lit(None).cast("decimal(7,2)") for n in ("pm25", "pm10", "no2", "so2", "co", "o3")}
    rows = events(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("city_id"), ts.alias("reading_ts"), date_key(F.col("ts")).cast("int").alias("date_key"),
        F.least(F.floor("value"), F.lit(400)).cast("smallint").alias("aqi_value"),
        F.lit("pm25").alias("dominant_pollutant"), ts.alias("fetched_at"), "k",
    )
    return rows.withColumns(absent)


def dq_recorded_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the gate over a stored warehouse, as its log and its results tell afterwards.

    The first run warns. Before the second all cities become active, though few have
    recent readings, and a later load takes index values away; it fails, and says so by
    an error that is caught here.
    """
    warehouse = Warehouse(spark, scratch_dir(spark, "recorded_gate"))
    air = _air(spark, sf_dir)
    measures = ("precipitation_mm", "pressure_hpa", "wind_speed_kmh")
    weather = air.select(
        "city_id", "reading_ts", "date_key", "fetched_at", (F.col("aqi_value") - 30).cast("decimal(5,2)").alias("temperature_c"),
        F.col("k").cast("decimal(5,2)").alias("humidity_pct"), *[F.lit(1).cast("decimal(6,2)").alias(m) for m in measures],
    )
    warehouse.merge_facts("fact_weather_reading", weather)
    warehouse.merge_facts("fact_air_quality_reading", air.drop("k"))
    names = dim_city(spark, sf_dir).select(F.col("c_mktsegment").alias("raw_name")).distinct()
    open_names = names.withColumns(
        {
            "id": F.lit(1), "source": F.lit("pipeline"), "occurrence_count": F.lit(1), "resolved": F.lit(False),
            "first_seen_at": F.lit(datetime(2024, 1, 1)), "last_seen_at": F.lit(datetime(2024, 1, 1)),
        }
    )
    warehouse.replace("quarantine_unmatched_city_names", open_names)
    warehouse.replace("dim_city", _cities(spark, sf_dir, recent_only=True))
    counted = events(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k") == 0).alias("zero")).first()
    failed = [r.n_name for r in table(spark, sf_dir, "nation").filter("n_regionkey = 1").orderBy("n_name").collect()]
    loaded = {"weather_loaded": counted.n, "aqi_loaded": counted.n, "weather_rejected": counted.zero, "cities_failed": failed}
    now = before_latest_event(spark, sf_dir, "0 HOURS")
    gate.run_gate(warehouse, loaded, gate.Run("readings", "gate", FIRST_DAY, datetime(2024, 1, 31)), now)

    warehouse.replace("dim_city", _cities(spark, sf_dir, recent_only=False))
    later = air.filter(F.col("k") < 3).withColumn("aqi_value", F.lit(None).cast("smallint")).drop("k")
    warehouse.merge_facts("fact_air_quality_reading", later)
    raised = ""
    try:
        gate.run_gate(warehouse, {"aqi_loaded": 9}, gate.Run("readings", "gate", date(2024, 2, 1), datetime(2024, 2, 1)), now)
    except gate.GateFailed as error:
        raised = str(error)

    log, results = gate.recorded(warehouse)
    nothing = F.lit(None).cast("string")
    runs = log.select(
        "run_id", F.lit(None).cast("bigint").alias("result_id"), F.concat_ws("/", "dag_id", "task_id").alias("name"), nothing.alias("table_name"), "status",
        F.col("logical_date").cast("string").alias("logical_date"), "rows_extracted", "rows_loaded", "rows_rejected",
        F.to_json("cities_failed").alias("cities_failed"),
        F.when(F.col("status") == "failure", F.lit(raised)).alias("raised"),
        (F.col("ended_at") >= F.col("started_at")).alias("ended"),
    )
    checked = results.select(
        "run_id", F.col("id").alias("result_id"), F.col("check_name").alias("name"), "table_name", "status",
        nothing.alias("logical_date"), *[F.lit(None).cast("bigint").alias(c) for c in ("rows_extracted", "rows_loaded", "rows_rejected")],
        nothing.alias("cities_failed"), nothing.alias("raised"), F.col("checked_at").isNotNull().alias("ended"),
    )
    return runs.unionByName(checked)


def names_resolved_and_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spellings resolved twice within a stored warehouse: what was counted, learned and quarantined."""
    warehouse = Warehouse(spark, scratch_dir(spark, "names"))
    absent = {n: F.lit(None) for n in ("state", "latitude", "longitude", "tier", "population", "created_at", "updated_at")}
    warehouse.replace("dim_city", named_cities(spark, sf_dir).withColumns(absent))
    warehouse.replace("dim_city_alias", known_aliases(spark, sf_dir))
    spelled = spelled_names(spark, sf_dir)
    # Two no-break spaces are as blank as the tabs among the spellings.
    spelled = spelled.withColumn("raw_name", F.when(F.col("raw_name").rlike("Zone (ERROR|VIEW)"), F.lit("  ")).otherwise(F.col("raw_name")))
    loads = [resolve_and_store(warehouse, spelled, F.lit(datetime(2024, 2, day))) for day in (1, 2)]
    counts = [
        F.struct(F.lit(f"load {n}").alias("part"), F.lit(kind).alias("item"), F.lit(number).cast("bigint").alias("value"))
        for n, load in enumerate(loads, 1)
        for kind, number in (("exact", load.exact), ("fuzzy", load.fuzzy), ("quarantined", load.quarantined), ("blank", load.blank))
    ]
    counted = spark.range(1).select(F.explode(F.array(*counts)).alias("c")).select("c.*")
    aliases = warehouse.read("dim_city_alias").select(
        F.concat(F.lit("alias "), "match_method").alias("part"), F.col("raw_alias").alias("item"), F.col("canonical_city_id").cast("bigint").alias("value")
    )
    quarantined = warehouse.read("quarantine_unmatched_city_names").select(
        F.lit("quarantine").alias("part"), F.col("raw_name").alias("item"), F.col("occurrence_count").alias("value")
    )
    return counted.unionByName(aliases).unionByName(quarantined)


def dq_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What freshness and completeness say of every event, as if it were the state of a warehouse: ages in
    quarters of an hour, many of which end in a five to be rounded, and shares of cities."""
    rows = events(spark, sf_dir)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    age = {"as_of": micros + F.col("k").cast("bigint") * 900_000_000, "weather.latest": micros}
    share = {"weather.recent_cities": F.col("k").cast("bigint"), "cities.active": F.col("event_id") % 201}
    said = [
        F.struct(F.lit(name).alias("check_name"), judged[0].alias("status"), judged[1].alias("details"))
        for name, judged in (("freshness", checks.judgement("freshness", age)), ("completeness", checks.judgement("completeness", share)))
    ]
    return rows.select("event_id", F.explode(F.array(*said)).alias("s")).select("event_id", "s.*")


def cascade_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities with a low balance are deleted unless they have readings, with their aliases; and so are
    the finished runs of the log with their results. Rows kept, deleted and refused in every table."""
    cities = dim_city(spark, sf_dir).select("city_id", "c_acctbal")
    tables = {
        "dim_city": cities,
        "dim_city_alias": known_aliases(spark, sf_dir).select("alias_id", "canonical_city_id"),
        "fact_air_quality_reading": events(spark, sf_dir).filter("event_type = 'error'").select("event_id", F.col("user_id").alias("city_id")),
        "pipeline_run_log": table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), "o_orderstatus"),
        "dq_check_results": table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("id"), F.col("l_orderkey").alias("run_id"), "l_partkey"),
    }
    parts = []
    for root, doomed in (("dim_city", F.col("c_acctbal") < 2000), ("pipeline_run_log", F.col("o_orderstatus") == "F")):
        for name, rows in delete_rows(tables, TABLE_RULES, root, doomed).items():
            key = F.col({"dim_city": "city_id", "dim_city_alias": "alias_id", "pipeline_run_log": "run_id"}.get(name, "l_partkey"))
            for fate in ("kept", "deleted", "refused"):
                counted = getattr(rows, fate).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(key), F.lit(0)).alias("key_sum"))
                parts.append(counted.select(F.lit(name).alias("table_name"), F.lit(fate).alias("fate"), "rows", "key_sum"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def constraint_audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constraints of aliases, weather, runs, results and quarantine over damaged stand-ins."""
    custkey, k = F.col("c_custkey"), F.col("k")
    customers = table(spark, sf_dir, "customer")
    day = F.lit(datetime(2024, 1, 1))
    tables = {
        "dim_city": dim_city(spark, sf_dir).filter("is_active").select("city_id"),
        "dim_city_alias": customers.select(
            custkey.alias("alias_id"),
            F.when(custkey % 11 == 0, F.lit(None)).when(custkey % 13 == 0, F.lit("Same")).when(custkey % 17 == 0, F.rpad("c_name", 201, "x"))
            .otherwise(F.col("c_name")).alias("raw_alias"),
            custkey.alias("canonical_city_id"),
            F.when(custkey % 7 == 0, F.lit("guess")).otherwise(F.lit("manual")).alias("match_method"),
        ),
        "fact_weather_reading": events(spark, sf_dir).select(
            F.col("event_id").alias("reading_id"), F.when(k > 0, F.col("user_id")).alias("city_id"), F.lit(20240101).alias("date_key"),
            F.when(k != 1, F.date_trunc("hour", "ts")).alias("reading_ts"), F.when(k != 2, F.col("ts")).alias("fetched_at"),
        ),
        "pipeline_run_log": table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("run_id"), F.rpad("o_orderpriority", 260, "x").alias("dag_id"),
            F.when(F.col("o_orderstatus") != "P", F.lit("gate")).alias("task_id"), F.col("o_orderdate").cast("date").alias("logical_date"),
            F.col("o_orderstatus").alias("status"),
        ),
        "dq_check_results": table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("id"), (F.col("l_orderkey") + F.when(F.col("l_linenumber") >= 4, 1_000_000_000).otherwise(0)).alias("run_id"),
            F.lit("check").alias("check_name"), F.lit("table").alias("table_name"),
            F.when(F.col("l_returnflag") == "A", "pass").when(F.col("l_returnflag") == "N", "warn").otherwise("broken down").alias("status"),
            F.when(F.col("l_linenumber") > 1, F.col("l_shipdate")).alias("checked_at"),
        ),
        "quarantine_unmatched_city_names": customers.select(
            custkey.alias("id"), F.col("c_mktsegment").alias("raw_name"), F.rpad("c_mktsegment", 60, "x").alias("source"),
            day.alias("first_seen_at"), day.alias("last_seen_at"), F.when(F.col("c_acctbal") >= 0, F.lit(1)).alias("occurrence_count"), F.lit(True).alias("resolved"),
        ),
    }
    return audit(tables, TABLE_RULES).filter("table_name <> 'dim_city'")


def source_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city file of all nations, one with a header only, and one that is not there."""
    nation = table(spark, sf_dir, "nation")
    cities = nation.select(
        F.col("n_name").alias("city_name"), F.col("n_regionkey").cast("string").alias("state"), F.col("n_nationkey").alias("latitude"),
        F.col("n_nationkey").alias("longitude"), F.lit(1).alias("tier"), F.lit(None).cast("string").alias("population"),
    )
    root, found = scratch_dir(spark, "sources"), []
    for name, rows in (("present", cities), ("empty", cities.filter(F.length("city_name") < 0))):
        rows.coalesce(1).write.option("header", True).csv(f"{root}/{name}")
    for name in ("present", "empty", "missing"):
        try:
            number = read_city_csv(spark, f"{root}/{name}")[0].count()
            found.append((name, "empty" if number == 0 else "present", number))
        except AnalysisException as error:
            found.append((name, error.getCondition(), None))
    return spark.createDataFrame(found, "source string, outcome string, rows bigint")


QUERIES = {
    "constraint_audit_records": constraint_audit_records,
    "source_presence": source_presence,
    "dq_recorded_run": dq_recorded_run,
    "names_resolved_and_stored": names_resolved_and_stored,
    "dq_messages": dq_messages,
    "cascade_refresh": cascade_refresh,
}

ORACLES = {
    "source_presence": """
SELECT 'present' AS source, 'present' AS outcome, count(*) AS rows FROM nation
UNION ALL SELECT 'empty', 'empty', 0 UNION ALL SELECT 'missing', 'PATH_NOT_FOUND', NULL
""",
    "constraint_audit_records": """
WITH alias AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'Same'
    WHEN c_custkey % 17 = 0 THEN rpad(c_name, 201, 'x') ELSE c_name END AS raw, c_custkey % 7 = 0 AS guess, c_acctbal < 0 AS orphan FROM customer),
weather AS (
  SELECT cast(props ->> '$.k' AS int) AS k, user_id, date_trunc('hour', ts) AS t, c_acctbal < 0 AS orphan
  FROM events JOIN customer ON user_id = c_custkey),
found AS (
  SELECT 'dim_city_alias' AS t, 'not null' AS kind, 'raw_alias' AS target, (SELECT count(*) FROM alias WHERE raw IS NULL) AS n
  UNION ALL SELECT 'dim_city_alias', 'not null', x, 0 FROM unnest(['canonical_city_id', 'match_method']) u(x)
  UNION ALL SELECT 'dim_city_alias', 'domain', 'match_method', (SELECT count(*) FROM alias WHERE guess)
  UNION ALL SELECT 'dim_city_alias', 'length', 'raw_alias', (SELECT count(*) FROM alias WHERE length(raw) > 200)
  UNION ALL SELECT 'dim_city_alias', 'length', 'match_method', 0
  UNION ALL SELECT 'dim_city_alias', 'unique', 'alias_id', 0
  UNION ALL SELECT 'dim_city_alias', 'unique', 'raw_alias', (SELECT count(raw) - count(DISTINCT raw) FROM alias)
  UNION ALL SELECT 'dim_city_alias', 'foreign', 'canonical_city_id', (SELECT count(*) FROM alias WHERE orphan)
  UNION ALL SELECT 'fact_weather_reading', 'not null', x, (SELECT count(*) FROM weather WHERE k = y)
    FROM (VALUES ('city_id', 0), ('reading_ts', 1), ('fetched_at', 2), ('date_key', -1)) v(x, y)
  UNION ALL SELECT 'fact_weather_reading', 'unique', 'reading_id', 0
  UNION ALL SELECT 'fact_weather_reading', 'unique', 'city_id, reading_ts', (SELECT count(*) - count(DISTINCT (user_id, t)) FROM weather WHERE k > 1)
  UNION ALL SELECT 'fact_weather_reading', 'foreign', 'city_id', (SELECT count(*) FROM weather WHERE orphan AND k > 0)
  UNION ALL SELECT 'pipeline_run_log', 'not null', x, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND x = 'task_id')
    FROM unnest(['dag_id', 'task_id', 'logical_date', 'status']) u(x)
  UNION ALL SELECT 'pipeline_run_log', 'length', x, (SELECT count(*) FROM orders WHERE x = 'dag_id') FROM unnest(['dag_id', 'task_id', 'status']) u(x)
  UNION ALL SELECT 'pipeline_run_log', 'unique', 'run_id', (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders)
  UNION ALL SELECT 'dq_check_results', 'not null', x, (SELECT count(*) FROM lineitem WHERE l_linenumber = 1 AND x = 'checked_at')
    FROM unnest(['check_name', 'status', 'checked_at']) u(x)
  UNION ALL SELECT 'dq_check_results', 'domain', 'status', (SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))
  UNION ALL SELECT 'dq_check_results', 'length', x, (SELECT count(*) FROM lineitem WHERE x = 'status' AND l_returnflag NOT IN ('A', 'N'))
    FROM unnest(['check_name', 'table_name', 'status']) u(x)
  UNION ALL SELECT 'dq_check_results', 'unique', 'id', (SELECT count(*) - count(DISTINCT l_orderkey) FROM lineitem)
  UNION ALL SELECT 'dq_check_results', 'foreign', 'run_id', (SELECT count(*) FROM lineitem
    WHERE l_linenumber >= 4 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders))
  UNION ALL SELECT 'quarantine_unmatched_city_names', 'not null', x, (SELECT count(*) FROM customer WHERE c_acctbal < 0 AND x = 'occurrence_count')
    FROM unnest(['raw_name', 'first_seen_at', 'last_seen_at', 'occurrence_count', 'resolved']) u(x)
  UNION ALL SELECT 'quarantine_unmatched_city_names', 'length', x, (SELECT count(*) FROM customer WHERE x = 'source') FROM unnest(['raw_name', 'source']) u(x)
  UNION ALL SELECT 'quarantine_unmatched_city_names', 'unique', 'id', 0
  UNION ALL SELECT 'quarantine_unmatched_city_names', 'unique', 'raw_name', (SELECT count(*) - count(DISTINCT c_mktsegment) FROM customer))
SELECT t AS table_name, kind, target, n AS violations FROM found
""",
    "dq_messages": """
WITH e AS (SELECT event_id, cast(props ->> '$.k' AS int) AS k, event_id % 201 AS n FROM events)
SELECT event_id, 'freshness' AS check_name, CASE WHEN k / 4.0 > 6 THEN 'fail' WHEN k / 4.0 > 4 THEN 'warn' ELSE 'pass' END AS status,
  'latest reading is ' || format('{:.1f}', k::DOUBLE / 4) || ' h old' AS details FROM e
UNION ALL
SELECT event_id, 'completeness', CASE WHEN n = 0 OR k::DOUBLE / n < 0.5 THEN 'fail' WHEN k::DOUBLE / n < 0.7 THEN 'warn' ELSE 'pass' END,
  CASE WHEN n = 0 THEN 'no active cities'
  ELSE k || ' of ' || n || ' cities have recent data (' || format('{:.0f}', k::DOUBLE / n * 100) || '%)' END FROM e
""",
    "cascade_refresh": """
WITH city AS (
  SELECT c_custkey AS id, c_mktsegment = 'BUILDING' AS has_alias, CASE WHEN c_acctbal >= 2000 THEN 'kept'
    WHEN c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error') THEN 'refused' ELSE 'deleted' END AS fate FROM customer),
run AS (SELECT o_orderkey AS id, if(o_orderstatus = 'F', 'deleted', 'kept') AS fate FROM orders),
rows AS (
  SELECT 'dim_city' AS table_name, id, fate FROM city UNION ALL SELECT 'dim_city', id, 'kept' FROM city WHERE fate = 'refused'
  UNION ALL SELECT 'dim_city_alias', id, if(fate = 'deleted', 'deleted', 'kept') FROM city WHERE has_alias
  UNION ALL SELECT 'pipeline_run_log', id, fate FROM run
  UNION ALL SELECT 'dq_check_results', l_partkey, fate FROM lineitem JOIN run ON id = l_orderkey)
SELECT t AS table_name, f AS fate, count(id) AS rows, coalesce(sum(id), 0)::BIGINT AS key_sum
FROM (SELECT unnest(['dim_city', 'dim_city_alias', 'pipeline_run_log', 'dq_check_results']) AS t) tables
CROSS JOIN (SELECT unnest(['kept', 'deleted', 'refused']) AS f) fates
LEFT JOIN rows ON table_name = t AND fate = f GROUP BY ALL
""",
    "dq_recorded_run": """
WITH e AS (SELECT *, cast(props ->> '$.k' AS int) AS k, least(floor(value), 400) AS aqi FROM events),
late AS (SELECT count(DISTINCT user_id) AS n FROM e WHERE ts >= (SELECT max(ts) FROM e) - INTERVAL 4 HOURS),
facts AS (
  SELECT (SELECT count(*) FROM e) AS n, (SELECT count(*) FROM e WHERE k = 0) AS zero,
    (SELECT count(*) FROM e WHERE k < 3) AS holes, (SELECT count(*) FROM e WHERE aqi - 30 > 60) AS warm,
    (SELECT count(DISTINCT c_mktsegment) FROM customer) AS names,
    (SELECT n FROM late) / (SELECT count(*) FROM customer) AS share),
checks AS (
  SELECT * FROM (VALUES (1, 'schema_presence', NULL), (2, 'freshness', 'fact_weather_reading'), (3, 'completeness', 'fact_weather_reading'),
    (4, 'null_critical_fields', NULL), (5, 'range_temperature', 'fact_weather_reading'), (6, 'range_humidity', 'fact_weather_reading'),
    (7, 'range_aqi', 'fact_air_quality_reading'), (8, 'row_count_sanity', NULL),
    (9, 'city_resolution', 'quarantine_unmatched_city_names'), (10, 'uniqueness', NULL)) t(no, name, table_name)),
results AS (
  SELECT run_id, no, name, table_name, CASE
    WHEN name = 'completeness' AND run_id = 2 THEN CASE WHEN share < 0.5 THEN 'fail' WHEN share < 0.7 THEN 'warn' ELSE 'pass' END
    WHEN name = 'null_critical_fields' AND run_id = 2 AND holes > 0 THEN 'fail'
    WHEN name = 'range_temperature' AND warm > 0 THEN 'warn'
    WHEN name = 'row_count_sanity' AND (run_id = 2 OR n < 10) THEN 'warn'
    WHEN name = 'city_resolution' AND names >= 10 THEN 'fail' WHEN name = 'city_resolution' AND names >= 3 THEN 'warn'
    ELSE 'pass' END AS status
  FROM checks, facts, (VALUES (1), (2)) r(run_id)),
judged AS (
  SELECT run_id, CASE WHEN count(*) FILTER (status = 'fail') > 0 THEN 'failure'
    WHEN count(*) FILTER (status = 'warn') > 0 THEN 'partial_success' ELSE 'success' END AS status,
    count(*) FILTER (status = 'fail') || ' checks failed: [' || string_agg('''' || name || '''', ', ' ORDER BY no) FILTER (status = 'fail') || ']' AS raised
  FROM results GROUP BY run_id)
SELECT run_id::BIGINT AS run_id, NULL::BIGINT AS result_id, 'readings/gate' AS name, NULL AS table_name, status,
  CASE run_id WHEN 1 THEN '2024-01-31' ELSE '2024-02-01' END AS logical_date,
  if(run_id = 1, 2 * n, 9) AS rows_extracted, if(run_id = 1, 2 * n, 9) AS rows_loaded, if(run_id = 1, zero, 0) AS rows_rejected,
  if(run_id = 1, (SELECT '["' || string_agg(n_name, '","' ORDER BY n_name) || '"]' FROM nation WHERE n_regionkey = 1), '[]') AS cities_failed,
  CASE WHEN status = 'failure' THEN raised END AS raised, true AS ended
FROM judged, facts
UNION ALL
SELECT run_id, (run_id - 1) * 10 + no, name, table_name, status, NULL, NULL, NULL, NULL, NULL, NULL, true FROM results
""",
    "names_resolved_and_stored": _BASE
    + """, told AS (
  SELECT *, raw_name LIKE 'Zone ERROR' OR raw_name LIKE 'Zone VIEW' OR trim(raw_name, ' ' || chr(9)) = '' AS blank,
    CASE WHEN raw_name IN ('Zone ERROR', 'Zone VIEW') THEN chr(160) ELSE raw_name END AS given FROM judged
), distinct_names AS (SELECT DISTINCT given, match_method, blank FROM told),
counts AS (
  SELECT count(*) FILTER (match_method = 'exact') AS e, count(*) FILTER (match_method = 'fuzzy') AS f,
    count(*) FILTER (match_method IS NULL AND NOT blank) AS q, count(*) FILTER (blank) AS b FROM distinct_names)
SELECT 'load 1' AS part, 'exact' AS item, e AS value FROM counts UNION ALL SELECT 'load 1', 'fuzzy', f FROM counts
UNION ALL SELECT 'load 1', 'quarantined', q FROM counts UNION ALL SELECT 'load 1', 'blank', b FROM counts
UNION ALL SELECT 'load 2', 'exact', e + f FROM counts UNION ALL SELECT 'load 2', 'fuzzy', 0
UNION ALL SELECT 'load 2', 'quarantined', q FROM counts UNION ALL SELECT 'load 2', 'blank', b FROM counts
UNION ALL SELECT 'alias manual', ' Old ' || w1 || ' ' || w2, city_id FROM named WHERE has_alias
UNION ALL SELECT DISTINCT 'alias fuzzy', raw_name, city_id FROM judged WHERE match_method = 'fuzzy'
UNION ALL SELECT 'quarantine', given, 2 * count(*) FROM told WHERE match_method IS NULL AND NOT blank GROUP BY given
""",
}
