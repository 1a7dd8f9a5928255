"""The ten data-quality checks.

Each check judges a few whole-number metrics. Metrics are computed in as few
passes as there are tables: one aggregate per fact reads all null, range, count
and freshness metrics, a second reads just the key columns for duplicates.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import fixed_text

WEATHER = "fact_weather_reading"
AIR_QUALITY = "fact_air_quality_reading"
CITIES = "dim_city"
QUARANTINE = "quarantine_unmatched_city_names"

# Thresholds, ranges and the columns that must be there.
FRESHNESS_WARN_HOURS = 4
FRESHNESS_FAIL_HOURS = 6
RECENT_HOURS = 4
MIN_CITIES_WARN = 0.70
MIN_CITIES_FAIL = 0.50
MIN_ROWS_PER_RUN = 10
QUARANTINE_WARN = 3
QUARANTINE_FAIL = 10
TEMPERATURE_RANGE = (-20, 60)
HUMIDITY_RANGE = (0, 100)
AQI_RANGE = (0, 500)
EXPECTED_COLUMNS = {
    WEATHER: [
        "reading_id", "city_id", "date_key", "reading_ts", "temperature_c", "humidity_pct",
        "precipitation_mm", "pressure_hpa", "wind_speed_kmh",
    ],
    AIR_QUALITY: [
        "reading_id", "city_id", "date_key", "reading_ts", "aqi_value", "pm25", "pm10", "no2", "so2", "co", "o3",
    ],
}
CRITICAL_COLUMNS = {
    WEATHER: ["city_id", "reading_ts", "date_key"],
    AIR_QUALITY: ["city_id", "reading_ts", "aqi_value"],
}

Metrics = Callable[[str], Column]


@dataclass(frozen=True)
class Check:
    """``judge`` maps metrics to (status, details, metric)."""

    name: str
    table: str | None
    needs: list[str]
    judge: Callable[[Metrics], tuple[Column, Column, Column]]


def _graded(fail: Column | None, warn: Column | None) -> Column:
    status = F.when(fail, "fail") if fail is not None else None
    if warn is not None:
        status = F.when(warn, "warn") if status is None else status.when(warn, "warn")
    return status.otherwise("pass")


def _judge_freshness(m: Metrics) -> tuple[Column, Column, Column]:
    hours = (m("as_of") - m("weather.latest")) / F.lit(3.6e9)
    empty = m("weather.latest").isNull()
    status = _graded(empty | (hours > FRESHNESS_FAIL_HOURS), hours > FRESHNESS_WARN_HOURS)
    details = F.when(empty, F.lit(f"{WEATHER} is empty")).otherwise(
        F.concat(F.lit("latest reading is "), fixed_text(hours, 1), F.lit(" h old"))
    )
    return status, details, hours


def _judge_completeness(m: Metrics) -> tuple[Column, Column, Column]:
    ratio = F.try_divide(m("weather.recent_cities"), m("cities.active"))
    none = m("cities.active") == 0
    status = _graded(none | (ratio < MIN_CITIES_FAIL), ratio < MIN_CITIES_WARN)
    details = F.when(none, F.lit("no active cities")).otherwise(
        F.concat(
            F.format_string("%d of %d cities have recent data (", m("weather.recent_cities"), m("cities.active")),
            fixed_text(ratio * 100, 0),
            F.lit("%)"),
        )
    )
    return status, details, ratio


def _judge_nulls(m: Metrics) -> tuple[Column, Column, Column]:
    counted = [(f"{table}.{column}", m(_null_metric(table, column)))
               for table, columns in CRITICAL_COLUMNS.items() for column in columns]
    total = sum((count for _, count in counted), F.lit(0))
    found = F.array_join(
        F.array_compact(
            F.array(*[F.when(count > 0, F.format_string("%s: %d", F.lit(name), count)) for name, count in counted])
        ),
        ", ",
    )
    return _graded(total > 0, None), F.when(total > 0, F.concat(F.lit("nulls in "), found)).otherwise(
        "no nulls in critical columns"
    ), total


def _judge_range(metric: str, bounds: tuple[int, int], severity: str) -> Callable:
    def judge(m: Metrics) -> tuple[Column, Column, Column]:
        bad = m(metric)
        status = _graded(bad > 0, None) if severity == "fail" else _graded(None, bad > 0)
        return status, F.format_string(f"%d readings outside [{bounds[0]}, {bounds[1]}]", bad), bad

    return judge


def _judge_row_counts(m: Metrics) -> tuple[Column, Column, Column]:
    weather, air = m("load.weather"), m("load.aqi")
    least = F.least(weather, air)
    details = F.format_string("weather: %d, air quality: %d rows loaded", weather, air)
    return _graded(None, least < MIN_ROWS_PER_RUN), details, least


def _judge_resolution(m: Metrics) -> tuple[Column, Column, Column]:
    open_names = m("quarantine.unresolved")
    status = _graded(open_names >= QUARANTINE_FAIL, open_names >= QUARANTINE_WARN)
    return status, F.format_string("%d unresolved city names", open_names), open_names


def _judge_uniqueness(m: Metrics) -> tuple[Column, Column, Column]:
    weather, air = m("weather.duplicates"), m("aqi.duplicates")
    details = F.format_string("surplus rows per key: weather %d, air quality %d", weather, air)
    return _graded(weather + air > 0, None), details, weather + air


def _judge_schema(m: Metrics) -> tuple[Column, Column, Column]:
    missing = m("schema.missing")
    return _graded(missing > 0, None), F.format_string("%d expected columns missing", missing), missing


def _null_metric(table: str, column: str) -> str:
    return f"{_short(table)}.null_{column}"


def _short(table: str) -> str:
    return {WEATHER: "weather", AIR_QUALITY: "aqi"}[table]


CHECKS = [
    Check("schema_presence", None, ["schema.missing"], _judge_schema),
    Check("freshness", WEATHER, ["weather.latest"], _judge_freshness),
    Check("completeness", WEATHER, ["weather.recent_cities", "cities.active"], _judge_completeness),
    Check(
        "null_critical_fields",
        None,
        [_null_metric(t, c) for t, columns in CRITICAL_COLUMNS.items() for c in columns],
        _judge_nulls,
    ),
    Check(
        "range_temperature", WEATHER, ["weather.bad_temperature"],
        _judge_range("weather.bad_temperature", TEMPERATURE_RANGE, "warn"),
    ),
    Check(
        "range_humidity", WEATHER, ["weather.bad_humidity"],
        _judge_range("weather.bad_humidity", HUMIDITY_RANGE, "fail"),
    ),
    Check("range_aqi", AIR_QUALITY, ["aqi.bad_aqi"], _judge_range("aqi.bad_aqi", AQI_RANGE, "fail")),
    Check("row_count_sanity", None, ["load.weather", "load.aqi"], _judge_row_counts),
    Check("city_resolution", QUARANTINE, ["quarantine.unresolved"], _judge_resolution),
    Check("uniqueness", None, ["weather.duplicates", "aqi.duplicates"], _judge_uniqueness),
]


def judgement(name: str, metrics: dict[str, Column]) -> tuple[Column, Column, Column]:
    """``(status, details, metric)`` of a check, from columns that hold its metrics."""
    check = next(check for check in CHECKS if check.name == name)
    return check.judge(lambda metric: metrics[metric])


def _outside(column: str, bounds: tuple[int, int]) -> Column:
    return F.count_if((F.col(column) < bounds[0]) | (F.col(column) > bounds[1]))


def _recent(df: DataFrame, since: Column) -> DataFrame:
    """Readings from ``since`` on. Stored facts are read from these days only."""
    recent = df.filter(F.col("reading_ts") >= since)
    return recent.filter(F.col("reading_day") >= since.cast("date")) if "reading_day" in df.columns else recent


def _profiles(as_of: Column) -> dict[str, list[tuple[Callable[[DataFrame], DataFrame], dict[str, Column]]]]:
    """Per table: (rows to aggregate, metrics over them)."""
    since = as_of - F.expr(f"INTERVAL {RECENT_HOURS} HOURS")

    def nulls(table: str) -> dict[str, Column]:
        return {_null_metric(table, c): F.count_if(F.col(c).isNull()) for c in CRITICAL_COLUMNS[table]}

    def same(df: DataFrame) -> DataFrame:
        return df

    def keys(df: DataFrame) -> DataFrame:
        return df.groupBy("city_id", "reading_ts").agg(F.count(F.lit(1)).alias("copies"))

    surplus = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))
    return {
        WEATHER: [
            (
                same,
                {
                    "weather.latest": F.unix_micros(F.max("reading_ts").cast("timestamp")),
                    **nulls(WEATHER),
                    "weather.bad_temperature": _outside("temperature_c", TEMPERATURE_RANGE),
                    "weather.bad_humidity": _outside("humidity_pct", HUMIDITY_RANGE),
                },
            ),
            (
                lambda df: _recent(df, since),
                {"weather.recent_cities": F.count_distinct("city_id")},
            ),
            (keys, {"weather.duplicates": surplus}),
        ],
        AIR_QUALITY: [
            (same, {**nulls(AIR_QUALITY), "aqi.bad_aqi": _outside("aqi_value", AQI_RANGE)}),
            (keys, {"aqi.duplicates": surplus}),
        ],
        CITIES: [(same, {"cities.active": F.count_if(F.col("is_active"))})],
        QUARANTINE: [(same, {"quarantine.unresolved": F.count_if(~F.col("resolved"))})],
    }


def measure(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    load_result: DataFrame | dict[str, int],
    as_of: Column,
    wanted: set[str],
    columns: dict[str, list[str]] | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """``(metrics, crashed)``: rows of (metric, value), and why the other metrics cannot be computed.

    Names are resolved when an aggregate is built, so a missing table or column
    surfaces here and takes down only the metrics that need it.
    """
    crashed: dict[str, str] = {}
    parts = [_literal(spark, {"schema.missing": len(missing_columns(tables, columns))})]
    for table, profiles in _profiles(as_of).items():
        for prepare, metrics in profiles:
            metrics = {name: column for name, column in metrics.items() if name in wanted}
            usable = {}
            for name, column in metrics.items():
                try:
                    prepare(tables[table]).agg(column)
                    usable[name] = column
                except (AnalysisException, KeyError) as error:
                    crashed[name] = str(error).splitlines()[0]
            if usable:
                parts.append(_as_rows(prepare(tables[table]).agg(*[c.alias(n) for n, c in usable.items()])))
    if isinstance(load_result, dict):
        load_result = spark.range(1).select(
            F.lit(load_result.get("weather_loaded", 0)).alias("weather_loaded"),
            F.lit(load_result.get("aqi_loaded", 0)).alias("aqi_loaded"),
        )
    if wanted & {"load.weather", "load.aqi"}:
        parts.append(
            _as_rows(load_result.select(F.col("weather_loaded").alias("load.weather"), F.col("aqi_loaded").alias("load.aqi")))
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows, crashed


def missing_columns(tables: dict[str, DataFrame], columns: dict[str, list[str]] | None = None) -> list[str]:
    """Expected columns that are absent, as table.column; ``columns`` tells those stored where frames show others."""
    actual = {table: set(df.columns) for table, df in tables.items()} | {t: set(c) for t, c in (columns or {}).items()}
    return [
        f"{table}.{column}"
        for table, columns in EXPECTED_COLUMNS.items()
        for column in columns
        if column not in actual.get(table, set())
    ]


def _as_rows(single: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("bigint").alias("value")) for n in single.columns]
    return single.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")


def _literal(spark: SparkSession, values: dict[str, int]) -> DataFrame:
    return _as_rows(spark.range(1).select(*[F.lit(v).cast("bigint").alias(n) for n, v in values.items()]))


def evaluate(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    load_result: DataFrame | dict[str, int],
    as_of: Column | None = None,
    checks: list[Check] | None = None,
    columns: dict[str, list[str]] | None = None,
) -> DataFrame:
    """One row per check: check_no, check_name, table_name, status, details, metric.

    ``load_result`` holds weather_loaded and aqi_loaded, as numbers or as one
    row. ``columns`` names the stored columns of tables whose frames show their whole schema.
    A check that cannot be computed counts as failed; the others go on.
    """
    checks = CHECKS if checks is None else checks
    as_of = F.current_timestamp() if as_of is None else as_of
    wanted = {need for check in checks for need in check.needs}
    metrics, crashed = measure(spark, tables, load_result, as_of, wanted, columns)
    # One row per metric, so this last aggregate handles a few dozen rows.
    names = sorted(wanted - set(crashed))
    wide = metrics.groupBy().agg(
        F.unix_micros(as_of.cast("timestamp")).alias("as_of"),
        *[F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name) for name in names],
    )

    def metric(name: str) -> Column:
        return F.col(f"`{name}`")

    rows = []
    for number, check in enumerate(checks, start=1):
        broken = [crashed[need] for need in check.needs if need in crashed]
        if broken:
            status, details, value = F.lit("fail"), F.lit(f"check crashed: {broken[0]}"), F.lit(None)
        else:
            status, details, value = check.judge(metric)
            if check.name == "schema_presence" and (missing := missing_columns(tables, columns)):
                details = F.lit(f"missing columns: {missing}")
        rows.append(
            F.struct(
                F.lit(number).alias("check_no"),
                F.lit(check.name).alias("check_name"),
                F.lit(check.table).cast("string").alias("table_name"),
                status.alias("status"),
                details.alias("details"),
                value.cast("double").alias("metric"),
            )
        )
    return wide.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def trend(results: DataFrame, as_of: Column | None = None, days: int = 30) -> DataFrame:
    """Results of the last ``days`` counted per check and status."""
    as_of = F.current_timestamp() if as_of is None else as_of
    recent = results.filter(F.col("checked_at") >= as_of - F.expr(f"INTERVAL {days} DAYS"))
    return recent.groupBy("check_name", "status").agg(F.count(F.lit(1)).alias("results"))
