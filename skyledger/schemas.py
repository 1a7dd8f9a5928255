"""Schemas, keys and constraints of the warehouse tables, all explicit."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INT, BIG, SMALL = T.IntegerType(), T.LongType(), T.ShortType()
TEXT, TEXTS, FLAG = T.StringType(), T.ArrayType(T.StringType()), T.BooleanType()
INSTANT, DAY = T.TimestampType(), T.DateType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CITY_CSV_COLUMNS = ["city_name", "state", "latitude", "longitude", "tier", "population"]

# The warehouse's tables, columns and types.
DIM_CITY = _table(
    city_id=INT, city_name=TEXT, state=TEXT, latitude=T.DecimalType(9, 6), longitude=T.DecimalType(9, 6),
    tier=SMALL, population=BIG, is_active=FLAG, created_at=INSTANT, updated_at=INSTANT,
)
DIM_CITY_ALIAS = _table(
    alias_id=INT, raw_alias=TEXT, canonical_city_id=INT, match_method=TEXT, created_at=INSTANT,
)
DIM_DATE = _table(
    date_key=INT, full_date=DAY, day_of_week=SMALL, day_name=TEXT, day_of_month=SMALL, day_of_year=SMALL,
    week_of_year=SMALL, month=SMALL, month_name=TEXT, quarter=SMALL, year=SMALL, is_weekend=FLAG,
)
FACT_WEATHER = _table(
    reading_id=BIG, city_id=INT, date_key=INT, reading_ts=INSTANT, temperature_c=T.DecimalType(5, 2),
    humidity_pct=T.DecimalType(5, 2), precipitation_mm=T.DecimalType(7, 2),
    pressure_hpa=T.DecimalType(7, 2), wind_speed_kmh=T.DecimalType(6, 2), fetched_at=INSTANT,
)
FACT_AIR_QUALITY = _table(
    reading_id=BIG, city_id=INT, date_key=INT, reading_ts=INSTANT, aqi_value=SMALL,
    pm25=T.DecimalType(7, 2), pm10=T.DecimalType(7, 2), no2=T.DecimalType(7, 2), so2=T.DecimalType(7, 2),
    co=T.DecimalType(7, 2), o3=T.DecimalType(7, 2), dominant_pollutant=TEXT, fetched_at=INSTANT,
)
RUN_LOG = _table(
    run_id=BIG, dag_id=TEXT, task_id=TEXT, logical_date=DAY, started_at=INSTANT, ended_at=INSTANT,
    status=TEXT, rows_extracted=BIG, rows_loaded=BIG, rows_rejected=BIG, cities_failed=TEXTS,
    error_message=TEXT,
)
DQ_RESULTS = _table(
    id=BIG, run_id=BIG, check_name=TEXT, table_name=TEXT, status=TEXT, details=TEXT, checked_at=INSTANT,
)
QUARANTINE = _table(
    id=BIG, raw_name=TEXT, source=TEXT, first_seen_at=INSTANT, last_seen_at=INSTANT, occurrence_count=BIG,
    resolved=FLAG,
)
BRONZE = _table(
    city_id=INT, city_name=TEXT, fetched_at=INSTANT, fetched_hour=INSTANT, source_api=TEXT, run_id=TEXT,
    raw_response=TEXT,
)

#: Which days a run has fetched documents of.
BRONZE_RUNS = _table(source_api=TEXT, run_id=TEXT, fetched_day=DAY)
#: What a batch could not load: rows that break constraints, and documents that cannot be parsed.
LOAD_REJECTS = _table(fact=TEXT, batch=TEXT, kind=TEXT, violations=TEXTS, document=TEXT)

READING_KEY = ["city_id", "reading_ts"]
WEATHER_MEASURES = [
    "temperature_c", "humidity_pct", "precipitation_mm", "pressure_hpa", "wind_speed_kmh", "fetched_at",
]
POLLUTANTS = ["pm25", "pm10", "no2", "so2", "co", "o3"]
AIR_QUALITY_MEASURES = ["aqi_value", *POLLUTANTS, "dominant_pollutant", "fetched_at"]
WEATHER_REQUIRED = ["city_id", "date_key", "reading_ts"]
AIR_QUALITY_REQUIRED = ["city_id", "date_key", "reading_ts", "aqi_value"]


@dataclass(frozen=True)
class Rules:
    """The constraints of one table, as data for ``operators.constraints``."""

    not_null: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    # column -> (parent table, parent column)
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    # foreign columns whose rows go with their parent; the others keep it from being deleted
    cascades: list[str] = field(default_factory=list)
    domain: dict[str, list] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)


# The constraints of the warehouse schema.
TABLE_RULES: dict[str, Rules] = {
    "dim_city": Rules(
        not_null=["city_name", "state", "latitude", "longitude", "is_active"],
        unique=[["city_id"], ["city_name", "state"]],
        domain={"tier": [1, 2, 3]},
        max_length={"city_name": 100, "state": 100},
    ),
    "dim_city_alias": Rules(
        not_null=["raw_alias", "canonical_city_id", "match_method"],
        unique=[["alias_id"], ["raw_alias"]],
        foreign={"canonical_city_id": ("dim_city", "city_id")},
        cascades=["canonical_city_id"],
        domain={"match_method": ["exact", "fuzzy", "manual"]},
        max_length={"raw_alias": 200, "match_method": 20},
    ),
    "dim_date": Rules(
        not_null=DIM_DATE.fieldNames(),
        unique=[["date_key"], ["full_date"]],
        domain={"quarter": [1, 2, 3, 4]},
        max_length={"day_name": 9, "month_name": 9},
    ),
    "fact_weather_reading": Rules(
        not_null=["city_id", "date_key", "reading_ts", "fetched_at"],
        unique=[["reading_id"], READING_KEY],
        foreign={"city_id": ("dim_city", "city_id"), "date_key": ("dim_date", "date_key")},
    ),
    "fact_air_quality_reading": Rules(
        not_null=["city_id", "date_key", "reading_ts", "fetched_at"],
        unique=[["reading_id"], READING_KEY],
        foreign={"city_id": ("dim_city", "city_id"), "date_key": ("dim_date", "date_key")},
        max_length={"dominant_pollutant": 10},
    ),
    "pipeline_run_log": Rules(
        not_null=["dag_id", "task_id", "logical_date", "status"],
        unique=[["run_id"]],
        max_length={"dag_id": 250, "task_id": 250, "status": 20},
    ),
    "dq_check_results": Rules(
        not_null=["check_name", "status", "checked_at"],
        unique=[["id"]],
        foreign={"run_id": ("pipeline_run_log", "run_id")},
        cascades=["run_id"],
        domain={"status": ["pass", "warn", "fail"]},
        max_length={"check_name": 100, "table_name": 100, "status": 10},
    ),
    "quarantine_unmatched_city_names": Rules(
        not_null=["raw_name", "first_seen_at", "last_seen_at", "occurrence_count", "resolved"],
        unique=[["id"], ["raw_name"]],
        max_length={"raw_name": 200, "source": 50},
    ),
}
