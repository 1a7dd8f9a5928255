"""Bronze documents to typed readings.

Both parsers keep every document and say in ``parse_status`` what became of it:
one bad document never fails the job, and nothing disappears uncounted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import variant_doubles, variant_int
from ..functions.times import date_key, local_minute, local_second, offset_instant, zoned_instant
from ..schemas import POLLUTANTS
from .barrier import computed_once

OK = "ok"
#: What an air-quality attempt can come to.
API_STATUSES = [OK, "no_station", "no_data", "error"]
OBJECT = "map<string,variant>"

# Fact column -> name in the payload.
WEATHER_FIELDS = {
    "temperature_c": "temperature_2m",
    "humidity_pct": "relative_humidity_2m",
    "precipitation_mm": "precipitation",
    "pressure_hpa": "surface_pressure",
    "wind_speed_kmh": "wind_speed_10m",
}
DOMINANT_POLLUTANT_PATH = "$.data.dominentpol"
DEFAULT_ZONE = "UTC"
DEFAULT_OFFSET = "+00:00"


def _fields(document: Column, path: str, names: list[str], kind: str) -> Column:
    """The named fields of the object at ``path`` in one pass; null if there is no object."""
    return F.try_variant_get(document, path, f"struct<{', '.join(f'{name} {kind}' for name in names)}>")


def _is(value: Column, kind: str) -> Column:
    """Whether a variant is of a JSON kind; false where it is missing."""
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


def _text(value: Column) -> Column:
    """A variant's string; null for numbers, booleans and nulls."""
    return F.when(_is(value, "STRING"), F.try_variant_get(value, "$", "string"))


def _with_default(value: Column, default: str) -> Column:
    """A variant's string, or ``default`` if it is missing; null for any other value."""
    return F.when(value.isNull(), F.lit(default)).otherwise(_text(value))


def _has_index(index: Column) -> Column:
    """False where the index is missing, null or the dash of a silent station."""
    return ~(index.isNull() | _is(index, "VOID") | F.coalesce(_text(index) == "-", F.lit(False)))


def parse_weather(documents: DataFrame) -> DataFrame:
    """Weather documents to rows of the weather fact plus ``parse_status``.

    Times are local minutes in the named zone, UTC if the zone is unknown or
    missing. A zone that is there but no text, or empty, spoils the document. A
    measure that is missing or no number is null.
    """
    document = F.col("_document")
    opened = documents.withColumn("_document", F.try_parse_json("raw_response")).select(
        "city_id",
        "fetched_at",
        "_document",
        F.try_variant_get(document, "$.timezone", "variant").alias("_zone"),
        F.try_variant_get(document, "$.current", OBJECT).alias("_current"),
        _fields(document, "$.current", list(WEATHER_FIELDS.values()), "variant").alias("_measured"),
    )
    read = opened.select(
        "city_id",
        "fetched_at",
        document.isNotNull().alias("_readable"),
        F.coalesce(F.size("_current") > 0, F.lit(False)).alias("_has_current"),
        _with_default(F.col("_zone"), DEFAULT_ZONE).alias("_zone"),
        local_minute(_text(F.try_element_at("_current", F.lit("time")))).alias("_local"),
        variant_doubles([F.col(f"_measured.{source}") for source in WEATHER_FIELDS.values()]).alias("_numbers"),
    )
    status = (
        F.when(~F.col("_readable"), "unreadable")
        .when(~F.col("_has_current"), "no current block")
        .when(F.col("_local").isNull(), "bad time")
        .when(F.col("_zone").isNull() | (F.col("_zone") == ""), "bad zone")
        .when(F.col("city_id").isNull(), "no city")
        .otherwise(OK)
    )
    rows = read.select(
        "city_id",
        date_key(F.col("_local")).alias("date_key"),
        zoned_instant(F.col("_local"), "_zone").alias("reading_ts"),
        *[F.col("_numbers")[i].alias(name) for i, name in enumerate(WEATHER_FIELDS)],
        "fetched_at",
        status.alias("parse_status"),
    )
    return computed_once(rows)


def parse_air_quality(documents: DataFrame) -> DataFrame:
    """Air-quality documents to rows of the air-quality fact plus ``parse_status``.

    A pollutant that is missing is null; one that is there but no object spoils
    the document. An index that is no whole number is null here and rejected
    when required fields are checked.
    """
    document = F.col("_document")
    opened = documents.withColumn("_document", F.try_parse_json("raw_response")).select(
        "city_id",
        "fetched_at",
        "_document",
        F.try_variant_get(document, "$.status", "variant").alias("_status"),
        _fields(document, "$.data", ["aqi", "iaqi", "time"], "variant").alias("_data"),
        _fields(document, "$.data.time", ["s", "tz"], "variant").alias("_time"),
        _fields(document, "$.data.iaqi", POLLUTANTS, "variant").alias("_pollutants"),
        _fields(document, "$.data.iaqi", POLLUTANTS, "struct<v variant>").alias("_measured"),
    )
    parts = [F.col("_data.iaqi"), *[F.col(f"_pollutants.{name}") for name in POLLUTANTS]]
    clock = _text(F.col("_time.s"))
    read = opened.select(
        "city_id",
        "fetched_at",
        document.isNotNull().alias("_readable"),
        F.coalesce(_text(F.col("_status")) == OK, F.lit(False)).alias("_answered"),
        _has_index(F.col("_data.aqi")).alias("_has_index"),
        local_second(clock).alias("_local"),
        offset_instant(clock, _with_default(F.col("_time.tz"), DEFAULT_OFFSET)).alias("_instant"),
        F.greatest(*[part.isNotNull() & ~_is(part, "OBJECT") for part in parts]).alias("_spoilt"),
        variant_int(F.col("_data.aqi"), "$").alias("aqi_value"),
        variant_doubles([F.col(f"_measured.{name}.v") for name in POLLUTANTS]).alias("_numbers"),
        F.try_variant_get(document, DOMINANT_POLLUTANT_PATH, "string").alias("dominant_pollutant"),
    )
    status = (
        F.when(~F.col("_readable"), "unreadable")
        .when(~F.col("_answered"), "no station")
        .when(~F.col("_has_index"), "no data")
        .when(F.col("_instant").isNull(), "bad time")
        .when(F.col("_spoilt"), "bad pollutant")
        .when(F.col("city_id").isNull(), "no city")
        .otherwise(OK)
    )
    rows = read.select(
        "city_id",
        date_key(F.col("_local")).alias("date_key"),
        F.col("_instant").alias("reading_ts"),
        "aqi_value",
        *[F.col("_numbers")[i].alias(name) for i, name in enumerate(POLLUTANTS)],
        "dominant_pollutant",
        "fetched_at",
        status.alias("parse_status"),
    )
    return computed_once(rows)


def parsed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("parse_status") == OK).drop("parse_status")


def parse_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("parse_status").agg(F.count(F.lit(1)).alias("documents"))


def classify_attempts(attempts: DataFrame) -> DataFrame:
    """Add ``status`` and ``stored`` to landed air-quality attempts.

    ``raw_response`` is null where the request failed. error: no usable answer;
    no_station: any status but ok; no_data: no index value; ok: stored.
    """
    document = F.col("_document")
    opened = attempts.withColumn("_document", F.try_parse_json("raw_response")).withColumns(
        {
            "_status": F.try_variant_get(document, "$.status", "variant"),
            "_data": F.try_variant_get(document, "$.data", "variant"),
            "_index": F.try_variant_get(document, "$.data.aqi", "variant"),
        }
    )
    status = (
        F.when(~_is(document, "OBJECT"), "error")
        .when(~F.coalesce(_text(F.col("_status")) == OK, F.lit(False)), "no_station")
        .when(F.col("_data").isNotNull() & ~_is(F.col("_data"), "OBJECT"), "error")
        .when(~_has_index(F.col("_index")), "no_data")
        .otherwise(OK)
    )
    classified = opened.withColumn("status", status).drop("_document", "_status", "_data", "_index")
    return computed_once(classified).withColumn("stored", F.col("status") == OK)


def outcome_counts(classified: DataFrame) -> DataFrame:
    """One row: stored, without data (no station or no data), failed."""
    return classified.agg(
        F.count_if(F.col("stored")).alias("stored"),
        F.count_if(F.col("status").isin("no_station", "no_data")).alias("no_data"),
        F.count_if(F.col("status") == "error").alias("failed"),
    )
