"""Cleaning of the city file: strip, title case, rename, coerce, drop, de-duplicate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import integral, text_to_double
from ..functions.text import is_blank, strip, title_case
from ..schemas import CITY_CSV_COLUMNS
from .barrier import computed_once
from .merge import latest_per_key

# Former city names, in lower case, and what they are called now.
HISTORICAL_NAMES = {
    "bombay": "Mumbai",
    "calcutta": "Kolkata",
    "madras": "Chennai",
    "poona": "Pune",
    "trivandrum": "Thiruvananthapuram",
    "gurgaon": "Gurugram",
    "bangalore": "Bengaluru",
    "mysore": "Mysuru",
    "baroda": "Vadodara",
    "cuttack": "Bhubaneswar",
}
TIERS = [1, 2, 3]


@dataclass(frozen=True)
class CleanCities:
    """``cities`` are ready for the dimension, ``alias_seeds`` for the aliases;
    ``rejects`` carry a ``reason``."""

    cities: DataFrame
    alias_seeds: DataFrame
    rejects: DataFrame


def clean_cities(raw: DataFrame, renames: dict[str, str] | None = None) -> CleanCities:
    """Clean all-text rows that have an ``ingest_seq``.

    Renaming precedes de-duplication, so a former and a current name fall
    together, and the later row of a (city_name, state) wins. Seeds come from
    every renamed row, also from rows dropped afterwards.
    """
    named = rename_historical(title_names(strip_all(raw)), HISTORICAL_NAMES if renames is None else renames)
    judged = computed_once(reject_reason(coerce_numbers(named)))
    valid = judged.filter(F.col("reason").isNull()).select("ingest_seq", *CITY_CSV_COLUMNS)
    return CleanCities(
        cities=keep_last(valid),
        alias_seeds=alias_seeds(named),
        rejects=judged.filter(F.col("reason").isNotNull()).select("ingest_seq", *CITY_CSV_COLUMNS, "reason"),
    )


def strip_all(raw: DataFrame) -> DataFrame:
    return raw.select("ingest_seq", *[strip(F.col(c)).alias(c) for c in CITY_CSV_COLUMNS])


def title_names(df: DataFrame) -> DataFrame:
    return df.withColumns({c: title_case(F.col(c)) for c in ("city_name", "state")})


def rename_historical(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Replace former names; ``raw_alias`` keeps the former one where there was one."""
    known = F.create_map(*[F.lit(text) for pair in renames.items() for text in pair])
    current = F.try_element_at(known, F.lower("city_name"))
    return df.withColumns(
        {
            "raw_alias": F.when(current.isNotNull(), F.col("city_name")),
            "city_name": F.coalesce(current, F.col("city_name")),
        }
    )


def alias_seeds(renamed: DataFrame) -> DataFrame:
    """One seed per renamed row."""
    return renamed.filter(F.col("raw_alias").isNotNull()).select(
        "ingest_seq", "raw_alias", F.col("city_name").alias("canonical"), F.lit("exact").alias("match_method")
    )


def coerce_numbers(df: DataFrame) -> DataFrame:
    """Text to numbers; what does not parse becomes null.

    "2857.000" is a whole population. A population with a fraction has no whole
    value: ``fractional`` marks it for rejection.
    """
    population = plain_number(F.col("population"))
    whole = F.coalesce(F.col("population").try_cast("bigint"), integral(population))
    tier = plain_number(F.col("tier"))
    return df.withColumns(
        {
            "latitude": plain_number(F.col("latitude")),
            "longitude": plain_number(F.col("longitude")),
            "tier": F.when(tier.isin(TIERS), tier.cast("smallint")),
            "population": whole,
            "fractional": population.isNotNull() & whole.isNull(),
        }
    )


def plain_number(text: Column) -> Column:
    return F.when(~F.contains(text, F.lit("_")), text_to_double(text))


def reject_reason(df: DataFrame) -> DataFrame:
    """``reason`` says why a row cannot become a city, null if it can; bounds are inclusive."""
    reason = (
        F.when(is_blank(F.col("city_name")), "no city name")
        .when(F.col("latitude").isNull() | F.col("longitude").isNull(), "no coordinates")
        .when(~F.col("latitude").between(-90, 90), "latitude out of range")
        .when(~F.col("longitude").between(-180, 180), "longitude out of range")
        .when(F.col("fractional"), "fractional population")
    )
    return df.withColumn("reason", reason)


def keep_last(valid: DataFrame) -> DataFrame:
    return latest_per_key(valid, ["city_name", "state"], ["ingest_seq"]).select("ingest_seq", *CITY_CSV_COLUMNS)
