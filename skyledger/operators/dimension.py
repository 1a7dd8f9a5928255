"""Upserts of the city dimension and its aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DIM_CITY, DIM_CITY_ALIAS
from .merge import insert_absent
from .numbering import highest, number_rows

CITY_KEY = ["city_name", "state"]
_REFRESHED = ["latitude", "longitude", "tier", "population"]


def merge_cities(old: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """Upsert cleaned cities on (city_name, state).

    Known cities get new coordinates, tier, population and ``updated_at``; they
    keep number, activity and ``created_at``. New ones are active and get the
    next numbers. Cities absent from ``new`` stay as they are.
    """
    now = F.current_timestamp() if now is None else now
    incoming = new.select(
        *CITY_KEY,
        *[F.col(c).cast(DIM_CITY[c].dataType).alias(f"new_{c}") for c in _REFRESHED],
        F.lit(True).alias("_given"),
    )
    joined = old.join(incoming, CITY_KEY, "full_outer")
    given, known = F.col("_given").isNotNull(), F.col("city_id").isNotNull()
    merged = joined.select(
        "city_id",
        *CITY_KEY,
        *[F.when(given, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in _REFRESHED],
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        F.coalesce("created_at", now).alias("created_at"),
        F.when(given, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    fresh = number_rows(merged.filter(~known).drop("city_id"), "city_id", CITY_KEY, highest(old, "city_id"))
    return _shaped(merged.filter(known).unionByName(fresh), DIM_CITY)


def city_ids_by_name(dim_city: DataFrame) -> DataFrame:
    """(city_name, city_id) of active cities; the lowest number where states share a name."""
    return active(dim_city).groupBy("city_name").agg(F.min("city_id").alias("city_id"))


def active(dim_city: DataFrame) -> DataFrame:
    return dim_city.filter(F.col("is_active"))


def active_cities(dim_city: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The cities to fetch readings for, by number."""
    return active(dim_city).select(*(columns or ["city_id", "city_name", "latitude", "longitude"])).orderBy("city_id")


def seed_aliases(seeds: DataFrame, dim_city: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(attempted, unknown)``: seeds whose canonical name is an active city, and the others.

    ``attempted`` counts repeated seeds; ``merge_aliases`` inserts each alias once.
    """
    by_name = city_ids_by_name(dim_city).withColumnsRenamed(
        {"city_name": "canonical", "city_id": "canonical_city_id"}
    )
    matched = seeds.join(by_name, "canonical", "left")
    found = F.col("canonical_city_id").isNotNull()
    return matched.filter(found), matched.filter(~found).drop("canonical_city_id")


def merge_aliases(old: DataFrame, new: DataFrame, order: list[str], now: Column | None = None) -> DataFrame:
    """Insert aliases that are not there yet; an existing one, perhaps set by hand, is never changed."""
    now = F.current_timestamp() if now is None else now
    candidates = new.select(*dict.fromkeys(["raw_alias", *order, "canonical_city_id", "match_method"]))
    absent = insert_absent(old, candidates, ["raw_alias"], order)
    fresh = number_rows(absent, "alias_id", ["raw_alias"], highest(old, "alias_id")).withColumn("created_at", now)
    return _shaped(old.select(*DIM_CITY_ALIAS.fieldNames()).unionByName(_shaped(fresh, DIM_CITY_ALIAS)), DIM_CITY_ALIAS)


def _shaped(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
