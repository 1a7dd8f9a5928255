"""City file to city dimension and aliases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.calendar import date_spine
from ..operators.clean import clean_cities
from ..operators.dimension import merge_aliases, merge_cities, seed_aliases
from ..operators.merge import insert_absent
from ..schemas import DIM_CITY, TABLE_RULES
from ..operators.constraints import conform
from ..sources.city_csv import read_city_csv
from ..sources.tables import Warehouse


@dataclass(frozen=True)
class DimensionLoad:
    """``aliases_seeded`` counts seeds with a known city, repeats included."""

    cities: int
    aliases_seeded: int
    rejects: DataFrame
    too_wide: DataFrame
    unknown_seeds: DataFrame


def load_dimension(warehouse: Warehouse, csv_path: str, now: Column | None = None) -> DimensionLoad:
    """Run the whole dimension flow; running it twice changes only ``updated_at``."""
    raw, too_wide = read_city_csv(warehouse.spark, csv_path)
    cleaned = clean_cities(raw)
    cities, misfits = conform(cleaned.cities, DIM_CITY, TABLE_RULES["dim_city"])
    loaded, seeded = Observation(), Observation()
    with warehouse.scratch() as stage:
        cities = stage(cities.observe(loaded, F.count(F.lit(1)).alias("rows")), "clean_cities")
        warehouse.replace("dim_city", merge_cities(warehouse.read("dim_city"), cities, now))
        attempted, _ = seed_aliases(cleaned.alias_seeds, warehouse.read("dim_city"))
        attempted = stage(attempted.observe(seeded, F.count(F.lit(1)).alias("rows")), "alias_seeds")
        merged = merge_aliases(warehouse.read("dim_city_alias"), attempted, ["ingest_seq"], now)
        warehouse.replace("dim_city_alias", merged)
    _, unknown = seed_aliases(cleaned.alias_seeds, warehouse.read("dim_city"))
    return DimensionLoad(
        cities=loaded.get["rows"],
        aliases_seeded=seeded.get["rows"],
        rejects=cleaned.rejects.unionByName(misfits, allowMissingColumns=True),
        too_wide=too_wide,
        unknown_seeds=unknown,
    )


def load_calendar(warehouse: Warehouse) -> None:
    """Fill the date dimension with days it lacks."""
    old = warehouse.read("dim_date")
    missing = insert_absent(old, date_spine(warehouse.spark), ["date_key"], ["full_date"])
    warehouse.replace("dim_date", old.unionByName(missing))
