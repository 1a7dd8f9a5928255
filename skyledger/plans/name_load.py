"""Names to cities, with what is learned and what stays open stored in the warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..operators.dimension import merge_aliases
from ..operators.resolve import merge_quarantine, resolve_names
from ..sources.tables import Warehouse


@dataclass(frozen=True)
class NameLoad:
    """Distinct names given, by what became of them; blank names are neither resolved nor quarantined."""

    exact: int
    fuzzy: int
    quarantined: int
    blank: int


def resolve_and_store(warehouse: Warehouse, raw: DataFrame, now: Column | None = None) -> NameLoad:
    """Resolve the column ``raw_name``; store fuzzy matches as aliases and unmatched names in the quarantine.

    A name that matched fuzzily resolves exactly from then on. Giving names
    again counts them again in the quarantine and changes nothing else.
    """
    cities, aliases = warehouse.read("dim_city"), warehouse.read("dim_city_alias")
    with warehouse.scratch() as stage:
        found = resolve_names(raw, cities, aliases, stage)
        names = stage(found.names, "resolved_names")
        method = F.col("match_method")
        open_names = F.col("city_id").isNull() & ~is_blank(F.col("raw_name"))
        counts = names.agg(
            F.count_if(method == "exact").alias("exact"),
            F.count_if(method == "fuzzy").alias("fuzzy"),
            F.count_if(open_names).alias("quarantined"),
            F.count(F.lit(1)).alias("all"),
        ).first()
        if counts.fuzzy:
            warehouse.replace("dim_city_alias", merge_aliases(aliases, found.new_aliases, ["raw_alias"], now))
        if counts.quarantined:
            unmatched = names.filter(open_names).select("raw_name", "occurrences")
            old = warehouse.read("quarantine_unmatched_city_names")
            warehouse.replace("quarantine_unmatched_city_names", merge_quarantine(old, unmatched, now))
    blank = counts["all"] - counts.exact - counts.fuzzy - counts.quarantined
    return NameLoad(counts.exact, counts.fuzzy, counts.quarantined, blank)
