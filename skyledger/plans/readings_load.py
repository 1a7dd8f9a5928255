"""Landed responses to bronze documents to facts."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.errors import PySparkValueError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.constraints import ConstraintViolation, fit, mark_orphans, mark_violations
from ..operators.dimension import active_cities
from ..operators.parse import API_STATUSES, OK, classify_attempts, parse_air_quality, parse_weather
from ..schemas import AIR_QUALITY_REQUIRED, FACT_AIR_QUALITY, FACT_WEATHER, TABLE_RULES, WEATHER_REQUIRED
from ..sources.landed import pair_batches, to_bronze
from ..sources.tables import Warehouse

# What the bronze zone calls its two sources.
WEATHER_API = "open_meteo"
AIR_QUALITY_API = "waqi"


class NoActiveCities(PySparkValueError):
    """There is nothing to fetch readings for."""


@dataclass(frozen=True)
class FactLoad:
    """What became of a batch: rows loaded, rows rejected for a constraint, documents that could not be parsed.

    The three add up to the documents given. ``rejects`` and ``spoilt`` are read
    from the warehouse, where they stay under the batch's name.
    """

    loaded: int
    rejected: int
    spoilt: int
    rejects: DataFrame
    spoilt_documents: DataFrame


def cities_to_fetch(warehouse: Warehouse) -> DataFrame:
    cities = active_cities(warehouse.read("dim_city"))
    if cities.isEmpty():
        raise NoActiveCities("the city dimension has no active cities; load it first")
    return cities


def store_weather(warehouse: Warehouse, requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Pair landed batches with their cities and store them; returns the rejected requests.

    ``requests``: batch_id, pos, city_id, city_name; ``responses``: batch_id,
    body, fetched_at, run_id.
    """
    paired, rejected = pair_batches(requests, responses)
    documents = to_bronze(paired.withColumn("source_api", F.lit(WEATHER_API)))
    with warehouse.scratch() as stage:
        warehouse.merge_bronze(stage(documents, "weather_documents"))
    return rejected


def store_air_quality(warehouse: Warehouse, attempts: DataFrame) -> dict[str, int]:
    """Store the usable answers among landed attempts; returns how many there were of each status.

    The counts are taken while the attempts are written.
    """
    counts = Observation()
    judged = classify_attempts(attempts)
    status = F.col("status")
    judged = judged.observe(counts, *[F.count_if(status == s).alias(s) for s in API_STATUSES])
    with warehouse.scratch() as stage:
        classified = stage(judged, "attempts")
        documents = to_bronze(classified.filter("stored").withColumn("source_api", F.lit(AIR_QUALITY_API)))
        warehouse.merge_bronze(documents)
    return counts.get


def load_weather(warehouse: Warehouse, run_id: str, on_violation: str = "quarantine") -> FactLoad:
    documents = warehouse.run_documents(WEATHER_API, run_id)
    return load_rows(warehouse, "fact_weather_reading", parse_weather(documents), run_id, on_violation=on_violation)


def load_air_quality(warehouse: Warehouse, run_id: str, on_violation: str = "quarantine") -> FactLoad:
    documents = warehouse.run_documents(AIR_QUALITY_API, run_id)
    return load_rows(warehouse, "fact_air_quality_reading", parse_air_quality(documents), run_id, on_violation=on_violation)


_FACTS = {
    "fact_weather_reading": (FACT_WEATHER, WEATHER_REQUIRED),
    "fact_air_quality_reading": (FACT_AIR_QUALITY, AIR_QUALITY_REQUIRED),
}


def load_rows(
    warehouse: Warehouse,
    table: str,
    rows: DataFrame,
    batch: str | None = None,
    check_foreign: bool = True,
    on_violation: str = "quarantine",
) -> FactLoad:
    """Validate parsed rows and merge them into ``table``.

    ``rows`` may have a ``parse_status``; those that are not ok count as spoilt.
    ``loaded`` counts valid rows given, before equal keys collapse; rejects list
    as ``violations`` what is missing, does not fit, or is an unknown city or day.
    Both are stored under ``batch``, in place of what a batch of that name left before.
    With ``on_violation="fail"`` a violation raises, and nothing is stored.
    """
    schema, required = _FACTS[table]
    rules = TABLE_RULES[table]
    strict = replace(rules, not_null=list(dict.fromkeys([*required, *rules.not_null])))
    if "parse_status" not in rows.columns:
        rows = rows.withColumn("parse_status", F.lit(OK))
    marked = mark_violations(rows, schema, strict)
    if check_foreign:
        for column, (parent, parent_column) in rules.foreign.items():
            marked = mark_orphans(marked, column, warehouse.read(parent), parent_column)
    batch = batch or uuid.uuid4().hex
    parsed = F.col("parse_status") == OK
    valid, broken = parsed & (F.size("violations") == 0), parsed & (F.size("violations") > 0)
    counts = Observation()
    marked = marked.observe(
        counts,
        F.count_if(valid).alias("loaded"), F.count_if(broken).alias("rejected"), F.count_if(~parsed).alias("spoilt"),
    )
    with warehouse.scratch() as stage:
        # The counts are taken while this is written; read for the merge and for the rejects.
        staged = stage(marked, f"{table}_rows")
        loaded, rejected, spoilt = (counts.get[name] for name in ("loaded", "rejected", "spoilt"))
        if on_violation == "fail" and rejected:
            raise ConstraintViolation(f"rows violate {staged.filter(broken).first().violations}")
        if loaded:
            warehouse.merge_facts(table, fit(staged.filter(valid).drop("violations", "parse_status"), schema))
        kind = F.when(parsed, "rejected").otherwise("spoilt")
        why = F.when(parsed, F.col("violations")).otherwise(F.array("parse_status"))
        lost = staged.filter(~valid).withColumns({"kind": kind, "violations": why}).drop("parse_status")
        if rejected or spoilt or warehouse.has_rejects(table, batch):
            warehouse.store_rejects(table, batch, lost)
    kept = warehouse.rejects(table, batch)
    return FactLoad(
        loaded, rejected, spoilt, kept.filter("kind = 'rejected'"), kept.filter("kind = 'spoilt'")
    )


def load_result(weather: FactLoad, air_quality: FactLoad) -> dict[str, int]:
    """The counts the quality gate looks at."""
    return {
        "weather_loaded": weather.loaded,
        "weather_rejected": weather.rejected + weather.spoilt,
        "aqi_loaded": air_quality.loaded,
        "aqi_rejected": air_quality.rejected + air_quality.spoilt,
    }
