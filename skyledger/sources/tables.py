"""The stored warehouse: Parquet tables with explicit schemas, in Spark's catalog.

Readings are stored by ``reading_day``, the UTC day of ``reading_ts``. The day
follows from the merge key, unlike ``date_key``, which is local and keeps its
first value; so a reading of a later load meets the earlier ones in its own partition.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.merge import latest_per_key, reading_id, upsert
from ..session import use_utc
from .catalog import MOST_LOADS, Catalog, Runs
from .landed import run_documents

READING_DAY = "reading_day"
FETCHED_DAY = "fetched_day"

SCHEMAS: dict[str, T.StructType] = {
    "dim_city": schemas.DIM_CITY,
    "dim_city_alias": schemas.DIM_CITY_ALIAS,
    "dim_date": schemas.DIM_DATE,
    "fact_weather_reading": schemas.FACT_WEATHER,
    "fact_air_quality_reading": schemas.FACT_AIR_QUALITY,
    "pipeline_run_log": schemas.RUN_LOG,
    "dq_check_results": schemas.DQ_RESULTS,
    "quarantine_unmatched_city_names": schemas.QUARANTINE,
    "bronze": schemas.BRONZE,
    "bronze_runs": schemas.BRONZE_RUNS,
    "load_rejects": schemas.LOAD_REJECTS,
}
#: Files that a load makes for a day; more spread larger days over more tasks.
BUCKETS = 4


def _fact(schema: T.StructType) -> Runs:
    by_day = T.StructType(list(schema)).add(READING_DAY, T.DateType())
    return Runs(by_day, [READING_DAY], schemas.READING_KEY, ["reading_id", "date_key"], BUCKETS)


#: Tables to which each load adds its own rows.
RUNS: dict[str, Runs] = {
    "fact_weather_reading": _fact(schemas.FACT_WEATHER),
    "fact_air_quality_reading": _fact(schemas.FACT_AIR_QUALITY),
    "bronze": Runs(
        T.StructType(list(schemas.BRONZE)).add(FETCHED_DAY, T.DateType()),
        ["source_api", FETCHED_DAY], ["source_api", "city_id", "fetched_hour"], [], BUCKETS,
    ),
    "load_rejects": Runs(schemas.LOAD_REJECTS, ["fact", "batch"], []),
}
#: Tables of records and what locates them.
RECORDS: dict[str, list[str]] = {
    "pipeline_run_log": ["run_id"],
    "dq_check_results": ["run_id"],
    "bronze_runs": ["source_api"],
}
MEASURES = {
    "fact_weather_reading": schemas.WEATHER_MEASURES,
    "fact_air_quality_reading": schemas.AIR_QUALITY_MEASURES,
}


def utc_day(ts: str) -> Column:
    return F.col(ts).cast("date")


def batch_name(batch: str) -> str:
    """``batch`` as part of a path."""
    return re.sub(r"[^A-Za-z0-9_.-]", "-", batch)


class Warehouse:
    """Tables below one folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")
        self.catalog = Catalog(self.spark, self.root)

    def read(self, table: str) -> DataFrame:
        """The table with every column of its schema, null where stored rows lack it; empty if never written."""
        schema = RUNS[table].schema if table in RUNS else SCHEMAS[table]
        found = self.catalog.read(table)
        if found is None:
            return self.spark.createDataFrame([], schema)
        return found.select(
            *[(F.col(f.name) if f.name in found.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
        )

    def stored_columns(self, table: str) -> list[str]:
        """The columns that the catalog lists, none if the table has not been written yet."""
        if not self.catalog.exists(table):
            return []
        return [c.name for c in self.spark.catalog.listColumns(self.catalog.name(table))]

    def record(self, table: str, df: DataFrame, replace: bool = True) -> None:
        """Add records; with ``replace`` those of the same run that are there already give way."""
        self.catalog.record(table, self._shaped(table, df), RECORDS[table], replace)

    def replace(self, table: str, df: DataFrame) -> None:
        """Replace a small table, also by rows computed from it."""
        self.catalog.replace(table, self._shaped(table, df))

    def scratch(self) -> AbstractContextManager[Callable[[DataFrame, str], DataFrame]]:
        """A function that stores a frame, cuts its lineage and gives it back, for as long as a block runs."""
        return self.catalog.scratch()

    def merge_facts(self, table: str, new: DataFrame, order: list[str] | None = None) -> None:
        """Upsert readings into a fact: their own rows are written, once for each key, and nothing else.

        Of rows with one key the last by ``order`` updates, and the first gives the
        date key.
        """
        order = order or ["fetched_at"]
        measures = MEASURES[table]
        incoming = new.select(
            *schemas.READING_KEY, "date_key",
            reading_id(F.col("city_id"), F.col("reading_ts")).alias("reading_id"),
            *dict.fromkeys([*measures, *order]),
        )
        once = upsert(incoming.limit(0), incoming, schemas.READING_KEY, measures, ["date_key", "reading_id"], order)
        self.catalog.add_run(table, RUNS[table], once.withColumn(READING_DAY, utc_day("reading_ts")))
        self.catalog.compact(table, RUNS[table], MOST_LOADS)

    def merge_bronze(self, new: DataFrame) -> None:
        """Upsert documents into the bronze zone: of one city and hour the later write counts, and in it the one fetched last.

        A re-run within the hour takes the document over, run id included, so the
        earlier run no longer finds it.
        """
        runs = RUNS["bronze"]
        once = latest_per_key(new.select(*schemas.BRONZE.fieldNames()), runs.keys, ["fetched_at"])
        # The runs first: days noted in vain cost a look, days not noted would hide documents.
        noted = new.select("source_api", "run_id", utc_day("fetched_hour").alias(FETCHED_DAY)).distinct()
        self.record("bronze_runs", noted, replace=False)
        self.catalog.add_run("bronze", runs, once.withColumn(FETCHED_DAY, utc_day("fetched_hour")))
        self.catalog.compact("bronze", runs, MOST_LOADS)

    def run_documents(self, source_api: str, run_id: str) -> DataFrame:
        """The documents that a run owns, read from the days it fetched only.

        Days are collected: a century has 36,525, and only literals prune partitions when
        the table is listed.
        """
        runs = self.read("bronze_runs").filter((F.col("source_api") == source_api) & (F.col("run_id") == run_id))
        days = sorted(row[0] for row in runs.select(FETCHED_DAY).distinct().collect())
        return run_documents(self.read("bronze").filter(F.col(FETCHED_DAY).isin(days)), source_api, run_id)

    def store_rejects(self, fact: str, batch: str, rejects: DataFrame) -> None:
        """Keep what a batch could not load: kind, violations and the row as JSON. A batch given again replaces its own."""
        rows = rejects.select(
            F.lit(fact).alias("fact"), F.lit(batch_name(batch)).alias("batch"), "kind", "violations",
            F.to_json(F.struct(*[c for c in rejects.columns if c not in ("kind", "violations")])).alias("document"),
        )
        shaped = self._shaped("load_rejects", rows)
        self.catalog.add_run("load_rejects", RUNS["load_rejects"], shaped, replaced=[(fact, batch_name(batch))])

    def has_rejects(self, fact: str, batch: str) -> bool:
        """Whether a batch of that name has left something before."""
        known = self.catalog.exists("load_rejects") and self.catalog.loads("load_rejects")
        return bool(known) and (fact, batch_name(batch)) in known

    def rejects(self, fact: str, batch: str) -> DataFrame:
        own = (F.col("fact") == fact) & (F.col("batch") == batch_name(batch))
        return self.read("load_rejects").filter(own)

    def _shaped(self, table: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])
