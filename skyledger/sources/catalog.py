"""Tables in Spark's catalog whose readers see a write whole or not at all.

Each warehouse is one database of the session's catalog, located at the warehouse's
folder. A table is a view over stored tables, and the view is what a write swaps:
until then readers see the old rows, afterwards the new ones. There are two kinds:

- *Whole tables*: a write makes a new stored table and points the view at it.
- *Run tables*: partitioned by day (or what else locates rows) and by ``load``, the
  number of the write. A write adds its own rows as new partitions and changes no
  file; where a partition of days has rows of several loads, the view merges them by key:
  updated columns from the last load, kept columns from the first. Files are
  bucketed by the key, so neither merging nor counting keys needs an exchange.

``compact`` writes a day's merged rows as one more load. Merging it again with the loads it
was made of gives the same rows, so no moment shows anything else, whatever step
fails. Stored tables and loads that the view has left are kept for readers that still use them:
whole tables for ``KEPT_VERSIONS`` more writes, loads until ``vacuum``.

One writer at a time. The catalog must outlive the session if the tables shall (Hive's, for
instance): a folder whose tables this session's catalog does not know is lost, and
using it raises instead of showing empty tables.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD = "load"
#: Stored tables behind a view that stay after it has moved on, and loads of a day before they are compacted.
KEPT_VERSIONS, MOST_LOADS = 8, 8


class LostTable(RuntimeError):
    """The folder holds tables that the catalog of this session does not know."""


@dataclass(frozen=True)
class Runs:
    """The shape of a run table. ``schema`` includes the partition columns ``by``."""

    schema: T.StructType
    by: list[str]
    keys: list[str]
    kept: list[str] = field(default_factory=list)
    buckets: int = 8


@dataclass
class State:
    """What the view of a run table shows: loads up to ``committed``; of some partitions only those from ``bases`` on."""

    committed: int = 0
    bases: dict[tuple[str, ...], int] = field(default_factory=dict)


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(value: str, kind: T.DataType) -> str:
    return f"cast({_quoted(value)} AS {kind.simpleString()})"


class Catalog:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.database = f"skyledger_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"

    # --- the database ---

    def known(self) -> bool:
        """Whether the catalog has this warehouse; raises if only the folder is there."""
        if self.spark.catalog.databaseExists(self.database):
            return True
        try:
            self.spark.read.text(f"{self.root}/_warehouse").isEmpty()
        except AnalysisException:
            return False
        raise LostTable(f"the catalog of this session does not know the tables in {self.root}")

    def _open(self) -> None:
        if not self.known():
            self.spark.range(1).select(F.lit(self.database)).coalesce(1).write.text(f"{self.root}/_warehouse")
            self.spark.sql(f"CREATE DATABASE {self.database} LOCATION {_quoted(self.root)}")

    def name(self, table: str) -> str:
        return f"{self.database}.`{table}`"

    def exists(self, table: str) -> bool:
        return self.known() and self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame | None:
        return self.spark.table(self.name(table)) if self.exists(table) else None

    def _properties(self, table: str) -> dict[str, str]:
        if not self.exists(table):
            return {}
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}

    def _swap(self, table: str, query: str, properties: dict[str, str]) -> None:
        """The one step that readers notice."""
        listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} TBLPROPERTIES ({listed}) AS {query}")

    # --- whole tables ---

    def replace(self, table: str, df: DataFrame) -> None:
        """Make ``df`` the table; it may be computed from the table."""
        self._open()
        shown = [v for v in self._properties(table).get("versions", "").split(",") if v]
        # What writes that failed before their swap have left.
        stored = self.spark.sql(f"SHOW TABLES IN {self.database} LIKE '{table}__*'").collect()
        for lost in {row.tableName for row in stored}.difference(shown):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(lost)}")
        fresh = f"{table}__{uuid.uuid4().hex[:16]}"
        df.write.format("parquet").saveAsTable(self.name(fresh))
        versions = [fresh, *shown]
        self._swap(table, f"SELECT * FROM {self.name(fresh)}", {"versions": ",".join(versions[:KEPT_VERSIONS])})
        for old in versions[KEPT_VERSIONS:]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(old)}")

    # --- tables of records, one partition for each run ---

    def record(self, table: str, df: DataFrame, by: list[str], replace: bool = True) -> None:
        """Add rows to a table partitioned by ``by``.

        With ``replace``, rows of equal ``by`` that are there already give way, so that recording
        something again leaves one record.
        """
        self._open()
        columns = [*[c for c in df.columns if c not in by], *by]
        if not self.exists(table):
            self._create(table, T.StructType([df.schema[c] for c in columns]), by)
        mode = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            df.select(*columns).coalesce(1).write.insertInto(self.name(table), overwrite=replace)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)

    def _create(self, table: str, schema: T.StructType, by: list[str], buckets: str = "") -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = ", ".join(f"`{c}`" for c in by)
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet PARTITIONED BY ({parts}) {buckets}")

    # --- run tables ---

    def state(self, table: str) -> State:
        properties = self._properties(table)
        bases = {tuple(group): load for group, load in json.loads(properties.get("bases", "[]"))}
        return State(int(properties.get("committed", 0)), bases)

    def loads(self, table: str) -> dict[tuple[str, ...], list[int]]:
        """All loads that the catalog knows, by the partition that they are part of."""
        found: dict[tuple[str, ...], list[int]] = {}
        for row in self.spark.sql(f"SHOW PARTITIONS {self.name(f'{table}__runs')}").collect():
            *group, load = (unquote(part.split("=", 1)[1]) for part in row.partition.split("/"))
            found.setdefault(tuple(group), []).append(int(load))
        return found

    def _drop(self, table: str, runs: Runs, partitions: Iterable[tuple[tuple[str, ...], int]]) -> None:
        for group, load in partitions:
            spec = ", ".join([*(f"`{c}` = {_quoted(v)}" for c, v in zip(runs.by, group, strict=True)), f"{LOAD} = {load}"])
            self.spark.sql(f"ALTER TABLE {self.name(f'{table}__runs')} DROP IF EXISTS PARTITION ({spec})")

    def add_run(
        self,
        table: str,
        runs: Runs,
        df: DataFrame,
        replaced: list[tuple[str, ...]] | None = None,
    ) -> int:
        """Write ``df``, which has each key once, as one more load and show it; returns the load's number.

        The partitions ``replaced`` show this load only, even if it has no rows there.
        """
        self._open()
        stored = f"{table}__runs"
        if not self.exists(stored):
            keys = ", ".join(f"`{k}`" for k in runs.keys if k not in runs.by)
            bucketed = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {runs.buckets} BUCKETS" if runs.keys else ""
            self._create(stored, T.StructType(list(runs.schema)).add(LOAD, T.LongType()), [*runs.by, LOAD], bucketed)
        state = self.state(table)
        # Loads of writes that failed before they were shown.
        self._drop(table, runs, [(g, n) for g, ns in self.loads(table).items() for n in ns if n > state.committed])
        load = max(time.time_ns() // 1000, state.committed + 1)
        self._write(stored, runs, df, load)
        # What the load before replaced is gone for good now.
        shown = self.loads(table)
        fresh = dict.fromkeys(replaced or [], load)
        self._drop(table, runs, [(g, n) for g in fresh for n in shown.get(g, []) if n < state.bases.get(g, 0)])
        self._show(table, runs, State(load, {**state.bases, **fresh}))
        return load

    def _write(self, stored: str, runs: Runs, df: DataFrame, load: int) -> None:
        columns = [f.name for f in runs.schema if f.name not in runs.by]
        rows = df.select(*columns, *runs.by, F.lit(load).cast("long").alias(LOAD))
        if runs.keys:
            # One file for each bucket of a partition, and as many tasks as there are such files, not as buckets.
            bucket = F.pmod(F.hash(*[k for k in runs.keys if k not in runs.by]), F.lit(runs.buckets))
            rows = rows.repartition(*runs.by, bucket)
        rows.write.insertInto(self.name(stored))

    def _show(self, table: str, runs: Runs, state: State) -> None:
        shown = {
            group: sorted(n for n in numbers if state.bases.get(group, 0) <= n <= state.committed)
            for group, numbers in self.loads(table).items()
        }
        several = [group for group, numbers in shown.items() if len(numbers) > 1]
        bases = json.dumps([[list(group), load] for group, load in state.bases.items()])
        self._swap(table, self._query(table, runs, state, several), {"committed": str(state.committed), "bases": bases})

    def _among(self, runs: Runs, groups: Iterable[tuple[str, ...]]) -> str:
        """Whether a row is in one of the partitions; literals, so that the catalog prunes by it."""
        kinds = [runs.schema[c].dataType for c in runs.by]
        listed = ", ".join(f"({', '.join(map(_literal, group, kinds))})" for group in groups)
        return f"({', '.join(f'`{c}`' for c in runs.by)}) IN ({listed})"

    def _query(self, table: str, runs: Runs, state: State, several: list[tuple[str, ...]]) -> str:
        """All rows of partitions with one load, and the merged rows of the others."""
        columns = [f.name for f in runs.schema]
        source = f"FROM {self.name(f'{table}__runs')} WHERE {LOAD} <= {state.committed}"
        for load in sorted(set(state.bases.values())):
            groups = [g for g, n in state.bases.items() if n == load]
            source += f" AND NOT ({LOAD} < {load} AND {self._among(runs, groups)})"
        plain = f"SELECT {', '.join(f'`{c}`' for c in columns)} {source}"
        if not several or not runs.keys:
            return plain
        grouped = list(dict.fromkeys([*runs.keys, *runs.by]))
        updated = [c for c in columns if c not in grouped and c not in runs.kept]
        last = ", ".join([LOAD, *(f"`{c}`" for c in updated)])
        first = ", ".join([LOAD, *(f"`{c}`" for c in runs.kept)])
        picks = [f"max(struct({last})) AS __last", *([f"min(struct({first})) AS __first"] if runs.kept else [])]
        keys = ", ".join(f"`{c}`" for c in grouped)
        place = {**{c: f"`{c}`" for c in grouped}, **{c: f"__last.`{c}`" for c in updated}, **{c: f"__first.`{c}`" for c in runs.kept}}
        merged = ", ".join(f"{place[c]} AS `{c}`" for c in columns)
        return (
            f"{plain} AND NOT {self._among(runs, several)} UNION ALL "
            f"SELECT {merged} FROM (SELECT {keys}, {', '.join(picks)} {source} AND {self._among(runs, several)} GROUP BY {keys})"
        )

    def compact(self, table: str, runs: Runs, most_loads: int = 1) -> int:
        """Write partitions with more than ``most_loads`` loads as one; returns how many there were."""
        state = self.state(table)
        shown = {g: [n for n in ns if state.bases.get(g, 0) <= n <= state.committed] for g, ns in self.loads(table).items()}
        full = [group for group, numbers in shown.items() if len(numbers) > most_loads]
        if not full:
            return 0
        self.add_run(table, runs, self.read(table).filter(self._among(runs, full)), replaced=full)
        return len(full)

    def vacuum(self, table: str, runs: Runs) -> None:
        """Drop loads that the view has left; readers that began before may fail."""
        state = self.state(table)
        self._drop(
            table, runs,
            [(g, n) for g, ns in self.loads(table).items() for n in ns if n > state.committed or n < state.bases.get(g, 0)],
        )
        self._show(table, runs, State(state.committed))

    # --- scratch ---

    @contextmanager
    def scratch(self) -> Iterator:
        """A function that writes a frame and reads it back, for as long as the block runs.

        It cuts lineage, survives lost executors and computes a frame once however often it is
        read. The copies are stored tables; they go at the end, also after an error.
        """
        names: list[str] = []

        def stage(df: DataFrame, label: str) -> DataFrame:
            self._open()
            names.append(self.name(f"scratch_{label}_{uuid.uuid4().hex[:16]}"))
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            self.spark.sql(f"CREATE TABLE {names[-1]} ({columns}) USING parquet")
            df.write.insertInto(names[-1])
            return self.spark.table(names[-1])

        try:
            yield stage
        finally:
            for name in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
