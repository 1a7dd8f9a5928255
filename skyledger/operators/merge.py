"""Keyed merges: what an upsert leaves behind, as a grouping of old and new rows.

All picks are aggregates (greatest or least struct per key), not windows: they
combine before the shuffle, so a key that makes up a third of the input is
reduced where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order``; null keys are equal.

    Rows that tie on ``order`` are settled by their remaining columns, so the
    result does not depend on how the input is split.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    greatest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return greatest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    updated: list[str],
    kept: list[str],
    order: list[str],
) -> DataFrame:
    """Insert ``new`` into ``old``, updating on an equal key.

    ``updated`` columns end up as in the last row given for the key, ``kept``
    columns as in the first, where all of ``old`` comes before ``new`` and
    ``new`` is ordered by ``order``. ``old`` need not have the order columns.
    """
    columns = [*keys, *updated, *kept]

    def ranked(df: DataFrame, batch: int, order_columns: list[Column]) -> DataFrame:
        return df.select(*columns, F.struct(F.lit(batch).alias("batch"), *order_columns).alias("_seq"))

    order_types = {name: new.schema[name].dataType for name in order}
    rows = ranked(old, 0, [F.lit(None).cast(t).alias(n) for n, t in order_types.items()]).unionByName(
        ranked(new, 1, [F.col(n) for n in order])
    )
    merged = rows.groupBy(*keys).agg(
        F.max(F.struct("_seq", *updated)).alias("_last"),
        *([F.min(F.struct("_seq", *kept)).alias("_first")] if kept else []),
    )
    return merged.select(
        *keys,
        *[F.col(f"_last.{c}").alias(c) for c in updated],
        *[F.col(f"_first.{c}").alias(c) for c in kept],
    )


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of ``new`` whose key ``old`` lacks; the first by ``order`` for each key."""
    rest = [c for c in new.columns if c not in keys]
    absent = new.join(old.select(*keys), keys, "left_anti")
    others = [c for c in rest if c not in order]
    first = absent.groupBy(*keys).agg(F.min(F.struct(*order, *others)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in new.columns])


def merge_readings(old: DataFrame, new: DataFrame, measures: list[str], order: list[str] | None = None) -> DataFrame:
    """Upsert readings on (city_id, reading_ts).

    Measures come from the last row; ``date_key`` and ``reading_id`` stay as
    first inserted.
    """
    kept = ["date_key", "reading_id"] if "reading_id" in old.columns else ["date_key"]
    merged = upsert(old, new, ["city_id", "reading_ts"], measures, kept, order or ["fetched_at"])
    return merged.select(*[c for c in old.columns if c in merged.columns])


def reading_id(city_id: Column, reading_ts: Column) -> Column:
    """A reading's number, computed from its key instead of drawn from a sequence.

    Whole seconds, which is all the sources report: city number in the upper,
    epoch seconds in the lower 32 bits, so distinct for distinct keys (until
    2106). Other instants: a 63-bit hash of city and microseconds with the sign bit
    set, so never equal to one of the first kind.
    """
    micros = F.unix_micros(reading_ts.cast("timestamp"))
    city = city_id.cast("bigint")
    whole = F.shiftleft(city, 32) + F.pmod(F.unix_seconds(reading_ts.cast("timestamp")), F.lit(2**32))
    hashed = F.xxhash64(city, micros).bitwiseOR(F.lit(-(2**63)))
    return F.when(F.pmod(micros, F.lit(1_000_000)) == 0, whole).otherwise(hashed)


def split_required(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; rejects list the ``missing`` fields."""
    marked = mark_missing(rows, required)
    complete = F.size("missing") == 0
    return marked.filter(complete).drop("missing"), marked.filter(~complete)


def mark_missing(rows: DataFrame, required: list[str]) -> DataFrame:
    names = [F.when(F.col(name).isNull(), F.lit(name)) for name in required]
    return rows.withColumn("missing", F.array_compact(F.array(*names)))


def load_summary(rows: DataFrame, required: list[str]) -> DataFrame:
    """One row: rows_loaded counts valid input rows, before keys collapse them."""
    complete = F.size("missing") == 0
    return mark_missing(rows, required).agg(
        F.count_if(complete).alias("rows_loaded"), F.count_if(~complete).alias("rows_rejected")
    )
