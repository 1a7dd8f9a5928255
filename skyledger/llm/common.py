"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import scratch_dir, use_utc

#: Words are the longest runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
#: ``bytes.split()`` without an argument splits at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows in one Arrow batch. Texts are long, and the default of 10,000 rows may be a gigabyte.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> SparkSession:
    """Keep the batches that go to Python small; holds for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return use_utc(spark)


#: Databases of the ``temporary`` blocks that run, the innermost last.
_TEMPORARY: list[str] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables stored in the block go at its end, also after an error, but for those stored with ``keep``. Blocks may be nested.

    No frame that reads them may be used afterwards.
    """
    database = f"temporary_{uuid.uuid4().hex}"
    location = scratch_dir(spark, "temporary").replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    _TEMPORARY.append(database)
    try:
        yield
    finally:
        _TEMPORARY.remove(database)
        spark.sql(f"DROP DATABASE {database} CASCADE")


def stored(df: DataFrame, label: str, keep: int = 0) -> DataFrame:
    """The same rows, read back from a table in the shared scratch folder.

    Cuts the lineage in a way that survives lost executors and gives Spark the
    true size of the table, which outlasts so many ``temporary`` blocks, the innermost first, as ``keep`` says.
    """
    spark = df.sparkSession
    if len(_TEMPORARY) > keep:
        name = f"{_TEMPORARY[-1 - keep]}.{label.replace('-', '_')}_{uuid.uuid4().hex}"
        df.write.format("parquet").saveAsTable(name)
        return spark.table(name)
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def uniform(*columns: Column | str, seed: int) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only, so that reruns agree."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 40)) / float(1 << 40)


def partitions_for(spark: SparkSession, at_least: int = 1) -> int:
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))
