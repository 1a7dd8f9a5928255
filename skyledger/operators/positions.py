"""Places in a total order, without a window over all rows.

Rows are dealt into ranges of the order and sorted within them; a row's place
is its place in its range plus the rows of all ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import scratch_dir

PART, ROW = "__range", "__row_of_range"
#: ``monotonically_increasing_id`` counts rows of a partition in its lower 33 bits.
ROW_BITS = (1 << 33) - 1


def in_ranges(df: DataFrame, *order: Column, partitions: int | None = None) -> DataFrame:
    """Rows sorted over all partitions, with the number of their range in ``__range``.

    Rows that are equal in the whole order are told apart by their place in the
    input, so that many of them don't meet in one range.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col("__tie")]
    ranged = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(partitions, *keys)
    return ranged.sortWithinPartitions(*keys).drop("__tie").withColumn(PART, F.spark_partition_id())


def before(sizes: DataFrame, by: str, size: str) -> DataFrame:
    """``sizes`` with the sum of ``size`` over all smaller ``by`` in ``__before``.

    For one row per range: as many as there are partitions, however many rows they hold.
    """
    earlier = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("__before", F.coalesce(F.sum(size).over(earlier), F.lit(0)))


def with_positions(df: DataFrame, *order: Column, name: str = "position", partitions: int | None = None) -> DataFrame:
    """All rows with their place 1, 2, 3 ... in ``order``, as a long.

    The sorted rows are written to the shared scratch folder, so that counting
    them and numbering them see the same ranges whatever becomes of executors.
    Equal rows get neighbouring places; ``order`` should name a tie-break.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "positions")
    ranged = in_ranges(df, *order, partitions=partitions)
    rows = ranged.withColumn(ROW, F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)))
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    sizes = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("__size"))
    starts = before(sizes, PART, "__size").select(PART, "__before")
    place = F.col("__before") + F.col(ROW) + 1
    return rows.join(F.broadcast(starts), PART).withColumn(name, place).drop(PART, ROW, "__before")
