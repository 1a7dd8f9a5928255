"""Consecutive surrogate keys without sending all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(df: DataFrame, id_column: str, natural_key: list[str], after: Column) -> DataFrame:
    """Add ids ``after + 1, after + 2, ...``, the same for the same set of keys.

    Rows are numbered within 4,096 buckets of a hash of the natural key, and
    each bucket starts where the buckets before it end. Only the bucket sizes
    pass through one task and one broadcast: at most 4,096 rows.
    """
    key_text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural_key])
    bucketed = df.withColumn("_bucket", F.left(F.md5(key_text), F.lit(3)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy(*natural_key)
    return (
        bucketed.join(F.broadcast(starts), "_bucket")
        .withColumn(id_column, after + F.col("_start") + F.row_number().over(within))
        .drop("_bucket", "_start")
    )


def highest(df: DataFrame, id_column: str) -> Column:
    """The highest id in use, 0 if none, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(id_column).cast("bigint"), F.lit(0).cast("bigint"))).scalar()
