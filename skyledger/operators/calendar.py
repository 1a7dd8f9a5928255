"""The date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import date_key

# The span of the date dimension.
FIRST_DAY = date(2020, 1, 1)
LAST_DAY = date(2030, 12, 31)


def describe_days(days: DataFrame, padded: bool = False) -> DataFrame:
    """Calendar attributes of the DATE column ``full_date``.

    ``padded`` blank-pads day and month names to nine characters.
    """
    day = F.col("full_date")

    def name(pattern: str) -> Column:
        text = F.date_format(day, pattern)
        return F.rpad(text, 9, " ") if padded else text

    day_of_week = F.dayofweek(day) - 1
    return days.select(
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        day_of_week.cast("smallint").alias("day_of_week"),
        name("EEEE").alias("day_name"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        F.dayofyear(day).cast("smallint").alias("day_of_year"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.month(day).cast("smallint").alias("month"),
        name("MMMM").alias("month_name"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.year(day).cast("smallint").alias("year"),
        day_of_week.isin(0, 6).alias("is_weekend"),
    )


def date_spine(
    spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY, padded: bool = False
) -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("full_date"))
    return describe_days(days, padded)


def spine_over(df: DataFrame, column: str, padded: bool = False) -> DataFrame:
    """One row per day between the earliest and the latest value of ``column``."""
    bounds = df.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    days = bounds.filter("first IS NOT NULL").select(F.explode(F.sequence("first", "last")).alias("full_date"))
    return describe_days(days, padded)
