"""The warehouse's tables, derived from the driver's tables.

``events`` stands in for both facts, ``customer`` and ``nation`` for the city
dimension, ``orders`` for long date ranges. Every stand-in keeps all rows; what
varies from row to row follows from the row's own attributes, so it is as mixed
as the data is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.times import date_key
from skyledger.session import use_utc

MEASURE = "decimal(12,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number ``k`` out of ``props``, 0 to 99."""
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def before_latest_event(spark: SparkSession, sf_dir: str, interval: str) -> Column:
    """The end of the data minus ``interval``, as a scalar subquery: these queries' now."""
    return table(spark, sf_dir, "events").agg(F.max("ts") - F.expr(f"INTERVAL {interval}")).scalar()


def readings(spark: SparkSession, sf_dir: str, measure: str, *more: str) -> DataFrame:
    """Events as a fact table with one measure of two decimals, and ``more`` columns of the events."""
    return events(spark, sf_dir).select(
        F.col("user_id").alias("city_id"),
        date_key(F.col("ts")).alias("date_key"),
        F.col("ts").alias("reading_ts"),
        F.col("value").cast(MEASURE).alias(measure),
        "event_id",
        *more,
    )


def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cities; a customer with a negative balance is inactive."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("city_id"),
        F.col("c_name").alias("city_name"),
        F.col("n_name").alias("state"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        "c_acctbal",
        "c_mktsegment",
    )


def as_text(column: Column | str) -> Column:
    """Timestamps leave the queries as text, so that every engine prints them alike."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


Query = Callable[[SparkSession, str], DataFrame]
