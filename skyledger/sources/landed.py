"""Landed API responses: pairing batches with their requests, and the bronze zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.merge import latest_per_key
from ..schemas import BRONZE


def pair_batches(requests: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(paired, rejected)``: one response object per requested city, by position.

    ``requests`` is (batch_id, pos, ...) with pos from 0; ``responses`` is
    (batch_id, body, ...) with the response text. A lone object counts as a list
    of one. A batch whose response is no JSON or has another number of objects
    than cities were asked for is rejected whole, one row per requested city,
    because positions cannot be trusted then.
    """
    asked = requests.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_requests"))
    answered = responses.withColumn("_list", as_list(F.try_parse_json("body"))).withColumn(
        "n_responses", F.coalesce(F.size("_list"), F.lit(0))
    )
    judged = asked.join(answered, "batch_id", "left").withColumn(
        "_good", F.coalesce(F.col("n_requests") == F.col("n_responses"), F.lit(False))
    )
    elements = judged.filter("_good").select(
        "batch_id",
        *[c for c in responses.columns if c not in ("batch_id", "body")],
        F.posexplode("_list").alias("pos", "_element"),
    )
    paired = requests.join(
        elements.withColumn("raw_response", F.to_json("_element")).drop("_element"), ["batch_id", "pos"]
    )
    bad = judged.filter(~F.col("_good")).select(
        "batch_id", "n_requests", F.coalesce("n_responses", F.lit(0)).alias("n_responses")
    )
    return paired, requests.join(bad, "batch_id")


def as_list(variant: Column) -> Column:
    """A variant array as an array of variants, any other value as an array of one."""
    return F.when(
        variant.isNotNull(), F.coalesce(F.try_variant_get(variant, "$", "array<variant>"), F.array(variant))
    )


def to_bronze(attempts: DataFrame) -> DataFrame:
    """Attempts (city_id, city_name, fetched_at, source_api, run_id, raw_response) in bronze form."""
    hour = F.date_trunc("hour", F.col("fetched_at"))
    return attempts.withColumn("fetched_hour", hour).select(*BRONZE.fieldNames())


def bronze_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """One document per (source_api, city_id, fetched_hour): of the later write, and in it the one fetched last.

    A re-run within the hour takes the document over, run id included, so the
    earlier run no longer finds it.
    """
    columns = BRONZE.fieldNames()
    both = old.select(*columns, F.lit(0).alias("_batch")).unionByName(new.select(*columns, F.lit(1).alias("_batch")))
    return latest_per_key(both, ["source_api", "city_id", "fetched_hour"], ["_batch", "fetched_at"]).drop("_batch")


def run_documents(bronze: DataFrame, source_api: str, run_id: str) -> DataFrame:
    """The documents one run owns; both predicates reach the scan."""
    return bronze.filter((F.col("source_api") == source_api) & (F.col("run_id") == run_id))
