"""The quality gate: run the checks, record them, then stop the flow on failure."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..schemas import DQ_RESULTS, RUN_LOG
from .checks import CHECKS, Check, evaluate


# What a failed job raises: some causes reach Python unconverted.
JobFailed = (PySparkException, Py4JJavaError)


class GateFailed(RuntimeError):
    """At least one check failed. The results are recorded all the same."""


@dataclass(frozen=True)
class Run:
    """Who runs the gate, for the run log."""

    dag_id: str
    task_id: str
    logical_date: date
    started_at: datetime


def run_status(results: DataFrame) -> DataFrame:
    """One row: failed, warned, passed and the run's status."""
    counted = results.agg(
        *[F.count_if(F.col("status") == s).alias(n) for s, n in (("fail", "failed"), ("warn", "warned"), ("pass", "passed"))]
    )
    return counted.withColumn(
        "run_status",
        F.when(F.col("failed") > 0, "failure").when(F.col("warned") > 0, "partial_success").otherwise("success"),
    )


def collect_results(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    load_result: dict[str, int],
    as_of: Column | None = None,
    checks: list[Check] | None = None,
    columns: dict[str, list[str]] | None = None,
) -> list[Row]:
    """The results, one row per check.

    All checks run as one job. Should that job break, for instance on an
    unreadable file, every check runs by itself, and those that break again fail.
    """
    checks = CHECKS if checks is None else checks
    try:
        return evaluate(spark, tables, load_result, as_of, checks, columns).orderBy("check_no").collect()
    except JobFailed:
        return [_run_alone(spark, tables, load_result, as_of, check, n, columns) for n, check in enumerate(checks, start=1)]


def _run_alone(spark, tables, load_result, as_of, check: Check, number: int, columns) -> Row:
    try:
        result = evaluate(spark, tables, load_result, as_of, [check], columns).first().asDict()
    except JobFailed as error:
        details = f"check crashed: {str(error).splitlines()[0]}"
        result = dict(check_name=check.name, table_name=check.table, status="fail", details=details, metric=None)
    return Row(**{**result, "check_no": number})


def record(
    spark: SparkSession, run: Run, results: list[Row], load_result: dict[str, int], run_id: int, first_result_id: int
) -> tuple[DataFrame, DataFrame]:
    """``(run log row, check result rows)`` to append."""
    statuses = {row.status for row in results}
    status = "failure" if "fail" in statuses else "partial_success" if "warn" in statuses else "success"
    loaded = load_result.get("weather_loaded", 0) + load_result.get("aqi_loaded", 0)
    rejected = load_result.get("weather_rejected", 0) + load_result.get("aqi_rejected", 0)
    cities_failed = list(load_result.get("cities_failed", []))
    log = spark.createDataFrame(
        [(run_id, run.dag_id, run.task_id, run.logical_date, run.started_at, None, status, loaded, loaded, rejected,
          cities_failed, None)],
        RUN_LOG,
    ).withColumn("ended_at", F.current_timestamp())
    rows = [
        (first_result_id + i, run_id, row.check_name, row.table_name, row.status, row.details, None)
        for i, row in enumerate(results)
    ]
    checked = spark.createDataFrame(rows, DQ_RESULTS).withColumn("checked_at", F.current_timestamp())
    return log, checked


def recorded(warehouse, run_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(run log, check results)`` as stored, of one run or of all recorded runs; other results are left out."""
    log, results = warehouse.read("pipeline_run_log"), warehouse.read("dq_check_results")
    if run_id is not None:
        log, results = log.filter(F.col("run_id") == run_id), results.filter(F.col("run_id") == run_id)
    return log, results.join(log.select("run_id"), "run_id", "left_semi")


def run_gate(
    warehouse,
    load_result: dict[str, int],
    run: Run,
    as_of: Column | None = None,
    checks: list[Check] | None = None,
) -> list[Row]:
    """Check the warehouse, record results and run, raise ``GateFailed`` on any failure.

    Results are written first: a run is recorded once its row is in the log. A gate that
    dies in between leaves results without a run, and the next run, which gets the same
    number, takes their place.
    """
    spark = warehouse.spark
    names = ["fact_weather_reading", "fact_air_quality_reading", "dim_city", "quarantine_unmatched_city_names"]
    # Frames show every column of the schema; what is stored may lack some.
    stored = {name: warehouse.stored_columns(name) for name in names}
    results = collect_results(spark, {name: warehouse.read(name) for name in names}, load_result, as_of, checks, stored)
    last_run = warehouse.read("pipeline_run_log").agg(F.max("run_id")).first()[0] or 0
    last_result = warehouse.read("dq_check_results").agg(F.max("id")).first()[0] or 0
    log, checked = record(spark, run, results, load_result, last_run + 1, last_result + 1)
    warehouse.record("dq_check_results", checked)
    warehouse.record("pipeline_run_log", log)
    failed = [row.check_name for row in results if row.status == "fail"]
    if failed:
        raise GateFailed(f"{len(failed)} checks failed: {failed}")
    return results
