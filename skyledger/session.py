"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    ``conf`` overrides or extends the defaults; keys use ``__`` for dots. On a
    cluster leave ``master`` unset and let the submit command choose it.
    """
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # HotSpot leaves larger methods uncompiled; Spark then splits the work instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    defaults.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: naive local times are converted by hand, so any
    other zone would shift them a second time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    The folder must be visible to every executor, so a machine-local one is
    made only where the setting is absent (tests, single-machine runs).
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="skyledger-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Tasks for each core, so that uneven ones even out.
WAVES = 4


def spread(df: DataFrame) -> DataFrame:
    """Shuffle rows to all cores unless the scan has several splits for each.

    Worth it before CPU-bound work on a file of a few row groups. A group is read whole by
    the split that holds its middle, so of as many splits as cores most may be empty, and one may hold all
    rows. Large inputs have many splits and pass through unchanged; finding out runs no job.
    """
    tasks = WAVES * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
