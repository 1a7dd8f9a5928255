from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        # Hundreds of tiny plans: compiling each takes far longer than running it.
        # The generated code is exercised by check_oracles.py.
        spark__sql__codegen__wholeStage="false",
        spark__sql__codegen__factoryMode="NO_CODEGEN",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from a DDL schema and tuples."""

    def build(schema: str, *rows):
        return spark.createDataFrame([row if isinstance(row, tuple) else (row,) for row in rows], schema)

    return build


@pytest.fixture
def evaluate(spark):
    """The value of one column expression over one row of named values."""

    def run(column, **values):
        df = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()]) if values else spark.range(1)
        return df.select(column.alias("out")).first()["out"]

    return run


FETCHED = datetime(2024, 9, 26, 8, 30)


@pytest.fixture
def documents(frame):
    """Bronze documents around the given payloads: dicts, or text taken as it is."""

    def build(*payloads, city_id=1):
        rows = [
            (city_id, "Somewhere", FETCHED, FETCHED.replace(minute=0), "api", "run-1",
             payload if isinstance(payload, str) else json.dumps(payload))
            for payload in payloads
        ]
        return frame(
            "city_id int, city_name string, fetched_at timestamp, fetched_hour timestamp, source_api string, "
            "run_id string, raw_response string",
            *rows,
        )

    return build
