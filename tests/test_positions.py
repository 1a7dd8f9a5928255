from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.operators.positions import with_positions


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_positions_are_those_of_a_sorted_list(spark, partitions):
    rows = [(k, None if k % 7 == 0 else k * 37 % 11, f"n{k % 5}") for k in range(500)]
    df = spark.createDataFrame(rows, "k int, a int, b string").repartition(5)
    got = with_positions(df, F.col("a").desc_nulls_last(), F.col("b"), F.col("k"), partitions=partitions).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    assert [(r.k, r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1, 501))


def test_equal_rows_are_spread_over_ranges(spark):
    df = spark.range(1000).select(F.lit(1).alias("a"))
    got = with_positions(df, F.col("a"), partitions=4)
    assert sorted(r.position for r in got.collect()) == list(range(1, 1001))
    from skyledger.operators.positions import PART, in_ranges

    sizes = [r["count"] for r in in_ranges(df, F.col("a"), partitions=4).groupBy(PART).count().collect()]
    assert max(sizes) < 500


def test_no_rows(spark):
    assert with_positions(spark.range(0), F.col("id")).count() == 0


def test_no_task_sees_all_rows(spark):
    plan = with_positions(spark.range(100).withColumn("x", -F.col("id")), F.col("x"))._jdf.queryExecution().toString()
    windows = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert all("__range" not in line or "rangepartitioning" not in line for line in windows)
