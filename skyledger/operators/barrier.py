"""Keeping costly columns from being computed more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with the columns fixed at this point of the plan.

    The optimizer moves a filter below the projection it reads from and repeats
    there whatever the filter needs. That is right for cheap columns, but after
    a parser it means parsing every row twice or more. A generator with one
    element is not crossed by filters, stays in generated code and costs a copy.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")
