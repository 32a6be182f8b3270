"""The first rows of each group, whatever the size of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A group is ranked in so many parts first, so that no task ranks more than the first rows of each.
PARTS = 32


def first_rows(df: DataFrame, group: str, order: list[Column], most: int, spread: Column) -> DataFrame:
    """The first ``most`` rows of each group with their place ``rank`` from 1.

    ``order`` leaves no ties within a group; ``spread`` deals the rows of a group over parts. A row
    among the first of its group is among the first of its part.
    """
    part = F.pmod(F.xxhash64(spread), F.lit(PARTS))
    within = Window.partitionBy(group, "__part").orderBy(*order)
    dealt = df.withColumn("__part", part).withColumn("__place", F.row_number().over(within))
    few = dealt.where(F.col("__place") <= most).drop("__part", "__place")
    placed = few.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return placed.where(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("long"))
