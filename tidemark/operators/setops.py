"""Set algebra over frames with equal columns; NULLs compare as equal.

Difference, intersection and symmetric difference share one grouping of the tagged union: one
shuffle, duplicates collapse before it, and a value that fills a third of either side is one row
per task by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def _membership(a: DataFrame, b: DataFrame) -> DataFrame:
    tagged_a = a.select("*", F.lit(True).alias("in_a"), F.lit(False).alias("in_b"))
    tagged_b = b.select("*", F.lit(False).alias("in_a"), F.lit(True).alias("in_b"))
    return tagged_a.unionByName(tagged_b).groupBy(*a.columns).agg(
        F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b")
    )


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return _membership(a, b).filter("in_a AND NOT in_b").select(*a.columns)


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in both."""
    return _membership(a, b).filter("in_a AND in_b").select(*a.columns)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in exactly one of the two."""
    return _membership(a, b).filter("in_a <> in_b").select(*a.columns)


def only_in_second(a: DataFrame, b: DataFrame) -> DataFrame:
    """The side of the symmetric difference that lies in ``b``, from the same single grouping."""
    return _membership(a, b).filter("in_b AND NOT in_a").select(*a.columns)
