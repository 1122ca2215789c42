"""Sorts, limits and top-k.

NULL is the largest value in every sort: first when descending, last when ascending. Spark's own
default is the opposite, so the order is always spelled out.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.selection import nth_largest

#: From this rank on a value is searched for by counts; before, each task keeps as many rows.
DEEP = 10_000


def desc(name: str) -> Column:
    return F.desc_nulls_first(name)


def asc(name: str) -> Column:
    return F.asc_nulls_last(name)


def sort_desc(df: DataFrame, *by: str, tie: str | None = None) -> DataFrame:
    """Global descending sort; ``tie`` is an ascending last key.

    A unique ``tie`` also matters for balance: rows of equal sort keys share one range partition,
    so a value held by a third of the rows would otherwise be sorted by a single task.
    """
    keys = [desc(name) for name in by]
    return df.orderBy(*keys, *([asc(tie)] if tie else []))


def top_n(df: DataFrame, n: int, *by: str, tie: str) -> DataFrame:
    """The ``n`` largest rows; each task keeps ``n`` rows before the final merge."""
    return sort_desc(df, *by, tie=tie).limit(n)


def kth_largest(df: DataFrame, k: int, by: str) -> DataFrame:
    """One row with the ``k``-th largest ``by``, or no row where there are fewer than ``k``.

    A deep rank is searched for now, by jobs over ``df`` (see ``nth_largest``); a small one is part of the plan.
    """
    if k > DEEP:
        return nth_largest(df, k, by)
    return df.select(by).orderBy(desc(by)).offset(k - 1).limit(1)


def top_k_with_ties(df: DataFrame, k: int, by: str, strict_threshold: bool = False) -> DataFrame:
    """All rows whose ``by`` reaches that of the ``k``-th largest row.

    The threshold is a scalar subquery, so ties of any number stay distributed. With fewer than
    ``k`` rows the default keeps every row that has a value; ``strict_threshold`` keeps none, which
    is what comparing with an empty subquery gives.
    """
    if strict_threshold:
        return df.filter(F.col(by) >= kth_largest(df, k, by).scalar())
    known = df.filter(F.col(by).isNotNull())
    if k > DEEP:
        lowest = nth_largest(known, k, by)
        # Fewer rows than that: all of them are kept.
        return known.filter(F.col(by) >= lowest.scalar()) if lowest.take(1) else known
    lowest = known.select(by).orderBy(desc(by)).limit(k).agg(F.min(by))
    return known.filter(F.col(by) >= lowest.scalar())


def top_per_condition(
    totals: DataFrame, key: str, value: str, conditions: Iterable[str], tag: str | None = None
) -> DataFrame:
    """The top-1 group under each of several conditions, united, from one pass over ``totals``.

    ``totals`` has one row per ``key``, and for each condition ``c`` the columns ``c_n``, how many rows
    met it, and ``c_<value>``, their sum. A group without such rows does not compete, one whose sum is
    unknown ranks first, ties go to the smallest key. Equal winners are one row, unless ``tag`` names a
    column for the condition.
    """
    def winner(condition: str) -> Column:
        amount, present = F.col(f"{condition}_{value}"), F.col(f"{condition}_n") > 0
        shown = [F.col(key), amount.alias(value), *([F.lit(condition).alias(tag)] if tag else [])]
        rank = F.struct(amount.isNotNull(), -amount, F.col(key))
        return F.min_by(F.when(present, F.struct(*shown)), F.when(present, rank)).alias(condition)

    names = list(conditions)
    best = totals.agg(*[winner(name) for name in names])
    rows = best.select(F.explode(F.array_distinct(F.array(*names))).alias("best"))
    return rows.filter(F.col("best").isNotNull()).select("best.*")
