"""Array and map expressions. They work inside one row, so no group is ever collected."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def element(array: Column, index: int) -> Column:
    """Item at a zero-based index, NULL beyond the end."""
    return F.get(array, index)


def append(array: Column, item: Column) -> Column:
    return F.array_append(array, item)


def extend(array: Column, other: Column) -> Column:
    return F.concat(array, other)


def distinct_items(array: Column) -> Column:
    return F.array_distinct(array)


def integers(first: Column, last: Column) -> Column:
    """All integers from ``first`` to ``last``, both included; empty where ``last < first``."""
    first, last = first.cast("bigint"), last.cast("bigint")
    return F.when(first <= last, F.sequence(first, last)).when(first > last, F.array().cast("array<bigint>"))


def stepped_slice(array: Column, start: int, stop: int, step: int) -> Column:
    """Items at ``start``, ``start + step``, ... below ``stop``; zero-based, positive step."""
    return F.filter(F.slice(array, start + 1, stop - start), lambda _, i: i % step == 0)


def reversed_items(array: Column) -> Column:
    return F.reverse(array)


def records(entries: Column, key: str, value: str) -> Column:
    """Map to an array of ``struct(<key>, <value>)``."""
    return F.transform(F.map_entries(entries), lambda e: F.struct(e["key"].alias(key), e["value"].alias(value)))
