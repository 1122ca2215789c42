"""Days: truncation, literals, ISO text and ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def day(ts: str) -> Column:
    return F.to_date(ts)


def on_day(ts: str, when: dt.date) -> Column:
    """Rows of one day. Catalyst turns the comparison into a timestamp range that the scan takes."""
    return F.to_date(ts) == F.lit(when)


def parse_day(text: Column) -> Column:
    """ISO text to a date; bad text raises."""
    return F.to_date(text, "yyyy-MM-dd")


def format_day(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def days_between(start: dt.date, end: dt.date | None = None) -> list[dt.date]:
    """All days from ``start`` to ``end``, both included; ``end`` defaults to ``start``."""
    end = start if end is None else end
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return [start + dt.timedelta(n) for n in range((end - start).days + 1)]


def day_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """The same days as a frame with one column ``ds``."""
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("ds")
    )


def day_sequence(start: Column, end: Column) -> Column:
    """Array of days between two date columns, both included; raises where start is after end."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))
