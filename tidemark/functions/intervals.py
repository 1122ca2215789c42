"""Elapsed time, its sum, and the month/day/time form of it.

A month counts 30 days and a day 24 hours. A 64-bit sum of microseconds overflows after about two
million intervals of two months, so whole seconds and the rest are summed apart, each in 64 bits, and
put together as decimal microseconds per group. The justified form is a struct for output only; sort
on the microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_MICROS = 1_000_000
DAY_MICROS = 86_400_000_000
MONTH_MICROS = 30 * DAY_MICROS


def elapsed_micros(end: str, start: str) -> Column:
    """Microseconds from ``start`` to ``end``; negative when reversed, NULL when either is."""
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))


def micros_sum(micros: Column) -> Column:
    """Sum of 64-bit microseconds as decimal(38,0), skipping NULLs; NULL when all are."""
    seconds = F.sum(F.call_function("div", micros, F.lit(SECOND_MICROS)))
    rest = F.sum(micros % SECOND_MICROS)
    return (seconds.cast("decimal(19,0)") * SECOND_MICROS + rest).cast("decimal(38,0)")


def elapsed_sum(end: str, start: str) -> Column:
    """Sum of elapsed time in microseconds."""
    return micros_sum(elapsed_micros(end, start))


def interval_micros(interval: Column) -> Column:
    """Microseconds of a day-time interval, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, epoch + interval)


def justify_interval(micros: Column) -> Column:
    """``struct(months, days, micros)``; all three fields have the sign of the whole."""
    def whole(unit: int) -> Column:
        return F.call_function("div", micros, F.lit(unit))

    return F.when(
        micros.isNotNull(),
        F.struct(
            whole(MONTH_MICROS).alias("months"),
            (whole(DAY_MICROS) % 30).alias("days"),
            (micros % DAY_MICROS).cast("bigint").alias("micros"),
        ),
    )
