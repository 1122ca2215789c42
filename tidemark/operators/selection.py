"""The n-th value of a column at any depth, without sorting the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A range of so few rows is sorted: what one task gets at most.
FEW_ROWS = 100_000
#: Ranks are estimated to one part in so many, so a pass leaves a few of these parts.
ACCURACY = 5_000


def _key(df: DataFrame, by: str) -> Column:
    """A number in the order of the column."""
    kind, column = df.schema[by].dataType, F.col(f"`{by}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"{by} is no number, date or time: {kind.simpleString()}")
    return column


def _zones(key: Column, upper: object, lower: object) -> list[tuple[str, Column]]:
    """Five stretches of values, largest first: outside the two values, the values, and between them."""
    top, bottom = F.lit(upper), F.lit(lower)
    zones = [("above", key > top), ("upper", key == top)]
    if upper != lower:
        zones += [("between", (key < top) & (key > bottom)), ("lower", key == bottom)]
    return [*zones, ("below", key < bottom)]


def nth_largest(df: DataFrame, n: int, by: str, few_rows: int = FEW_ROWS) -> DataFrame:
    """One row with the ``n``-th largest value of ``by``, or no row where there are fewer than ``n``.

    NULL is the largest value, NaN the next. Each round estimates two values that enclose the rank, counts the rows of
    the five stretches they make exactly, and goes on with the one that holds the rank, a thousandth of the
    rows or so; the last few rows are sorted. Only these counts reach the driver, no task holds more than ``few_rows``, and
    equal values, however many, end the search. The jobs run now and read ``df`` twice a round: hand in a stored
    frame where it is dear to compute.
    """
    if n < 1:
        raise ValueError(f"ranks count from 1: {n}")
    key = _key(df, by)
    unknown = key.isNull()
    is_nan = F.isnan(key) if isinstance(df.schema[by].dataType, (T.DoubleType, T.FloatType)) else F.lit(False)
    number = ~unknown & ~is_nan
    chosen = df.select(F.col(f"`{by}`"))
    rows, nulls, nans, low, high = chosen.agg(
        F.count_if(number), F.count_if(unknown), F.count_if(~unknown & is_nan), F.min(F.when(number, key)), F.max(F.when(number, key))
    ).first()
    if n <= nulls:
        return chosen.where(unknown).limit(1)
    if n <= nulls + nans:
        return chosen.where(is_nan).limit(1)
    rank = n - nulls - nans
    if rank > rows:
        return chosen.limit(0)

    known = chosen.where(number).select(key.alias("key"))
    at = F.col("key")
    value = low if low == high else None
    halve = False
    while value is None:
        inside = known.where(at.between(F.lit(low), F.lit(high)))
        if rows <= few_rows:
            value = inside.orderBy(at.desc()).offset(rank - 1).limit(1).first()[0]
            break
        if halve:
            middle = (low + high) // 2 if isinstance(low, int) else (low + high) / 2
            upper = lower = middle
        else:
            share = 1 - (rank - 0.5) / rows
            bounds = [min(1.0, share + 2 / ACCURACY), max(0.0, share - 2 / ACCURACY)]
            upper, lower = inside.agg(F.percentile_approx(at, bounds, ACCURACY)).first()[0]
        zones = _zones(at, upper, lower)
        counts = inside.agg(*[
            F.struct(F.count_if(zone), F.min(F.when(zone, at)), F.max(F.when(zone, at))).alias(name) for name, zone in zones
        ]).first()
        before = rows
        for name, _ in zones:
            rows, low, high = counts[name]
            if rank <= rows:
                break
            rank -= rows
        if low == high:
            value = low
        # Estimates of numbers beyond 53 bits may miss the range; halving the range does not.
        halve = rows == before
    return chosen.where(key == F.lit(value)).limit(1)
