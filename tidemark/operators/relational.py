"""Joins and aggregates in the shapes the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import broadcastable, splittable_join


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed ``<prefix>_<name>``, so that ``*`` over a join has no duplicate names."""
    return df.select(*[F.col(name).alias(f"{prefix}_{name}") for name in df.columns])


def join_chain(fact: DataFrame, *steps: tuple[DataFrame, str] | tuple[DataFrame, str, str]) -> DataFrame:
    """Join ``fact`` to a chain of look-up tables, shuffling it once at most.

    A step is ``(table, key)`` or ``(table, key, how)``: the key is unique in the table and a column
    of the table before; ``how`` is inner or left. The rows are those of joining step by step. A left
    step before an inner one is an inner one too, as its unmatched rows have no key for the later
    step; inner steps followed by left ones may be regrouped freely. So tables up to the last one too
    large to broadcast are joined among themselves first and meet the fact as one; the small ones
    behind them are attached to the fact in turn, where Spark broadcasts them. Joining small tables
    among themselves would hide their size from Spark, which estimates a join by the product of
    its inputs. Only the plan depends on sizes, never the rows.
    """
    tables, keys = [step[0] for step in steps], [step[1] for step in steps]
    hows = [step[2] if len(step) == 3 else "inner" for step in steps]
    if set(hows) - {"inner", "left"}:
        raise ValueError(f"a step is an inner or a left join: {hows}")
    hows = ["inner" if "inner" in hows[i:] else "left" for i in range(len(hows))]
    last = max((i for i in range(1, len(steps)) if not broadcastable(tables[i])), default=0)
    nested = tables[last]
    for i in range(last, 0, -1):
        nested = tables[i - 1].join(nested, keys[i], hows[i])
    joined = fact.join(nested, keys[0], hows[0])
    for i in range(last + 1, len(steps)):
        joined = joined.join(tables[i], keys[i], hows[i])
    return joined


def anti_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Rows of ``left`` without a partner; a NULL key has none.

    Keys of ``right`` are reduced to one row each, so a hot one costs nothing; one of ``left``, NULL
    included, is split.
    """
    return splittable_join(left, right.select(on).distinct(), on, "left_anti")


# Parts that a hot key of a left join's right side is dealt over.
SALTS = 32


def left_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """LEFT JOIN in which one key may hold many rows on either side.

    Of a left join Spark splits a hot key on the left side only. So the rows of ``right`` get a salt from
    their values, each left row is told the salts of its key, SALTS at most, and both meet on key and salt.
    ``left`` is read once, ``right`` once more for its keys. Where ``on`` is unique in ``right``, a plain
    left join does less work.
    """
    # Maps have no hash.
    hashed = [name for name, kind in right.dtypes if "map<" not in kind]
    salted = right.withColumn("on_salt", F.pmod(F.xxhash64(*hashed), F.lit(SALTS)).cast("int"))
    salts = salted.filter(F.col(on).isNotNull()).groupBy(on).agg(F.collect_set("on_salt").alias("on_salts"))
    told = splittable_join(left, salts, on, "left")
    each = told.withColumn("on_salt", F.explode(F.coalesce("on_salts", F.array(F.lit(-1))))).drop("on_salts")
    return each.join(salted, [on, "on_salt"], "left").drop("on_salt")


def group_count(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_distinct(df: DataFrame, keys: list[str | Column], counted: str, name: str) -> DataFrame:
    """Exact distinct count. Spark first shuffles on keys plus value, which spreads a hot group."""
    return df.groupBy(*keys).agg(F.count_distinct(counted).alias(name))


def rounded_mean(amount: str) -> Column:
    """Mean of a decimal column to two places, half away from zero; NULL where no amount is known.

    Exact at the column's scale (up to 6 places): Spark's decimal mean is itself rounded, so rounding it
    again can be one cent off. Whole cents of the quotient come from an integer division, and what that
    leaves decides about one more.
    """
    n = F.nullif(F.count(amount), F.lit(0))
    total = F.sum(amount)
    scaled = F.abs(total) * 100
    cents = F.call_function("div", scaled, n)
    rest = scaled - (cents.cast("decimal(20,0)") * n.cast("decimal(12,0)")).cast("decimal(28,0)")
    magnitude = cents + F.when(rest * 2 >= n, 1).otherwise(0)
    return (F.signum(total).cast("int") * magnitude.cast("decimal(20,0)") / 100).cast("decimal(22,2)")


def amount_stats(amount: str) -> list[Column]:
    """Count, minimum, maximum, sum and rounded mean of one decimal column, for one ``agg`` call."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        F.sum(amount).alias("sum_amount"),
        rounded_mean(amount).alias("avg_amount"),
    ]


def null_extended_counts(parent: DataFrame, child: DataFrame, on: str) -> DataFrame:
    """For each row of ``parent`` the row count of ``parent LEFT JOIN child`` and the true matches.

    ``joined_rows`` counts an unmatched parent as 1, ``matches`` as 0. The child is counted before
    the join.
    """
    counted = group_count(child.filter(F.col(on).isNotNull()), on, name="matches")
    matches = F.coalesce("matches", F.lit(0))
    # ``on`` need not be unique in the parent, so a hot key there must stay splittable.
    return splittable_join(parent, counted, on, "left").select(
        *[F.col(name) for name in parent.columns],
        F.greatest(matches, F.lit(1)).alias("joined_rows"),
        matches.alias("matches"),
    )
