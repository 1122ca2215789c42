"""Key chains that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed

#: Pairs of rows that one cell of a grid joins, about.
CELL_PAIRS = 16_000_000
#: Parts that the rows beside a broadcast side are dealt over at most.
MAX_PARTS = 10_000
#: Rows of a key in a strip, about, and strips at most: each is a join of its own in the plan.
STRIP_ROWS = 500
MAX_STRIPS = 32
#: Rows of a strip from which on it is made of whole eights.
EVEN_ROWS = 64
#: Copies of rows that are always allowed.
MIN_COPIES = 1_000_000
#: Hot keys that every task is told, at most.
TOLD_KEYS = 10_000


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark, by its own size estimate and threshold, broadcasts ``df`` in a join."""
    return estimated_bytes(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def splittable_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join of an input aggregated by ``on`` with one in which a key may be hot.

    Adaptive execution splits a hot partition of a join only where both inputs come straight from
    a shuffle made for that join. Of an input that was just aggregated by ``on`` Spark would reuse
    the partitioning, leaving all rows of a hot key on the other side to one task. Joining on the
    key and a value computed from it asks for a partitioning of its own, so the split applies; each
    part of the hot key meets a copy of its one aggregated row.
    """
    # Equal values of different types hash differently, so both sides get the wider type first.
    kind = left.select(on).union(right.select(on)).schema[0].dataType

    def keyed(df: DataFrame) -> DataFrame:
        if df.schema[on].dataType != kind:
            df = df.withColumn(on, F.col(on).cast(kind))
        # One bit is enough, and costs next to nothing in a compressed shuffle.
        return df.withColumn("on_bit", F.pmod(F.hash(on), F.lit(2)))

    return keyed(left).join(keyed(right), [on, "on_bit"], how).drop("on_bit")


def roll_up(measures: DataFrame, link: DataFrame, on: str, to: str, many: bool = False) -> DataFrame:
    """Carry additive measures from key ``on`` to key ``to`` through a link table.

    ``measures`` has one row per ``on``; every other column is summed. Aggregating before each join
    of a chain lets a hot key cross the next shuffle as one row per task, and a fan-out through a
    non-key multiplies one summed row instead of all the rows behind it. ``many`` marks a link in
    which ``on`` is not unique.
    """
    pairs = link.select(on, to)
    joined = splittable_join(measures, pairs, on) if many else measures.join(pairs, on)
    return joined.groupBy(to).agg(*[F.sum(name).alias(name) for name in measures.columns if name != on])


def grid_join(left: DataFrame, right: DataFrame, on: str, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """Inner join that returns all pairs of keys that may be hot on both sides.

    A key with l rows here and r there makes l * r rows, so splitting one side leaves each part with all of the other. Keys with more
    than ``cell_pairs`` pairs are looked up by a job that runs now. The side with fewer rows of them is cut into strips of some
    STRIP_ROWS rows of a key, the rows of the other side are dealt to columns, and a strip makes about ``cell_pairs`` pairs in a
    column. The longer side is written once by its shuffle and read again for each strip; only the shorter one is copied, to each
    column. There are fewer columns where the copies would outnumber the rows of both sides, so what is written grows with the
    rows, not with their pairs. Rows come out in runs, a row of the longer side with its whole strip, which files hold compactly.

    Hot keys with no more than a strip on one side are not cut: these few rows are copied along a line of cells of about the square
    root of ``cell_pairs`` rows of the other side. No other key is copied. Strips, lines and columns come from the rows' values, so
    a task that runs again deals them alike; equal rows share them.

    Rows beside a side that Spark broadcasts are joined where they lie, which in a small file is one task, however many pairs they
    make. So rows of keys that are not cut are dealt evenly there to parts of about ``cell_pairs`` pairs, counted by a job that runs now.
    """
    strip = min(STRIP_ROWS, max(1, math.isqrt(cell_pairs)))
    left, right = left.where(F.col(on).isNotNull()), right.where(F.col(on).isNotNull())
    lefts, rights, pairs = _counted(left, right, on)
    hot = checkpointed(lefts.join(rights, on).where(pairs > cell_pairs))
    is_cut = F.least("lefts", "rights") > strip
    totals = {name: F.sum(F.when(is_cut, F.col(name))).alias(name) for name in ("lefts", "rights")}
    known = hot.agg(F.count(F.lit(1)).alias("hot"), F.count_if(is_cut).alias("cut"), *totals.values()).first()
    if known.hot <= TOLD_KEYS:
        hot = F.broadcast(hot)
    lined = hot.where(~is_cut) if known.cut < known.hot else None
    if not known.cut:
        return _lined_join(left, right, on, lined, cell_pairs)
    short, long = ("lefts", "rights") if known.lefts <= known.rights else ("rights", "lefts")
    strips = F.least(F.ceil(F.col(short) / strip), F.lit(MAX_STRIPS))
    cut = hot.where(is_cut).select(on, F.col(short).alias("grid_short"), F.col(long).alias("grid_long"), strips.alias("grid_strips"))
    others = [splittable_join(df, cut.select(on), on, "left_anti") for df in (left, right)]
    joined = _lined_join(*others, on, lined, cell_pairs)
    # Columns are named by place, since both sides may have names in common.
    sides = (left, right) if short == "lefts" else (right, left)
    names = [[f"{side}_{i}" for i in range(len(df.columns))] for side, df in zip(("short", "long"), sides)]
    first, second = names if short == "lefts" else names[::-1]
    key, again = first[left.columns.index(on)], second[right.columns.index(on)]
    for piece in _strips(*sides, on, cut, cell_pairs):
        joined = joined.union(piece.select(key, *(n for n in first if n != key), *(n for n in second if n != again)))
    return joined


def _counted(left: DataFrame, right: DataFrame, on: str) -> tuple[DataFrame, DataFrame, Column]:
    lefts = left.groupBy(on).agg(F.count(F.lit(1)).alias("lefts"))
    rights = right.groupBy(on).agg(F.count(F.lit(1)).alias("rights"))
    # As decimals, since two counts may have a product beyond 64 bits.
    return lefts, rights, F.col("lefts").cast("decimal(19,0)") * F.col("rights").cast("decimal(19,0)")


def _hash(df: DataFrame) -> Column:
    # Maps and variants have none.
    return F.xxhash64(*[f"`{name}`" for name, kind in df.dtypes if not ("map<" in kind or "variant" in kind)])


def _dealt_join(left: DataFrame, right: DataFrame, on: str, cell_pairs: int) -> DataFrame:
    if broadcastable(left) or broadcastable(right):
        lefts, rights, pairs = _counted(left, right, on)
        # Spark broadcasts the smaller side, the right one of equals.
        beside_left = estimated_bytes(left) < estimated_bytes(right)
        dealt = F.sum("rights" if beside_left else "lefts").alias("dealt")
        known = lefts.join(rights, on).agg(F.sum(pairs).alias("pairs"), dealt).first()
        parts = min(MAX_PARTS, int(known.dealt or 0), -(-int(known.pairs or 0) // cell_pairs))
        if parts > 1 and beside_left:
            right = right.repartition(parts)
        elif parts > 1:
            left = left.repartition(parts)
    return left.join(right, on)


def _lined_join(left: DataFrame, right: DataFrame, on: str, hot: DataFrame | None, cell_pairs: int) -> DataFrame:
    """The join of the hot keys that have few rows on one side, and of all that are not hot."""
    if hot is None or broadcastable(left) or broadcastable(right):
        return _dealt_join(left, right, on, cell_pairs)
    side = max(1, math.isqrt(cell_pairs))
    lines, columns = (F.ceil(F.col(name) / side).cast("int") for name in ("lefts", "rights"))
    grid = hot.select(on, lines.alias("grid_lines"), columns.alias("grid_columns"))

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        known = splittable_join(df, grid, on, "left")
        at = F.pmod(_hash(df), F.coalesce(f"grid_{own}s", F.lit(1))).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(f"grid_{other}s", F.lit(1)) - 1))
        return known.select(*[f"`{name}`" for name in df.columns], at.alias(f"grid_{own}"), copies.alias(f"grid_{other}"))

    cells = [on, "grid_line", "grid_column"]
    return placed(left, "line", "column").join(placed(right, "column", "line"), cells).drop("grid_line", "grid_column")


def _strips(short: DataFrame, long: DataFrame, on: str, cut: DataFrame, cell_pairs: int) -> list[DataFrame]:
    """A join for each strip of the keys in ``cut``, with columns named by their place in ``short`` and ``long``."""
    pairs = F.col("grid_short") * F.col("grid_long").cast("double")
    wanted = F.least(F.ceil(pairs / F.col("grid_strips") / cell_pairs), "grid_long")
    copies, rows = F.sum(F.col("grid_short") * wanted.cast("double")), F.sum(F.col("grid_short") + F.col("grid_long"))
    known = cut.agg(F.max("grid_strips").alias("strips"), copies.alias("copies"), rows.alias("rows")).first()
    fewer = max(1.0, known.copies / max(known["rows"], MIN_COPIES))
    grid = cut.select(on, "grid_strips", F.ceil(wanted / fewer).cast("int").alias("grid_columns"))
    parts = min(MAX_PARTS // (known.strips + 1), grid.agg(F.sum("grid_columns")).first()[0])

    def named(df: DataFrame, side: str) -> list[Column]:
        return [F.col(f"`{name}`").alias(f"{side}_{i}") for i, name in enumerate(df.columns)]

    short_key, long_key = f"short_{short.columns.index(on)}", f"long_{long.columns.index(on)}"
    strip = F.pmod(_hash(short), F.col("grid_strips")).cast("int").alias("strip")
    placed = splittable_join(short, grid, on).select(*named(short, "short"), strip, "grid_strips", "grid_columns")
    # Files pack values by eights, so a strip of whole eights repeats byte by byte: rows over go to a last strip of their key.
    same = Window.partitionBy(short_key, "strip")
    held = F.count(F.lit(1)).over(same)
    over = F.row_number().over(same.orderBy(short_key)) > held - F.when(held >= EVEN_ROWS, held % 8).otherwise(0)
    stored = checkpointed(placed.withColumn("strip", F.when(over, F.col("grid_strips")).otherwise(F.col("strip"))))
    column = F.pmod(_hash(long), F.col("grid_columns")).cast("int").alias("long_column")
    dealt = splittable_join(long, grid, on).select(*named(long, "long"), column).repartition(parts, long_key, "long_column")
    copied = F.explode(F.sequence(F.lit(0), F.col("grid_columns") - 1)).alias("short_column")
    met = (F.col(long_key) == F.col(short_key)) & (F.col("long_column") == F.col("short_column"))
    # The rows of the left side are read one by one, those of the right side are held for a key and a column.
    return [dealt.join(stored.where(F.col("strip") == i).select("*", copied), met) for i in range(known.strips + 1)]
