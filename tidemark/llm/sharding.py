"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_names

#: Rows that one local permutation should hold, and the largest matrix side that the driver draws.
ROWS_PER_CELL = 2_000
MAX_CELLS = 1_024
#: Copies of one row that a task numbers.
COPIES = 100_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Good items in ``sample`` draws without replacement.

    numpy's sampler takes populations below 10^9; beyond, the law is inverted from its mode outwards.
    """
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, sample)) if good + bad else 0
    low, high = max(0, sample - bad), min(sample, good)
    mode = min(max((sample + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    weight = math.exp(log_choose(good, mode) + log_choose(bad, sample - mode) - log_choose(good + bad, sample))
    left = right = mode
    weight_left = weight_right = weight
    u = rng.random() - weight
    while u > 0 and (left > low or right < high):
        if right < high:
            weight_right *= (good - right) * (sample - right) / ((right + 1) * (bad - sample + right + 1))
            right += 1
            u -= weight_right
            if u <= 0:
                return right
        if left > low:
            weight_left *= left * (bad - sample + left) / ((good - left + 1) * (sample - left + 1))
            left -= 1
            u -= weight_left
            if u <= 0:
                return left
    return mode


def communication_matrix(rows: list[int], columns: list[int], seed: int) -> list[list[int]]:
    """Counts with the given row and column sums, drawn as a uniform shuffle of all items would give them."""
    rng = np.random.default_rng(seed)
    remaining, matrix = list(columns), []
    for size in rows:
        drawn, wanted, rest = [], size, sum(remaining)
        for capacity in remaining:
            rest -= capacity
            count = hypergeometric(rng, capacity, rest, wanted) if wanted else 0
            drawn.append(count)
            wanted -= count
        remaining = [c - d for c, d in zip(remaining, drawn)]
        matrix.append(drawn)
    return matrix


def even_sizes(total: int, parts: int) -> list[int]:
    return [total // parts + (part < total % parts) for part in range(parts)]


def _relation(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A relation of at most MAX_CELLS rows out of driver values, without Python workers."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def numbered_copies(df: DataFrame) -> DataFrame:
    """All columns, with ``copy``: 0, 1, ... for rows that are equal in all columns, which must be comparable.

    Equal rows are counted before the shuffle and written out again in pieces, so one row with any number of copies is
    dealt over many tasks. A column of that name is replaced.
    """
    rows = df.drop("copy")
    names = [f"`{name}`" for name in rows.columns]
    [n] = free_names(rows, "n")
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias(n))
    pieces = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(COPIES).cast("long"))).alias("copy"))
    pieces = pieces.repartition(*names, "copy")
    last = F.least(F.col(n), F.col("copy") + COPIES) - 1
    return pieces.select(*names, F.explode(F.sequence("copy", last)).alias("copy"))


def shuffle_into_shards(df: DataFrame, identity: list[Column], shards: int = 24, seed: int = 20_240_501) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard) to every row.

    Shard sizes differ by one row at most; which rows go where is a uniform shuffle fixed by ``seed`` and the
    rows' ``identity``. Steps: rows are hashed to source cells and counted; the driver draws the exact cell by
    target matrix (sides bounded by MAX_CELLS); each cell permutes its rows and deals them out by its row of
    the matrix; each target permutes what it got. A target is a fixed part of a shard, so that no task orders
    a whole shard, and its first slot is known from the drawn sizes.
    Nulls count as values of their own, rows of one identity are interchangeable and share a cell (``numbered_copies``
    gives many copies identities of their own), an empty input gives no rows. Columns named ``shard`` or ``slot`` in the input
    are replaced, all others are kept.
    """
    spark, kept = df.sparkSession, df.drop("shard", "slot")
    # Own names for the input's columns while it is dealt out.
    places = {name: f"c{place}" for place, name in enumerate(kept.columns)}
    parts_of = {f"i{place}": column for place, column in enumerate(identity)}
    hashed = df.select(
        *[F.col(f"`{name}`").alias(place) for name, place in places.items()],
        *[column.alias(place) for place, column in parts_of.items()],
        F.xxhash64(F.lit(seed), *identity, *[c.isNull() for c in identity]).alias("_h"),
    )
    total = hashed.count()
    cells = min(max(1, math.ceil(total / ROWS_PER_CELL)), MAX_CELLS)
    parts = min(max(1, math.ceil(total / shards / ROWS_PER_CELL)), max(1, MAX_CELLS // shards))
    hashed = hashed.withColumn("_cell", F.pmod("_h", F.lit(cells)).cast("int"))
    counted = {row["_cell"]: row["count"] for row in hashed.groupBy("_cell").count().collect()}
    rows = [counted.get(cell, 0) for cell in range(cells)]
    targets = [size for whole in even_sizes(sum(rows), shards) for size in even_sizes(whole, parts)]
    bounds = [[cell, np.cumsum(drawn).tolist()] for cell, drawn in enumerate(communication_matrix(rows, targets, seed))]
    starts = [[part, int(sum(targets[part // parts * parts : part]))] for part in range(len(targets))]

    def permuted(partition: str, salt: int) -> Column:
        order = [F.xxhash64(F.lit(seed + salt), "_h"), F.col("_h"), *parts_of]
        return F.row_number().over(Window.partitionBy(partition).orderBy(*order)).cast("long") - 1

    def as_objects(pairs: list, names: tuple[str, str]) -> list[dict]:
        return [dict(zip(names, pair)) for pair in pairs]

    matrix = _relation(spark, as_objects(bounds, ("_cell", "_ends")), "_cell: int, _ends: array<bigint>")
    offsets = _relation(spark, as_objects(starts, ("_target", "_start")), "_target: int, _start: bigint")
    # The number of ends up to a rank, by halving steps.
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(targets).bit_length()))])
    rank = F.col("_r")

    def further(at: Column, step: Column) -> Column:
        return F.when((at + step <= len(targets)) & (F.get("_ends", at + step - 1) <= rank), at + step).otherwise(at)

    dealt = (
        hashed.withColumn("_r", permuted("_cell", 1))
        .join(F.broadcast(matrix), "_cell")
        .withColumn("_target", F.reduce(steps, F.lit(0), further))
        .drop("_ends", "_r", "_cell")
    )
    return (
        dealt.withColumn("_r", permuted("_target", 2))
        .join(F.broadcast(offsets), "_target")
        .withColumn("shard", F.floor(F.col("_target") / parts).cast("int"))
        .withColumn("slot", F.col("_start") + F.col("_r"))
        .select(*[F.col(place).alias(name) for name, place in places.items()], "shard", "slot")
    )


def op5(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most; texts are hashed, not moved."""
    from tidemark.llm.common import table

    octets = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(octets) + 8).cast("long").alias("size"),
        F.crc32(octets).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"),
    )
    rows = numbered_copies(rows)
    return shuffle_into_shards(rows, [F.col(name) for name in rows.columns]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
