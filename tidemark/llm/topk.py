"""Exact top-k inner products: tiles of queries times tiles of candidates, merged as a tree."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERY_TILE = 1_024
CANDIDATE_TILE = 8_192
#: Partial lists that one step of the merge tree takes together.
FAN_IN = 16


def scaled(vector: Column, scale: int = 1_024) -> Column:
    """floor(scale * x) of every component, as whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def products(queries: np.ndarray, candidates: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Exact integer matrix product, zero where not allowed: in floating point while every sum is below 2^53."""
    if not queries.shape[1]:
        return np.zeros(allowed.shape, np.int64)
    left, right = queries.astype(np.float64), candidates.T.astype(np.float64)
    if queries.shape[1] * np.abs(left).max() * np.abs(right).max() < 2**53:
        return np.where(allowed, np.rint(left @ right).astype(np.int64), 0)
    # Rounding can only matter where the sum of magnitudes is next to the limit itself.
    if (allowed & (np.abs(left) @ np.abs(right) >= 2.0**63 * (1 - 1e-12))).any():
        raise OverflowError("inner products of these vectors leave 64 bits")
    return np.where(allowed, queries @ candidates.T, 0)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the columns of its k highest allowed scores; columns stand in order of preference."""
    width = scores.shape[1]
    if scores.size and int(np.abs(scores).max()) < 2**62 // width:
        keys = scores * width + np.arange(width - 1, -1, -1)
        keys[~allowed] = np.iinfo(np.int64).min
        top = np.argpartition(-(keys + 1), min(k, width) - 1, axis=1)[:, :k] if k < width else np.tile(np.arange(width), (len(scores), 1))
        for row, columns in enumerate(top):
            yield row, columns[allowed[row, columns]]
        return
    for row in range(len(scores)):
        columns = np.flatnonzero(allowed[row])
        yield row, columns[np.argsort(-scores[row, columns], kind="stable")[:k]]


def _matrix(tile: pa.StructArray | pa.ListArray, row: int) -> tuple[np.ndarray, np.ndarray]:
    items = tile[row].values
    ids = items.field("id").to_numpy(zero_copy_only=False)
    vectors = items.field("v")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.reshape(len(ids), -1)[order]


def exact_top_k(vectors: DataFrame, is_query: Column, k: int, query_tile: int = QUERY_TILE, candidate_tile: int = CANDIDATE_TILE) -> DataFrame:
    """For each query row the k rows of highest inner product, ties to the smaller id.

    ``vectors`` has ``id`` (long) and ``v`` (array of long); the result is query_id, rank, id, score. Rows with
    a null id or vector take no part; only vectors of one length are compared. Of rows that repeat a query's id
    none is its candidate, and the smallest vector of that id is the query. Tiles have a bounded number of rows,
    every query tile meets every candidate tile of its length once, and partial lists of k are merged in groups.
    An empty table gives an empty result.
    """
    rows = vectors.where("id IS NOT NULL AND v IS NOT NULL").withColumn("dim", F.size("v"))
    queries = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    shards = max(1, math.ceil(sizes["n"] / candidate_tile))
    blocks = max(1, math.ceil(sizes["q"] / query_tile))

    def tiles(frame: DataFrame, name: str, key: Column) -> DataFrame:
        return frame.withColumn(name, key.cast("int")).groupBy("dim", name).agg(
            F.collect_list(F.struct("id", "v")).alias(f"{name}_rows")
        )

    query_tiles = tiles(queries, "block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    # Not by id alone: copies of one id must not meet in one tile.
    shard_tiles = tiles(rows, "shard", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards)))
    pairs = query_tiles.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(
        shard_tiles, ["dim", "shard"]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                query_ids, query_rows = _matrix(batch.column(0), row)
                ids, candidates = _matrix(batch.column(1), row)
                out = [[], [], []]
                for start in range(0, len(query_ids), 256):
                    some = slice(start, start + 256)
                    allowed = query_ids[some, None] != ids[None, :]
                    scores = products(query_rows[some], candidates, allowed)
                    for i, columns in best(scores, allowed, k):
                        out[0].append(np.full(len(columns), query_ids[start + i]))
                        out[1].append(ids[columns])
                        out[2].append(scores[i, columns])
                found = [np.concatenate(x).astype(np.int64) for x in out]
                part = np.full(len(found[0]), batch.column(2)[row].as_py(), np.int32)
                yield pa.RecordBatch.from_arrays([*map(pa.array, found), pa.array(part)], ["query_id", "id", "score", "part"])

    lists = pairs.select("block_rows", "shard_rows", "shard").mapInArrow(score, "query_id long, id long, score long, part int")
    parts = shards
    while True:
        parts = math.ceil(parts / FAN_IN)
        last = parts == 1
        keys = ["query_id"] if last else ["query_id", "part"]
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
        lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if last:
            return lists.select("query_id", "rank", "id", "score")


def op3(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 best candidates of each embedding whose vec_id is divisible by 100, among all rows."""
    from tidemark.llm.common import table

    rows = table(spark, folder, "embeddings").where(usable(F.col("embedding")))
    found = exact_top_k(rows.select(F.col("vec_id").alias("id"), scaled(F.col("embedding")).alias("v")), F.col("id") % 100 == 0, 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP3_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
