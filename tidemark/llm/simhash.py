"""SimHash fingerprints and their near pairs by a Gray-order hierarchical index."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free_names, slices, utf8, words_of
from tidemark.llm.graph import components
from tidemark.operators.skew import splittable_join
from tidemark.session import materialise

#: Fingerprints with equal bits in two of four 16-bit blocks form a bucket; larger ones take the flip path.
MAX_BUCKET = 512
BLOCKS = 4
#: Bits that each level of the index fixes, from the most significant down.
LEVELS = tuple(range(8, 65, 8))


def fingerprint(data: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of one text: bit set where over half of its shingles' XXH64 values have it."""
    words = words_of(data.lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    spans = list(zip(starts.tolist(), ends.tolist()))
    for first in range(0, len(spans), 1 << 14):
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans[first : first + (1 << 14)]], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, width: int = 3, keys: list[str] | None = None) -> DataFrame:
    """doc_id, ``fp`` (the 64 bits as a signed long) and further columns of longs."""
    names = ["doc_id", "fp", *(keys or [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [fingerprint(utf8(text.as_py()), width) for text in batch.column(1)]
            codes = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), codes, *batch.columns[2:]], names)

    rows = documents.select(F.col("doc_id").cast("long"), "text", *(keys or []))
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the reflected Gray sequence; codes with equal leading bits stay together."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints of many buckets, each in Gray order, under levels of nodes with shared leading bits.

    A node stands for a run of codes of one bucket that agree in its mask. A search goes down level by level
    for all queries at once, adds the differing bits of each level to what the path has, and leaves out a
    whole node once the sum passes ``distance``.
    """

    def __init__(self, bucket: np.ndarray, codes: np.ndarray):
        order = np.lexsort((gray_rank(codes), bucket))
        self.order, self.codes, self.bucket = order, codes[order], bucket[order]
        self.starts, self.masks = [], []
        size = len(codes)
        for bits in LEVELS:
            mask = np.uint64(((1 << bits) - 1) << (64 - bits))
            heads = np.ones(size, bool)
            heads[1:] = (self.bucket[1:] != self.bucket[:-1]) | ((self.codes[1:] ^ self.codes[:-1]) & mask != 0)
            self.starts.append(np.flatnonzero(heads))
            self.masks.append(mask)

    def pairs(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions (in index order) of codes of one bucket that differ in at most ``distance`` bits."""
        size = len(self.codes)
        heads = np.flatnonzero(np.concatenate(([True], self.bucket[1:] != self.bucket[:-1])))
        of = np.searchsorted(heads, np.arange(size), "right") - 1
        first = np.searchsorted(self.starts[0], heads)
        count = np.diff(np.append(first, len(self.starts[0])))
        for begin in range(0, size, 2_048):
            query = np.arange(begin, min(begin + 2_048, size))
            query, node = expand(query, first[of[query]], count[of[query]])
            spent = np.zeros(len(query), np.uint8)
            seen = np.uint64(0)
            for level, (starts, mask) in enumerate(zip(self.starts, self.masks)):
                differ = np.bitwise_count((self.codes[query] ^ self.codes[starts[node]]) & (mask ^ seen))
                spent = spent + differ
                keep = spent <= distance
                query, node, spent, seen = query[keep], node[keep], spent[keep], mask
                if level + 1 == len(self.starts):
                    yield query, starts[node]
                    break
                bounds = np.append(np.searchsorted(self.starts[level + 1], starts), len(self.starts[level + 1]))
                width = bounds[node + 1] - bounds[node]
                index = np.repeat(np.arange(len(query)), width)
                query, node = expand(query, bounds[node], width)
                spent = spent[index]


def expand(owner: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each owner beside first, first + 1, ... (count of them)."""
    total = int(count.sum())
    offset = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(owner, count), np.repeat(first, count) + offset


def _roots(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position linked with each position."""
    label = np.arange(size)
    links = [(a[a > b], b[a > b]) for a, b in pairs]
    a, b = (np.concatenate(x) for x in zip(*links)) if links else (label[:0], label[:0])
    while True:
        low = np.minimum(label[a], label[b])
        changed = label.copy()
        np.minimum.at(changed, label[a], low)
        np.minimum.at(changed, label[b], low)
        changed = changed[changed]
        if (changed == label).all():
            return label
        label = changed


def near_links(codes: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs of ``fp`` within ``distance`` <= 2 bits.

    Two codes at such a distance agree in two of four blocks, so each code goes to six buckets and a bucket's
    index finds its pairs; of a bucket only a star for each local component leaves the task. Buckets of over
    MAX_BUCKET codes are searched exactly and without pairs: codes at distance two or less share a value that
    is at most one flipped bit from either, and at most 65 codes can share one.
    """
    if not 0 <= distance <= 2:
        raise ValueError("blocks and flips are laid out for at most two differing bits")
    blocks = [((1 << 16) - 1) << (16 * b) for b in range(BLOCKS)]
    masks = [a | b for a, b in itertools.combinations(blocks, 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = codes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("combo", "value"))
    keyed = keyed.select("fp", F.struct("combo", "value").alias("bucket"))
    size = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A bucket may hold many codes, so its join may be split.
    shared = splittable_join(size, keyed, "bucket").select("bucket.*", "fp", "n")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def links(rows: pa.Table) -> pa.RecordBatch:
            combo, value, fp = (rows.column(i).to_numpy() for i in range(3))
            new = np.concatenate(([True], (combo[1:] != combo[:-1]) | (value[1:] != value[:-1])))
            index = GrayIndex(np.cumsum(new), np.ascontiguousarray(fp).view(np.uint64))
            root = _roots(len(fp), index.pairs(distance))
            sorted_fp = index.codes.view(np.int64)
            moved = root != np.arange(len(fp))
            return pa.RecordBatch.from_arrays([pa.array(sorted_fp[moved]), pa.array(sorted_fp[root[moved]])], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < 1 << 15:
                continue
            rows = pa.Table.from_batches(held)
            combo, value = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            last = np.flatnonzero((combo != combo[-1]) | (value != value[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield links(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
        if held and sum(x.num_rows for x in held):
            yield links(pa.Table.from_batches(held))

    small = (
        shared.where(F.col("n") <= MAX_BUCKET)
        .select("combo", "value", "fp")
        .repartition("combo", "value")
        .sortWithinPartitions("combo", "value")
        .mapInArrow(search, "a long, b long")
    )
    free = F.array(*[F.lit(0), *[F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b) for b in range(64)]]).cast("array<long>")
    value = F.col("fp").bitwiseXOR(F.col("flip"))
    flipped = (
        shared.where(F.col("n") > MAX_BUCKET)
        .select("fp")
        .distinct()
        .select("fp", F.explode(free).alias("flip"))
        .select("fp", value.alias("value"), F.when(F.col("flip") != 0, 1).otherwise(0).alias("cost"))
    )
    # A value within one bit of a hub: two codes of a group differ in at most the sum of their costs.
    grouped = flipped.groupBy("value").agg(F.collect_set(F.struct("cost", "fp")).alias("near")).where(F.size("near") > 1)
    first = F.array_min("near")
    large = grouped.select(first["fp"].alias("b"), F.explode("near").alias("x"), first["cost"].alias("c")).where(
        (F.col("x.fp") != F.col("b")) & (F.col("c") + F.col("x.cost") <= distance)
    )
    return small.unionByName(large.select(F.col("x.fp").alias("a"), "b"))


def near_duplicates(documents: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, ``fp`` and component_id, the smallest doc_id reachable over links of at most ``distance`` bits.

    A null or empty text has fingerprint zero and is linked like any other; equal texts and repeated rows have
    one fingerprint and so one component; a null doc_id keeps its row and never names a component while the
    component has another. Other columns of the input are not read. An empty table gives no rows.
    """
    spark = documents.sparkSession
    marked = materialise(spark, fingerprints(documents, width), "simhash")
    codes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    stars = components(spark, near_links(codes.select("fp"), distance))
    rooted = codes.join(stars.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    mapped = splittable_join(named, rooted, "root").select("fp", "component_id")
    return marked.join(mapped, "fp").select("doc_id", "fp", "component_id")


def keep_first(documents: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """One row, all columns, of each component: that of the smallest doc_id (null ids last, then by text hash).

    Of rows that agree in id and text one stays. Components are those of ``near_duplicates``.
    """
    spark = documents.sparkSession
    keys = [F.xxhash64(F.lit(salt), "doc_id", F.col("doc_id").isNull(), F.coalesce("text", F.lit(""))) for salt in (1, 2)]
    own = free_names(documents, "k", "l")
    keyed = documents.withColumns(dict(zip(own, keys)))
    marked = materialise(spark, fingerprints(keyed, width, own).withColumnsRenamed(dict(zip(own, "kl"))), "simhash")
    codes = marked.select("fp").distinct()
    stars = components(spark, near_links(codes, distance))
    rooted = codes.join(stars.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k", "l")
    # The first of each fingerprint, then of each component: hot fingerprints shrink before the join.
    first = marked.groupBy("fp").agg(F.min(order).alias("first"))
    kept = first.join(rooted, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.k", "first.l").toDF(*own)
    return keyed.join(kept, own, "left_semi").dropDuplicates(own).select(*[f"`{name}`" for name in documents.columns])


def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its fingerprint and its component of fingerprints at most two bits apart."""
    from tidemark.llm.common import table

    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
