"""Removal of repeated byte strings by two-stage suffix sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, utf8
from tidemark.llm.windows import Units, covered, kept_runs, marked_places, repeated, row_key, spans

LENGTH = 400
GRAM = 16


def smaller_than_next(letters: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one is not (the empty suffix is least)."""
    size = len(letters)
    step = np.zeros(size, np.int8)
    step[:-1] = np.sign(letters[1:].astype(np.int16) - letters[:-1])
    step[-1] = -1
    # Inside a run of one letter the end of the run decides.
    decided = np.where(step != 0, np.arange(size), size)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    return step[decided] > 0


def eights(data: bytes, depth: int) -> np.ndarray:
    """The eight bytes from every place on as a number that compares like them; beyond the end are zeros, ``depth`` bytes and more."""
    padded = data + bytes(depth + 16)
    return np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))


def sorted_places(data: bytes, places: np.ndarray, depth: int) -> np.ndarray:
    """Places by the ``depth`` bytes that follow, fewer at the end of the data, where the shorter of equal beginnings is less.

    Eight bytes are compared at a time, and only those places go on to the next eight that are still equal to a neighbour: no place's
    bytes are held, as these would be hundreds of times the data. Bytes beyond ``depth`` may be compared as well.
    """
    if not len(places):
        return places
    eight = eights(data, depth)
    # Every sort is stable, so of equal ones the shortest stays first.
    order = places[np.argsort(np.minimum(len(data) - places, depth), kind="stable")]
    order = order[np.argsort(eight[order].astype(np.uint64), kind="stable")]
    group = np.cumsum(np.diff(eight[order], prepend=eight[order[:1]]) != 0)
    active = np.arange(len(order))
    for step in range(8, depth, 8):
        equal = group[1:] == group[:-1]
        tied = np.concatenate((equal, [False])) | np.concatenate(([False], equal))
        active, group = active[tied], group[tied]
        if not len(active):
            break
        value = eight[order[active] + step].astype(np.uint64)
        same = group[1:] == group[:-1]
        fall = group[1:][same & (value[1:] < value[:-1])]
        if len(fall):
            # Groups that are in order already, as long repeats are, need no sort.
            wrong = np.zeros(group[-1] + 1, bool)
            wrong[fall] = True
            moved = np.flatnonzero(wrong[group])
            within = moved[np.lexsort((value[moved], group[moved]))]
            order[active[moved]] = order[active[within]]
            value[moved] = value[within]
        new = ~same | (value[1:] != value[:-1])
        group = np.cumsum(np.concatenate(([0], new)))
    return order


def suffix_order(data: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their suffixes' first ``depth`` bytes: the wanted ones and those their order rests on.

    Suffixes smaller than their successors are sorted directly. One larger than its successor is put, in a scan
    of the buckets by first byte, when the scan reaches the successor: in each bucket those come first, in the
    order of the scan, and the directly sorted ones follow. Ties beyond ``depth`` may stand in any order.
    """
    letters = np.frombuffer(data, np.uint8)
    size = len(letters)
    rising = smaller_than_next(letters)
    need = np.zeros(size + 1, bool)
    need[wanted] = True
    # A falling suffix needs its successor, and so on to the next rising one.
    fronts = wanted
    while len(fronts):
        fronts = fronts[~rising[fronts]] + 1
        fronts = fronts[~need[np.minimum(fronts, size)]]
        need[fronts] = True
        fronts = fronts[fronts < size]
    falling = need[:size] & ~rising
    direct = sorted_places(data, np.flatnonzero(need[:size] & rising), depth)
    bounds = np.searchsorted(letters[direct], np.arange(257)) if len(direct) else np.zeros(257, np.int64)
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []

    def before(places: np.ndarray) -> np.ndarray:
        found = places[places > 0] - 1
        return found[falling[found]]

    def enqueue(places: np.ndarray) -> None:
        heads = letters[places]
        order = np.argsort(heads, kind="stable")
        heads, places = heads[order], places[order]
        cuts = np.flatnonzero(np.diff(heads)) + 1
        for part in np.split(places, cuts):
            if len(part):
                waiting[letters[part[0]]].append(part)

    if need[size]:
        enqueue(before(np.array([size])))
    for head in range(256):
        wave = np.concatenate(waiting[head]) if waiting[head] else np.empty(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            earlier = before(wave)
            wave = earlier[letters[earlier] == head]
        bucket.append(direct[bounds[head] : bounds[head + 1]])
        done = np.concatenate(bucket)
        if len(done):
            out.append(done)
            earlier = before(done)
            enqueue(earlier[letters[earlier] > head])
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(data: bytes, order: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``order``, up to ``limit``."""
    eight = eights(data, limit)
    lengths = np.zeros(len(order), np.int64)
    active = np.arange(1, len(order))
    for step in range(0, limit, 8):
        left, right = eight[order[active - 1] + step], eight[order[active] + step]
        same = left == right
        ended = active[~same]
        differ = (left[~same] ^ right[~same]).astype(np.uint64)
        leading = np.zeros(len(ended), np.int64)
        for byte in range(1, 8):
            leading += differ < np.uint64(1 << (64 - 8 * byte))
        lengths[ended] = step + leading
        active = active[same]
        if not len(active):
            break
    lengths[active] = limit
    return np.minimum(lengths, limit)


def repeated_places(data: bytes, valid: np.ndarray, length: int, copies: np.ndarray | None = None) -> np.ndarray:
    """Valid places whose next ``length`` bytes start at another valid place too; a place may stand for several ``copies``."""
    order = suffix_order(data, valid, length)
    times = np.zeros(len(data) + 1, np.int64)
    times[valid] = 1 if copies is None else copies
    run = np.cumsum(common_prefixes(data, order, length) < length)
    count = np.bincount(run, weights=times[order])
    return order[(times[order] > 0) & (count[run] >= 2)]


def solver(length: int):
    """Runs of places in each segment whose strings come twice in the block; those of a segment with copies count twice."""

    def solve(items: list[dict]) -> list[tuple[list[tuple[int, int]], list[tuple[int, int]]]]:
        data = b"".join(item["data"] for item in items)
        base = np.concatenate(([0], np.cumsum([len(item["data"]) for item in items])))
        valid = np.concatenate([np.arange(item["windows"]) + start for item, start in zip(items, base.tolist())])
        copies = np.repeat([1 + item["again"] for item in items], [item["windows"] for item in items])
        marked = np.zeros(len(data), bool)
        marked[repeated_places(data, valid, length, copies)] = True
        out = []
        for item, start in zip(items, base.tolist()):
            runs = kept_runs(marked[start : start + item["windows"]])
            out.append(([(a, b - 1) for a, b in runs], []))
        return out

    return solve


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, t, spans): byte ranges that strings of ``length`` bytes cover which start anywhere else too."""
    units = Units("bytes", length, gram)
    several = F.col("n") > 1
    found = repeated(documents, units, several, several, solver(length))
    return spans(marked_places(found.places, found.solved), units)


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans, kept (binary) and kept_sha256 of every row of (doc_id, text).

    A byte is removed if a string of ``length`` bytes covers it that starts anywhere else as well, in the same
    document or another; every occurrence goes, overlapping ones too, and strings are judged on the input. What
    remains need not be UTF-8. A null text is empty; texts shorter than ``length`` lose nothing; a row that is
    repeated, id and text, counts as often as it stands. An empty table gives no rows; other columns are not read.
    """
    keyed = documents.select("doc_id", row_key(F.col("text")).alias("t"), "text")
    found = repeated_spans(keyed, length).withColumnsRenamed({"doc_id": "_doc", "t": "_t"})
    joined = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("t") == F.col("_t")), "left")
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in slices(batches, "text", 4 << 20):
            sizes, removed, cut, kept, digests = [], [], [], [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = utf8(text)
                runs = kept_runs(covered(ranges, len(data))) if ranges else []
                rest, last = [], 0
                for a, b in runs:
                    rest.append(data[last:a])
                    last = b
                rest = b"".join([*rest, data[last:]])
                sizes.append(len(data))
                removed.append(len(data) - len(rest))
                cut.append([{"start": a, "stop": b} for a, b in runs])
                kept.append(rest)
                digests.append(hashlib.sha256(rest).hexdigest())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(cut, kind)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary()), pa.array(digests)], names)

    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: int, stop: int>>, kept binary, kept_sha256 string"
    return joined.select(F.col("doc_id").cast("long"), "text", "spans").mapInArrow(run, schema)


def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the bytes that remain once each repeated string of 400 bytes is gone."""
    from tidemark.llm.common import table

    done = remove_repeats(table(spark, folder, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
