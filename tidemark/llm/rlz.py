"""Substring deduplication by relative Lempel-Ziv factors over anchored reference blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, free_names, slices, utf8
from tidemark.llm.windows import Units, covered, kept_runs, marked_places, repeated, row_key, spans

WORDS = 50
GRAM = 8


class ReferenceBlock:
    """Segments with one anchor gram, indexed outwards from it, in order of their documents."""

    def __init__(self, hashes: list[np.ndarray], offsets: list[int]):
        self.left_size, right = np.array(offsets), [len(h) - o for h, o in zip(hashes, offsets)]
        self.right_size = np.array(right)
        self.left = np.zeros((len(hashes), max(offsets) + 1), np.uint64)
        self.right = np.zeros((len(hashes), max(right) + 1), np.uint64)
        for row, (units, offset) in enumerate(zip(hashes, offsets)):
            self.left[row, :offset] = units[:offset][::-1]
            self.right[row, : len(units) - offset] = units[offset:]

    def reach(self, row: int, earlier: int) -> np.ndarray:
        """For every number of units left of the anchor, how far right the best earlier segment with these goes on."""

        def common(table: np.ndarray, size: np.ndarray) -> np.ndarray:
            differ = table[:earlier] != table[row]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])
            return np.minimum(first, np.minimum(size[:earlier], size[row]))

        best = np.full(self.left.shape[1] + 1, -1)
        np.maximum.at(best, common(self.left, self.left_size), common(self.right, self.right_size))
        return np.maximum.accumulate(best[::-1])[::-1]


def factor(reach: np.ndarray, offset: int, windows: int, width: int) -> list[tuple[int, int]]:
    """Greedy parse of one segment: runs of windows inside factors of at least ``width`` units.

    A factor is the longest match at its start. The next one is tried from the first window that crosses the
    factor's end, so that a window over a boundary is found where another reference holds it.
    """
    runs, place = [], 0
    while place < windows:
        right = int(reach[offset - place])
        length = offset - place + right if right >= 0 else 0
        if length >= width:
            last = min(place + length - width, windows - 1)
            runs.append((place, last))
            place = last + 1
        else:
            place += 1
    return runs


def solver(units: Units):
    """Factors of each segment against those of earlier documents, and of its later copies against it and these."""

    def solve(items: list[dict]) -> list[tuple[list[tuple[int, int]], list[tuple[int, int]]]]:
        out: list = [([], []) for _ in items]
        start = 0
        while start < len(items):
            stop, group = start, (items[start]["g"], items[start]["h"], items[start]["k"])
            while stop < len(items) and (items[stop]["g"], items[stop]["h"], items[stop]["k"]) == group:
                stop += 1
            # A null id comes after every other.
            order = sorted(range(start, stop), key=lambda i: (items[i]["doc_id"] is None, items[i]["doc_id"] or 0))
            hashes, offsets = [], []
            for i in order:
                data, _, _, units_of = units.load(items[i]["data"])
                hashes.append(units_of)
                offsets.append(int((units.grams(data, units_of).view(np.int64) == items[i]["h"]).argmax()))
            block = ReferenceBlock(hashes, offsets)
            earlier = 0
            for row, i in enumerate(order):
                if items[i]["doc_id"] != items[order[earlier]]["doc_id"]:
                    earlier = row
                runs, later = [], []
                if earlier:
                    runs = factor(block.reach(row, earlier), offsets[row], items[i]["windows"], units.width)
                if items[i]["again"]:
                    later = factor(block.reach(row, row + 1), offsets[row], items[i]["windows"], units.width)
                out[i] = runs, later
            start = stop
        return out

    return solve


def duplicate_spans(documents: DataFrame, width: int = WORDS, gram: int = GRAM) -> DataFrame:
    """(doc_id, t, spans): word ranges that windows of ``width`` words cover which start in a smaller doc_id too.

    ``documents`` has doc_id, t (``row_key`` of the text) and text. A row with a null doc_id is never a source
    and gives way to any other; rows of one doc_id are no sources for each other.
    """
    units = Units("words", width, gram)
    later = (F.col("source") < F.col("doc_id")) | (F.col("doc_id").isNull() & F.col("source").isNotNull())
    again = (F.col("most") > F.col("least")) | ((F.col("nulls") > 0) & F.col("least").isNotNull())
    found = repeated(documents, units, F.coalesce(again, F.lit(False)), later, solver(units))
    parsed = found.contents.select("h", "c", F.col("doc_id").alias("source")).join(found.solved, ["h", "c"])
    marks = marked_places(found.places, parsed).withColumn("runs", F.when(later, F.col("later")).otherwise(F.col("runs")))
    return spans(marks.where("runs IS NOT NULL"), units)


def remove_duplicates(documents: DataFrame, width: int = WORDS) -> DataFrame:
    """All columns, with ``text`` less the words of duplicate spans, and n_words, n_removed, spans, kept_sha256.

    A word is removed if a window of ``width`` consecutive words covers it whose words also start in a document
    with a smaller doc_id; windows are judged on the input. A text that loses nothing stays as it is; otherwise
    what stands from a removed run's first word to the next kept word goes. ``spans`` are ranges of word places,
    ``kept_sha256`` is of the kept words joined by one space. Null and empty texts, and those shorter than a
    window, lose nothing; a null text stays null. Columns of these names in the input are replaced.
    """
    added = ["n_words", "n_removed", "spans", "kept_sha256"]
    clean = documents.drop(*added)
    key, doc, t, marked = free_names(clean, "key", "doc", "t", "marked")
    keyed = clean.withColumn(key, row_key(F.col("text")))
    base = keyed.select("doc_id", F.col(key).alias("t"), "text")
    found = duplicate_spans(base, width).withColumnsRenamed({"doc_id": doc, "t": t, "spans": marked})
    joined = keyed.join(found, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(t)), "left")
    rows = joined.select(*[f"`{name}`" for name in clean.columns], marked)
    schema = extended(clean, "n_words long, n_removed long, spans array<struct<start: int, stop: int>>, kept_sha256 string")
    place = clean.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in slices(batches, "text", 4 << 20):
            texts, counts, removed, kept, digests = [], [], [], [], []
            marked = batch.column(len(batch.schema) - 1).to_pylist()
            for text, ranges in zip(batch.column(place).to_pylist(), marked):
                words = utf8(text).split()
                counts.append(len(words))
                if not ranges:
                    texts.append(text)
                    removed.append(0)
                    kept.append([])
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    continue
                gone = covered(ranges, len(words))
                runs = kept_runs(gone)
                digests.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist()) if not g])).hexdigest())
                texts.append(cut_words(utf8(text), runs).decode("utf-8", "surrogatepass"))
                removed.append(int(gone.sum()))
                kept.append([{"start": a, "stop": b} for a, b in runs])
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(texts, pa.string())
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, kind), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *added])

    return rows.mapInArrow(run, schema)


def cut_words(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The text without the words of ``runs``: each cut goes from a run's first word to the word after it."""
    letters = np.frombuffer(data, np.uint8)
    blank = (letters == 32) | ((letters >= 9) & (letters <= 13))
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    starts = np.append(starts, len(data))
    out, last = [], 0
    for a, b in runs:
        out.append(data[last : starts[a]])
        last = starts[b]
    out.append(data[last:])
    return b"".join(out)


def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that remain beside those of documents with smaller ids."""
    from tidemark.llm.common import table

    done = remove_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")
