"""Windows of a fixed number of units (words or bytes) that occur more than once in a corpus.

Every window has one anchor: the leftmost of its smallest grams by hash, which depends on the window's content
alone. So two equal windows have equal anchors at equal offsets, and only places with equal anchors need to be
compared. The windows of one text that share an anchor are consecutive; the text from the first one's start to
the last one's end is a segment, of bounded length. Segments of one content are counted without their text and have one
representative, which stands for its copies too: contents that differ under one anchor, and a content with its copies, are
compared by the caller's method, in blocks of bounded groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, utf8, words_of
from tidemark.operators.skew import splittable_join
from tidemark.session import discard, materialise

#: Contents of one anchor that a block compares; anchors with more are narrowed down first.
MAX_CONTENTS = 1_000
#: Bytes of segments that one block holds.
BLOCK_BYTES = 1 << 20
#: Windows of one text that are held at a time.
PIECE = 1 << 18

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


@dataclass(frozen=True)
class Units:
    """How a text is cut: ``width`` units make a window, ``gram`` units an anchor."""

    kind: str
    width: int
    gram: int

    @property
    def class_sizes(self) -> list[int]:
        """Windows that one class of a crowded anchor holds, step by step; fewer than a window has units."""
        return sorted({max(1, self.width // 6), max(1, self.width // 48), 1}, reverse=True)

    def load(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Canonical bytes, where each unit starts and ends in them, and a hash of each unit."""
        if self.kind == "bytes":
            place = np.arange(len(text))
            return text, place, place + 1, np.frombuffer(text, np.uint8).astype(np.uint64)
        words = words_of(text)
        ends = np.cumsum([len(word) + 1 for word in words], dtype=np.int64) - 1
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(words) else ends
        digest = xxhash.xxh64_intdigest
        return b" ".join(words), starts, ends, np.array([digest(word) for word in words], np.uint64)

    def pieces(self, text: bytes) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
        """The text in pieces of PIECE windows at most: the first window's place, then what ``load`` gives.

        A run of windows with one anchor may be cut in two; each window is in one piece.
        """
        reach = PIECE + self.width - 1
        if self.kind == "bytes":
            for base in range(0, len(text) - self.width + 1, PIECE):
                yield base, *self.load(text[base : base + reach])
            return
        data, starts, ends, hashes = self.load(text)
        for base in range(0, len(starts) - self.width + 1, PIECE):
            part = slice(base, base + reach)
            yield base, data, starts[part], ends[part], hashes[part]

    def cutter(self, text: bytes) -> Callable[[int, int], bytes]:
        """The canonical bytes of units first to stop - 1."""
        if self.kind == "bytes":
            return lambda first, stop: text[first:stop]
        data, starts, ends, _ = self.load(text)
        return lambda first, stop: data[starts[first] : ends[stop - 1]]

    def grams(self, data: bytes, hashes: np.ndarray) -> np.ndarray:
        """A hash of the ``gram`` units from each place on."""
        count = len(hashes) - self.gram + 1
        if self.kind == "bytes":
            # Eight bytes from every place, without a copy.
            eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
            return _mixed(_mixed(eight[:count] * _MIX) + eight[self.gram - 8 :][:count])
        total = np.zeros(count, np.uint64)
        for offset in range(self.gram):
            total = total * _MIX + hashes[offset : offset + count]
        return _mixed(total)


def anchors(grams: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each anchor, and its place; a window has ``reach`` grams."""
    firsts, places = [], []
    windows = len(grams) - reach + 1
    for base in range(0, windows, 1 << 18):
        part = grams[base : base + (1 << 18) + reach - 1]
        # The place in the low bits lets the leftmost of equal hashes win.
        keys = (part >> np.uint64(20) << np.uint64(20)) | np.arange(len(part), dtype=np.uint64)
        padded = np.full(-(-len(keys) // reach) * reach, np.iinfo(np.uint64).max)
        padded[: len(keys)] = keys
        rows = padded.reshape(-1, reach)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(part) - reach + 1
        lowest = np.minimum(after[:count], before[reach - 1 : reach - 1 + count])
        at = (lowest & np.uint64((1 << 20) - 1)).astype(np.int64) + base
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        if places and places[-1][-1] == at[0]:
            first = first[1:]
        firsts.append(first + base)
        places.append(at[first] if len(first) else places[-1][-1:])
    first, place = np.concatenate(firsts), np.concatenate([p[: len(f)] for p, f in zip(places, firsts)])
    return first, np.append(first[1:], windows) - 1, place


def row_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def segments(documents: DataFrame, units: Units) -> DataFrame:
    """One row per anchor of every text: anchor hash h, content hash c, the row's keys, first window, windows."""

    names = ["h", "c", "doc_id", "t", "first", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = units.width - units.gram + 1
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches, "text", 4 << 20):
            out: list[list] = [[], [], [], [], []]
            held = 0

            def result() -> pa.RecordBatch:
                h, c, row, first, windows = (np.concatenate(x) for x in out)
                row = pa.array(row)
                keys = [batch.column(0).take(row), batch.column(1).take(row)]
                hashes = [pa.array(h.view(np.int64)), pa.array(c.view(np.int64))]
                numbers = [pa.array(x.astype(np.int32)) for x in (first, windows)]
                return pa.RecordBatch.from_arrays([*hashes, *keys, *numbers], names)

            for row in range(batch.num_rows):
                for base, data, starts, ends, hashes in units.pieces(utf8(batch.column(2)[row].as_py())):
                    grams = units.grams(data, hashes)
                    first, last, place = anchors(grams, reach)
                    begin, stop = starts[first].tolist(), ends[last + units.width - 1].tolist()
                    out[0].append(grams[place])
                    out[1].append(np.array([digest(data[a:b]) for a, b in zip(begin, stop)], np.uint64))
                    out[2].append(np.full(len(first), row))
                    out[3].append(first + base)
                    out[4].append(last - first + 1)
                    held += len(first)
                    if held >= PIECE:
                        yield result()
                        out, held = [[], [], [], [], []], 0
            if held:
                yield result()

    return documents.select("doc_id", "t", "text").mapInArrow(
        run, "h long, c long, doc_id long, t long, first int, windows int"
    )


TEXTS = pa.schema([
    ("h", pa.int64()), ("c", pa.int64()), ("doc_id", pa.int64()), ("windows", pa.int32()), ("data", pa.binary()),
    ("crowded", pa.bool_()), ("again", pa.bool_()),
])
RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
SOLVED = pa.schema([("h", pa.int64()), ("k", pa.int64()), ("c", pa.int64()), ("runs", RUNS), ("later", RUNS)])
#: What a solver gives for each item: runs of marked windows in the item, and in a later copy of it.
Solver = Callable[[list[dict]], list[tuple[list[tuple[int, int]], list[tuple[int, int]]]]]


def texts_of(documents: DataFrame, wanted: DataFrame, units: Units) -> DataFrame:
    """The bytes of the wanted segments (h, c, doc_id, t, first, windows, crowded, again), with all but t and first."""
    part = F.struct("h", "c", "first", "windows", "crowded", "again")
    lists = wanted.groupBy("doc_id", "t").agg(F.collect_list(part).alias("parts"))
    lists = lists.withColumnsRenamed({"doc_id": "_doc", "t": "_t"})
    joined = documents.join(lists, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("t") == F.col("_t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            out: list[list] = [[] for _ in TEXTS]
            for row in range(batch.num_rows):
                cut = units.cutter(utf8(batch.column(1)[row].as_py()))
                for part in batch.column(2)[row].as_py():
                    stop = part["first"] + part["windows"] + units.width - 1
                    out[0].append(part["h"])
                    out[1].append(part["c"])
                    out[2].append(batch.column(0)[row].as_py())
                    out[3].append(part["windows"])
                    out[4].append(cut(part["first"], stop))
                    out[5].append(part["crowded"])
                    out[6].append(part["again"])
            yield pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(out, TEXTS)], schema=TEXTS)

    return joined.select("doc_id", "text", "parts").mapInArrow(
        run, "h long, c long, doc_id long, windows int, data binary, crowded boolean, again boolean"
    )


def in_blocks(parts: DataFrame, solve: Solver) -> DataFrame:
    """Runs of windows (h, k, c, runs, later) that ``solve`` finds in blocks of items (g, h, k, c, doc_id, windows, data, again).

    A group g is never split. ``again`` items have copies that are not items of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def result() -> pa.RecordBatch:
            rows = [(x["h"], x["k"], x["c"], runs, later) for x, (runs, later) in zip(held, solve(held)) if runs or later]
            columns = list(zip(*rows)) if rows else [[] for _ in SOLVED]
            for at in (3, 4):
                columns[at] = [[{"a": a, "b": b} for a, b in found] for found in columns[at]]
            return pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(columns, SOLVED)], schema=SOLVED)

        for batch in batches:
            for item in batch.to_pylist():
                if size >= BLOCK_BYTES and item["g"] != held[-1]["g"]:
                    yield result()
                    held, size = [], 0
                held.append(item)
                size += len(item["data"])
        if held:
            yield result()

    ordered = parts.repartition("g").sortWithinPartitions("g", "h", "k", "doc_id", "c")
    runs = "array<struct<a: int, b: int>>"
    return ordered.mapInArrow(run, f"h long, k long, c long, runs {runs}, later {runs}")


def classes(parts: DataFrame, units: Units, size: int) -> DataFrame:
    """Runs a to b of ``size`` windows at most of every range of (h, c, doc_id, windows, data, ranges).

    Windows of one anchor are dealt to classes by the anchor's place in them. ``k`` is a hash of what all the
    windows of a class have in common, ``f`` of all that they cover: only runs of one k can share a window,
    and runs of one f share every window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                out: list[list] = [[], [], [], [], [], [], []]
                for item in batch.slice(start, 512).to_pylist():
                    data, starts, ends, hashes = units.load(item["data"])
                    offset = int((units.grams(data, hashes).view(np.int64) == item["h"]).argmax())
                    ranges = item["ranges"] or [{"a": 0, "b": item["windows"] - 1}]
                    for low, high in sorted({(r["a"], r["b"]) for r in ranges}):
                        for number in range((offset - high) // size, (offset - low) // size + 1):
                            # The windows whose anchor stands at number * size to number * size + size - 1.
                            first, last = offset - number * size - size + 1, offset - number * size
                            a, b = max(first, low), min(last, high)
                            common = data[starts[last] : ends[first + units.width - 1]]
                            whole = data[starts[a] : ends[b + units.width - 1]]
                            k, f = digest(common, number), digest(whole, a - first << 16 | b - first)
                            row = (item["h"], item["c"], item["doc_id"], a, b, k - (k >> 63 << 64), f - (f >> 63 << 64))
                            for column, value in zip(out, row):
                                column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                names = ["h", "c", "doc_id", "a", "b", "k", "f"]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds)], names)

    schema = "h long, c long, doc_id long, a int, b int, k long, f long"
    # Dealt out evenly: a crowded anchor may lie in one file.
    return parts.repartition("h", "c").select("h", "c", "doc_id", "windows", "data", "ranges").mapInArrow(run, schema)


def cut_out(parts: DataFrame, wanted: DataFrame, units: Units) -> DataFrame:
    """The wanted runs a to b (h, c, a, b, g, k, f, doc_id, again) of contents as items, each with its own text."""
    kept = ["g", "h", "k", "f", "doc_id", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts, counts = [], []
                for data, a, b in zip(*(part.column(at).to_pylist() for at in (6, 7, 8))):
                    data, starts, ends, _ = units.load(data)
                    texts.append(data[starts[a] : ends[b + units.width - 1]])
                    counts.append(b - a + 1)
                columns = [*part.columns[:6], pa.array(texts, pa.binary()), pa.array(counts, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["g", "h", "k", "c", "doc_id", "again", "data", "windows"])

    schema = "g long, h long, k long, c long, doc_id long, again boolean, data binary, windows int"
    return wanted.join(parts.select("h", "c", "data"), ["h", "c"]).select(*kept, "data", "a", "b").mapInArrow(run, schema)


def copies() -> list[Column]:
    """What is known of the rows of one content: their number, least and largest id, and how many have none."""
    return [F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count_if(F.col("doc_id").isNull()).alias("nulls")]


def narrowed(parts: DataFrame, units: Units, again: Column, done: Column, solve: Solver) -> DataFrame | None:
    """Runs of windows (h, c, runs) for anchors with too many contents; None where there are none.

    Contents are cut into classes of fewer and fewer windows, by what all windows of a class have in common: only these can be
    equal. Runs that agree in all they cover are one form from then on. A class of MAX_CONTENTS forms at most is a group
    for ``solve``; a larger one goes on to the next size, less the runs that are ``done`` as copies of a form, which the
    form alone decides. At size 1 a class has one form.
    """
    if parts.isEmpty():
        return None
    spark = parts.sparkSession
    marks, current = [], parts.withColumn("ranges", F.lit(None).cast("array<struct<a: int, b: int>>"))
    for size in units.class_sizes:
        runs = materialise(spark, classes(current, units, size).withColumn("form", F.struct("h", "k", "f")), "classes")
        place = F.struct(F.col("doc_id").isNull(), "doc_id", "c", "a", "b")
        same = runs.groupBy("form").agg(*copies(), F.min(place).alias("first")).withColumn("again", again)
        same = same.withColumn("class", F.struct("form.h", "form.k"))
        forms = same.groupBy("class").agg(F.count(F.lit(1)).alias("forms"))
        told = splittable_join(forms, same, "class").withColumn("open", F.col("forms") > MAX_CONTENTS)
        told = materialise(spark, told, "forms")
        group = F.when(F.col("open"), F.xxhash64("form")).otherwise(F.xxhash64("class")).alias("g")
        items = told.where("again OR (forms > 1 AND NOT open)").select("form.*", "first.*", "again", group)
        solved = in_blocks(cut_out(parts, items, units), solve).select(F.struct("h", "k", F.col("c").alias("f")).alias("form"), "runs", "later")
        known = splittable_join(told.select("form", "n", "open", "first", F.col("first.doc_id").alias("source")), solved, "form", "left")
        joined = materialise(spark, splittable_join(known, runs, "form"), "narrowed")
        is_done = F.coalesce(done, F.lit(False))
        found = F.when(is_done, F.coalesce(F.when(F.size("later") > 0, F.col("later")), F.col("runs"))).otherwise(F.col("runs"))
        shifted = F.explode(F.transform(found, lambda r: F.struct((F.col("a") + r["a"]).alias("a"), (F.col("a") + r["b"]).alias("b"))))
        marks.append(joined.select("h", "c", shifted.alias("r")))
        if size == 1:
            break
        # A copy is done; what stands for its form goes on against the others.
        stands = (F.col("c") == F.col("first.c")) & (F.col("a") == F.col("first.a"))
        ranges = joined.where(F.col("open") & (~is_done | stands)).groupBy("h", "c").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))
        ranges = materialise(spark, ranges, "ranges")
        if ranges.isEmpty():
            break
        current = parts.join(ranges, ["h", "c"])
    united = marks[0]
    for other in marks[1:]:
        united = united.unionByName(other)
    return united.groupBy("h", "c").agg(F.collect_set("r").alias("runs"))


@dataclass
class Repeated:
    """Segments whose anchor occurs at least twice, their contents, and the runs that the solver found in these."""

    places: DataFrame
    contents: DataFrame
    solved: DataFrame


def repeated(documents: DataFrame, units: Units, again: Column, done: Column, solve: Solver) -> Repeated:
    """``documents``: doc_id, t (``row_key``), text. Contents have their count and their smallest place.

    ``again`` tells of a content (n, least, most and number of null ids) whether its copies matter, ``done`` of a place beside
    its content (n, source) whether it is such a copy. Every marked window comes from ``solve``.
    """
    spark = documents.sparkSession
    found = materialise(spark, segments(documents, units), "segments")
    anchor = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), (F.min("c") != F.max("c")).alias("mixed"))
    places = materialise(spark, splittable_join(anchor.where("n > 1").drop("n"), found, "h"), "places")
    discard(found)
    # Nulls last: a null id is never the first place while there is another.
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "t", "first", "windows")
    contents = places.groupBy("h", "c").agg(*copies(), F.min(place).alias("p"), F.first("mixed").alias("mixed"))
    contents = contents.withColumn("again", again)
    contents = materialise(spark, contents.select("h", "c", "n", "mixed", "again", "p.doc_id", "p.t", "p.first", "p.windows"), "contents")
    compared = contents.where("mixed OR again")
    crowd = compared.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > MAX_CONTENTS)
    tagged = splittable_join(crowd, compared, "h", "right").withColumn("crowded", F.col("m").isNotNull())
    parts = materialise(spark, texts_of(documents, tagged, units), "parts")
    # Copies of a crowded anchor's contents are decided by each content alone, the rest by ever smaller classes.
    group = F.when(F.col("crowded"), F.xxhash64("h", "c")).otherwise(F.col("h"))
    items = parts.where("again OR NOT crowded").withColumns({"g": group, "k": F.lit(0).cast("long")}).drop("crowded")
    solved = in_blocks(items, solve).select("h", "c", "runs", "later")
    crowded = narrowed(parts.where("crowded"), units, again, done, solve)
    if crowded is not None:
        solved = solved.unionByName(crowded, allowMissingColumns=True)
    return Repeated(places, contents, solved)


def marked_places(places: DataFrame, contents: DataFrame) -> DataFrame:
    """Places beside what is known of their content; a content with many places is split."""
    bit = F.pmod(F.hash("h", "c"), F.lit(2))
    return places.withColumn("bit", bit).join(contents.withColumn("bit", bit), ["h", "c", "bit"])


def spans(marks: DataFrame, units: Units) -> DataFrame:
    """(doc_id, t, first, runs) as (doc_id, t, spans): unit ranges [start, stop) that marked windows cover."""
    each = marks.select("doc_id", "t", "first", F.explode("runs").alias("r"))
    span = F.struct(
        (F.col("first") + F.col("r.a")).alias("start"), (F.col("first") + F.col("r.b") + units.width).alias("stop")
    )
    return each.groupBy("doc_id", "t").agg(F.sort_array(F.collect_set(span)).alias("spans"))


def covered(ranges: list[dict] | None, size: int) -> np.ndarray:
    """Mask of the units inside any range."""
    steps = np.zeros(size + 1, np.int32)
    for item in ranges or ():
        steps[item["start"]] += 1
        steps[item["stop"]] -= 1
    return np.cumsum(steps[:-1]) > 0


def kept_runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [start, stop) where the mask is set."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))
