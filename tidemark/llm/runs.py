"""Periodic runs of words: branching tandem repeats in an enhanced suffix array, rotated and merged into runs."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, slices, table, utf8

#: Bytes of text that a task searches together.
BATCH_BYTES = 2 << 20
#: Pairs of a suffix and its interval that are looked up together.
PAIRS = 1 << 20


class SuffixArray:
    """Suffixes of many texts in one array, by prefix doubling; no suffix of a text is compared with another text's.

    ``words`` are numbers that no two texts share, ``stops`` the end of the text that each word stands in. ``ranks[k]``
    tells apart the stretches of 2**k words (shorter ones at a text's end), the last level all suffixes; its
    last entry stands for the place behind all texts.
    """

    def __init__(self, words: np.ndarray, stops: np.ndarray):
        self.size = size = len(words)
        order = np.argsort(words, kind="stable").astype(np.int32)
        ordered = words[order]
        heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        counts = np.diff(np.append(heads, size))
        rank = np.full(size + 1, -1, np.int32)
        rank[order] = np.repeat(heads, counts)
        self.ranks = [rank]
        at = np.flatnonzero(np.repeat(counts > 1, counts))
        width = 1
        while len(at):
            place = order[at]
            after = np.minimum(place + width, size)
            second = np.where(after < stops[place], rank[after] + 1, 0)
            key = rank[place].astype(np.int64) << 32 | second
            by = np.argsort(key)
            place, key = place[by], key[by]
            order[at] = place
            fresh = np.concatenate(([True], key[1:] != key[:-1]))
            group = np.cumsum(fresh) - 1
            rank = rank.copy()
            rank[place] = at[fresh][group]
            self.ranks.append(rank)
            at = at[(np.bincount(group) > 1)[group]]
            width *= 2
        self.order, self.inverse = order, rank
        self.lcp = self._prefixes()

    def _prefixes(self) -> np.ndarray:
        """Words that each suffix shares with the one before it in the order."""
        lcp = np.zeros(self.size, np.int32)
        first = self.ranks[0]
        at = 1 + np.flatnonzero(first[self.order[1:]] == first[self.order[:-1]])
        left, right = self.order[at - 1].copy(), self.order[at].copy()
        for level in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[level]
            step = (rank[left] == rank[right]).astype(np.int32) << level
            left += step
            right += step
            lcp[at] += step
        return lcp

    def extend_left(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words before the places ``left`` and ``right`` are the same."""
        found = np.zeros(len(left), np.int32)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[level]
            a = left - found - (1 << level)
            same = (a >= 0) & (rank[np.maximum(a, 0)] == rank[np.maximum(right - found - (1 << level), 0)])
            found += same.astype(np.int32) << level
        return found


def children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Children of all intervals of common prefixes but the largest child of each.

    Arrays: first and one past the last place of a child in the order, the same of its interval, and the interval's depth.
    """
    size = len(lcp)
    values = array("i", lcp.tobytes())
    # Nearest places before and after with no longer a prefix, and the first border of the same interval.
    before, after, node = (array("i", bytes(4 * size)) for _ in range(3))
    places, depths = [0], [-1]
    for k, depth in enumerate(values):
        while depths[-1] > depth:
            after[places.pop()] = k
            depths.pop()
        last = before[k] = places[-1]
        if depths[-1] == depth:
            after[last] = k
            node[k] = node[last]
            places[-1] = k
        else:
            node[k] = k
            places.append(k)
            depths.append(depth)
    for k in places:
        after[k] = size
    before, after, node = (np.frombuffer(x, np.int32) for x in (before, after, node))
    borders = np.flatnonzero(lcp)
    last = np.zeros(size, np.int32)
    last[node[borders]] = borders
    tails = borders[last[node[borders]] == borders]
    low = np.concatenate((before[borders], tails))
    high = np.concatenate((borders, after[tails]))
    owner = np.concatenate((node[borders], node[tails]))
    sizes = high - low
    largest = np.zeros(size, np.int64)
    np.maximum.at(largest, owner, sizes)
    chosen = np.full(size, -1)
    ties = np.flatnonzero(sizes == largest[owner])
    chosen[owner[ties]] = ties
    small = np.flatnonzero(chosen[owner] != np.arange(len(owner)))
    owner = owner[small]
    return low[small], high[small], before[owner], after[last[owner]], lcp[owner]


def squares(suffixes: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and root lengths of all squares that the word behind them does not continue.

    A suffix of a smaller child of an interval of depth d starts such a square, or its second half, if the suffix d words
    further, or d words before, lies in the same interval but in another child.
    """
    low, high, first, end, depth = children(suffixes.lcp)
    sizes = (high - low).astype(np.int64)
    totals = np.cumsum(sizes)
    starts, lengths = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    done = 0
    while done < len(sizes):
        # At least one child, and as many as give about PAIRS suffixes.
        base = totals[done] - sizes[done]
        until = max(done + 1, int(np.searchsorted(totals, base + PAIRS)))
        part = slice(done, until)
        of = np.repeat(np.arange(done, until), sizes[part])
        within = np.arange(len(of)) - np.repeat(totals[part] - sizes[part] - base, sizes[part])
        place = suffixes.order[low[of] + within].astype(np.int64)
        step = depth[of]
        for other, start in ((place + step, place), (place - step, place - step)):
            inside = (other >= 0) & (other < suffixes.size)
            at = suffixes.inverse[np.where(inside, other, suffixes.size)]
            hit = inside & (at >= first[of]) & (at < end[of]) & ((at < low[of]) | (at >= high[of]))
            starts.append(start[hit])
            lengths.append(step[hit].astype(np.int64))
        done = until
    return np.concatenate(starts), np.concatenate(lengths)


def find_runs(words: np.ndarray, stops: np.ndarray, least_length: int = 6, least_periods: int = 4) -> np.ndarray:
    """Start, length and smallest period of all runs, one row each, by start and period."""
    if not len(words):
        return np.empty((0, 3), np.int64)
    suffixes = SuffixArray(words, stops)
    start, period = squares(suffixes)
    end = start + 2 * period
    start = start - suffixes.extend_left(start, start + period)
    length = end - start
    enough = (length >= least_length) & (length >= least_periods * period)
    found = np.stack((start, length, period), axis=1)[enough]
    # A run turns up with each multiple of its period that fits twice: the least one is the period.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[fresh]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _searched(texts: list[str | None], least_length: int, least_periods: int) -> tuple[list, list]:
    """Runs of each text, and each text without the words that only repeat a run's first period."""
    split = [utf8(text).split() for text in texts]
    counts = np.array([len(words) for words in split], np.int64)
    ends = np.cumsum(counts)
    begins = ends - counts
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for words, begin, end in zip(split, begins.tolist(), ends.tolist()):
        number = dict(zip(dict.fromkeys(words), range(begin, end)))
        flat[begin:end] = list(map(number.__getitem__, words))
    found = find_runs(flat, np.repeat(ends, counts), least_length, least_periods)
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    dropped = np.cumsum(change) > 0
    bounds = np.searchsorted(found[:, 0], np.append(begins, len(flat))).tolist()
    runs, kept = [], []
    for row, (words, begin, end) in enumerate(zip(split, begins.tolist(), ends.tolist())):
        own = found[bounds[row] : bounds[row + 1]] - (begin, 0, 0)
        runs.append([{"start": s, "length": n, "period": p} for s, n, p in own.tolist()])
        if len(own):
            words = [word for word, out in zip(words, dropped[begin:end].tolist()) if not out]
        kept.append(None if texts[row] is None else b" ".join(words).decode("utf-8", "surrogatepass"))
    return runs, kept


def collapse_runs(documents: DataFrame, text: str = "text", least_length: int = 6, least_periods: int = 4) -> DataFrame:
    """All columns, with ``runs``, and the text as its words joined by one blank, repetitions of a run's first period left out.

    A run is a stretch of words with smallest period q, ``least_length`` words and ``least_periods`` times q long or longer,
    that no neighbour extends; ``runs`` holds start (word number), length and period of each, by start and period.
    A null text stays null and an empty one empty, both without runs. Equal rows give equal results. An input column
    ``runs`` is replaced, all others are kept. A text is searched whole by one task at any length; that takes some
    4 bytes a word for each doubling up to its longest repeat, and 100 bytes a word besides.
    """
    frame = documents.drop("runs") if text != "runs" else documents
    schema = extended(frame, "runs array<struct<start: long, length: long, period: long>>")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, BATCH_BYTES):
            at = batch.schema.get_field_index(text)
            runs, kept = _searched(batch.column(at).to_pylist(), least_length, least_periods)
            columns = [pa.array(kept, pa.string()) if k == at else column for k, column in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(runs, kind)], [*batch.schema.names, "runs"])

    return frame.mapInArrow(run, schema)


def looped(text: Column, key: Column) -> Column:
    """Texts as they are, but every tenth by the key's checksum with its words from some place on in a loop."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", -1), "")
    checksum = F.crc32(key.cast("string").cast("binary"))
    count = F.size(words)
    drawn = F.floor(checksum / 10)
    start = F.when(count > 0, drawn % count).otherwise(0).cast("int")
    rest = count - start
    period = (1 + F.floor(rest / (3 + drawn % 8))).cast("int")
    loop = F.flatten(F.array_repeat(F.slice(words, start + 1, period), F.ceil(rest / period).cast("int")))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), start), F.slice(loop, F.lit(1), rest)), " ")
    return F.when((checksum % 10 == 0) & (count > 0), made).otherwise(text)


def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document, a tenth of which are made periodic first: their number, the strongest, and digests."""
    documents = table(spark, folder, "documents").select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text"))
    found = collapse_runs(documents)
    # Runs come by start and period, so the first of equal exponents stays.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"),
    )
