"""Benchmark decontamination: pigeonhole piece hits, verified by Myers' bit-parallel edit distance."""

from __future__ import annotations

import functools
import math
import re
import warnings
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, slices
from tidemark.session import materialise

#: Edits allowed per character of an item, and the length below which an item must occur unchanged.
ERROR_RATE = 0.05
SHORT = 20
#: Characters of items that are broadcast and searched for together: an automaton takes some 45 bytes for each.
BLOCK_CHARS = 4 << 20

#: Items of fewer characters, and single words under SHORT, say too little to drop a document for.
LEAST = 5

NOT_WORD = re.compile(r"[\W_]+")
# Signs that carry meaning: no punctuation of sentences, or one between digits.
MEANT = re.compile(r"[^\w\s'’\-–.,;:!?\"“”„«»()…]|\d[^\w\s]\d")
ENDS = " .,;:!?…\"“”„«»'’"
# Scripts that write words without spaces between them, or endings straight behind them.
JOINED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
LEAKS = "array<struct<item_id: bigint, distance: int, budget: int, start: int, stop: int>>"


def plain(text: str | None) -> str:
    """Lower case, each run of anything but letters and digits as one space."""
    return NOT_WORD.sub(" ", (text or "").lower()).strip()


def signed(text: str | None) -> str:
    """Lower case with all signs, each run of white space as one space."""
    return " ".join((text or "").lower().split())


def item_form(text: str | None) -> tuple[str, bool]:
    """What is searched for, and whether with its signs: an item of mostly signs, or a short one whose signs carry meaning."""
    words, whole = plain(text), signed(text)
    whole = whole.strip(ENDS) or whole
    letters = sum(c.isalnum() for c in whole)
    if 2 * letters <= len(whole.replace(" ", "")) or (len(words) < SHORT and MEANT.search(whole)):
        return whole, True
    return words, False


def telling(text: str) -> bool:
    """Whether an item is long enough to drop documents that hold it."""
    return len(text) >= LEAST and (len(text) >= SHORT or " " in text or bool(JOINED.search(text)))


def whole_words(text: str, start: int, stop: int) -> bool:
    """Whether text[start:stop] begins and ends where words do."""
    for place in (start, stop):
        if 0 < place < len(text) and text[place - 1].isalnum() and text[place].isalnum() and not JOINED.search(text[place - 1 : place + 1]):
            return False
    return True


def budget(length: int, rate: float = ERROR_RATE) -> int:
    return 0 if length < SHORT else max(1, int(length * rate))


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """The text in errors + 1 consecutive parts of nearly one length, with their places: some part has no error."""
    cuts = [len(text) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Myers:
    """Edit distance of one pattern to the best substring that ends at each place of a text."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.full = (1 << self.size) - 1
        self.last = 1 << (self.size - 1)
        self.masks: dict[str, int] = defaultdict(int)
        for place, letter in enumerate(pattern):
            self.masks[letter] |= 1 << place

    def best(self, text: str) -> tuple[int, int]:
        """Least distance of the pattern to any substring, and where the first such substring ends."""
        get, full, last = self.masks.get, self.full, self.last
        positive, negative, score = full, 0, self.size
        least, end = score, 0
        for place, letter in enumerate(text):
            match = get(letter, 0)
            vertical = match | negative
            diagonal = (((match & positive) + positive) ^ positive) | match
            up = negative | (full & ~(diagonal | positive))
            down = positive & diagonal
            if up & last:
                score += 1
            elif down & last:
                score -= 1
            up, down = up << 1, down << 1
            positive = (down | ~(vertical | up)) & full
            negative = up & vertical & full
            if score < least:
                least, end = score, place + 1
        return least, end


class Matcher:
    """All items of a block, their pieces in one automaton."""

    def __init__(self, items: tuple[tuple[int | None, str], ...], rate: float):
        self.items = [(key, text, budget(len(text), rate)) for key, text in items]
        self.patterns: dict[int, tuple[Myers, Myers]] = {}
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, text, errors) in enumerate(self.items):
            for place, piece in pieces(text, errors):
                places[piece].append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def leaks(self, text: str) -> list[dict]:
        """Each item that occurs in the text within its budget: the place of least distance, the first of these."""
        if self.empty or not text:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (size, found) in self.automaton.iter(text):
            for number, place in found:
                starts[number].add(end + 1 - size - place)
        out = []
        for number, begun in sorted(starts.items()):
            key, item, errors = self.items[number]
            if not errors:
                start = next((x for x in sorted(begun) if whole_words(text, x, x + len(item))), None)
                if start is not None:
                    out.append({"item_id": key, "distance": 0, "budget": 0, "start": start, "stop": start + len(item)})
                continue
            if number not in self.patterns:
                self.patterns[number] = Myers(item), Myers(item[::-1])
            forward, backward = self.patterns[number]
            least, where, done = errors + 1, (0, 0), -1
            for start in sorted(begun):
                # An occurrence with this piece begins within the budget of where the piece says.
                low, high = max(0, start - errors), min(len(text), start + len(item) + errors)
                if low < done and high <= done:
                    continue
                distance, end = forward.best(text[low:high])
                done = high if distance == 0 else done
                if distance < least:
                    _, size = backward.best(text[low : low + end][::-1])
                    least, where = distance, (low + end - size, low + end)
            if least <= errors:
                out.append({"item_id": key, "distance": least, "budget": errors, "start": where[0], "stop": where[1]})
        return out


Items = tuple[tuple[int | None, str, bool], ...]


@functools.lru_cache(maxsize=1)
def matchers(items: Items, rate: float) -> tuple[Matcher, Matcher]:
    """One pair per worker process and block: items without signs, items with signs."""
    plain_items, signed_items = (tuple((key, text) for key, text, signs in items if signs == kind) for kind in (False, True))
    return Matcher(plain_items, rate), Matcher(signed_items, rate)


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[Items]:
    """The items (item_id, text) as ``item_form`` has them, in blocks of bounded size, one after the other."""
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * size / block_chars))
    keyed = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        rows = keyed.where(F.col("_block") == block).select("item_id", "text").collect() if size else []
        found = sorted({(row["item_id"], *item_form(row["text"])) for row in rows}, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
        found = tuple(item for item in found if item[1])
        if found:
            yield found


def with_leaks(documents: DataFrame, shared: Broadcast, rate: float = ERROR_RATE) -> DataFrame:
    """All columns, with ``leaks``: the items of one block, as broadcast, that the text holds (none: empty)."""
    clean = documents.drop("leaks")
    place = clean.columns.index("text")
    kind = pa.list_(
        pa.struct([("item_id", pa.int64()), *[(n, pa.int32()) for n in ("distance", "budget", "start", "stop")]])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, with_signs = matchers(shared.value, rate)
        for batch in slices(batches, "text"):
            texts = batch.column(place).to_pylist()
            found = [search.leaks(plain(text)) + ([] if with_signs.empty else with_signs.leaks(signed(text))) for text in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "leaks"])

    return clean.mapInArrow(run, extended(clean, f"leaks {LEAKS}"))


def contaminated(documents: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance, budget, start, stop for every document and item that it holds.

    An item occurs in a text if some part of the text is at most ``budget`` edits from it, both in lower case
    with runs of other characters as one space; start and stop count characters of that form. The budget is
    ``rate`` edits a character, at least one; items under SHORT characters must occur unchanged and as whole words.
    An item of mostly signs, or a short one whose signs carry meaning (2+2), is compared with its signs, in lower
    case with runs of white space as one space; start and stop then count characters of that form. The search
    loses no occurrence: of budget + 1 pieces one is free of errors. Items come in blocks of bounded size,
    each searched for in all documents. Null and empty texts and items match nothing; repeated rows are
    reported as often as they stand; empty tables give no rows.
    """
    spark, texts = documents.sparkSession, documents.select("doc_id", "text")
    parts, last = [], None
    for block in item_blocks(items):
        if last is not None:
            parts.append(_settled(*last, "leaks"))
        shared = spark.sparkContext.broadcast(block)
        leaks = with_leaks(texts, shared, rate).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
        last = leaks, shared
    if last is None:
        return spark.createDataFrame([], "doc_id long, item_id bigint, distance int, budget int, start int, stop int")
    return functools.reduce(DataFrame.unionByName, [*parts, last[0]])


def _settled(frame: DataFrame, shared: Broadcast, purpose: str) -> DataFrame:
    """The frame's rows from the shared folder, without the block of items that made them."""
    stored = materialise(frame.sparkSession, frame, purpose)
    shared.destroy()
    return stored


def remove_contaminated(documents: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The documents, all columns, whose text holds no item (as ``contaminated`` defines it).

    Items that say too little (under LEAST characters, single words under SHORT) drop none: a warning names them.
    Of several blocks of items one at a time is in memory, each over the documents that the last one left. A column
    ``leaks`` of the input is kept.
    """
    packed = F.struct(*[f"`{name}`" for name in documents.columns if name != "text"]).alias("row")
    kept, slight, shared = documents.select("text", packed), [], None
    for block in item_blocks(items):
        slight += [item for item in block if not telling(item[1])]
        if block := tuple(item for item in block if telling(item[1])):
            kept = _settled(kept, shared, "uncontaminated") if shared is not None else kept
            shared = documents.sparkSession.sparkContext.broadcast(block)
            kept = with_leaks(kept, shared, rate).where(F.size("leaks") == 0).drop("leaks")
    if slight:
        named = ", ".join(f"{key}: {text!r}" for key, text, _ in slight[:20])
        warnings.warn(f"{len(slight)} items are too short to drop documents for ({named})", stacklevel=2)
    return kept.select(*[F.col("text") if name == "text" else F.col(f"row.`{name}`").alias(name) for name in documents.columns])


def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds within the item's edit budget."""
    from tidemark.llm.common import table

    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
