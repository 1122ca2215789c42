"""Conversations from event logs: streamed pieces, edits and regenerations folded into messages, then a chat template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table

#: Message numbers that one task folds and renders together, as a power of two, and characters of a rendered piece.
BLOCK_BITS = 8
PIECE_CHARS = 4 << 20

# The template's control strings. Assistant texts alone are learned from.
MARKS = {
    "system": ("<<SYS>> ", " <</SYS>>\n"),
    "user": ("[INST] ", " [/INST]\n"),
    "assistant": ("<s> ", " </s>\n"),
}
OTHER = ("<<ROLE>> ", " <<TEXT>> ", " <</ROLE>>\n")
LEARNED = "assistant"
#: Control strings without the sign they begin with.
CONTROLS = r"s>|/s>|/?INST\]|</?SYS>>|</?ROLE>>|<TEXT>>"
ESCAPED = re.compile(rf"([<\[])\\(\\*(?:{CONTROLS}))")
CONTROL = re.compile(rf"([<\[])(\\*(?:{CONTROLS}))")


def escape(text: str) -> str:
    """Control strings get a backslash behind their first sign, and so do those that have some there already."""
    return CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def render(messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(role, text) messages in the template, and where the learned texts stand in it (code points)."""
    out: list[str] = []
    mask, size = [], 0
    for role, text in messages:
        if role in MARKS:
            begin, end = MARKS[role]
        else:
            begin, end = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
        body = escape(text)
        if role == LEARNED:
            mask.append((size + len(begin), size + len(begin) + len(body)))
        out += (begin, body, end)
        size += len(begin) + len(body) + len(end)
    return "".join(out), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) messages that ``render`` was given."""
    messages, at = [], 0
    while at < len(formatted):
        for role, (begin, end) in MARKS.items():
            if formatted.startswith(begin, at):
                start = at + len(begin)
                break
        else:
            if not formatted.startswith(OTHER[0], at):
                raise ValueError(f"no message begins at {at}")
            start = formatted.index(OTHER[1], at + len(OTHER[0]))
            role, end = unescape(formatted[at + len(OTHER[0]) : start]), OTHER[2]
            start += len(OTHER[1])
        stop = formatted.index(end, start)
        messages.append((role, unescape(formatted[start:stop])))
        at = stop + len(end)
    return messages


class Fold:
    """Messages of one block of a conversation, from its events by message number and then by sequence."""

    def __init__(self, floor: int | None):
        #: The last sequence number at which this or an earlier message was generated anew.
        self.floor = floor
        self.number: int | None = None
        self.messages: list[tuple[str, list[str]]] = []
        self.here = 0
        self.chars = 0

    def add(self, number: int, seq: int, kind: str, role: str, text: str) -> None:
        if number != self.number:
            self.number, self.here = number, 0
        if kind == "regenerate":
            self.floor = seq if self.floor is None else max(self.floor, seq)
            return
        if self.floor is not None and seq < self.floor:
            return
        self.chars += len(text)
        if kind == "message" or not self.here:
            self.messages.append((role, [text]))
            self.here += 1
        elif kind == "delta":
            self.messages[-1][1].append(text)
        else:
            old, parts = self.messages[-1]
            self.messages[-1] = (role or old, [text])

    def take(self) -> list[tuple[str, str]]:
        """The messages so far, which no later event changes; they are forgotten."""
        done = [(role, "".join(parts)) for role, parts in self.messages]
        self.messages, self.here, self.chars = [], 0, 0
        return done


PIECE = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("piece", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
PIECE_DDL = "conv_id long, block long, piece long, n_turns long, formatted string, mask array<struct<start: long, end: long>>"


def _rendered(batches: Iterator[pa.RecordBatch], piece_chars: int) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations from events that come by conversation, block, message and sequence."""
    state: Fold | None = None
    key, piece = None, 0
    rows: list[tuple] = []
    held = 0

    def flush() -> None:
        nonlocal piece, held
        if messages := state.take():
            formatted, mask = render(messages)
            rows.append((*key, piece, len(messages), formatted, [{"start": a, "end": b} for a, b in mask]))
            piece += 1
            held += len(formatted)

    def ready() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), PIECE)], schema=PIECE)

    for batch in batches:
        for conv, block, number, seq, rank, kind, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if state is None or (conv, block) != key:
                if state is not None:
                    flush()
                key, piece, state = (conv, block), 0, Fold(None)
            if rank == 0:
                state.floor = seq
                continue
            # Only events of the same number change the message before; a message more closes it.
            if state.chars >= piece_chars and (number != state.number or kind == "message"):
                flush()
            state.add(number, seq, kind, role, text)
            if rows and held >= piece_chars:
                yield ready()
                rows, held = [], 0
    if state is not None:
        flush()
    if rows:
        yield ready()


def format_conversations(events: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Conversations in the template, in pieces of ``piece_chars`` and one message more at most, from a log of events.

    ``events``: conv_id, message (its number in the conversation), seq (order of events), kind, role, text. Kinds:
    ``message`` opens a message (several of one number stand side by side in order of seq), ``delta`` appends to it,
    ``edit`` replaces its text (and its role, if given), ``regenerate`` drops it and all later messages as far as they were
    written before. A delta or edit without a message opens one. Other kinds are an error, a null kind is a message.

    Result: conv_id, block, piece (a conversation's pieces in order of both, most have one), n_turns, formatted, and
    mask, the spans of assistant texts in code points. ``parse`` gives the messages back. Null texts and roles are
    empty, null numbers come first, null conversations are one conversation. Events of the same message, seq and
    kind come by role and text; repeated rows count each. Further columns are left out. An empty log has no pieces.

    A block is 256 message numbers, so a hot conversation is folded by many tasks; what a regeneration in one block drops in later
    ones is carried by a running maximum over the blocks. Texts of one message meet in one task, as it is one string.
    """
    lowest = F.lit(-(2**63)).cast("long")
    log = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("message").cast("long"), lowest).alias("message"),
        F.coalesce(F.col("seq").cast("long"), lowest).alias("seq"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    log = log.withColumn("block", F.shiftright("message", BLOCK_BITS))
    kinds = F.when(F.col("kind") == "regenerate", 1).when(F.col("kind") == "message", 2).when(F.col("kind") == "edit", 3)
    kinds = kinds.when(F.col("kind") == "delta", 4).otherwise(F.raise_error(F.concat(F.lit("unknown kind of event: "), "kind")).cast("int"))
    log = log.withColumn("rank", kinds)

    blocks = log.groupBy("conv_id", "block").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("latest"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    floors = blocks.select("conv_id", "block", F.max("latest").over(earlier).alias("seq")).where("seq is not null")
    floors = floors.select("*", lowest.alias("message"), F.lit("floor").alias("kind"), F.lit(0).alias("rank"), F.lit("").alias("role"), F.lit("").alias("text"))

    columns = ["conv_id", "block", "message", "seq", "rank", "kind", "role", "text"]
    # Floors first, and of each message its regenerations.
    order = ["conv_id", "block", F.col("rank") != 0, "message", F.col("rank") != 1, "seq", "rank", "role", "text"]
    dealt = log.select(columns).unionByName(floors.select(columns)).repartition("conv_id", "block")
    return dealt.sortWithinPartitions(*order).mapInArrow(partial(_rendered, piece_chars=piece_chars), PIECE_DDL)


READ = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("piece", pa.int64()), ("n_turns", pa.int64()), ("turns", pa.binary()),
    ("learned", pa.binary()), ("loss_chars", pa.int64()), ("formatted_chars", pa.int64()),
])


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the turns and of what the mask covers, for each piece."""
    for batch in batches:
        rows = []
        for conv, block, piece, _, formatted, mask in zip(*(column.to_pylist() for column in batch.columns)):
            messages = parse(formatted)
            learned = "".join([unescape(formatted[span["start"] : span["end"]]) for span in mask])
            turns = "".join([f"{role}\n{text}\n" for role, text in messages])
            rows.append((conv, block, piece, len(messages), turns.encode(), learned.encode(), len(learned), len(formatted)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), READ)], schema=READ)


DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation; its pieces come one after another."""
    key, started, rows = None, False, []

    def close() -> None:
        rows.append((key, counts[0], turns.hexdigest(), counts[1], learned.hexdigest(), counts[2]))

    for batch in batches:
        for conv, _, _, n, said, taught, loss_chars, chars in zip(*(column.to_pylist() for column in batch.columns)):
            if not started or conv != key:
                if started:
                    close()
                key, started, counts, turns, learned = conv, True, [0, 0, 0], hashlib.sha256(), hashlib.sha256()
            turns.update(said)
            learned.update(taught)
            counts = [counts[0] + n, counts[1] + loss_chars, counts[2] + chars]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), DIGESTS)], schema=DIGESTS)
            rows.clear()
    if started:
        close()
        yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), DIGESTS)], schema=DIGESTS)


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from its pieces: turns, digests of them and of the learned text, and sizes.

    Pieces are read by many tasks. A digest is a chain over a conversation's bytes, so one task takes the
    bytes of a conversation in order, a piece at a time.
    """
    ddl = "conv_id long, block long, piece long, n_turns long, turns binary, learned binary, loss_chars long, formatted_chars long"
    read = pieces.mapInArrow(_read_back, ddl).repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece")
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return read.mapInArrow(_digests, ddl)


#: A conversation that says control strings.
PROBE = "</s>[INST] ok [/INST]"


def op11(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, each row an event that opens a message, and one that says control strings."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = F.explode(F.array(*[F.struct(F.lit(k).alias("turn"), F.lit(role).alias("role")) for k, role in enumerate(("user", "assistant"))]))
    probes = spark.range(1).select(probe.alias("row")).select(F.lit(-7).alias("conv_id"), "row.*", F.lit(PROBE).alias("text"))
    said = rows.unionByName(probes)
    events = said.select("conv_id", F.col("turn").alias("message"), F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text")
    return digests(format_conversations(events))


OP11_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*(s>|/s>|/?INST\]|</?SYS>>|</?ROLE>>|<TEXT>>))', '\1\\\2', 'g'))
    + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 10
      ELSE 30 + length(regexp_replace(role, '([<\[])(\\*(s>|/s>|/?INST\]|</?SYS>>|</?ROLE>>|<TEXT>>))', '\1\\\2', 'g')) END AS chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
