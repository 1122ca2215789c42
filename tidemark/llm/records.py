"""Length-delimited binary records with masked checksums and an offset index, written and read by Spark tasks.

A record is the payload's length (8 bytes), its masked checksum (4), the payload, and the payload's masked
checksum (4), all little-endian. The checksum is CRC-32, rotated right by 15 bits plus a constant, so that a
checksum over data that hold checksums stays telling. A payload is a flag byte (1: the id is null), the id
(8 bytes), the bytes of one token id (2 or 4), and the token ids. Beside each data file lies an index of
fixed-size entries (offset, length, tokens, first token in the file), and ``manifest.json`` names the files
of a folder in order.
"""

from __future__ import annotations

import functools
import json
import operator
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidemark.llm.bpe import byte_letters
from tidemark.llm.common import slices
from tidemark.session import scratch_dir

# Fixed value of the masking rule.
MASK = 0xA282EAD8
ENTRY = np.dtype([("offset", "<u8"), ("length", "<u4"), ("tokens", "<u4"), ("first", "<u8")])
HEADER = np.dtype([("length", "<u8"), ("check", "<u4")])
PREFIX = 10
#: A data file is closed once it has this many bytes; a reader's task takes this many records.
FILE_BYTES = 128 << 20
READ_RECORDS = 4_096
MAX_READERS = 10_000


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join((length, masked(length).to_bytes(4, "little"), payload, masked(payload).to_bytes(4, "little")))


def unframe(data: bytes) -> bytes:
    """The payload of one record; a damaged record is an error."""
    length = data[:8]
    payload = data[12:-4]
    if masked(length) != int.from_bytes(data[8:12], "little") or int.from_bytes(length, "little") != len(payload):
        raise ValueError("damaged record length")
    if masked(payload) != int.from_bytes(data[-4:], "little"):
        raise ValueError("damaged record payload")
    return payload


def pack(key: int | None, ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    body = ids.astype(f"<u{width}").tobytes()
    return bytes([key is None]) + (key or 0).to_bytes(8, "little", signed=True) + bytes([width]) + body


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    key = None if payload[0] else int.from_bytes(payload[1:9], "little", signed=True)
    return key, np.frombuffer(payload, f"<u{payload[9]}", offset=PREFIX)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class RecordWriter(DataSourceArrowWriter):
    """``tokenizer`` names a tokenizer file for rows of (id, text), whose ids are then made here, each with ``end`` behind."""

    def __init__(self, url: str, tokenizer: str | None = None, end: int = 0):
        self.url = url
        self.tokenizer = tokenizer
        self.end = end

    def records(self, iterator: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
        """Id and token ids of every row."""
        if self.tokenizer is None:
            for batch in iterator:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            return
        coder, tail = word_tokenizer(self.tokenizer), np.array([self.end], "<u4").tobytes()
        for batch in slices(iterator, "text", 4 << 20):
            for key, ids in zip(batch.column(0).to_pylist(), coder.encode_column(batch.column(1))):
                yield key, ids + tail

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One task's rows in their order; names are new for every attempt, only committed ones are listed."""
        store, root = fs.FileSystem.from_uri(self.url)
        store.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        files: list[dict] = []
        out, entries, offset, first = None, [], 0, 0

        def close() -> None:
            nonlocal out, entries, offset, first
            if out is not None:
                out.close()
                with store.open_output_stream(f"{root}/{files[-1]['name']}.index") as index:
                    index.write(np.array(entries, ENTRY).tobytes())
                files[-1] |= {"records": len(entries), "tokens": first}
            out, entries, offset, first = None, [], 0, 0

        for key, ids in self.records(iterator):
            if out is None:
                name = f"part-{part:06d}-{len(files):05d}-{uuid.uuid4().hex}"
                files.append({"part": part, "number": len(files), "name": name})
                out = store.open_output_stream(f"{root}/{name}.records")
            tokens = np.frombuffer(ids or b"", "<u4")
            record = frame(pack(key, tokens))
            out.write(record)
            entries.append((offset, len(record), len(tokens), first))
            offset += len(record)
            first += len(tokens)
            if offset >= FILE_BYTES:
                close()
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.url)
        store.create_dir(root, recursive=True)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: (f["part"], f["number"]))
        start = 0
        for file in files:
            file["start"] = start
            start += file["tokens"]
        with store.open_output_stream(f"{root}/manifest.json") as out:
            out.write("".join(json.dumps(file) + "\n" for file in files).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.url)
        for file in (f for m in messages if m for f in m.files):
            for end in ("records", "index"):
                if store.get_file_info(f"{root}/{file['name']}.{end}").type == fs.FileType.File:
                    store.delete_file(f"{root}/{file['name']}.{end}")


class RecordSink(DataSource):
    """``df.write.format("framed_records")`` for rows of (id long, ids binary of unsigned 32-bit integers).

    With the options ``tokenizer`` (a file) and ``end`` (an id) for rows of (id long, text string).
    """

    @classmethod
    def name(cls) -> str:
        return "framed_records"

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"], self.options.get("tokenizer"), int(self.options.get("end", 0)))


def write_records(rows: DataFrame, url: str) -> None:
    """Write (id, ids), in the order of their partitions, to a new folder that all executors reach."""
    rows.sparkSession.dataSource.register(RecordSink)
    rows.select("id", "ids").write.format("framed_records").mode("append").save(url)


def read_records(spark: SparkSession, url: str, shuffle_seed: int | None = None) -> DataFrame:
    """id, start (tokens of all records before), ids (binary, unsigned 32-bit) of every record, checksums verified.

    A task reads a bounded run of index entries and their records, some megabytes at a time. With a seed, runs and the records
    of each run come in a random order that the seed fixes, each read by itself.
    """
    schema = "part int, number int, name string, records bigint, tokens bigint, start bigint"
    files = spark.read.schema(schema).json(f"{url}/manifest.json")
    runs = files.select(
        "name", "start", "records", F.explode(F.sequence(F.lit(0), F.col("records") - 1, F.lit(READ_RECORDS))).alias("first")
    )
    # A number of its own: runs are small rows for much work, which would else be put together into few tasks.
    wanted = files.agg(F.sum(F.ceil(F.col("records") / READ_RECORDS))).first()[0] or 1
    order = F.xxhash64(F.lit(shuffle_seed or 0), "name", "first")
    runs = runs.repartition(max(1, min(int(wanted), MAX_READERS)), order)
    if shuffle_seed is not None:
        runs = runs.sortWithinPartitions(order)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(url)
        for batch in batches:
            for run in batch.to_pylist():
                wanted = min(READ_RECORDS, run["records"] - run["first"])
                with store.open_input_file(f"{root}/{run['name']}.index") as file:
                    entries = np.frombuffer(file.read_at(wanted * ENTRY.itemsize, run["first"] * ENTRY.itemsize), ENTRY)
                order = np.arange(len(entries))
                if shuffle_seed is not None:
                    np.random.default_rng([shuffle_seed, run["first"], zlib.crc32(run["name"].encode())]).shuffle(order)
                with store.open_input_file(f"{root}/{run['name']}.records") as file:
                    keys, starts, ids, held = [], [], [], 0
                    stretches = stretched(entries) if shuffle_seed is None else [(at, at + 1) for at in order.tolist()]
                    for entry, record in stored(file, entries, stretches):
                        key, tokens = unpack(unframe(record))
                        keys.append(key)
                        starts.append(run["start"] + int(entry["first"]))
                        ids.append(tokens.astype("<u4").tobytes())
                        held += len(ids[-1])
                        if held >= 8 << 20:
                            yield _batch(keys, starts, ids)
                            keys, starts, ids, held = [], [], [], 0
                    yield _batch(keys, starts, ids)

    return runs.mapInArrow(read, "id long, start long, ids binary")


def stretched(entries: np.ndarray, size: int = 8 << 20) -> list[tuple[int, int]]:
    """Ranges of neighbouring entries whose records take about ``size`` bytes."""
    part = np.cumsum(entries["length"].astype(np.int64)) // size
    cuts = np.flatnonzero(np.diff(part)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(entries)])) if len(entries) else []


def stored(file, entries: np.ndarray, stretches: list[tuple[int, int]]) -> Iterator[tuple[np.void, bytes]]:
    """Each entry of the stretches with its record; a stretch is read in one go."""
    for first, stop in stretches:
        begin = int(entries[first]["offset"])
        data = file.read_at(int(entries[stop - 1]["offset"]) + int(entries[stop - 1]["length"]) - begin, begin)
        for entry in entries[first:stop]:
            at = int(entry["offset"]) - begin
            yield entry, data[at : at + int(entry["length"])]


def _batch(keys: list, starts: list, ids: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], ["id", "start", "ids"])


#: Signs that commonly stand behind a word.
SIGNS = frozenset(".,;:!?")
TOKEN_ID = operator.attrgetter("id")
SEPARATORS = "[\x1c-\x1f]"


class WordTokenizer:
    """The tokenizers library over the distinct words of a batch.

    In this kind of tokenizer white space only separates: no token, normal form or special token spans it,
    so a text's ids are its words' ids one after the other, and frequent words need no second call.
    A word of plain letters with signs behind it is two of the tokenizer's own pieces already (its lower case is
    its normal form), so the library's model gets the letters without the library's search for pieces;
    every other word goes through the whole of it.
    """

    #: Words that a generation of the memory holds; words not asked for in two generations are forgotten.
    REMEMBERED = 200_000
    PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?*#%$&()\[\]\"-]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.seen: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in found]

    def spell(self, letters: str) -> bytes:
        """Ids of lower-case letters, from the library's model."""
        spelled = letters if letters.isascii() else "".join([self.letters[byte] for byte in letters.encode()])
        tokens = list(map(TOKEN_ID, self.model.tokenize(spelled)))
        return struct.pack(f"<{len(tokens)}I", *tokens)

    def learn(self, words: list[str]) -> None:
        """Take up words that are not remembered; they may stand in the memory without ids."""
        seen, cores, plain = self.seen, self.cores, self.PLAIN.fullmatch
        others = []
        for word in words:
            signs = word[-1] if word[-1] in SIGNS else ""
            letters = word[:-1] if signs else word
            # The usual word is plain letters with a sign at most; the pattern knows the rest of the plain ones.
            if not (letters.isascii() and letters.isalpha()):
                found = plain(word)
                if found is None:
                    others.append(word)
                    continue
                letters, signs = found.groups()
            letters = letters.lower()
            core = cores.get(letters)
            if core is None:
                core = cores[letters] = self.spell(letters)
            if signs:
                if seen.get(signs) is None:
                    seen[signs] = self.ids([signs])[0]
                core += seen[signs]
            seen[word] = core
        for start in range(0, len(others), 8_192):
            some = others[start : start + 8_192]
            seen.update(zip(some, self.ids(some)))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.large_string()))

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text. Arrow cuts and numbers the words, so Python sees each distinct one of the batch once."""
        texts = pc.fill_null(texts, "")
        # Four control characters separate words for Arrow, as for str.split, but not for the tokenizer.
        odd = pc.match_substring_regex(texts, SEPARATORS)
        cut = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        coded = cut.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.seen) > self.REMEMBERED:
            self.seen, self.before = {"": b""}, self.seen
        if len(self.cores) > 2 * self.REMEMBERED:
            self.cores = {}
        unknown = [word for word, ids in zip(words, map(self.seen.get, words)) if ids is None]
        former = list(map(self.before.get, unknown))
        self.seen.update(zip(unknown, former))
        self.learn([word for word, ids in zip(unknown, former) if ids is None])
        found = list(map(self.seen.__getitem__, words))
        table = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        place = coded.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(sizes[place])))
        # Each word's ids lie in the table from its own start on.
        shift = (np.cumsum(sizes) - sizes)[place] - ends[:-1]
        ids = table[np.repeat(shift, sizes[place]) + np.arange(ends[-1])].tobytes()
        bounds = (4 * ends[cut.offsets.to_numpy()]).tolist()
        rows = [ids[start:stop] for start, stop in zip(bounds, bounds[1:])]
        for row in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            rows[row] = self.ids([texts[row].as_py()])[0]
        return rows


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process and file."""
    return WordTokenizer(path)


def tokenize_to_records(documents: DataFrame, path: str, end: int, url: str) -> None:
    """Encode (id, text) and write records in ascending id, nulls first; rows of one id come in text order.

    A null or empty text is the end id alone. The texts are dealt out by ranges of ids before they are encoded, so each
    is encoded once, by the process that writes it. An empty table gives an empty manifest.
    """
    rows = documents.select(F.col("id").cast("long"), "text")
    # Ranges of ids alone: the driver gets a sample of what they are made of.
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    documents.sparkSession.dataSource.register(RecordSink)
    ordered.write.format("framed_records").option("tokenizer", path).option("end", end).mode("append").save(url)


def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the record files."""
    import public_tokenizers

    from tidemark.llm.common import table

    url = scratch_dir(spark, "records")
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    tokenize_to_records(documents, public_tokenizers.path("word_bpe_49k.json"), 1, url)
    return read_records(spark, url).select(
        F.col("id").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
