"""Byte-level BPE encoding in batched numpy merge rounds, and decoding."""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import extended, slices

# White space of the tokenizer's pattern, and that pattern.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^S\p{L}\p{N}]+|[S]+(?![^S])|[S]+".replace("S", SPACE)

#: White space belongs to the word after it: no token goes from a word into the white space behind.
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
WORD = regex.compile(PATTERN)
#: Some signs that end a word of letters.
SIGNS = frozenset(".,;:!?")
#: Chunks of a generation whose ids a worker remembers; a full generation is kept until the next one is full.
REMEMBERED = 250_000
#: Symbols that one set of merge rounds takes together.
ROUND_SYMBOLS = 1 << 18


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes are themselves, the rest follow 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Tables of one tokenizer file and the ids of chunks seen so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = vocabulary[letter]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.none = len(pairs)
        self.special = {token["content"]: token["id"] for token in spec.get("added_tokens", [])}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        top = max([*vocabulary.values(), *self.special.values()])
        self.token = [b""] * (top + 1)
        for token, i in vocabulary.items():
            self.token[i] = bytes(letters[letter] for letter in token)
        for token, i in self.special.items():
            self.token[i] = token.encode()
        sizes = np.array([len(token) for token in self.token], np.int64)
        self.sizes, self.begins = sizes, np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self.seen: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``none`` where it never merges."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word: in every round each word merges its lowest-rank pair wherever it stands."""
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        lengths = np.array([len(word) for word in words], np.int64)
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        ranks = self._pair_ranks(symbols, owner)
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == self.none
            sizes = np.diff(np.append(starts, len(symbols)))
            if done.any():
                keep = np.repeat(~done, sizes)
                finished.append((owner[~keep], symbols[~keep]))
                symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
                lowest, sizes = lowest[~done], sizes[~done]
                if not len(symbols):
                    break
            hit = ranks == np.repeat(lowest, sizes)
            where = np.flatnonzero(hit)
            # Overlapping hits (one symbol repeated) merge from the left: every second one of a run.
            run = np.concatenate(([0], np.cumsum(np.diff(where) != 1)))
            begin = np.flatnonzero(np.concatenate(([True], np.diff(run) != 0)))
            where = where[(np.arange(len(where)) - begin[run]) % 2 == 0]
            symbols[where] = self.merged[ranks[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            position = np.cumsum(keep)[where] - 1
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            for at in (position, position[position > 0] - 1):
                inside = at[at + 1 < len(symbols)]
                same = owner[inside] == owner[inside + 1]
                ranks[at] = self.none
                ranks[inside[same]] = self.rank(symbols[inside[same]], symbols[inside[same] + 1])
        if not finished:
            return [b""] * len(words)
        owners = np.concatenate([part[0] for part in finished])
        flat = np.concatenate([part[1] for part in finished])[np.argsort(owners, kind="stable")].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owners, minlength=len(words)))).tolist()
        return [flat[start:end] for start, end in zip([0, *ends], ends)]

    def _pair_ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        ranks = np.full(len(symbols), self.none, np.int64)
        if len(symbols) > 1:
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])
        return ranks

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode chunks not seen yet, many words to a batch of rounds. A word by itself is a chunk, too."""
        cuts: dict[str, tuple[str, ...]] = {}
        words: set[str] = set()
        for chunk in chunks:
            # Letters behind at most one blank are one word of the pattern, and a sign after them is the next.
            body = chunk[:-1] if chunk[-1] in SIGNS else chunk
            if (body[1:] if body[:1] == " " else body).isalpha():
                if body is chunk:
                    words.add(chunk)
                else:
                    cuts[chunk] = (body, chunk[-1])
            else:
                cuts[chunk] = tuple(WORD.findall(chunk))
        words.update(*cuts.values())
        fresh = [(word, word.encode("utf-8", "surrogatepass")) for word in words.difference(self.seen)]
        sizes = np.cumsum([len(data) for _, data in fresh], dtype=np.int64)
        starts = np.flatnonzero(np.diff(sizes // ROUND_SYMBOLS, prepend=-1)).tolist()
        for start, end in zip(starts, [*starts[1:], len(fresh)]):
            part = fresh[start:end]
            self.seen.update(zip([word for word, _ in part], self.merge([data for _, data in part])))
        get = self.seen.__getitem__
        for chunk, cut in cuts.items():
            self.seen[chunk] = b"".join(map(get, cut))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; special tokens in a text are tokens."""
        parts: list[list[str]] = []
        for text in texts:
            if self.cut is None or not self.cut.search(text):
                parts.append(CHUNK.findall(text))
                continue
            row, start = [], 0
            for found in self.cut.finditer(text):
                row += CHUNK.findall(text[start : found.start()])
                row.append(found[0])
                start = found.end()
            parts.append(row + CHUNK.findall(text[start:]))
        if len(self.seen) > REMEMBERED:
            self.seen, self.former = {}, self.seen
        for token, i in self.special.items():
            self.seen[token] = np.array([i], "<u4").tobytes()
        unknown = set().union(*parts).difference(self.seen)
        known = unknown.intersection(self.former)
        self.seen.update(zip(known, map(self.former.__getitem__, known)))
        self.learn(unknown.difference(known))
        get = self.seen.__getitem__
        return [b"".join(map(get, row)) for row in parts]

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD."""
        return self.decode_batch([ids])[0]

    def decode_batch(self, rows: list[bytes]) -> list[str]:
        """Text of each row of ids, all bytes gathered from one table of the tokens."""
        ids = np.frombuffer(b"".join(rows), "<u4")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self.bytes[np.arange(total) + np.repeat(self.begins[ids] - ends + sizes, sizes)].tobytes()
        last = np.cumsum([len(row) // 4 for row in rows])
        stops = np.concatenate(([0], ends))[last].tolist()
        return [data[start:stop].decode("utf-8", "replace") for start, stop in zip([0, *stops], stops)]


@functools.cache
def codec(path: str) -> Codec:
    """One per worker process and file."""
    return Codec(path)


def encode(documents: DataFrame, path: str, text: str = "text", verify: bool = False, digests: bool = False) -> DataFrame:
    """All columns, with ``ids`` (binary: little-endian unsigned 32-bit token ids) and ``n_tokens`` (long).

    With ``verify`` also ``round_trip``: whether the ids decode to the text. With ``digests`` the text and its ids
    stay in the task, and ``ids_sha256`` and ``decoded_sha256`` (lowercase hex) come instead: of the ids, and of the
    UTF-8 bytes of what they decode to. A null or empty text has no tokens. Columns of these names in the input are
    replaced. Whole texts are encoded at any length; equal rows give equal results.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "n_tokens"]
    added += ["round_trip"] if verify else []
    kinds = {"ids": "binary", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "round_trip": "boolean"}
    frame = documents.drop(*[name for name in added if name != text])
    kept = [name for name in frame.columns if not (digests and name == text)]
    schema = extended(frame.select(*[f"`{name}`" for name in kept]), ", ".join(f"{name} {kinds[name]}" for name in added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in slices(batches, text, 2 << 20):
            texts = [value or "" for value in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            ids = coder.encode_batch(texts)
            columns = {"ids": pa.array(ids, pa.binary()) if not digests else None, "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}
            if verify or digests:
                decoded = coder.decode_batch(ids)
            if digests:
                columns["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
                columns["decoded_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())
            if verify:
                columns["round_trip"] = pa.array([x == value for x, value in zip(decoded, texts)], pa.bool_())
            own = [column for name, column in zip(batch.schema.names, batch.columns) if name in kept]
            yield pa.RecordBatch.from_arrays([*own, *[columns[name] for name in added]], [*kept, *added])

    return frame.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns, with ``decoded``, the text of ``ids`` (null ids: empty)."""
    frame = encoded.drop("decoded")
    schema = extended(frame, "decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in slices(batches, "ids", 4 << 20):
            texts = coder.decode_batch([ids or b"" for ids in batch.column(batch.schema.get_field_index("ids")).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return frame.mapInArrow(run, schema)


def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again, as digests of both."""
    import public_tokenizers

    from tidemark.llm.common import table

    path = public_tokenizers.path("byte_bpe_50k.json")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return encode(documents, path, digests=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
