"""Reading documents from a remote service, one request key (a day, a currency base) at a time.

The service is reached through a *fetcher*, any picklable object with

    connect()                    -> a session handle; called on the executor, and again on renewal
    splits(key)                  -> names of the parts a key's data comes in, None if it has no data
    fetch(session, key, split)   -> the documents of one part in a stable order, None if no data
    expired(error)               -> whether an error of ``fetch`` calls for a new session

A document is decoded JSON, or its text. Pages or files are natural splits: they let a day that
holds a third of all documents be read by many tasks. Splits are listed by tasks of their own.
Every (key, split) is one task until there are ``max_tasks`` of them; a lower cap respects a rate
limit, or gives fewer and larger files when landed. Documents leave a task in batches of bounded
size. Where keys may be skipped, the documents are first written to the shared folder, and a split
that is to be skipped says so in a row of its own: its key is then left out as a whole.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import pickle
import sys
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.functions.dates import days_between
from tidemark.session import materialise

# Fixed value: session renewals allowed per request, whatever else its task does.
MAX_RENEWALS = 5

MAX_TASKS = 20_000
BATCH_BYTES = 4 << 20

# Executors receive these classes, and those of the fetcher, by value: they need no copy of the code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Batch(InputPartition):
    """The requests of one task."""

    def __init__(self, work: list):
        super().__init__(work)
        self.work = work


def one_line(document) -> str:
    """JSON text without line breaks, as the landing files hold one document per line."""
    if isinstance(document, str):
        if "\n" not in document and "\r" not in document:
            return document
        document = json.loads(document)
    return json.dumps(document, ensure_ascii=False, separators=(",", ":"))


class KeyedReader(DataSourceReader):
    """``work`` lists requests (number of the key, key, split). With ``skip_errors`` a row has the number and ``skipped`` too."""

    def __init__(self, fetcher, work: list, schema: pa.Schema, skip_errors: tuple, max_tasks: int):
        self.fetcher = fetcher
        self.work = work
        self.schema = schema
        self.skip_errors = skip_errors
        self.max_tasks = max_tasks

    def partitions(self) -> list[Batch]:
        # Neighbouring requests share a task, so a task touches few keys.
        size = -(-len(self.work) // self.max_tasks) or 1
        return [Batch(self.work[i : i + size]) for i in range(0, len(self.work), size)] or [Batch([])]

    def read(self, partition: Batch) -> Iterator[pa.RecordBatch]:
        if not partition.work:
            return
        self.session = self.fetcher.connect()
        rows, size = [], 0
        for number, key, split in partition.work:
            for line, skipped in self._lines(key, split):
                rows.append((key, line, number, skipped))
                size += len(line or "")
                if size >= BATCH_BYTES:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], self.schema.names)

    def _lines(self, key, split) -> Iterator[tuple[str | None, bool]]:
        """The documents of a split; a last one without text if the request is to be skipped."""
        try:
            for line in self._documents(key, split):
                yield line, False
        except self.skip_errors:
            yield None, True

    def _documents(self, key, split) -> Iterator[str]:
        """Every document of the split once; after a renewal it goes on behind the last one."""
        sent, renewals = 0, MAX_RENEWALS
        while True:
            try:
                documents = self.fetcher.fetch(self.session, key, split)
                for document in itertools.islice(documents or (), sent, None):
                    line = one_line(document)
                    sent += 1
                    yield line
                break
            except Exception as error:
                if not renewals or not self.fetcher.expired(error):
                    raise
                renewals -= 1
                self.session = self.fetcher.connect()


def _requests(spark: SparkSession, fetcher, keys: Sequence, skip_errors: tuple) -> list:
    """(number of the key, key, split) of every request, listed by tasks; a key whose listing fails with ``skip_errors`` has none."""

    def split_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for place in batch.column(0).to_pylist():
                try:
                    splits = list(fetcher.splits(keys[place]) or ())
                except skip_errors:
                    splits = []
                found.append(pickle.dumps(splits))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "splits"])

    tasks = max(1, min(len(keys), spark.sparkContext.defaultParallelism))
    listed = spark.range(0, len(keys), 1, tasks).mapInArrow(split_lists, "id long, splits binary").collect()
    return [(row.id, keys[row.id], split) for row in sorted(listed) for split in pickle.loads(row.splits)]


def _read(
    spark: SparkSession, name: str, schema: str, fetcher, keys: Sequence, skip_errors: tuple, max_tasks: int
) -> DataFrame:
    for part in type(fetcher).__mro__[:-1]:
        cloudpickle.register_pickle_by_value(sys.modules[part.__module__])
    work = _requests(spark, fetcher, keys, skip_errors)
    key_type = pa.date32() if " date," in schema else pa.string()
    fields = [(schema.split()[0], key_type), ("payload", pa.string())]
    if skip_errors:
        schema += ", number long, skipped boolean"
        fields += [("number", pa.int64()), ("skipped", pa.bool_())]
    arrow = pa.schema(fields)

    class KeyedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return KeyedReader(fetcher, work, arrow, skip_errors, max_tasks)

    spark.dataSource.register(KeyedSource)
    return spark.read.format(name).load()


def read_days(
    spark: SparkSession,
    fetcher,
    start: dt.date,
    end: dt.date | None = None,
    max_tasks: int = MAX_TASKS,
) -> DataFrame:
    """``(ds, payload)`` for the days from ``start`` to ``end``, both included.

    A day without data gives no row; any error other than an expired session fails the job.
    """
    return read_listed_days(spark, fetcher, days_between(start, end), max_tasks)


def read_listed_days(
    spark: SparkSession, fetcher, days: Iterable[dt.date], max_tasks: int = MAX_TASKS
) -> DataFrame:
    return _read(spark, "tidemark_daily", "ds date, payload string", fetcher, list(days), (), max_tasks)


def read_keys(
    spark: SparkSession,
    fetcher,
    keys: Iterable[str],
    skip_errors: tuple[type[Exception], ...] = (),
    max_tasks: int = MAX_TASKS,
) -> DataFrame:
    """``(key, payload)`` for each key; a key whose request fails with ``skip_errors`` is left out.

    With ``skip_errors`` the service is read now, into the shared folder; ``discard`` removes the files.
    """
    found = _read(spark, "tidemark_keyed", "key string, payload string", fetcher, list(keys), skip_errors, max_tasks)
    if not skip_errors:
        return found
    stored = materialise(spark, found, "keyed")
    # Nothing is grouped below the join, so that a key with many documents can be split.
    kept = stored.where("NOT skipped").join(stored.where("skipped").select("number"), "number", "left_anti")
    kept = kept.select("key", "payload")
    kept.scratch_path = stored.scratch_path
    return kept
