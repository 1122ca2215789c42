"""The daily landing area: JSON documents as text lines below ``<root>/ds=YYYY-MM-DD/``.

Days are replaced with dynamic partition overwrite: a day is replaced when its load commits, other
days stay, and a load that brings no document for a day leaves that day alone. The file commit is
not atomic, so a reader that runs beside a refresh should wait for it, or the loads be given the
``published`` area as their ``store``, which publishes days in one step. A row without a day or key, or
without a payload, is refused: it would come back as another one.

Loads take a *source*: a fetcher (see ``keyed``), or a function from a list of days to a frame of
``(ds, payload)``.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable, Iterable
from types import ModuleType

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.sources.keyed import MAX_TASKS, read_listed_days

FIELD = "ds"
MAX_DOCUMENTS_PER_FILE = 5_000_000


def _refused(broken: Column, why: str, column: Column) -> Column:
    return F.when(broken, F.raise_error(F.lit(why))).otherwise(column)


def _single_line() -> Column:
    """The payload; a line break in it would come back as two documents, and no payload as an empty one."""
    payload = F.col("payload")
    whole = _refused(payload.contains("\n") | payload.contains("\r"), "a document spans lines", payload)
    return _refused(payload.isNull(), "a document has no payload", whole).alias("payload")


def land(documents: DataFrame, root: str, gather: bool = True) -> list[dt.date]:
    """Write ``(ds, payload)`` by day and return the days written.

    ``gather`` brings the documents of a day together first: the rebalance hint collects small days
    into few files and splits a day that is too large for one task. Without it each task writes the
    days it holds.
    """
    seen = Observation()
    rows = documents.select(_single_line(), _refused(F.col(FIELD).isNull(), "a document has no day", F.col(FIELD)).alias(FIELD))
    (
        (rows.hint("rebalance", FIELD) if gather else rows)
        .observe(seen, F.collect_set(FIELD).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_DOCUMENTS_PER_FILE)
        .partitionBy(FIELD)
        .text(root)
    )
    return sorted(seen.get["days"])


def _folder(spark: SparkSession, root: str):
    """Hadoop path and file system of the landing area."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def landed_days(spark: SparkSession, root: str) -> list[dt.date]:
    """Days present, from one directory listing; no file is opened."""
    path, files = _folder(spark, root)
    if not files.exists(path):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(path)]
    return sorted(dt.date.fromisoformat(n.removeprefix("ds=")) for n in names if n.startswith("ds="))


def read_landed(spark: SparkSession, root: str, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """``(payload, ds)`` of the landed days in the range; only their folders are read."""
    days = days_between(start, end)
    if not landed_days(spark, root):
        return spark.createDataFrame([], "payload string, ds date")
    landed = spark.read.schema("payload string, ds date").text(root)
    return landed.filter(F.col(FIELD).between(F.lit(days[0]), F.lit(days[-1])))


Source = Callable[[list[dt.date]], DataFrame] | object


def _area(store: ModuleType | None) -> ModuleType:
    """Where loads land: a module with ``land``, ``landed_days`` and ``read_landed``; this one unless named."""
    return store or sys.modules[__name__]


def _load(
    spark: SparkSession, source: Source, root: str, days: Iterable[dt.date], max_tasks: int, store: ModuleType | None
) -> list[dt.date]:
    """A fetching task holds one day, a part of one or a few neighbouring ones, so it writes them itself."""
    days, area = list(days), _area(store)
    if not days:
        return []
    if callable(source):
        return area.land(source(days), root)
    return area.land(read_listed_days(spark, source, days, max_tasks), root, gather=False)


def refresh(
    spark: SparkSession,
    source: Source,
    root: str,
    start: dt.date,
    end: dt.date | None = None,
    max_tasks: int = MAX_TASKS,
    store: ModuleType | None = None,
) -> list[dt.date]:
    """Fetch every day of the range again and replace it; returns the days that had data."""
    return _load(spark, source, root, days_between(start, end), max_tasks, store)


def fill_gaps(
    spark: SparkSession,
    source: Source,
    root: str,
    start: dt.date,
    end: dt.date | None = None,
    max_tasks: int = MAX_TASKS,
    store: ModuleType | None = None,
) -> list[dt.date]:
    """Fetch only the days not landed yet; returns those that had data."""
    present = set(_area(store).landed_days(spark, root))
    return _load(spark, source, root, [d for d in days_between(start, end) if d not in present], max_tasks, store)


def read_through(
    spark: SparkSession,
    source: Source,
    root: str,
    start: dt.date,
    end: dt.date | None = None,
    max_tasks: int = MAX_TASKS,
    store: ModuleType | None = None,
) -> DataFrame:
    """Documents of the range, fetched and landed first where missing."""
    fill_gaps(spark, source, root, start, end, max_tasks, store)
    return _area(store).read_landed(spark, root, start, end)


def daily_load(
    spark: SparkSession,
    source: Source,
    root: str,
    start: dt.date,
    end: dt.date | None = None,
    force: bool = True,
    max_tasks: int = MAX_TASKS,
    store: ModuleType | None = None,
) -> list[dt.date]:
    """The scheduled job, for one day or a backfill; rerunning it gives the same landing area.

    ``force`` refetches landed days, as the nightly run does; otherwise only gaps are filled.
    """
    load = refresh if force else fill_gaps
    return load(spark, source, root, start, end, max_tasks, store)


def clear(spark: SparkSession, root: str, confirm: bool = False) -> bool:
    """Remove every landed day; True if there was any. Needs ``confirm=True``."""
    if not confirm:
        raise ValueError("clear() removes the whole landing area: pass confirm=True")
    if not landed_days(spark, root):
        return False
    empty = spark.createDataFrame([], "payload string, ds date")
    empty.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(FIELD).text(root)
    return True


def land_by_key(documents: DataFrame, root: str) -> None:
    """Write ``(key, payload)`` as text lines below ``<root>/key=.../``, replacing the keys written."""
    key = F.col("key")
    named = _refused(key.isNull() | (key == ""), "a document has no key", key).alias("key")
    (
        documents.select(_single_line(), named)
        .hint("rebalance", "key")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_DOCUMENTS_PER_FILE)
        .partitionBy("key")
        .text(root)
    )


def read_by_key(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("payload string, key string").text(root)
