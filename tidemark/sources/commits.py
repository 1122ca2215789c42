"""Which folders make up the present state of a data set: a small file per commit, the last one counts.

Data goes to folders that nothing refers to yet; a commit then names them, by one rename. Readers take the last commit,
so they see all of a load or nothing of it, and one that has begun goes on with the folders it was told. ``sweep`` removes
what no commit needs any more.

    <root>/data/load=<id>/...       folders of the loads
    <root>/commits/<number>.json    {name: entry} of everything that is valid from this commit on
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Commits that lose the race to a number so often give up.
ATTEMPTS = 50


def folder_of(spark: SparkSession, path: str):
    """Hadoop path and file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def fresh(root: str) -> str:
    """A folder for a load's files; its name is what a commit refers to."""
    return f"{root}/data/load={uuid.uuid4().hex}"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    path, files = folder_of(spark, f"{root}/commits")
    if not files.exists(path):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(path)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _file(root: str, number: int) -> str:
    return f"{root}/commits/{number:020d}.json"


def _read(spark: SparkSession, root: str, number: int) -> dict:
    path, files = folder_of(spark, _file(root, number))
    stream = files.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def state(spark: SparkSession, root: str) -> dict:
    """The entries of the last commit; empty before the first."""
    numbers = _numbers(spark, root)
    return _read(spark, root, numbers[-1]) if numbers else {}


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Rename that refuses an existing target: whether the name was free.

    HDFS does this in one step. A local disk looks and then renames, so there one driver should commit at a time.
    """
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), where, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True


def commit(spark: SparkSession, root: str, change: Callable[[dict], dict | None]) -> dict:
    """Make what ``change`` gives for the present entries the new ones; None leaves all as it is.

    Where another driver commits meanwhile, ``change`` is asked again with its entries, so neither commit is lost.
    """
    for _ in range(ATTEMPTS):
        numbers = _numbers(spark, root)
        before = _read(spark, root, numbers[-1]) if numbers else {}
        after = change(dict(before))
        if after is None:
            return before
        draft = f"{root}/commits/.draft-{uuid.uuid4().hex}"
        path, files = folder_of(spark, draft)
        stream = files.create(path, False)
        try:
            stream.write(bytearray(json.dumps(after, sort_keys=True), "utf-8"))
        finally:
            stream.close()
        if _rename(spark, draft, _file(root, numbers[-1] + 1 if numbers else 0)):
            return after
        files.delete(path, False)
    raise RuntimeError(f"{ATTEMPTS} commits to {root} came in between")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a load's folder, as one that no commit came to name."""
    path, files = folder_of(spark, folder)
    files.delete(path, True)


def sweep(spark: SparkSession, root: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove commits but the last, and folders that none of the others names, if last changed so long ago.

    The time must be longer than any load or read takes: files of a load that has not committed and of readers
    that began before the last commit are kept for it. Returns the names of the removed folders.
    """
    limit = int((time.time() - older_than.total_seconds()) * 1000)
    path, files = folder_of(spark, f"{root}/commits")
    if not files.exists(path):
        return []
    last = max(_numbers(spark, root), default=None)
    named = set()
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        number = int(name.removesuffix(".json")) if name.endswith(".json") else None
        if (number is None or number != last) and entry.getModificationTime() <= limit:
            files.delete(entry.getPath(), False)
        elif number is not None:
            named |= {value["load"] for value in _read(spark, root, number).values()}
    path, files = folder_of(spark, f"{root}/data")
    removed = []
    for entry in files.listStatus(path) if files.exists(path) else []:
        name = entry.getPath().getName()
        if name not in named and entry.getModificationTime() <= limit:
            files.delete(entry.getPath(), True)
            removed.append(name)
    return removed
