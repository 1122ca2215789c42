"""The daily landing area with days that are published in one step.

As ``landing``, but a load writes its days beside those that are read, and one commit (see ``commits``) then makes all of
them valid together. A reader sees each day either as it was or as it is, never without it; one that has begun keeps what it
began with. Give this module as ``store`` to the loads of ``landing``.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.sources import commits, landing


def land(documents: DataFrame, root: str, gather: bool = True) -> list[dt.date]:
    """Write ``(ds, payload)`` by day, publish the days together and return them."""
    spark, folder = documents.sparkSession, commits.fresh(root)
    days = landing.land(documents, folder, gather)
    if days:
        load = folder.rpartition("/")[2]
        commits.commit(spark, root, lambda valid: valid | {day.isoformat(): {"load": load} for day in days})
    return days


def landed_days(spark: SparkSession, root: str) -> list[dt.date]:
    """Days published, from the last commit alone."""
    return sorted(map(dt.date.fromisoformat, commits.state(spark, root)))


def read_landed(spark: SparkSession, root: str, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """``(payload, ds)`` of the published days in the range, as of now; one scan of their folders."""
    wanted = {day.isoformat() for day in days_between(start, end)}
    folders = [f"{root}/data/{entry['load']}/ds={day}" for day, entry in sorted(commits.state(spark, root).items()) if day in wanted]
    if not folders:
        return spark.createDataFrame([], "payload string, ds date")
    found = spark.read.schema("payload string, load string, ds date").option("basePath", f"{root}/data").text(folders)
    return found.select("payload", F.col("ds"))


def land_by_key(documents: DataFrame, root: str) -> list[str]:
    """Write ``(key, payload)`` by key, publish the keys together and return them; other keys stay.

    For a number of keys that one small file can list, such as currencies: each commit names them all.
    """
    if documents.isEmpty():
        return []
    spark, folder, seen = documents.sparkSession, commits.fresh(root), Observation()
    landing.land_by_key(documents.observe(seen, F.collect_set("key").alias("keys")), folder)
    keys, load = sorted(seen.get["keys"]), folder.rpartition("/")[2]
    commits.commit(spark, root, lambda valid: valid | {key: {"load": load} for key in keys})
    return keys


def read_by_key(spark: SparkSession, root: str) -> DataFrame:
    """``(payload, key)`` of all published keys, as of now; a load is read for the keys that it still stands for."""
    valid = commits.state(spark, root)
    if not valid:
        return spark.createDataFrame([], "payload string, key string")
    folders = sorted({f"{root}/data/{entry['load']}" for entry in valid.values()})
    found = spark.read.schema("payload string, load string, key string").option("basePath", f"{root}/data").text(folders)
    loads = {}
    for key, entry in valid.items():
        loads.setdefault(entry["load"].removeprefix("load="), []).append(key)
    # Conditions on folder names alone: other keys of a load are not read.
    stands = [(F.col("load") == load) & F.col("key").isin(keys) for load, keys in loads.items()]
    return found.where(functools.reduce(Column.__or__, stands)).select("payload", "key")


def clear(spark: SparkSession, root: str, confirm: bool = False) -> bool:
    """Publish that there is no day; True if there was any. ``commits.sweep`` removes the files. Needs ``confirm=True``."""
    if not confirm:
        raise ValueError("clear() empties the whole landing area: pass confirm=True")
    if not landed_days(spark, root):
        return False
    commits.commit(spark, root, lambda valid: {})
    return True
