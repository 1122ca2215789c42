"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Day boundaries depend on the session zone, so it is fixed. AQE is on by default in Spark;
# forcing the skew-join rule lets it split a hot key even where that costs one more shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    # Files of a checkpoint go when nothing refers to its frame any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators expect; ``settings`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = SETTINGS | {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the application's part of the shared scratch folder (it is not created yet).

    Frames that were returned may be read at any time, so what they are made of stays while the application runs, and
    goes with it: the driver's file system removes the application's part when it closes.
    """
    return f"{_application_root(spark, scratch_root(spark), spark.sparkContext.applicationId)}/{purpose}-{uuid.uuid4().hex}"


@functools.cache
def _application_root(spark: SparkSession, root: str, application: str) -> str:
    folder = f"{root}/tidemark/{application}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


@functools.cache
def _packed() -> str:
    """This package as an archive."""
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    return archive


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once an application: they need not find it on their path."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        # A driver that runs from an archive has shipped it already.
        if os.path.isfile(os.path.abspath(__file__)):
            context.addPyFile(_packed())
        _SHIPPED.add(context.applicationId)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once (a job runs now) into the shared folder, for several uses in one query.

    The frame owns the files: Spark removes them after the last query on it is forgotten.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


def materialise(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: this runs a job while a query is being built.

    For a frame that several branches use and that is dear to compute: the files outlive a lost
    executor, and each branch scans them instead of repeating the work. They stay until ``discard``
    removes them or the application ends, as the frames built on them may run at any time before.
    """
    path = scratch_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(stored: DataFrame) -> None:
    """Remove the files of a frame that ``materialise`` returned, once nothing will read them any more."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
