"""Moving tables between databases, CSV, JSON and Avro files."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import commits

# A CSV file whose values may hold line breaks, and a JSON file that is one array, are read by one
# task each. Writers bound the file size so that such reads stay parallel.
MAX_RECORDS_PER_FILE = 1_000_000
MAX_FILE_BYTES = 256 << 20
# Tables of a snapshot that are written at one time.
SIDE_BY_SIDE = 4

_QUOTING = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# NULL, empty text, padding, quotes, commas, backslashes and line breaks all survive a round trip;
# only the text \N itself reads back as NULL.
EXACT = _QUOTING | {"nullValue": "\\N"}
# What a database's own CSV copy writes and expects: NULL is an unquoted empty field and empty text
# a quoted one. Spark reads both as NULL.
PLAIN = _QUOTING | {"nullValue": ""}


# --- CSV -------------------------------------------------------------------------------------


def _csv_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: its values as text, quotes twice, and signs around each."""
    size = F.lit(3 * len(df.columns))
    for field in df.schema.fields:
        text = F.col(f"`{field.name}`").cast("string")
        size = size + F.coalesce(F.octet_length(text), F.lit(2))
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit(""))), F.lit(0))
    return size.cast("long")


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def dealt_by_bytes(df: DataFrame, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """The same rows in partitions whose CSV takes ``max_bytes`` and one row more at most.

    Two passes: bytes of every input partition, one number each for the driver, then each row goes to the partition that its
    place in the running sum over all bytes falls in. So long rows are spread like short ones, whatever the values.
    A frame whose partitions are small enough, or whose columns have a fixed width, is returned as it is; nothing
    is shuffled. The sums belong to the partitions of ``df``: where a second run would deal its rows anew, partitions may grow.
    """
    if not any(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in df.schema.fields):
        return df
    held = df.select(F.spark_partition_id().alias("at"), _csv_bytes(df).alias("bytes")).groupBy("at").agg(F.sum("bytes").alias("bytes"))
    sizes = dict(held.collect())
    if max(sizes.values(), default=0) <= max_bytes:
        return df
    ordered = sorted(sizes)
    begins = dict(zip(ordered, accumulate([0, *[sizes[at] for at in ordered[:-1]]])))
    parts = sum(sizes.values()) // max_bytes + 1
    size, part = _free(df, "bytes"), _free(df, "part")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offset = begins.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            bytes_ = batch.column(batch.num_columns - 1)
            ends = pc.cumulative_sum(bytes_, start=offset)
            number = pc.divide(pc.subtract(ends, bytes_), max_bytes).cast(pa.int32())
            offset = ends[-1].as_py() if batch.num_rows else offset
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], number], [*batch.schema.names[:-1], part])

    schema = T.StructType([*df.schema.fields, T.StructField(part, T.IntegerType())])
    return df.withColumn(size, _csv_bytes(df)).mapInArrow(place, schema).repartitionById(parts, F.col(part)).drop(part)


def export_csv(
    df: DataFrame,
    path: str,
    columns: Iterable[str] | None = None,
    dialect: Mapping = EXACT,
    max_bytes: int = MAX_FILE_BYTES,
) -> None:
    """Write the columns as a folder of CSV files with header, replacing what is there.

    A file has ``max_bytes`` and one row at most, by about the bytes its values take.
    """
    chosen = dealt_by_bytes(df.select(*columns) if columns else df, max_bytes)
    chosen.write.mode("overwrite").options(**dialect).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).csv(path)


def import_csv(
    spark: SparkSession, path: str, schema, dialect: Mapping = EXACT, multi_line: bool = True
) -> DataFrame:
    """Read CSV under a declared schema. Without line breaks in values, ``multi_line=False`` lets
    several tasks share a file."""
    return spark.read.schema(schema).options(**dialect).option("multiLine", multi_line).csv(path)


def snapshot(tables: Mapping[str, DataFrame], root: str, dialect: Mapping = EXACT) -> list[str]:
    """Write each table to ``<root>/<table>``, replacing it; returns the paths.

    Tables are independent jobs, some of them side by side. Over a database connection they are separate reads, not one
    consistent state.
    """
    paths = {name: f"{root}/{name}" for name in tables}
    with ThreadPoolExecutor(max_workers=max(1, min(len(tables), SIDE_BY_SIDE))) as pool:
        jobs = [pool.submit(export_csv, table, paths[name], dialect=dialect) for name, table in tables.items()]
        for job in jobs:
            job.result()
    return list(paths.values())


def _summary(df: DataFrame) -> list[Column]:
    """Rows and a digest of all values that does not depend on their order."""
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(F.xxhash64(*[f"`{c}`" for c in df.columns])), F.lit(0)).alias("digest")]


def _on_disk(spark: SparkSession, path: str) -> dict[str, int]:
    where, files = commits.folder_of(spark, path)
    if not files.exists(where):
        return {"files": 0, "bytes": 0}
    found = files.getContentSummary(where)
    return {"files": found.getFileCount(), "bytes": found.getLength()}


def publish_snapshot(tables: Mapping[str, DataFrame], root: str, dialect: Mapping = EXACT) -> dict[str, dict]:
    """Write the tables as one state below ``root`` and return its manifest.

    Each table goes to a folder of its own beside the former ones. When all are written, one commit (see ``commits``) names
    for every table its folder, number of files, bytes and rows, and a digest of its values. Until then readers have the
    former snapshot; a table that is not among ``tables`` is not part of the new one. Over a database connection
    the tables are separate reads, not one consistent state. Maps have no digest, and CSV does not take them.
    """
    manifest: dict[str, dict] = {}

    def write(name: str, table: DataFrame) -> None:
        seen, folder = Observation(), commits.fresh(root)
        # Summed on the way to the file, after rows have been dealt out.
        export_csv(dealt_by_bytes(table).observe(seen, *_summary(table)), folder, dialect=dialect, max_bytes=1 << 62)
        # Spark leaves the observation out of the plan of a table that it knows to be empty.
        summed = {"rows": 0, "digest": 0} if table.isEmpty() else seen.get
        manifest[name] = {"load": folder.rpartition("/")[2], **summed, **_on_disk(table.sparkSession, folder)}

    with ThreadPoolExecutor(max_workers=max(1, min(len(tables), SIDE_BY_SIDE))) as pool:
        for job in [pool.submit(write, name, table) for name, table in tables.items()]:
            job.result()
    if tables:
        commits.commit(next(iter(tables.values())).sparkSession, root, lambda former: manifest)
    return manifest


def read_snapshot(
    spark: SparkSession, root: str, schemas: Mapping[str, str | T.StructType], dialect: Mapping = EXACT, check: bool = False
) -> dict[str, DataFrame]:
    """Tables of the last published snapshot, all of one state.

    A table that the manifest does not have, or whose files are not those of the manifest, is an error. ``check`` also
    reads all values and compares rows and digest, for a dialect that keeps them.
    """
    manifest, tables = commits.state(spark, root), {}
    for name, schema in schemas.items():
        entry = manifest.get(name)
        if entry is None:
            raise RuntimeError(f"the snapshot {root} has no table {name}")
        folder = f"{root}/data/{entry['load']}"
        if (found := _on_disk(spark, folder)) != {key: entry[key] for key in found}:
            raise RuntimeError(f"the snapshot {root} is damaged: {name} has {found}, its manifest {entry}")
        table = import_csv(spark, folder, schema, dialect)
        if check and (found := table.agg(*_summary(table)).first().asDict()) != {key: entry[key] for key in found}:
            raise RuntimeError(f"the snapshot {root} is damaged: {name} has {found}, its manifest {entry}")
        tables[name] = table
    return tables


# --- tables ----------------------------------------------------------------------------------


def append_table(df: DataFrame, path: str) -> None:
    """Bulk append to a Parquet table."""
    df.write.mode("append").parquet(path)


def insert_rows(spark: SparkSession, rows: Iterable[tuple], target: DataFrame, path: str) -> None:
    """Append literal rows in the target's column order and types."""
    append_table(spark.createDataFrame(list(rows), target.schema), path)


def append_batch(df: DataFrame, root: str, batch: str) -> bool:
    """Append to a ledger table what has not been appended under this batch id; whether it was now.

    The batch's files count from the commit on that names them, so a job may be run again at any point, and one batch that
    two jobs append at a time is there once.
    """
    spark = df.sparkSession
    if batch in commits.state(spark, root):
        return False
    folder = commits.fresh(root)
    df.write.parquet(folder)
    load = folder.rpartition("/")[2]
    after = commits.commit(spark, root, lambda ledger: None if batch in ledger else ledger | {batch: {"load": load}})
    if after[batch]["load"] == load:
        return True
    commits.remove(spark, folder)
    return False


def insert_batch(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType, root: str, batch: str) -> bool:
    """Append literal rows under a batch id."""
    return append_batch(spark.createDataFrame(list(rows), schema), root, batch)


def read_batches(spark: SparkSession, root: str, schema: str | T.StructType) -> DataFrame:
    """Rows of all batches that the ledger names, in one scan."""
    folders = [f"{root}/data/{entry['load']}" for entry in commits.state(spark, root).values()]
    reader = spark.read.schema(schema)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], schema)


# --- databases -------------------------------------------------------------------------------


def jdbc_options(prefix: str = "TIDEMARK_JDBC") -> dict[str, str]:
    """Connection options from ``<prefix>_URL``, ``_USER``, ``_PASSWORD`` and ``_DRIVER``."""
    names = {"url": "URL", "user": "USER", "password": "PASSWORD", "driver": "DRIVER"}
    found = {option: os.environ.get(f"{prefix}_{suffix}") for option, suffix in names.items()}
    if not found["url"]:
        raise ValueError(f"set {prefix}_URL")
    return {option: value for option, value in found.items() if value}


def partition_options(column: str, lower: object, upper: object, partitions: int) -> dict[str, str]:
    """Options that split a table read into ranges of one numeric, date or timestamp column."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession, table: str, options: Mapping[str, str], split: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """A table read in parallel; ``split`` comes from ``partition_options`` or is a list of conditions.

    Without a split Spark would fetch the whole table in one task, so it is required. Conditions,
    such as ``MOD(id, 64) = 5``, suit a column whose ranges are uneven; together they must cover
    each row once. Each part is its own connection.
    """
    if isinstance(split, Mapping) and "numPartitions" in split:
        return spark.read.format("jdbc").options(**options).options(**split).option("dbtable", table).load()
    if not split or isinstance(split, Mapping):
        raise ValueError("split the read: see partition_options()")
    properties = {name: value for name, value in options.items() if name != "url"}
    return spark.read.jdbc(options["url"], table, predicates=list(split), properties=properties)


def preview(df: DataFrame, n: int = 2) -> DataFrame:
    """A few arbitrary rows; each scanning task stops after ``n``."""
    return df.limit(n)


def preview_jdbc(spark: SparkSession, table: str, options: Mapping[str, str], n: int = 2) -> DataFrame:
    """A few arbitrary rows; the limit is part of the statement, so no more leave the database."""
    return spark.read.format("jdbc").options(**options).option("query", f"SELECT * FROM {table} LIMIT {n}").load()


def append_jdbc(df: DataFrame, table: str, options: Mapping[str, str], batch_size: int = 10_000) -> None:
    """Bulk append. A task that is retried can send its rows twice: give the table a key."""
    df.write.mode("append").format("jdbc").options(**options).option("dbtable", table).option(
        "batchsize", batch_size
    ).save()


# --- JSON and Avro ---------------------------------------------------------------------------


def write_json(df: DataFrame, path: str) -> None:
    """One record per line, so that files can be split. NULL fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema, multi_line: bool = False) -> DataFrame:
    """Records from JSON lines; a line that holds an array gives one row per element.

    ``multi_line`` reads a file that is one array or object over several lines.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def _avro(action):
    try:
        return action()
    except AnalysisException as error:
        if "avro" in str(error).lower():
            raise RuntimeError("Avro needs Spark's spark-avro package on the class path") from error
        raise


def write_avro(df: DataFrame, path: str, record: str = "Record", namespace: str = "") -> None:
    """Avro container files; the frame's nullable columns become unions with null."""
    writer = df.write.mode("overwrite").option("recordName", record).option("recordNamespace", namespace)
    _avro(lambda: writer.format("avro").save(path))


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Records of Avro container files under the schema they carry."""
    return _avro(lambda: spark.read.format("avro").load(path))
