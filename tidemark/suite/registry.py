"""Registration, table access and output types."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        key = (path, _modified(self.spark, path))
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(path)


# Reading a schema from the files is a Spark job of its own, so it is done once for each state of a table.
_SCHEMAS: dict[tuple[str, int], T.StructType] = {}


def _modified(spark: SparkSession, path: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getModificationTime()


def register(name: str, sql: str | None = None):
    """Register ``f(tables)`` under ``name``."""
    def add(build: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: comparable(build(Tables(spark, folder)))
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates and timestamps as ISO text, which every engine prints alike."""
    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            # With the fraction of a second, where there is one.
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[plain(field) for field in df.schema.fields])


def money(name: str) -> Column:
    """Money is stored as double; sums must not depend on the order of addition."""
    return F.col(name).cast("decimal(18,2)")
