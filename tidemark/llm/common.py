"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of the folder. The operators run in Python workers, which get the package here."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes; a null text has none."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words_of(data: bytes) -> list[bytes]:
    """Maximal runs outside [\\x20\\x09-\\x0D]: exactly what ``bytes.split`` without arguments yields."""
    return data.split()


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of text, so that a worker holds little at once."""
    for batch in batches:
        start, held = 0, 0
        column = batch.column(batch.schema.get_field_index(text))
        for row in range(batch.num_rows):
            value = column[row]
            held += value.as_buffer().size if value.is_valid else 0
            if held >= max_bytes:
                yield batch.slice(start, row + 1 - start)
                start, held = row + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def words_column(text: Column) -> Column:
    """Words of a text as an array, for plans that stay in the JVM; null and empty text: no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", -1), lambda word: word != "")


def extended(frame: DataFrame, ddl: str) -> T.StructType:
    """The frame's schema with further columns."""
    return T.StructType([*frame.schema.fields, *T.StructType.fromDDL(ddl).fields])


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the frame has such a column: Spark does not tell upper from lower case."""
    taken, out = {column.lower() for column in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
