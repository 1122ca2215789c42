"""JSON payload columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER_MAP = "map<string,double>"


def decode(payload: str, schema: str) -> Column:
    return F.from_json(payload, schema)


def decode_numbers(payload: str) -> Column:
    """An object whose keys vary, as a map; inference would make one struct field per key."""
    return F.from_json(payload, NUMBER_MAP)


def encode(value: Column) -> Column:
    return F.to_json(value)


def decode_any(payload: str | Column) -> Column:
    """A document of any shape as a variant: every key, list and type is kept. Text that is no JSON gives NULL."""
    return F.try_parse_json(payload)


def field(document: str | Column, path: str, kind: str) -> Column:
    """The value at a path such as ``$.rates.EUR`` of a decoded document; NULL where it is absent or of another kind."""
    return F.try_variant_get(document, path, kind)


def entries(df: DataFrame, document: str, *kept: str) -> DataFrame:
    """One row for each key of the decoded objects in column ``document``: ``kept``, ``key`` and ``value`` as JSON text.

    Documents that are no object, and empty objects, have no keys. Documents of one column may differ in keys and types.
    """
    each = df.sparkSession.tvf.variant_explode(F.col(document).outer())
    # An element of a list has a place and no key.
    named = df.lateralJoin(each).where(F.col("key").isNotNull())
    return named.select(*kept, "key", F.to_json("value").alias("value"))
