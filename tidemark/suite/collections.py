"""Array and map functions on the words of whole documents and on JSON maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import arrays, payloads
from tidemark.suite.registry import Tables, register

WORDS = "string_split(text, ' ')"


def _words(t: Tables, *more: str):
    return t.documents.select("doc_id", *more, F.split("text", " ").alias("words"))


def _joined(array):
    return F.array_join(array, " ")


@register("r01_element", f"SELECT doc_id, {WORDS}[1] AS word FROM documents")
def _(t):
    return _words(t).select("doc_id", arrays.element(F.col("words"), 0).alias("word"))


@register("r02_append", f"SELECT doc_id, array_to_string(list_append({WORDS}, source), ' ') AS words FROM documents")
def _(t):
    longer = arrays.append(F.col("words"), F.col("source"))
    return _words(t, "source").select("doc_id", _joined(longer).alias("words"))


@register("r03_extend", f"""
    SELECT doc_id, array_to_string(list_concat({WORDS}, [lang, source]), ' ') AS words FROM documents""")
def _(t):
    longer = arrays.extend(F.col("words"), F.array("lang", "source"))
    return _words(t, "lang", "source").select("doc_id", _joined(longer).alias("words"))


@register("r04_distinct_items", f"""
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n, array_to_string(list_sort(w), ' ') AS words
    FROM (SELECT doc_id, list_distinct({WORDS}) AS w FROM documents)""")
def _(t):
    unique = _words(t).select("doc_id", arrays.distinct_items(F.col("words")).alias("w"))
    return unique.select("doc_id", F.size("w").cast("bigint").alias("n"), _joined(F.sort_array("w")).alias("words"))


@register("r05_integers", """
    SELECT l_orderkey, l_linenumber, array_to_string(range(1, l_linenumber + 1), ' ') AS numbers FROM lineitem""")
def _(t):
    numbers = arrays.integers(F.lit(1), F.col("l_linenumber"))
    return t.lineitem.select("l_orderkey", "l_linenumber", _joined(numbers.cast("array<string>")).alias("numbers"))


@register("r06_stepped_slice", f"SELECT doc_id, array_to_string({WORDS}[3:5:2], ' ') AS words FROM documents")
def _(t):
    return _words(t).select("doc_id", _joined(arrays.stepped_slice(F.col("words"), 2, 5, 2)).alias("words"))


@register("r07_reverse", f"SELECT doc_id, array_to_string(list_reverse({WORDS}), ' ') AS words FROM documents")
def _(t):
    return _words(t).select("doc_id", _joined(arrays.reversed_items(F.col("words"))).alias("words"))


RECORDS_SQL = """SELECT event_id, key AS name, CAST(json_extract(props, '$.' || key) AS DOUBLE) AS salary
    FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)"""


def _records(t: Tables):
    entries = payloads.decode_numbers("props")
    return t.events.select("event_id", arrays.records(entries, "name", "salary").alias("emps"))


@register("r08_map_to_records", RECORDS_SQL)
def _(t):
    return _records(t).select("event_id", F.inline("emps"))


@register("r09_field_of_each", f"SELECT event_id, salary FROM ({RECORDS_SQL})")
def _(t):
    return _records(t).select("event_id", F.explode("emps").alias("emp")).select("event_id", "emp.salary")
