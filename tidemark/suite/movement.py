"""Files, landing areas and loads, each read back so that the result can be compared.

Landing areas are fed by a loader over the given tables: whole rows as documents.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import payloads
from tidemark.functions.dates import day
from tidemark.session import scratch_dir
from tidemark.sources import landing, published, transfer
from tidemark.suite.registry import Tables, money, register

# Times travel as text: JSON timestamps would lose the fraction of a second.
EVENT = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
EVENT_COLUMNS = "strftime(ts, '%Y-%m-%d') AS ds, event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type"
EVENT_SQL = f"SELECT {EVENT_COLUMNS}, value, props FROM events"


def _daily_documents(t: Tables, factor: int = 1) -> Callable[[list[dt.date]], DataFrame]:
    """A loader with one document per event; ``factor`` tells two versions of the data apart."""
    fields = ["event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type"]
    document = F.struct(*fields, (F.col("value") * factor).alias("value"), "props")

    def load(days: list[dt.date]) -> DataFrame:
        start, end = F.lit(min(days)), F.lit(max(days))
        # The range reaches the scan; the list also leaves out days between that are not asked for.
        asked = t.events.filter((F.col("ts") >= start.cast("timestamp_ntz")) & (F.col("ts") < F.date_add(end, 1)))
        dated = asked.withColumn("ds", day("ts")).filter(F.col("ds").isin(days))
        return dated.select("ds", payloads.encode(document).alias("payload"))

    return load


def _range(t: Tables) -> tuple[dt.date, dt.date]:
    """Two days more than the events cover on either side, so some days have no data."""
    first, last = t.events.agg(F.min(day("ts")), F.max(day("ts"))).first()
    return first - dt.timedelta(2), last + dt.timedelta(2)


def _events_of(documents: DataFrame) -> DataFrame:
    return documents.select("ds", payloads.decode("payload", EVENT).alias("e")).select("ds", "e.*")


# --- CSV, JSON and tables --------------------------------------------------------------------


@register("s02_table_preview", "SELECT count(*) AS n FROM (SELECT * FROM supplier LIMIT 2)")
def _(t):
    return transfer.preview(t.supplier).agg(F.count(F.lit(1)).alias("n"))


@register("s03_csv_export", "SELECT doc_id, text, lang FROM documents")
def _(t):
    path = scratch_dir(t.spark, "csv")
    transfer.export_csv(t.documents, path, ["doc_id", "text", "lang"])
    return transfer.import_csv(t.spark, path, "doc_id bigint, text string, lang string")


CATEGORY = "category_id bigint, name string"


def _named(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(F.col(key).alias("category_id"), F.col(name).alias("name"))


@register("s04_csv_bulk_append", """
    SELECT s_suppkey AS category_id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer""")
def _(t):
    csv, table = scratch_dir(t.spark, "csv"), scratch_dir(t.spark, "table")
    transfer.append_table(_named(t.supplier, "s_suppkey", "s_name"), table)
    transfer.export_csv(_named(t.customer, "c_custkey", "c_name"), csv)
    transfer.append_table(transfer.import_csv(t.spark, csv, CATEGORY), table)
    return t.spark.read.schema(CATEGORY).parquet(table)


@register("s05_row_insert", """
    SELECT c_custkey AS category_id, c_name AS name FROM customer UNION ALL SELECT 100, 'inserted'""")
def _(t):
    table = scratch_dir(t.spark, "table")
    rows = _named(t.customer, "c_custkey", "c_name")
    transfer.append_table(rows, table)
    transfer.insert_rows(t.spark, [(100, "inserted")], rows, table)
    return t.spark.read.schema(CATEGORY).parquet(table)


@register("s04_append_of_repeated_batches", """
    SELECT s_suppkey AS category_id, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer
    UNION ALL SELECT 100, 'inserted'""")
def _(t):
    """Every batch arrives twice, as from a job that is run again."""
    table = scratch_dir(t.spark, "ledger")
    for _ in range(2):
        transfer.append_batch(_named(t.supplier, "s_suppkey", "s_name"), table, "suppliers")
        transfer.append_batch(_named(t.customer, "c_custkey", "c_name"), table, "customers")
        transfer.insert_batch(t.spark, [(100, "inserted")], CATEGORY, table, "one row")
    return transfer.read_batches(t.spark, table, CATEGORY)


SNAPSHOT = ["customer", "orders", "part", "supplier", "documents"]
# One line per row of any table: its name and all columns as text.
SNAPSHOT_ROWS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}
# Fixed value: doubles are compared as whole cents, which every engine prints alike.
DOUBLES = ["c_acctbal", "o_totalprice", "p_retailprice", "s_acctbal", "value"]


def _line_sql(table: str, columns: list[str]) -> str:
    texts = [
        f"CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)" if c in DOUBLES else f"CAST({c} AS VARCHAR)" for c in columns
    ]
    joined = " || '|' || ".join(f"coalesce({text}, '-')" for text in texts)
    return f"SELECT '{table}' AS name, md5({joined}) AS line FROM {table}"


SNAPSHOT_SQL = " UNION ALL ".join(_line_sql(table, columns) for table, columns in SNAPSHOT_ROWS.items())


def _lines(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """A digest of every column of every row, so that a damaged value of any column shows."""
    texts = [F.round(F.col(c) * 100).cast("bigint").cast("string") if c in DOUBLES else F.col(c).cast("string") for c in columns]
    joined = F.concat_ws("|", *[F.coalesce(text, F.lit("-")) for text in texts])
    return df.select(F.lit(name).alias("name"), F.md5(joined.cast("binary")).alias("line"))


@register("s06_snapshot", SNAPSHOT_SQL)
def _(t):
    return _snapshot_lines(t)


def _snapshot_lines(t: Tables) -> DataFrame:
    """Every row of the written snapshot, as a digest."""
    root = scratch_dir(t.spark, "snapshot")
    tables = {name: getattr(t, name) for name in SNAPSHOT}
    transfer.snapshot(tables, root)
    lines = None
    for name, table in tables.items():
        one = _lines(transfer.import_csv(t.spark, f"{root}/{name}", table.schema), name, SNAPSHOT_ROWS[name])
        lines = one if lines is None else lines.unionByName(one)
    return lines


@register("s06_published_snapshot", SNAPSHOT_SQL)
def _(t):
    """A second snapshot replaces the first as a whole; its values are checked against the manifest."""
    root = scratch_dir(t.spark, "snapshot")
    transfer.publish_snapshot({"customer": t.customer.limit(0), "orders": t.orders.limit(0)}, root)
    tables = {name: getattr(t, name) for name in SNAPSHOT}
    transfer.publish_snapshot(tables, root)
    found = transfer.read_snapshot(t.spark, root, {name: table.schema for name, table in tables.items()}, check=True)
    lines = [_lines(found[name], name, SNAPSHOT_ROWS[name]) for name in SNAPSHOT]
    return functools.reduce(DataFrame.unionByName, lines)


CAR = "model string, make string, year double"
CAR_SQL = """
    SELECT p_name AS model, nullif(p_brand, 'Brand#1') AS make,
           CAST(CASE WHEN p_size > 10 THEN 1990 + p_size END AS DOUBLE) AS year FROM part"""


def _cars(t: Tables) -> DataFrame:
    """Records with a required and two optional fields."""
    return t.part.select(
        F.col("p_name").alias("model"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("make"),
        F.when(F.col("p_size") > 10, F.col("p_size") + 1990.0).alias("year"),
    )


@register("s09_json_records", CAR_SQL)
def _(t):
    path = scratch_dir(t.spark, "json")
    transfer.write_json(_cars(t), path)
    return transfer.read_json(t.spark, path, CAR)


@register("s10_json_arrays", f"{CAR_SQL} UNION ALL {CAR_SQL}")
def _(t):
    """Each line holds an array of two records; reading gives one row per element."""
    path = scratch_dir(t.spark, "json")
    record = F.struct("model", "make", "year")
    _cars(t).select(payloads.encode(F.array(record, record)).alias("line")).write.text(path)
    return transfer.read_json(t.spark, path, CAR)


@register("d3_records_with_absent_keys", CAR_SQL)
def _(t):
    """Absent optional keys read back as NULL."""
    path = scratch_dir(t.spark, "json")
    _cars(t).select(payloads.encode(F.struct("model", "make", "year")).alias("line")).write.text(path)
    return transfer.read_json(t.spark, path, CAR)


@register("d4_table_to_csv_to_table", """
    SELECT p_partkey AS category_id, p_name AS name FROM part UNION ALL SELECT 100, 'inserted'""")
def _(t):
    csv, table = scratch_dir(t.spark, "csv"), scratch_dir(t.spark, "table")
    source = _named(t.part, "p_partkey", "p_name")
    transfer.export_csv(source, csv)
    transfer.append_table(transfer.import_csv(t.spark, csv, CATEGORY), table)
    transfer.insert_rows(t.spark, [(100, "inserted")], source, table)
    return t.spark.read.schema(CATEGORY).parquet(table)


# --- the landing area ------------------------------------------------------------------------

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("d5_documents_per_key", """
    SELECT c_mktsegment AS key, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def _(t):
    root = scratch_dir(t.spark, "keyed")
    document = payloads.encode(F.struct(*t.customer.columns))
    landing.land_by_key(t.customer.select(F.col("c_mktsegment").alias("key"), document.alias("payload")), root)
    landed = landing.read_by_key(t.spark, root)
    return landed.select("key", payloads.decode("payload", CUSTOMER).alias("c")).select("key", "c.*")


@register("d5_published_documents_per_key", """
    SELECT c_mktsegment AS key, c_custkey, c_name, c_nationkey,
           CASE WHEN c_mktsegment < 'F' THEN -c_acctbal ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""")
def _(t):
    """All keys in one step, then some of them once more after their documents changed."""
    root = scratch_dir(t.spark, "keyed")
    for factor, customers in ((1, t.customer), (-1, t.customer.where("c_mktsegment < 'F'"))):
        fields = [(F.col(name) * factor).alias(name) if name == "c_acctbal" else name for name in t.customer.columns]
        documents = customers.select(F.col("c_mktsegment").alias("key"), payloads.encode(F.struct(*fields)).alias("payload"))
        published.land_by_key(documents, root)
    landed = published.read_by_key(t.spark, root)
    return landed.select("key", payloads.decode("payload", CUSTOMER).alias("c")).select("key", "c.*")


RATES = "base string, rates map<string,double>, date string"


@register("f09_nested_documents", """
    SELECT s.s_name AS base, n.n_name AS currency, s.s_acctbal + n.n_nationkey AS rate, '2024-01-01' AS date
    FROM supplier s, nation n WHERE n.n_regionkey = s.s_nationkey % 5""")
def _(t):
    """Documents with a map of varying keys, landed, decoded and turned into one row per key."""
    root = scratch_dir(t.spark, "rates")
    # One small map per group, bounded by the nations of a region.
    names = t.nation.groupBy("n_regionkey").agg(
        F.map_from_entries(F.collect_list(F.struct("n_name", "n_nationkey"))).alias("nations")
    )
    suppliers = t.supplier.withColumn("n_regionkey", F.col("s_nationkey") % 5).join(names, "n_regionkey")
    rates = F.transform_values("nations", lambda name, number: F.col("s_acctbal") + number)
    document = F.struct(F.col("s_name").alias("base"), rates.alias("rates"), F.lit("2024-01-01").alias("date"))
    landing.land_by_key(suppliers.select((F.col("s_suppkey") % 10).cast("string").alias("key"), payloads.encode(document).alias("payload")), root)
    decoded = landing.read_by_key(t.spark, root).select(payloads.decode("payload", RATES).alias("d"))
    return decoded.select("d.base", F.explode("d.rates").alias("currency", "rate"), "d.date")


@register("f09_documents_of_any_shape", """
    SELECT 'customer' AS kind, c_custkey AS id, 'name' AS key, '"' || c_name || '"' AS value FROM customer
    UNION ALL SELECT 'customer', c_custkey, 'id', CAST(c_custkey AS VARCHAR) FROM customer
    UNION ALL SELECT 'customer', c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey % 3 = 0
    UNION ALL SELECT 'supplier', s_suppkey, 'id', '"' || s_suppkey || '"' FROM supplier
    UNION ALL SELECT 'supplier', s_suppkey, 'home', '{"nation":' || s_nationkey || ',"near":[' || s_nationkey + 1 || ',null]}' FROM supplier
    UNION ALL SELECT 'part', p_partkey, 'size-' || p_size % 7, CAST(p_size AS VARCHAR) FROM part""")
def _(t):
    """Documents of three kinds, whose keys and types differ, landed and taken apart without a schema."""
    root = scratch_dir(t.spark, "shapes")
    own = F.when(F.col("c_nationkey") % 3 == 0, F.col("c_nationkey")).alias("nation")
    customers = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), own)
    near = F.array(F.col("s_nationkey") + 1, F.lit(None).cast("int"))
    home = F.struct(near.alias("near"), F.col("s_nationkey").alias("nation"))
    suppliers = F.struct(F.col("s_suppkey").cast("string").alias("id"), home.alias("home"))
    parts = F.create_map(F.concat(F.lit("size-"), F.col("p_size") % 7), F.col("p_size"))
    kinds = {"customer": (t.customer, "c_custkey", customers), "supplier": (t.supplier, "s_suppkey", suppliers), "part": (t.part, "p_partkey", parts)}
    documents = [
        table.select(F.lit(kind).alias("key"), F.concat_ws(" ", key, payloads.encode(document)).alias("payload"))
        for kind, (table, key, document) in kinds.items()
    ]
    landing.land_by_key(functools.reduce(DataFrame.unionByName, documents), root)
    cut = F.split("payload", " ", 2)
    landed = landing.read_by_key(t.spark, root).select(
        F.col("key").alias("kind"), cut[0].cast("long").alias("id"), payloads.decode_any(cut[1]).alias("document")
    )
    return payloads.entries(landed, "document", "kind", "id")


@register("s13_daily_landing", EVENT_SQL)
def _(t):
    root, (start, end) = scratch_dir(t.spark, "landing"), _range(t)
    landing.land(_daily_documents(t)([start + dt.timedelta(n) for n in range((end - start).days + 1)]), root)
    return _events_of(landing.read_landed(t.spark, root, start, end))


@register("s14_refresh", f"""
    SELECT {EVENT_COLUMNS}, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
           THEN value * 2 ELSE value END AS value, props
    FROM events""")
def _(t):
    """Three days are loaded again after their documents changed."""
    root, (start, end) = scratch_dir(t.spark, "landing"), _range(t)
    landing.refresh(t.spark, _daily_documents(t), root, start, end)
    landing.refresh(t.spark, _daily_documents(t, factor=2), root, dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    return _events_of(landing.read_landed(t.spark, root, start, end))


@register("s15_read_through", f"""
    SELECT {EVENT_COLUMNS}, CASE WHEN CAST(ts AS DATE) <= DATE '2024-01-15' THEN value ELSE value * 2 END AS value, props
    FROM events""")
def _(t):
    """Days landed before the documents changed are kept; the others are loaded when they are read."""
    root, (start, end) = scratch_dir(t.spark, "landing"), _range(t)
    landing.refresh(t.spark, _daily_documents(t), root, start, dt.date(2024, 1, 15))
    return _events_of(landing.read_through(t.spark, _daily_documents(t, factor=2), root, start, end))


@register("s16_clear", "SELECT CAST(0 AS BIGINT) AS after FROM events HAVING count(*) > 0")
def _(t):
    root, (start, end) = scratch_dir(t.spark, "landing"), _range(t)
    landing.refresh(t.spark, _daily_documents(t), root, start, end)
    landing.clear(t.spark, root, confirm=True)
    return landing.read_landed(t.spark, root, start, end).agg(F.count(F.lit(1)).alias("after"))


DAY_SQL = """SELECT strftime(ts, '%Y-%m-%d') AS ds, count(*) AS n,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1"""


def _per_day(documents: DataFrame) -> DataFrame:
    return _events_of(documents).groupBy("ds").agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))


@register("s17_daily_load", DAY_SQL)
def _(t):
    """A backfill in two runs, the second one filling the gaps."""
    root, (start, end) = scratch_dir(t.spark, "landing"), _range(t)
    landing.daily_load(t.spark, _daily_documents(t), root, dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    landing.daily_load(t.spark, _daily_documents(t), root, start, end, force=False)
    return _per_day(landing.read_landed(t.spark, root, start, end))


@register("s14_published_refresh", f"""
    SELECT {EVENT_COLUMNS}, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
           THEN value * 2 ELSE value END AS value, props
    FROM events""")
def _(t):
    """A backfill in two runs and a refresh, each published in one step."""
    root, (start, end) = scratch_dir(t.spark, "published"), _range(t)
    landing.daily_load(t.spark, _daily_documents(t), root, dt.date(2024, 1, 5), dt.date(2024, 1, 20), store=published)
    landing.daily_load(t.spark, _daily_documents(t), root, start, end, force=False, store=published)
    landing.refresh(t.spark, _daily_documents(t, factor=2), root, dt.date(2024, 1, 10), dt.date(2024, 1, 12), store=published)
    return _events_of(published.read_landed(t.spark, root, start, end))


@register("d1_land_range", EVENT_SQL + " WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'")
def _(t):
    """The command-line job: ISO text in, the landed days out."""
    start, end = dt.date.fromisoformat("2024-01-03"), dt.date.fromisoformat("2024-01-09")
    landed = landing.read_through(t.spark, _daily_documents(t), scratch_dir(t.spark, "landing"), start, end)
    return _events_of(landed)


LOADED = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("d2_daily_load_and_snapshot", f"{SNAPSHOT_SQL} UNION ALL {_line_sql('events', LOADED)}")
def _(t):
    """Both scheduled jobs; they are independent of each other."""
    root, (start, end) = scratch_dir(t.spark, "landing"), _range(t)
    landing.daily_load(t.spark, _daily_documents(t), root, start, end)
    landed = _events_of(landing.read_landed(t.spark, root, start, end))
    return _snapshot_lines(t).unionByName(_lines(landed, "events", LOADED))


@register("d2_published_load_and_snapshot", f"{SNAPSHOT_SQL} UNION ALL {_line_sql('events', LOADED)}")
def _(t):
    """Both scheduled jobs, each published in one step."""
    root, (start, end) = scratch_dir(t.spark, "published"), _range(t)
    landing.daily_load(t.spark, _daily_documents(t), root, start, end, store=published)
    landed = _events_of(published.read_landed(t.spark, root, start, end))
    root, tables = scratch_dir(t.spark, "snapshot"), {name: getattr(t, name) for name in SNAPSHOT}
    transfer.publish_snapshot(tables, root)
    found = transfer.read_snapshot(t.spark, root, {name: table.schema for name, table in tables.items()})
    lines = [_lines(found[name], name, SNAPSHOT_ROWS[name]) for name in SNAPSHOT]
    return functools.reduce(DataFrame.unionByName, [*lines, _lines(landed, "events", LOADED)])
