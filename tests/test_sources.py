"""S01 to S17 and D1 to D5: the fetcher contract, the landing area and round trips."""

import datetime as dt
import gc
import json
import os
import time
from urllib.parse import quote

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.session import checkpointed, discard, materialise, scratch_dir
from tidemark.sources import keyed, landing, transfer

JAN = [dt.date(2021, 1, d) for d in range(1, 32)]


class Expired(Exception):
    pass


class Service:
    """Documents per day; ``expiries`` maps a day to the calls that fail before one succeeds."""

    def __init__(self, days, expiries=None, broken=(), pages=1):
        self.days = days
        self.expiries = expiries or {}
        self.broken = broken
        self.pages = pages
        self.failed = {}

    def connect(self):
        return object()

    def expired(self, error):
        return type(error).__name__ == "Expired"

    def splits(self, key):
        return list(range(self.pages)) if key in self.days or key in self.expiries or key in self.broken else None

    def fetch(self, session, key, split):
        if key in self.broken:
            raise ConnectionError(key)
        failed = self.failed.get(key, 0)
        documents = self.days.get(key)
        if documents is None and failed >= self.expiries.get(key, 0):
            return None
        return self._documents(key, split, documents or [], failed)

    def _documents(self, key, split, documents, failed):
        # The session expires after the first document, so a renewal must not repeat it.
        for n, document in enumerate(documents[split :: self.pages]):
            if failed < self.expiries.get(key, 0) and n == len(documents[split :: self.pages]) // 2:
                self.failed[key] = failed + 1
                raise Expired(key)
            yield document


class LineFiles:
    """Fetcher over text files laid out as ``<root>/<field>=<key>/<part>``, one document per line and a split per file."""
    def __init__(self, root: str, field: str):
        self.root = root
        self.field = field

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.root)

    def connect(self):
        return self._open()[0]

    def expired(self, error: Exception) -> bool:
        return False

    def splits(self, key) -> list[str] | None:
        from pyarrow import fs

        system, root = self._open()
        found = system.get_file_info(fs.FileSelector(f"{root}/{self.field}={quote(str(key), safe='')}", allow_not_found=True))
        return sorted(f.path for f in found if f.is_file and not f.base_name.startswith(("_", "."))) or None

    def fetch(self, session, key, split):
        import io

        with session.open_input_stream(split) as raw, io.TextIOWrapper(raw, "utf-8", newline="\n") as lines:
            for line in lines:
                yield line.rstrip("\n")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def documents(day, n=2):
    return [{"id": day.day * 100 + i} for i in range(n)]


def payloads(df):
    return sorted((r.ds, json.loads(r.payload)["id"]) for r in df.collect())


def expected(days, n=2):
    return [(d, d.day * 100 + i) for d in days for i in range(n)]


# --- S11, S12 --------------------------------------------------------------------------------


def test_s11_one_task_per_day_and_no_row_for_a_day_without_data(spark):
    service = Service({d: documents(d) for d in JAN[:5] if d.day != 3})
    found = keyed.read_days(spark, service, JAN[0], JAN[4])
    assert found.schema.simpleString() == "struct<ds:date,payload:string>"
    assert found.rdd.getNumPartitions() == 4
    assert payloads(found) == expected([d for d in JAN[:5] if d.day != 3])


def test_s11_single_day_equals_range_of_one(spark):
    service = Service({d: documents(d) for d in JAN})
    one = keyed.read_days(spark, service, JAN[7])
    assert payloads(one) == payloads(keyed.read_days(spark, service, JAN[7], JAN[7])) == expected(JAN[7:8])


def test_s11_start_after_end_is_refused(spark):
    with pytest.raises(ValueError):
        keyed.read_days(spark, Service({}), JAN[2], JAN[1])


def test_s11_no_day_has_data(spark):
    assert rows(keyed.read_days(spark, Service({}), JAN[0], JAN[4])) == []


def test_s11_a_renewed_session_continues_after_the_last_document(spark):
    service = Service({d: documents(d, 5) for d in JAN[:3]}, expiries={JAN[1]: 3})
    assert payloads(keyed.read_days(spark, service, JAN[0], JAN[2])) == expected(JAN[:3], 5)


@pytest.mark.parametrize("expiries, fails", [(5, False), (6, True)])
def test_s11_five_renewals_per_task(spark, expiries, fails):
    service = Service({JAN[0]: documents(JAN[0])}, expiries={JAN[0]: expiries})
    found = keyed.read_days(spark, service, JAN[0])
    if fails:
        with pytest.raises(PySparkException, match="Expired"):
            found.collect()
    else:
        assert payloads(found) == expected(JAN[:1])


def test_s11_other_errors_fail_the_job(spark):
    service = Service({d: documents(d) for d in JAN[:2]}, broken=JAN[1:2])
    with pytest.raises(PySparkException, match="ConnectionError"):
        keyed.read_days(spark, service, JAN[0], JAN[1]).collect()


def test_s11_a_large_day_is_read_by_many_tasks(spark):
    service = Service({JAN[0]: documents(JAN[0], 90)}, pages=6)
    found = keyed.read_days(spark, service, JAN[0])
    assert found.rdd.getNumPartitions() == 6
    assert payloads(found) == expected(JAN[:1], 90)
    capped = keyed.read_days(spark, service, JAN[0], max_tasks=4)
    assert capped.rdd.getNumPartitions() == 3
    assert payloads(capped) == expected(JAN[:1], 90)


def test_documents_take_one_line():
    assert keyed.one_line({"a": [1, None], "b": "ä\n"}) == '{"a":[1,null],"b":"ä\\n"}'
    assert keyed.one_line('{"a": 1}') == '{"a": 1}'
    assert keyed.one_line('{\n  "a": 1\n}') == '{"a":1}'


@pytest.mark.parametrize("pages", [1, 2, 5])
def test_s12_a_key_is_skipped_as_a_whole_whatever_its_splits(spark, pages):
    days = {"EUR": [{"n": n} for n in range(7)], "GBP": [{"n": n} for n in range(7)]}
    service = Service(days, broken=("GBP",), pages=pages)
    found = keyed.read_keys(spark, service, ["EUR", "GBP"], skip_errors=(ConnectionError,))
    assert {r.key for r in found.collect()} == {"EUR"} and found.count() == 7


def test_s11_renewals_do_not_depend_on_how_many_requests_share_a_task(spark):
    service = Service({d: documents(d) for d in JAN[:4]}, expiries={d: 3 for d in JAN[:4]})
    for tasks in (4, 1):
        assert payloads(keyed.read_days(spark, service, JAN[0], JAN[3], max_tasks=tasks)) == expected(JAN[:4])


def test_s13_rows_without_day_payload_or_key_are_refused(spark):
    for row, why in (((None, "{}"), "no day"), ((JAN[0], None), "no payload")):
        with pytest.raises(PySparkException, match=why):
            landing.land(spark.createDataFrame([row], "ds date, payload string"), scratch_dir(spark, "land"))
    for key in (None, ""):
        docs = spark.createDataFrame([(key, "{}")], "key string, payload string")
        with pytest.raises(PySparkException, match="no key"):
            landing.land_by_key(docs, scratch_dir(spark, "land"))


def test_s12_keys_with_signs_come_back(spark):
    root = scratch_dir(spark, "land")
    docs = spark.createDataFrame([("a:b", "1"), ("c/d", "2")], "key string, payload string")
    landing.land_by_key(docs, root)
    assert rows(landing.read_by_key(spark, root).select("key", "payload")) == [("a:b", "1"), ("c/d", "2")]
    assert rows(keyed.read_keys(spark, LineFiles(root, "key"), ["a:b", "c/d", "e"])) == [("a:b", "1"), ("c/d", "2")]


def test_s14_a_loader_is_a_source_too(spark):
    root = scratch_dir(spark, "land")
    docs = spark.createDataFrame([(d, str(d.day)) for d in JAN[:3]], "ds date, payload string")

    def load(days):
        return docs.filter(F.col("ds").isin(days))

    assert landing.daily_load(spark, load, root, JAN[0], JAN[1]) == JAN[:2]
    assert landing.daily_load(spark, load, root, JAN[0], JAN[5], force=False) == [JAN[2]]
    assert len(rows(landing.read_landed(spark, root, JAN[0], JAN[5]))) == 3


def test_scratch_files_can_be_removed(spark):
    stored = materialise(spark, spark.range(5), "test")
    assert stored.count() == 5 and os.path.isdir(stored.scratch_path.removeprefix("file:"))
    discard(stored)
    assert not os.path.exists(stored.scratch_path.removeprefix("file:"))


def test_checkpoints_leave_nothing_behind(spark):
    """The files of a checkpointed frame go once the frame is forgotten."""
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")

    def files():
        return sum(len(names) for _, _, names in os.walk(root))

    before = files()
    frame = checkpointed(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert frame.count() == 7 and files() > before
    del frame
    for _ in range(50):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before


def test_s12_named_errors_skip_a_key_and_others_stop(spark):
    service = Service({"EUR": [{"base": "EUR"}], "USD": [{"base": "USD"}]}, broken=("GBP",))
    found = keyed.read_keys(spark, service, ["EUR", "GBP", "USD", "PLN"], skip_errors=(ConnectionError,))
    assert rows(found) == [("EUR", '{"base":"EUR"}'), ("USD", '{"base":"USD"}')]
    with pytest.raises(PySparkException, match="ConnectionError"):
        keyed.read_keys(spark, service, ["EUR", "GBP"], skip_errors=(TimeoutError,)).collect()


def test_d5_documents_with_varying_keys(spark):
    service = Service({
        "EUR": [{"base": "EUR", "rates": {"USD": 1.2, "GBP": 0.9}, "date": "2021-04-01"}],
        "USD": [{"base": "USD", "rates": {"USD": 1.0}, "date": "2021-04-01"}],
    })
    root = scratch_dir(spark, "fx")
    landing.land_by_key(keyed.read_keys(spark, service, ["EUR", "USD", "XXX"]), root)
    schema = "base string, rates map<string,double>, date date"
    found = landing.read_by_key(spark, root).select("key", F.from_json("payload", schema).alias("d"))
    assert {r.key: r.d.rates for r in found.collect()} == {"EUR": {"USD": 1.2, "GBP": 0.9}, "USD": {"USD": 1.0}}


# --- S13 to S17 ------------------------------------------------------------------------------


def test_s13_s14_refresh_replaces_days_with_data_only(spark):
    root = scratch_dir(spark, "land")
    first = Service({d: documents(d) for d in JAN[:4]})
    assert landing.refresh(spark, first, root, JAN[0], JAN[4]) == JAN[:4]
    assert landing.landed_days(spark, root) == JAN[:4]
    second = Service({JAN[1]: [{"id": 1}], JAN[4]: [{"id": 2}]})
    assert landing.refresh(spark, second, root, JAN[0], JAN[4]) == [JAN[1], JAN[4]]
    found = payloads(landing.read_landed(spark, root, JAN[0], JAN[4]))
    assert found == sorted(expected([JAN[0], *JAN[2:4]]) + [(JAN[1], 1), (JAN[4], 2)])
    assert landing.refresh(spark, Service({}), root, JAN[0]) == []
    assert payloads(landing.read_landed(spark, root, JAN[0])) == expected(JAN[:1])


def test_s13_a_small_day_is_one_file(spark):
    service = Service({d: documents(d, 50) for d in JAN[:6]}, pages=5)
    root = scratch_dir(spark, "land")
    landing.land(keyed.read_days(spark, service, JAN[0], JAN[5]), root)
    assert len(spark.read.text(root).inputFiles()) == 6
    root = scratch_dir(spark, "land")
    landing.refresh(spark, service, root, JAN[0], JAN[5], max_tasks=6)
    assert len(spark.read.text(root).inputFiles()) == 6
    assert payloads(landing.read_landed(spark, root, JAN[0], JAN[5])) == expected(JAN[:6], 50)


def test_s13_a_large_day_is_written_by_many_tasks(spark, settings):
    settings(**{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"})
    root = scratch_dir(spark, "land")
    day = F.when(F.col("id") % 3 == 0, F.lit("2021-01-01")).otherwise(F.lit("2021-01-02")).cast("date")
    docs = spark.range(0, 60_000, 1, 16).select(day.alias("ds"), F.to_json(F.struct("id")).alias("payload"))
    assert landing.land(docs, root) == JAN[:2]
    files = spark.read.text(root).inputFiles()
    assert len([f for f in files if "ds=2021-01-02" in f]) > 1
    assert landing.read_landed(spark, root, JAN[0], JAN[1]).count() == 60_000


def test_s13_a_document_over_two_lines_is_refused(spark):
    docs = spark.createDataFrame([(JAN[0], '{"a":\n1}')], "ds date, payload string")
    with pytest.raises(PySparkException, match="spans lines"):
        landing.land(docs, scratch_dir(spark, "land"))


def test_s14_a_failed_refresh_keeps_what_was_landed(spark):
    root = scratch_dir(spark, "land")
    landing.refresh(spark, Service({d: documents(d) for d in JAN[:2]}), root, JAN[0], JAN[1])
    broken = Service({JAN[0]: [{"id": 0}]}, broken=JAN[1:2])
    with pytest.raises(PySparkException):
        landing.refresh(spark, broken, root, JAN[0], JAN[1])
    assert payloads(landing.read_landed(spark, root, JAN[0], JAN[1])) == expected(JAN[:2])


def test_s15_read_through_fetches_missing_days_only(spark):
    root = scratch_dir(spark, "land")
    landing.refresh(spark, Service({d: documents(d) for d in JAN[2:4]}), root, JAN[0], JAN[4])
    # The landed days are broken at the service now, so asking for them would fail.
    service = Service({JAN[0]: documents(JAN[0])}, broken=JAN[2:4])
    found = landing.read_through(spark, service, root, JAN[0], JAN[4])
    assert payloads(found) == expected([JAN[0], *JAN[2:4]])
    assert "PartitionFilters: [isnotnull(ds" in found._jdf.queryExecution().executedPlan().toString()
    empty = landing.read_through(spark, Service({}), scratch_dir(spark, "land"), JAN[0])
    assert rows(empty) == []


def test_s16_clear(spark):
    root = scratch_dir(spark, "land")
    assert landing.clear(spark, root, confirm=True) is False
    landing.refresh(spark, Service({d: documents(d) for d in JAN[:3]}), root, JAN[0], JAN[2])
    with pytest.raises(ValueError):
        landing.clear(spark, root)
    assert len(landing.landed_days(spark, root)) == 3
    assert landing.clear(spark, root, confirm=True) is True
    assert landing.landed_days(spark, root) == []
    assert landing.clear(spark, root, confirm=True) is False


def test_s17_daily_load_forced_or_not(spark):
    root = scratch_dir(spark, "land")
    old, new = Service({d: documents(d) for d in JAN[:2]}), Service({d: [{"id": 0}] for d in JAN[:3]})
    landing.daily_load(spark, old, root, JAN[0], JAN[1])
    assert landing.daily_load(spark, new, root, JAN[0], JAN[2], force=False) == [JAN[2]]
    assert payloads(landing.read_landed(spark, root, JAN[0], JAN[1])) == expected(JAN[:2])
    assert landing.daily_load(spark, new, root, JAN[0], JAN[2]) == JAN[:3]
    assert landing.daily_load(spark, new, root, JAN[0], JAN[2]) == JAN[:3]
    assert payloads(landing.read_landed(spark, root, JAN[0], JAN[2])) == [(d, 0) for d in JAN[:3]]


def test_landing_feeds_the_line_fetcher(spark):
    first, second = scratch_dir(spark, "land"), scratch_dir(spark, "land")
    landing.refresh(spark, Service({d: documents(d) for d in JAN[:3]}), first, JAN[0], JAN[2])
    landing.refresh(spark, LineFiles(first, "ds"), second, JAN[0], JAN[30])
    assert payloads(landing.read_landed(spark, second, JAN[0], JAN[30])) == expected(JAN[:3])


# --- S03 to S10, D3, D4 ----------------------------------------------------------------------

TRICKY = [
    (1, None), (2, ""), (3, 'say "hi"'), (4, "a,b"), (5, "back\\slash"), (6, "two\nlines"), (7, "\\"), (8, " pad "),
    (9, '"'), (10, "ä€"), (11, "a\rb"), (12, "a\r\nb"), (13, "\n"), (14, "#x"), (15, "\t"),
]


def test_s03_csv_round_trip_keeps_every_value(spark):
    df = spark.createDataFrame(TRICKY, "id int, s string")
    path = scratch_dir(spark, "csv")
    transfer.export_csv(df, path)
    assert rows(transfer.import_csv(spark, path, "id int, s string").na.fill("<null>")) == rows(df.na.fill("<null>"))
    assert transfer.import_csv(spark, path, "id int, s string").filter("s is null").count() == 1


def test_s03_plain_csv_writes_null_as_an_empty_field(spark):
    path = scratch_dir(spark, "csv")
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, 'q"q', "z")], "id int, s string, t string")
    transfer.export_csv(df.coalesce(1), path, ["id", "s"], transfer.PLAIN)
    assert [r.value for r in spark.read.text(path).collect()] == ["id,s", "1,", '2,""', '3,"q""q"']
    back = transfer.import_csv(spark, path, "id int, s string", transfer.PLAIN)
    assert sorted(rows(back.na.fill("<null>"))) == [(1, "<null>"), (2, "<null>"), (3, 'q"q')]


def test_d4_csv_appends_to_a_second_table(spark):
    category = spark.createDataFrame([(1, "Action"), (2, "Drama")], "category_id int, name string")
    csv, table = scratch_dir(spark, "csv"), scratch_dir(spark, "table")
    transfer.export_csv(category, csv, ["category_id", "name"])
    for _ in range(2):
        transfer.append_table(transfer.import_csv(spark, csv, category.schema), table)
    transfer.insert_rows(spark, [(100, "Inserted")], category, table)
    assert rows(spark.read.parquet(table)) == sorted(rows(category) * 2 + [(100, "Inserted")], key=str)


def test_s06_snapshot_overwrites_and_keeps_empty_tables(spark):
    root = scratch_dir(spark, "snapshot")
    schema = "id int, name string"
    tables = {
        "aisles": spark.createDataFrame([(1, "a"), (2, None)], schema),
        "clients": spark.createDataFrame([], schema),
    }
    for _ in range(2):
        assert transfer.snapshot(tables, root) == [f"{root}/aisles", f"{root}/clients"]
    assert transfer.import_csv(spark, f"{root}/aisles", schema).count() == 2
    assert transfer.import_csv(spark, f"{root}/clients", schema).count() == 0
    assert [r.value for r in spark.read.text(f"{root}/clients").distinct().collect()] == ["id,name"]


# The car records.
CAR = "model string, make string, year int"
CARS = [("ABC", "Audi", 2010)] * 5 + [("EDF", "BEWM", None)] * 5 + [("XCV", None, 2010)] * 5


def test_s09_json_lines_keep_null_fields(spark):
    path = scratch_dir(spark, "json")
    df = spark.createDataFrame(CARS, CAR)
    transfer.write_json(df, path)
    assert '"make":null' in "".join(r.value for r in spark.read.text(path).collect())
    assert transfer.read_json(spark, path, CAR).exceptAll(df).count() == 0


def test_s10_one_array_per_file(spark, tmp_path):
    records = [{"name": "Ida", "salary": 310}, {"name": "Uma", "salary": 290}, {"salary": 1}]
    (tmp_path / "pretty.json").write_text(json.dumps(records, indent=2))
    found = transfer.read_json(spark, str(tmp_path / "pretty.json"), "name string, salary bigint", multi_line=True)
    assert sorted(rows(found), key=str) == sorted([("Ida", 310), ("Uma", 290), (None, 1)], key=str)
    (tmp_path / "line.json").write_text(json.dumps(records))
    assert transfer.read_json(spark, str(tmp_path / "line.json"), "name string, salary bigint").count() == 3


def test_d3_absent_keys_are_null(spark):
    cars = [{"model": m, **({"make": k} if k else {}), **({"year": y} if y else {})} for m, k, y in CARS]
    df = spark.createDataFrame(cars, CAR)
    assert df.filter("year is null").count() == 5 and df.filter("make is null").count() == 5


def test_s07_s08_avro_round_trip_or_clear_error(spark):
    path = scratch_dir(spark, "avro")
    df = spark.createDataFrame(CARS, CAR)
    try:
        transfer.write_avro(df, path, "Cars", "sample.avro")
    except RuntimeError as error:
        assert "spark-avro" in str(error)
        with pytest.raises(RuntimeError, match="spark-avro"):
            transfer.read_avro(spark, path)
        pytest.skip("the spark-avro package is not on the class path")
    assert transfer.read_avro(spark, path).exceptAll(df).count() == 0


def test_s02_database_reads_are_split_and_credentials_come_from_outside(spark, monkeypatch):
    monkeypatch.delenv("TIDEMARK_JDBC_URL", raising=False)
    with pytest.raises(ValueError):
        transfer.jdbc_options()
    monkeypatch.setenv("TIDEMARK_JDBC_URL", "jdbc:example:x")
    monkeypatch.setenv("TIDEMARK_JDBC_USER", "u")
    options = transfer.jdbc_options()
    assert options == {"url": "jdbc:example:x", "user": "u"}
    assert transfer.partition_options("id", 0, 100, 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        transfer.read_jdbc(spark, "category", options, {})


def test_scratch_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path != scratch_dir(spark, "x")
    if named:
        assert path.startswith(named)
