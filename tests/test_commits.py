"""Published days, snapshots and batches: what a reader sees between the steps."""

import datetime as dt
import json
import os
import random
import threading

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.sources import commits, landing, published, transfer
from tidemark.suite import QUERIES, SQL

JAN = [dt.date(2021, 1, d) for d in range(1, 32)]


def loader(spark, version):
    def load(days):
        return spark.createDataFrame([(day, f"{version} {day.day} {k}") for day in days for k in range(3)], "ds date, payload string")

    return load


def seen(frame):
    return sorted((r.ds.day, r.payload.split()[0]) for r in frame.distinct().collect() if r.payload.endswith("0"))


def files(root):
    return sorted(name for _, _, names in os.walk(root.removeprefix("file:")) for name in names if not name.startswith((".", "_")))


def test_days_are_published_in_one_step(spark, monkeypatch):
    root = scratch_dir(spark, "published")
    assert published.landed_days(spark, root) == [] and published.read_landed(spark, root, JAN[0], JAN[3]).collect() == []
    assert landing.refresh(spark, loader(spark, "old"), root, JAN[0], JAN[2], store=published) == JAN[:3]
    begun, between = published.read_landed(spark, root, JAN[0], JAN[5]), []
    commit = commits.commit

    def watched(*args):
        # The new files are written, the old ones count.
        assert len(files(f"{root}/data")) > 3
        between.append(seen(published.read_landed(spark, root, JAN[0], JAN[5])))
        return commit(*args)

    monkeypatch.setattr(commits, "commit", watched)
    assert landing.refresh(spark, loader(spark, "new"), root, JAN[1], JAN[3], store=published) == JAN[1:4]
    old, new = [(1, "old"), (2, "old"), (3, "old")], [(1, "old"), (2, "new"), (3, "new"), (4, "new")]
    assert between == [old] and seen(published.read_landed(spark, root, JAN[0], JAN[5])) == new
    assert seen(begun) == old
    assert seen(published.read_landed(spark, root, JAN[1])) == [(2, "new")]


def test_a_load_that_fails_changes_nothing(spark):
    root = scratch_dir(spark, "published")
    landing.refresh(spark, loader(spark, "old"), root, JAN[0], JAN[1], store=published)

    def broken(days):
        return loader(spark, "new")(days).withColumn("payload", F.when(F.col("ds") == JAN[1], F.lit("two\nlines")).otherwise(F.col("payload")))

    with pytest.raises(Exception, match="spans lines"):
        landing.refresh(spark, broken, root, JAN[0], JAN[1], store=published)
    assert seen(published.read_landed(spark, root, JAN[0], JAN[1])) == [(1, "old"), (2, "old")]


def test_gaps_read_through_and_clear(spark):
    root = scratch_dir(spark, "published")
    assert landing.daily_load(spark, loader(spark, "a"), root, JAN[1], store=published) == [JAN[1]]
    assert seen(landing.read_through(spark, loader(spark, "b"), root, JAN[0], JAN[2], store=published)) == [(1, "b"), (2, "a"), (3, "b")]
    assert landing.fill_gaps(spark, loader(spark, "c"), root, JAN[0], JAN[2], store=published) == []
    assert landing.refresh(spark, lambda days: loader(spark, "d")([]), root, JAN[0], JAN[2], store=published) == []
    with pytest.raises(ValueError):
        published.clear(spark, root)
    assert published.clear(spark, root, confirm=True) and not published.clear(spark, root, confirm=True)
    assert published.landed_days(spark, root) == []


def test_sweep_removes_what_no_commit_names(spark):
    root = scratch_dir(spark, "published")
    for version in "abc":
        landing.refresh(spark, loader(spark, version), root, JAN[0], JAN[1], store=published)
    landing.refresh(spark, loader(spark, "d"), root, JAN[1], store=published)
    assert commits.sweep(spark, root) == []
    removed = commits.sweep(spark, root, dt.timedelta(seconds=-5))
    assert len(removed) == 2 and len(files(f"{root}/commits")) == 1
    assert seen(published.read_landed(spark, root, JAN[0], JAN[1])) == [(1, "c"), (2, "d")]
    assert commits.sweep(spark, scratch_dir(spark, "published")) == []


def test_commits_that_meet_lose_nothing(spark, monkeypatch):
    root = scratch_dir(spark, "commits")
    commits.commit(spark, root, lambda state: state | {"a": {"load": "1"}})
    rename, other = commits._rename, []

    def late(*args):
        if not other:
            other.append(1)
            commits.commit(spark, root, lambda state: state | {"b": {"load": "2"}})
        return rename(*args)

    monkeypatch.setattr(commits, "_rename", late)
    assert commits.commit(spark, root, lambda state: state | {"c": {"load": "3"}}).keys() == {"a", "b", "c"}
    assert commits.state(spark, root).keys() == {"a", "b", "c"} and len(files(f"{root}/commits")) == 3
    monkeypatch.setattr(commits, "_rename", lambda *args: False)
    monkeypatch.setattr(commits, "ATTEMPTS", 2)
    with pytest.raises(RuntimeError, match="came in between"):
        commits.commit(spark, root, lambda state: {})


TABLE = "id int, s string"


def tables(spark, n):
    return {"one": spark.createDataFrame([(k, f"v{n}") for k in range(n)], TABLE), "two": spark.createDataFrame([(n, None), (n, 'a "b",\n')], TABLE)}


def test_a_snapshot_is_one_state(spark, monkeypatch):
    root, schemas = scratch_dir(spark, "snapshot"), {"one": TABLE, "two": TABLE}
    with pytest.raises(RuntimeError, match="has no table one"):
        transfer.read_snapshot(spark, root, schemas)
    manifest = transfer.publish_snapshot(tables(spark, 3), root)
    assert {name: entry["rows"] for name, entry in manifest.items()} == {"one": 3, "two": 2}
    export = transfer.export_csv

    def crash(df, path, **options):
        if "s" in df.columns and df.count() == 2:
            raise OSError("disk")
        export(df, path, **options)

    monkeypatch.setattr(transfer, "export_csv", crash)
    with pytest.raises(OSError, match="disk"):
        transfer.publish_snapshot(tables(spark, 5), root)
    monkeypatch.undo()
    found = transfer.read_snapshot(spark, root, schemas, check=True)
    assert found["one"].count() == 3 and found["two"].where("id = 3").count() == 2
    transfer.publish_snapshot(tables(spark, 4) | {"none": spark.createDataFrame([], TABLE)}, root)
    found = transfer.read_snapshot(spark, root, schemas | {"none": TABLE}, check=True)
    assert [found[name].count() for name in ("one", "two", "none")] == [4, 2, 0]


@pytest.mark.parametrize("damage, check", [("remove", False), ("change", True)])
def test_a_damaged_snapshot_is_refused(spark, damage, check):
    root = scratch_dir(spark, "snapshot")
    manifest = transfer.publish_snapshot(tables(spark, 3), root)
    folder = f"{root}/data/{manifest['one']['load']}".removeprefix("file:")
    name = next(n for n in sorted(os.listdir(folder)) if n.startswith("part-") and "v3" in open(f"{folder}/{n}").read())
    if damage == "remove":
        os.remove(f"{folder}/{name}")
    else:
        text = open(f"{folder}/{name}").read()
        os.remove(f"{folder}/.{name}.crc")
        open(f"{folder}/{name}", "w").write(text.replace("v3", "w3"))
        manifest["one"] |= transfer._on_disk(spark, folder)
        commits.commit(spark, root, lambda state: manifest)
        transfer.read_snapshot(spark, root, {"one": TABLE})
    with pytest.raises(RuntimeError, match="damaged: one"):
        transfer.read_snapshot(spark, root, {"one": TABLE}, check=check)


def test_a_batch_is_appended_once(spark, monkeypatch):
    root = scratch_dir(spark, "ledger")
    assert transfer.read_batches(spark, root, TABLE).collect() == []
    frame = spark.createDataFrame([(1, "a"), (1, "a")], TABLE)
    assert transfer.append_batch(frame, root, "first") and not transfer.append_batch(frame, root, "first")
    assert transfer.insert_batch(spark, [(2, None)], TABLE, root, "second")
    # Two jobs with one batch: the second has looked before the first commits.
    state = commits.state
    monkeypatch.setattr(commits, "state", lambda *args: {})
    before = files(f"{root}/data")
    assert not transfer.append_batch(frame, root, "first")
    monkeypatch.setattr(commits, "state", state)
    assert files(f"{root}/data") == before
    assert sorted(map(tuple, transfer.read_batches(spark, root, TABLE).collect()), key=str) == [(1, "a"), (1, "a"), (2, None)]
    jobs = [threading.Thread(target=transfer.append_batch, args=(frame, root, "first")) for _ in range(3)]
    [job.start() for job in jobs], [job.join() for job in jobs]
    assert transfer.read_batches(spark, root, TABLE).count() == 3


@pytest.mark.parametrize("partitions", [1, 3])
def test_files_are_bounded_by_bytes(spark, partitions):
    rng = random.Random(partitions)
    sizes = [rng.choice([1, 10, 100, 20_000, 60_000]) for _ in range(300)] + [60_000] * 20 + [0] * 50
    rows = [(k, ('"' if k % 7 == 0 else "x") * (size // 2 if k % 7 == 0 else size), None, k) for k, size in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "id int, text string, part string, bytes int").coalesce(partitions)
    path, bound = scratch_dir(spark, "csv"), 64_000
    transfer.export_csv(frame, path, max_bytes=bound)
    folder = path.removeprefix("file:")
    written = [os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n.startswith("part-")]
    assert max(written) <= 2 * bound and len(written) <= 2 * sum(written) / bound + 2
    back = transfer.import_csv(spark, path, frame.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert transfer.dealt_by_bytes(frame, 1 << 40) is frame and transfer.dealt_by_bytes(frame.select("id"), 1).columns == ["id"]
    empty = scratch_dir(spark, "csv")
    transfer.export_csv(frame.limit(0), empty, max_bytes=1)
    assert transfer.import_csv(spark, empty, frame.schema).count() == 0


def test_keys_are_published_in_one_step(spark):
    root, schema = scratch_dir(spark, "keyed"), "key string, payload string"
    assert published.read_by_key(spark, root).collect() == []
    assert published.land_by_key(spark.createDataFrame([("EUR", "1"), ("a:b", "2"), ("c/d", "3")], schema), root) == ["EUR", "a:b", "c/d"]
    begun = published.read_by_key(spark, root)
    assert published.land_by_key(spark.createDataFrame([("EUR", "4"), ("USD", "5"), ("USD", "6")], schema), root) == ["EUR", "USD"]
    assert published.land_by_key(spark.createDataFrame([], schema), root) == []
    rows = lambda df: sorted(tuple(r) for r in df.select("key", "payload").collect())
    assert rows(published.read_by_key(spark, root)) == [("EUR", "4"), ("USD", "5"), ("USD", "6"), ("a:b", "2"), ("c/d", "3")]
    assert rows(begun) == [("EUR", "1"), ("a:b", "2"), ("c/d", "3")]
    with pytest.raises(Exception, match="no key"):
        published.land_by_key(spark.createDataFrame([(None, "1")], schema), root)


PUBLISHED = "s04_append_of_repeated_batches s06_published_snapshot s14_published_refresh d2_published_load_and_snapshot d5_published_documents_per_key"


@pytest.mark.parametrize("name", PUBLISHED.split())
def test_published_queries(spark, name):
    folder = "/root/testdata/sf0.001"
    assert difference(QUERIES[name], SQL[name], spark, connect(folder), folder) is None


def test_commit_files_are_json(spark):
    root = scratch_dir(spark, "commits")
    commits.commit(spark, root, lambda state: {"ä": {"load": "x"}})
    assert commits.commit(spark, root, lambda state: None) == {"ä": {"load": "x"}}
    [name] = files(f"{root}/commits")
    assert json.load(open(f"{root}/commits/{name}".replace("file:", ""))) == {"ä": {"load": "x"}}
