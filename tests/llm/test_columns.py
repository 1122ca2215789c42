"""Input columns that have the operators' own names, very long texts, and keys that are hot."""

import collections
import random

import pytest
from corpus_fixtures import documents, mixed_texts  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import plan_of
from tidemark.llm import bpe, decontam, extract, graph, records, rlz, runs, sharding, simhash, toxicity

NAMES = (
    "_doc _t _key _spans _h _r _cell _target _ends _start _k _l _features _vector _margin _p _label _page _block key doc t marked k l "
    "h c n m row page part c0 c1 i0 i1 copy on_bit bit fp first root node bucket value combo held toxic fold runs_ marked_ KEY_"
).split()


@pytest.fixture
def crowded_names(documents, mixed_texts):
    """Documents with a column for every name, which holds that name and the id."""
    texts = [*enumerate(mixed_texts(11, count=12)), (3, "twice"), (3, "twice"), (None, "no id")]
    frame = documents(texts)
    return frame.select("doc_id", "text", *[F.concat_ws(" ", F.lit(name), "doc_id").alias(name) for name in NAMES])


def untouched(found, frame, rows):
    names = [name for name in frame.columns if name != "text"]
    assert all(name in found.columns for name in names)
    done = found.collect()
    for row in done:
        assert all(row[name] == (name if row.doc_id is None else f"{name} {row.doc_id}") for name in NAMES)
    assert rows is None or len(done) == rows


def test_columns_pass_through_every_operator(spark, crowded_names):
    frame, count = crowded_names, crowded_names.count()
    items = spark.createDataFrame([(1, "an item that is nowhere in these texts")], "item_id long, text string")
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(20)], "doc_id long, quality int, toxic int")
    untouched(rlz.remove_duplicates(frame, width=20), frame, count)
    untouched(decontam.remove_contaminated(frame, items), frame, count)
    untouched(simhash.keep_first(frame), frame, None)
    untouched(runs.collapse_runs(frame), frame, count)
    untouched(toxicity.score_documents(frame, labels, rounds=2), frame, count)
    path = corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")
    untouched(bpe.encode(frame, path, digests=True), frame, count)
    untouched(bpe.encode(frame, path, verify=True), frame, count)
    untouched(extract.extract(frame, "text"), frame, count)
    sharded = sharding.shuffle_into_shards(frame, [F.col("doc_id"), F.col("text")], 3)
    untouched(sharded, frame, count)


def test_stages_keep_all_columns(spark, crowded_names, tmp_path):
    folder, frame = str(tmp_path), crowded_names.withColumn("score", F.lit(1)).withColumn("n_tokens", F.lit("old"))
    spark.createDataFrame([(k, 0, k % 2) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "an item that is nowhere here")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, frame, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert done.schema == frame.schema or [(f.name, f.dataType) for f in done.schema] == [(f.name, f.dataType) for f in frame.schema], name
        untouched(done, frame.drop("n_tokens"), None)
    assert dict(done.dtypes)["n_tokens"] == "bigint"


def test_length_column_follows_the_text(spark, documents):
    passage = " ".join(f"w{k}" for k in range(60))
    frame = documents([(1, passage), (2, f"before {passage} after"), (3, None)]).withColumn("n_chars", F.col("n_chars").cast("int"))
    rows = {r.doc_id: r for r in corpus_pipeline.cut_repeated_passages(spark, frame, "").collect()}
    assert rows[2].text == "before after" and rows[2].n_chars == 12 and rows[1].n_chars == len(passage) and rows[3].n_chars == 0


LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_a_hub_of_links_is_split(spark, settings, monkeypatch):
    settings(**LARGE)
    plans, materialise = [], graph.materialise

    def watched(session, frame, purpose):
        plans.append(plan_of(frame))
        return materialise(session, frame, purpose)

    monkeypatch.setattr(graph, "materialise", watched)
    # One node with 60,000 neighbours, beside chains.
    hub = spark.range(60_000).select(F.xxhash64("id").alias("a"), F.lit(-(2**62)).alias("b"))
    chains = spark.range(3_000).select((F.col("id") * 3 + 1).alias("a"), (F.col("id") * 3 + 2).alias("b"))
    found = graph.components(spark, hub.unionByName(chains))
    counts = collections.Counter(r["count"] for r in found.groupBy("root").count().collect())
    least = hub.agg(F.least(F.min("a"), F.min("b"))).first()[0]
    assert found.where(F.col("root") == least).count() == 60_000 and counts[1] == 3_000
    assert any("skew=true" in plan for plan in plans)


def test_copies_are_numbered_and_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 100)
    frame = spark.range(5_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 900).alias("k"), F.lit("x").alias("t"))
    numbered = sharding.numbered_copies(frame)
    for row in numbered.groupBy("k", "t").agg(F.sort_array(F.collect_list("copy")).alias("copies")).collect():
        assert row.copies == list(range(len(row.copies)))
    assert numbered.count() == 5_000 and sharding.numbered_copies(frame.limit(0)).collect() == []
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 50)
    done = sharding.shuffle_into_shards(numbered, [F.col("k"), F.col("t"), F.col("copy")], 4).collect()
    slots = collections.defaultdict(list)
    for row in done:
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(1_250)) for s in slots.values()) and len(slots) == 4
    hot = collections.Counter(row.shard for row in done if row.k is None)
    assert max(hot.values()) - min(hot.values()) < 200


def test_items_of_several_blocks_are_held_one_at_a_time(spark, documents, monkeypatch):
    rng = random.Random(1)
    item = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(10))
    items = [(k, item()) for k in range(40)]
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (1_200,))
    table = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontam.item_blocks(table))) >= 3
    open_blocks, most = set(), []
    context, settled = type(spark.sparkContext), decontam._settled
    broadcast = context.broadcast

    def opened(self, value):
        made = broadcast(self, value)
        open_blocks.add(id(made))
        most.append(len(open_blocks))
        return made

    def closed(frame, shared, purpose):
        done = settled(frame, shared, purpose)
        open_blocks.discard(id(shared))
        return done

    monkeypatch.setattr(context, "broadcast", opened)
    monkeypatch.setattr(decontam, "_settled", closed)
    texts = [(k, f"some words {items[k][1]} and more") for k in range(40)] + [(99, "nothing here at all")]
    found = decontam.contaminated(documents(texts), table)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(k, k) for k in range(40)]
    assert max(most) == 1 and len(most) >= 3
    open_blocks.clear()
    assert [r.doc_id for r in decontam.remove_contaminated(documents(texts), table).collect()] == [99]
    assert max(most) == 1


def test_very_long_texts(spark, documents):
    long = " ".join(f"word{k % 977}" for k in range(300_000))
    frame = documents([(1, long), (2, long), (3, "short"), (4, long + " more")])
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame).collect()}
    assert found[1] == found[2] == 1 and found[3] == 3
    url = records.scratch_dir(spark, "records")
    path = corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")
    records.tokenize_to_records(frame.withColumnRenamed("doc_id", "id"), path, 1, url)
    done = {r.id: bytes(r.ids) for r in records.read_records(spark, url).collect()}
    assert done[1] == done[2] and done[4].startswith(done[1][:-4]) and len(done[1]) > 4 * 300_000 and len(done[3]) >= 8


def test_odd_labels_are_no_labels(spark, documents):
    labels = spark.createDataFrame([(k, 0, [0, 1, 2, -1][k % 4]) for k in range(40)], "doc_id long, quality int, toxic int")
    found = toxicity.score_documents(documents([(k, f"text {k}") for k in range(40)]), labels, rounds=2).collect()
    assert len(found) == 40 and all(0 <= r.score <= 1 for r in found)


def test_corpus_queries_are_registered():
    import importlib.util
    import os

    from tidemark.llm.queries import QUERIES, SQL

    root = os.path.dirname(corpus_pipeline.__file__)
    spec = importlib.util.spec_from_file_location("entry_points", os.path.join(root, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert QUERIES.items() <= module.queries().items() and SQL.items() <= module.oracle_sql().items()
    assert "pipeline" in module.queries() and "pipeline" not in module.oracle_sql()


def test_contract_columns_of_the_newer_queries(spark):
    from tidemark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    count = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "conversations")}
    wanted = {
        "op11_chat_format": ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint", count["conversations"].select("conv_id").distinct().count() + 1),
        "op12_filter_audit": ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint", 600 * count["documents"].select("source").distinct().count()),
        "op13_periodic_runs": ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string", count["documents"].count()),
    }
    for name, (columns, rows) in wanted.items():
        found = QUERIES[name](spark, folder)
        assert ", ".join(f"{c} {kind}" for c, kind in found.dtypes) == columns and found.count() == rows, name
