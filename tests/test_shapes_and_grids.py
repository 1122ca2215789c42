"""Documents of any shape, mergeable distinct counts and joins of keys that are hot on both sides."""

import itertools
import random

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tidemark.functions import payloads
from tidemark.operators import distinct, skew
from tidemark.suite import QUERIES, SQL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_documents_keep_every_key(spark):
    texts = ['{"a": 1, "b": {"x": [1, "é"]}}', '{"a": "one", "c d": null}', "[1, 2]", "{}", "7", "no json", None, '{"b": {"x": 2.50}, "": true}']
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("doc", payloads.decode_any("text"))
    assert rows(payloads.entries(frame, "doc", "id")) == sorted([
        (0, "a", "1"), (0, "b", '{"x":[1,"é"]}'), (1, "a", '"one"'), (1, "c d", "null"), (7, "", "true"), (7, "b", '{"x":2.5}'),
    ], key=str)
    fields = frame.select(payloads.field("doc", "$.a", "int"), payloads.field("doc", "$.b.x", "double"), payloads.field("doc", "$.b.x[1]", "string"))
    found = [tuple(r) for r in fields.collect()]
    assert found[0] == (1, None, "é") and found[1] == (None, None, None) and found[7] == (None, 2.5, None) and found[6] == (None,) * 3


def values(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["x", "y", None]), rng.choice([rng.randint(0, 70_000), rng.randint(-9, 9), None])) for _ in range(3_000)]
    return spark.createDataFrame([*rows, ("only null", None), ("far", 2**62), ("far", -(2**62))], "k string, v long")


def test_distinct_states(spark):
    one, two = values(spark, 1), values(spark, 2)
    both = one.unionByName(two)
    wanted = rows(both.groupBy("k").agg(F.count_distinct("v").alias("n")))
    assert rows(distinct.group_distinct_dense(both, ["k"], "v", "n")) == wanted
    states = [distinct.distinct_state(frame, ["k"], "v") for frame in (one, two, one)]
    assert rows(distinct.distinct_count(distinct.merge_states(*states), "n")) == wanted
    assert max(len(r.bits) for r in states[0].collect()) <= 4096
    assert distinct.group_distinct_dense(one.limit(0), ["k"], "v", "n").collect() == []
    total = distinct.group_distinct_dense(both, [], "v", "n")
    assert rows(total) == rows(both.agg(F.count_distinct("v").alias("n")))


def sides(spark, count, share):
    """Keys of which one holds ``share`` of all rows."""
    key = F.when(F.col("id") % 100 < int(100 * share), 0).when(F.col("id") % 97 == 5, None).otherwise(1 + F.col("id") % 50)
    return spark.range(count).select(key.cast("int").alias("k"), F.col("id"))


@pytest.mark.parametrize("cell_pairs", [1, 900, skew.CELL_PAIRS])
def test_grid_join_equals_a_join(spark, cell_pairs):
    left = sides(spark, 300, 0.34).withColumnRenamed("id", "l").withColumn("m", F.create_map(F.lit("a"), "l"))
    right = sides(spark, 400, 0.34).withColumnRenamed("id", "r")
    right = right.unionByName(right.where("k = 0"))
    found, wanted = skew.grid_join(left, right, "k", cell_pairs), left.join(right, "k")
    assert found.columns == wanted.columns and rows(found.drop("m")) == rows(wanted.drop("m"))
    assert skew.grid_join(left.limit(0), right, "k", cell_pairs).collect() == []


def test_a_key_hot_on_both_sides_is_spread(spark, settings):
    settings(**{
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    })
    left, right = sides(spark, 3_000, 0.34).withColumnRenamed("id", "l"), sides(spark, 3_000, 0.34).withColumnRenamed("id", "r")

    def largest_task(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    joined = left.join(right, "k")
    total, plain = joined.count(), largest_task(joined)
    # A third of both sides is one key: nine in ten pairs are its.
    assert plain > 0.9 * total
    found = skew.grid_join(left, right, "k", cell_pairs=4_000)
    assert found.count() == total and largest_task(found) < 0.15 * total


NAMES = ["j03_many_to_many_rows", "a09_distinct_dense_keys", "a09_distinct_of_merged_states", "f09_documents_of_any_shape"]


@pytest.mark.parametrize("name", NAMES)
def test_queries(spark, name):
    folder = "/root/testdata/sf0.001"
    assert difference(QUERIES[name], SQL[name], spark, connect(folder), folder) is None


@pytest.mark.parametrize("small", ["left", "right"])
def test_rows_beside_a_broadcast_side_are_spread(spark, small):
    few, many = sides(spark, 300, 0.34).coalesce(1), sides(spark, 3_000, 0.34).coalesce(1)
    left, right = (few, many) if small == "left" else (many, few)
    left, right = left.withColumnRenamed("id", "l"), right.withColumnRenamed("id", "r")
    wanted, found = left.join(right, "k"), skew.grid_join(left, right, "k", cell_pairs=8_000)
    assert found.columns == wanted.columns and rows(found) == rows(wanted)
    sizes = [r[0] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).collect()]
    # All pairs were made by the one task that read the larger side.
    assert len(sizes) > 5 and max(sizes) < 0.35 * sum(sizes)


@pytest.mark.parametrize("cell_pairs", [1, 900])
def test_grid_without_broadcast_equals_a_join(spark, settings, cell_pairs):
    settings(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    left = sides(spark, 300, 0.34).withColumnRenamed("id", "l").withColumn("m", F.create_map(F.lit("a"), "l"))
    right = sides(spark, 400, 0.34).withColumnRenamed("id", "r")
    right = right.unionByName(right.where("k = 0"))
    found, wanted = skew.grid_join(left, right, "k", cell_pairs), left.join(right, "k")
    assert found.columns == wanted.columns and rows(found.drop("m")) == rows(wanted.drop("m"))


def shuffled(node):
    """Rows that the shuffles of an executed plan wrote."""
    kind = node.getClass().getSimpleName()
    if kind == "ReusedExchangeExec":
        return 0
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(node.plan())
    own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled(node.children().apply(i)) for i in range(node.children().size()))


def test_shuffles_are_bounded_by_the_rows_not_by_the_pairs(spark, settings, monkeypatch):
    settings(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    monkeypatch.setattr(skew, "MIN_COPIES", 0, raising=False)

    left, right = (sides(spark, n, 0.34).withColumnRenamed("id", name) for n, name in ((2_000, "l"), (12_000, "r")))
    sums = [F.count(F.lit(1)), F.sum(F.xxhash64("k", "l", "r").cast("decimal(38,0)"))]
    found = skew.grid_join(left, right, "k", cell_pairs=400).agg(*sums)
    assert rows(found) == rows(left.join(right, "k").agg(*sums))
    # Nearly three million pairs: both sides were copied, twenty times as many rows were shuffled as there are.
    assert shuffled(found._jdf.queryExecution().executedPlan()) < 2.5 * 14_000


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_rows_come_in_runs(spark, settings, threshold):
    settings(**{"spark.sql.autoBroadcastJoinThreshold": threshold, "spark.sql.adaptive.autoBroadcastJoinThreshold": threshold})
    left, right = sides(spark, 300, 0.34).withColumnRenamed("id", "l"), sides(spark, 3_000, 0.34).withColumnRenamed("id", "r")
    found = skew.grid_join(left, right, "k", cell_pairs=2_500).where("k = 0").select(F.spark_partition_id(), "r").collect()
    assert len(found) == 102 * 1_020
    # One of the left side with many of the right was followed by the next: no two rows in turn had a value of r in common.
    assert sum(a == b for a, b in zip(found, found[1:])) > 0.9 * len(found)


def test_strips_are_of_whole_eights(spark, settings):
    settings(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    left, right = sides(spark, 1_200, 0.34).withColumnRenamed("id", "l"), sides(spark, 1_400, 0.34).withColumnRenamed("id", "r")
    joined = skew.grid_join(left, right, "k", cell_pairs=10_000)
    assert rows(joined) == rows(left.join(right, "k"))
    found = joined.where("k = 0").select(F.spark_partition_id(), "r").collect()
    runs = [len(list(run)) for _, run in itertools.groupby(found)]
    # Of 408 rows in five strips, seven a strip at most are over and stand in a strip of their own.
    assert sum(n for n in runs if n % 8 == 0) >= len(found) * 373 // 408 and len(runs) <= 6 * 476
