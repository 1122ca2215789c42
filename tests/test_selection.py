"""The n-th value at any depth against a sorted list."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from conftest import plan_of
from tidemark.operators import ordering, selection
from tidemark.suite import QUERIES, SQL

rng = random.Random(5)
NEAR = 2**62
COLUMNS = {
    "int": [rng.randint(-50, 50) for _ in range(400)] + [7] * 300 + [None] * 20,
    "double": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)] + [math.nan] * 9 + [math.inf, -math.inf, 0.0, None],
    "bigint": [NEAR + rng.randint(0, 3_000) for _ in range(600)] + [-NEAR, NEAR],
    "decimal(38,4)": [Decimal(rng.randint(-(10**30), 10**30)) / 10**4 for _ in range(300)] + [Decimal(10) ** 30 + k for k in range(200)],
    "date": [dt.date(1900, 1, 1) + dt.timedelta(rng.randint(0, 90_000)) for _ in range(300)] + [None],
    "timestamp_ntz": [dt.datetime(1950, 1, 1) + dt.timedelta(microseconds=rng.randint(0, 10**15)) for _ in range(300)],
}


def largest_first(values):
    nan = lambda v: isinstance(v, float) and math.isnan(v)
    known = sorted((v for v in values if v is not None and not nan(v)), reverse=True)
    return [v for v in values if v is None] + [v for v in values if nan(v)] + known


@pytest.mark.parametrize("kind", list(COLUMNS))
def test_nth_largest_of_every_type(spark, kind):
    values = COLUMNS[kind]
    frame = spark.createDataFrame([(v,) for v in values], f"`a b` {kind}")
    ordered = largest_first(values)
    for n in (1, 24, len(values) // 3, len(values)):
        found = selection.nth_largest(frame, n, "a b", few_rows=20)
        assert found.schema == frame.schema
        value, wanted = found.first()[0], ordered[n - 1]
        assert value == wanted or value is not None and math.isnan(value) and math.isnan(wanted), n
    assert selection.nth_largest(frame, len(values) + 1, "a b", few_rows=20).collect() == []


def test_no_rows_ties_and_refusals(spark):
    frame = spark.range(0).withColumn("t", F.lit("x"))
    assert selection.nth_largest(frame, 1, "id").collect() == []
    same = spark.range(50_000).select(F.lit(3).alias("x"))
    assert selection.nth_largest(same, 40_000, "x", few_rows=10).collect() == [(3,)]
    with pytest.raises(TypeError, match="no number"):
        selection.nth_largest(frame, 1, "t")
    with pytest.raises(ValueError, match="count from 1"):
        selection.nth_largest(frame, 0, "id")


def test_a_few_rounds_are_enough(spark, monkeypatch):
    rounds = []
    zones = selection._zones
    monkeypatch.setattr(selection, "_zones", lambda *args: rounds.append(1) or zones(*args))
    frame = spark.range(0, 3_000_000, 1, 8).select((F.hash("id") * 1.5).alias("x"))
    found = selection.nth_largest(frame, 1_000_000, "x", few_rows=5_000).first()[0]
    assert frame.where(F.col("x") > found).count() < 1_000_000 <= frame.where(F.col("x") >= found).count()
    assert len(rounds) <= 2


def test_deep_ranks_of_the_other_operators(spark, monkeypatch):
    monkeypatch.setattr(ordering, "DEEP", 5)
    values = COLUMNS["int"]
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x int")
    for k in (40, 300, 700):
        threshold = largest_first(values)[k - 1]
        assert ordering.kth_largest(frame, k, "x").first()[0] == threshold
        assert ordering.top_k_with_ties(frame, k, "x", strict_threshold=True).count() == sum(v is not None and v >= threshold for v in values)
        known = sorted((v for v in values if v is not None), reverse=True)
        assert ordering.top_k_with_ties(frame, k, "x").count() == sum(v >= known[min(k, len(known)) - 1] for v in known)
    assert ordering.top_k_with_ties(frame, 10_000, "x").count() == 700
    assert ordering.top_k_with_ties(frame, 10_000, "x", strict_threshold=True).count() == 0
    assert "TakeOrderedAndProject" in plan_of(ordering.kth_largest(frame, 3, "x"))


@pytest.mark.parametrize("few_rows", [50, 100_000])
@pytest.mark.parametrize("name", ["c04_nth_value_at_a_deep_offset", "o08_half_of_the_groups_with_ties"])
def test_half_of_a_table(spark, monkeypatch, name, few_rows):
    nth = selection.nth_largest
    monkeypatch.setattr(selection, "nth_largest", lambda df, n, by: nth(df, n, by, few_rows))
    folder = "/root/testdata/sf0.001"
    assert difference(QUERIES[name], SQL[name], spark, connect(folder), folder) is None
