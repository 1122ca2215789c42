"""Operator 12 against all orders run one by one."""

import random
from itertools import permutations
from math import factorial

import pytest
from corpus_fixtures import documents  # noqa: F401

from conftest import plan_of
from tidemark.llm import audit


def test_paths_through_the_lattice():
    for n in range(1, 6):
        reaching, leaving = audit.path_counts(n)
        for state in range(1 << n):
            done = state.bit_count()
            assert (reaching[state], leaving[state]) == (factorial(done), factorial(n - done))
        rows = audit.edges(n)
        assert len(rows) == n * 2 ** (n - 1)
        assert [sum(w for s, _, w in rows if s.bit_count() == k) for k in range(n)] == [factorial(n)] * n


def by_hand(rows, names):
    """rows: (part, set of failed names, loss)."""
    out = {}
    for part in {row[0] for row in rows}:
        own = [row for row in rows if row[0] == part]
        shapley = dict.fromkeys(names, 0)
        lines = []
        for order in permutations(names):
            left = own
            for step, name in enumerate(order, 1):
                removed = [row for row in left if name in row[1]]
                left = [row for row in left if name not in row[1]]
                failing = sum(name in row[1] for row in own)
                alone = sum(row[1] == {name} for row in own)
                shapley[name] += len(removed)
                lines.append(("".join(order), step, len(left), len(removed), failing - len(removed), alone, sum(row[2] for row in removed)))
        for order, step, *counts in lines:
            out[part, order, step] = (*counts, shapley[order[step - 1]])
    return out


@pytest.mark.parametrize("names", ["A", "AB", "ABCD"])
def test_audit_equals_all_orders(spark, names):
    rng = random.Random(len(names))
    rows = [(rng.choice(["x", "y", None]), {n for n in names if rng.random() < 0.4}, rng.random() < 0.3) for _ in range(200)]
    rows += [("hot", {names[0]}, True)] * 150
    # Input columns with names that the operator uses, and null flags for false.
    flat = [(part, *[True if n in failed else rng.choice([False, None]) for n in names], loss, 1, "e") for part, failed, loss in rows]
    ddl = "where string, " + ", ".join(f"{n} boolean" for n in names) + ", bad boolean, n int, edge string"
    frame = spark.createDataFrame(flat, ddl)
    found = audit.audit(frame, list(names), "where", {"bad_lost": "bad"})
    assert found.columns == ["where", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "bad_lost", "shapley"]
    assert {tuple(row)[:3]: tuple(row)[3:] for row in found.collect()} == by_hand(rows, names)
    assert audit.audit(frame.limit(0), list(names), "where").collect() == []
    with pytest.raises(ValueError, match="1 to 7 filters"):
        audit.audit(frame, [], "where")


def flags_by_hand(pairs):
    lowest = {}
    for key, text in pairs:
        if key is not None:
            lowest[text or ""] = min(lowest.get(text or "", key), key)
    out = []
    for key, text in pairs:
        text = text or ""
        words = text.encode().split()
        failed = {"A"} if len(words) < 200 else set()
        failed |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        failed |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else set()
        failed |= {"D"} if set(text) & set("#$%&*|") else set()
        failed |= {"E"} if key is not None and key > lowest[text] else set()
        out.append((key, failed))
    return out


def test_flags_of_texts(spark, documents):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(4))
    texts = [" ".join(word() for _ in range(rng.randint(1, 400))) for _ in range(40)]
    texts += ["A" * 2 + "a" * 98, "A" * 3 + "a" * 97, "one\x1cword " * 210, "É" * 300, "#", "a|b", None, "", " \n", "x " * 100_000, "w\x0b" * 200, "日 " * 199]
    pairs = [(k, t) for k, t in enumerate(texts)] + [(500 + k, texts[k]) for k in range(0, 40, 3)] + [(None, texts[0]), (7, texts[7]), (900, ""), (-1, None)]
    labels = [(0, 1, 0), (0, 0, 1), (7, 1, 1), (None, 1, 1), (12345, 1, 1), (3, None, None)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.text_flags(documents(pairs).withColumnRenamed("lang", "part").withColumnRenamed("n_chars", "digest"), known).collect()
    assert sorted(((r.doc_id, {n for n in "ABCDE" if r[n]}) for r in found), key=str) == sorted(flags_by_hand(pairs), key=str)
    assert {(r.doc_id, r.good, r.toxic) for r in found if r.good or r.toxic} == {(0, True, True), (7, True, True)}


def test_a_hot_text_is_split(spark, documents, settings):
    settings(**{
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    # Copies of one digest take few bytes, and Spark splits by bytes: five in six rows.
    rows = [(k, "the same text" if k % 6 else f"text {k}") for k in range(12_000)]
    frame = documents(rows).repartition(8)
    known = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    flags = audit.text_flags(frame, known)
    assert "skew=true" in plan_of(flags)
    assert flags.where("E").count() == 9_999
