"""Operator 13 against a brute-force search of all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from corpus_fixtures import documents  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import runs


def runs_by_hand(words, least_length=6, least_periods=4):
    """Every maximal stretch of each period; of a stretch found with several periods the least one counts."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end - start >= period:
                found.setdefault((start, end + period), period)
            start = end + 1
    rows = [(s, e - s, p) for (s, e), p in found.items() if e - s >= max(least_length, least_periods * p)]
    return sorted(rows, key=lambda row: (row[0], row[2]))


def collapsed_by_hand(words, found):
    out = {k for start, length, period in found for k in range(start + period, start + length)}
    return " ".join(word for k, word in enumerate(words) if k not in out)


def looped_by_hand(key, words):
    checksum = zlib.crc32(str(key).encode())
    if checksum % 10 or not words:
        return words
    drawn, count = checksum // 10, len(words)
    start = drawn % count
    period = 1 + (count - start) // (3 + drawn % 8)
    return [word if i < start else words[start + (i - start) % period] for i, word in enumerate(words)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


blocks = st.lists(st.sampled_from("abc"), min_size=1, max_size=5)
texts = st.lists(st.tuples(blocks, st.integers(1, 9)), max_size=6).map(lambda parts: [w for part, n in parts for w in part * n])


@given(st.lists(texts, max_size=4), st.sampled_from([(6, 4), (2, 2), (5, 3)]), st.sampled_from([3, 1 << 20]))
@settings(max_examples=300, deadline=None)
def test_runs_equal_brute_force(rows, least, pairs):
    before, runs.PAIRS = runs.PAIRS, pairs
    try:
        found, kept = runs._searched([" ".join(words) for words in rows], *least)
    finally:
        runs.PAIRS = before
    for words, own, text in zip(rows, found, kept):
        wanted = runs_by_hand(words, *least)
        assert [tuple(run.values()) for run in own] == wanted
        assert text == collapsed_by_hand(words, wanted)


@given(st.lists(st.sampled_from("ab"), min_size=1, max_size=40))
@settings(max_examples=150, deadline=None)
def test_suffix_array_and_smaller_children(letters):
    words = np.array([ord(x) for x in letters], np.int64)
    built = runs.SuffixArray(words, np.full(len(words), len(words)))
    assert built.order.tolist() == sorted(range(len(letters)), key=lambda i: letters[i:])
    common = [0] + [next((d for d in range(len(letters)) if letters[a : a + d + 1] != letters[b : b + d + 1] or max(a, b) + d >= len(letters)), 0) for a, b in zip(built.order, built.order[1:])]
    assert built.lcp.tolist() == common
    low, high, first, end, depth = runs.children(built.lcp)
    for row in zip(low, high, first, end, depth):
        assert row[2] <= row[0] < row[1] <= row[3] and 2 * (row[1] - row[0]) <= row[3] - row[2]
        assert len({tuple(letters[i : i + row[4]]) for i in built.order[row[2] : row[3]]}) == 1


def odd_texts():
    rng = random.Random(3)
    rows = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 200))) for _ in range(60)]
    rows += ["a " * 40, "\ta\nb " * 8 + "c", "x y z " * 5 + "x y", "a" * 5000, "", None, " \n\t ", "é\x00  é\x00  " * 6, "a a a a a", "a a a a a a"]
    return rows


def test_frame_keeps_columns_and_rows(spark, documents):
    rows = [*enumerate(odd_texts()), (None, "b b b b b b"), (3, "q " * 7), (3, "q " * 7), (99, "u v w " * 60_000 + "long words " * 3)]
    frame = documents(rows).withColumnsRenamed({"lang": "runs", "source": "best"})
    found = runs.collapse_runs(frame)
    assert found.columns == ["doc_id", "text", "best", "n_chars", "runs"]
    done = found.collect()
    assert len(done) == len(rows)
    for (key, text), row in zip(rows, done):
        if key == 99:
            # 60,000 periods of three words, too many for the search by hand.
            assert [tuple(run) for run in row.runs] == [(0, 180_000, 3)] and row.text == "u v w" + " long words" * 3
            continue
        wanted = runs_by_hand((text or "").encode().split())
        assert (row.doc_id, [tuple(run) for run in row.runs]) == (key, wanted)
        assert row.text == (None if text is None else collapsed_by_hand([w.decode() for w in text.encode().split()], wanted))
    assert runs.collapse_runs(documents([])).collect() == []


def test_query_equals_brute_force(spark, documents, tmp_path):
    rng = random.Random(8)
    rows = [*enumerate(odd_texts()), *[(1000 + k, " ".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 90)))) for k in range(300)]]
    rows += [(None, "b b b b b b"), (5, ""), (5, ""), (-12, "m n " * 9)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    done = sorted((tuple(row) for row in runs.op13(spark, str(tmp_path)).collect()), key=str)
    wanted = []
    for key, text in rows:
        words = [word.decode() for word in (text or "").encode().split()]
        if key is not None:
            words = looped_by_hand(key, words)
        found = runs_by_hand(words)
        best = min(found, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2])) if found else (None,) * 3
        milli = 1000 * best[1] // best[2] if found else None
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        wanted.append((key, len(found), *best, milli, digest(lines), digest(collapsed_by_hand(words, found))))
    assert done == sorted(wanted, key=str)
    assert sum(row[1] > 0 for row in wanted) > 20


@pytest.mark.parametrize("count", [0, 1])
def test_few_words(count):
    assert runs.find_runs(np.zeros(count, np.int64), np.full(count, count)).shape == (0, 3)
