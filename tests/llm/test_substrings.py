"""Operators 1 and 4: repeated windows of words and bytes against brute force."""

import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_fixtures import documents, mixed_texts  # noqa: F401
from tidemark.llm import rlz, suffix, windows


def removed_words(texts, width):
    """(words, mask) of each (doc_id, text) by the definition."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in texts]
    first = {}
    for (key, _), words in zip(texts, split):
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if key is not None and (first.get(window) is None or key < first[window]):
                first[window] = key
    out = []
    for (key, _), words in zip(texts, split):
        mask = [False] * len(words)
        for i in range(len(words) - width + 1):
            source = first.get(tuple(words[i : i + width]))
            if source is not None and (key is None or source < key):
                mask[i : i + width] = [True] * width
        out.append((words, mask))
    return out


def removed_bytes(texts, length):
    data = [(text or "").encode() for _, text in texts]
    count = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        mask = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        out.append((d, bytes(mask)))
    return out


@pytest.mark.parametrize("crowded", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_duplicate_words_equal_brute_force(documents, mixed_texts, monkeypatch, seed, crowded):
    """Also where every anchor counts as crowded and texts come in pieces, with a null id and two rows of one id."""
    if crowded:
        monkeypatch.setattr(windows, "MAX_CONTENTS", 1)
        monkeypatch.setattr(windows, "PIECE", 37)
    texts = [*enumerate(mixed_texts(seed)), (None, mixed_texts(seed)[0]), (3, mixed_texts(seed)[5])]
    random.Random(seed).shuffle(texts)
    frame = documents(texts).withColumnsRenamed({"lang": "spans"})
    done = rlz.remove_duplicates(frame, width=20)
    assert done.columns == ["doc_id", "text", "source", "n_chars", "n_words", "n_removed", "spans", "kept_sha256"]
    found = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.text is None) for r in done.collect())
    wanted = []
    for (key, text), (words, mask) in zip(texts, removed_words(texts, 20)):
        kept = " ".join(w for w, gone in zip(words, mask) if not gone)
        wanted.append((str(key), len(words), sum(mask), hashlib.sha256(kept.encode()).hexdigest(), text is None))
    assert found == sorted(wanted) and sum(row[2] for row in found)
    for row in done.collect():
        assert hashlib.sha256(" ".join((row.text or "").split()).encode()).hexdigest() == row.kept_sha256


@pytest.mark.parametrize("crowded", [False, True])
@pytest.mark.parametrize("seed", [3, 4])
def test_repeated_bytes_equal_brute_force(documents, mixed_texts, monkeypatch, seed, crowded):
    if crowded:
        monkeypatch.setattr(windows, "MAX_CONTENTS", 1)
        monkeypatch.setattr(windows, "PIECE", 37)
    texts = [*enumerate(mixed_texts(seed)), (None, mixed_texts(seed)[2]), (4, mixed_texts(seed)[4])]
    done = suffix.remove_repeats(documents(texts), length=60)
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in done.collect())
    wanted = []
    for (key, _), (data, mask) in zip(texts, removed_bytes(texts, 60)):
        kept = bytes(b for b, gone in zip(data, mask) if not gone)
        wanted.append((str(key), len(data), sum(mask), len(re.findall(b"\1+", mask)), kept))
    assert found == sorted(wanted) and sum(row[2] for row in found)


def test_long_text_and_repeated_rows(documents):
    rng = random.Random(5)
    long = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 10**6)) for _ in range(60_000))
    rows = rlz.remove_duplicates(documents([(1, long), (2, long[5000:50_000]), (2, long[5000:50_000])])).collect()
    by_id = {r.doc_id: r.n_removed for r in rows}
    assert by_id[1] == 0 and by_id[2] >= rows[-1].n_words - 2 and len(rows) == 3
    rows = suffix.remove_repeats(documents([(1, long), (1, long)])).collect()
    assert [r.n_removed for r in rows] == [len(long)] * 2


def test_empty_table(documents):
    assert rlz.remove_duplicates(documents([])).collect() == []
    assert suffix.remove_repeats(documents([])).collect() == []


@given(st.binary(min_size=1, max_size=200).map(lambda b: bytes(x % 4 for x in b)), st.data())
@settings(max_examples=200, deadline=None)
def test_two_stage_order_is_suffix_order(data, draw):
    wanted = np.array(sorted(draw.draw(st.sets(st.integers(0, len(data) - 1), min_size=1))))
    order = suffix.suffix_order(data, wanted, len(data) + 1)
    assert set(wanted.tolist()) <= set(order.tolist())
    assert [data[i:] for i in order if i < len(data)] == sorted(data[i:] for i in set(order.tolist()) if i < len(data))
    lengths = suffix.common_prefixes(data, order, 16)
    for i in range(1, len(order)):
        a, b = data[order[i - 1] :] + bytes(32), data[order[i] :] + bytes(32)
        assert lengths[i] == next((n for n in range(16) if a[n] != b[n]), 16)


@given(st.lists(st.integers(0, 5), min_size=12, max_size=300))
@settings(max_examples=100, deadline=None)
def test_anchors_depend_on_the_window_alone(values):
    grams = np.array(values, np.uint64) << np.uint64(40)
    first, last, place = windows.anchors(grams, 12)
    assert first[0] == 0 and last[-1] == len(grams) - 12 and (first[1:] == last[:-1] + 1).all()
    for a, b, at in zip(first, last, place):
        for start in range(a, b + 1):
            assert at == start + int(np.argmin(grams[start : start + 12]))


def test_anchors_across_chunks():
    grams = np.random.default_rng(1).integers(0, 2**63, (1 << 18) * 2 + 777).astype(np.uint64)
    first, last, place = windows.anchors(grams, 50)
    assert (np.diff(place) > 0).all() and (first[1:] == last[:-1] + 1).all() and last[-1] == len(grams) - 50
    for i in range(0, len(first), 997):
        assert place[i] == first[i] + int(np.argmin(grams[first[i] : first[i] + 50] >> np.uint64(20)))


def test_a_window_over_a_factor_boundary_is_found():
    """The parse goes on from the first window that crosses a factor's end, in whichever reference."""
    units = windows.Units("words", 6, 2)
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 30)}" for _ in range(40)]
    one, two, both = base[:20] + ["x"] * 8, ["y"] * 8 + base[10:30], base[:30]
    mask = removed_words([(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(both))], 6)[2][1]
    assert all(mask) and units.width == 6


@pytest.mark.parametrize("limit", [windows.MAX_CONTENTS, 1])
def test_every_marked_window_comes_from_the_solver(documents, mixed_texts, monkeypatch, limit):
    """A solver that finds nothing leaves no window marked, copies and crowded anchors included."""
    monkeypatch.setattr(windows, "MAX_CONTENTS", limit)
    texts = [*enumerate(mixed_texts(6)), (400, mixed_texts(6)[0]), (401, mixed_texts(6)[0])]
    frame = documents(texts)

    def nothing(items):
        return [([], []) for _ in items]

    for module, run, made in ((rlz, rlz.remove_duplicates, rlz.solver), (suffix, suffix.remove_repeats, suffix.solver)):
        removed = [r.n_removed for r in run(frame, 20).collect()]
        assert sum(removed) > 0
        monkeypatch.setattr(module, "solver", lambda *_: nothing)
        assert sum(r.n_removed for r in run(frame, 20).collect()) == 0
        monkeypatch.setattr(module, "solver", made)


@given(st.lists(st.sampled_from([b"\0", b"a", b"b", b"abcdefgh" * 3, b"\0" * 9, b"\xff" * 8]), min_size=1, max_size=30), st.integers(1, 60), st.data())
@settings(max_examples=300, deadline=None)
def test_sorted_places_compare_like_bytes(parts, depth, draw):
    data = b"".join(parts)
    places = np.array(sorted(draw.draw(st.sets(st.integers(0, len(data) - 1), min_size=0))), np.int64)
    found = suffix.sorted_places(data, places, depth)
    assert sorted(found.tolist()) == places.tolist()
    beginnings = [data[place : place + depth] for place in found.tolist()]
    assert beginnings == sorted(beginnings)


def test_sorting_holds_no_copies_of_the_suffixes():
    rng = random.Random(3)
    passage = rng.randbytes(5_000)
    data = b"".join(rng.randbytes(3_000) + passage + b"x" * 500 for _ in range(25))
    tracemalloc.start()
    order = suffix.suffix_order(data, np.arange(len(data)), 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The first 400 bytes of half of all places, held at a time, are over 200 times the data.
    assert len(order) == len(data) and peak < 130 * len(data)
