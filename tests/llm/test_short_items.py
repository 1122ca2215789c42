"""Operator 2 with items that are short or hold signs."""

import pytest
from corpus_fixtures import documents  # noqa: F401

from tidemark.llm import decontam

ITEMS = [(1, "42"), (2, "yes"), (3, "2+2=?"), (4, "the red house"), (5, "..."), (6, "∑ i² ≤ (n+1)³ / 3"), (7, "北京是首都")]
TEXTS = [
    (10, "Born in 1942 with blue eyes"), (11, "It is 42."), (12, "They gathered houses: the red houses"), (13, "See 2 2 of them"),
    (14, "What is 2+2=4"), (15, "Where is The Red\n House?"), (16, "i n 1 3"), (17, "so ∑ I² ≤ (n+1)³ / 3 holds"), (18, "我知道北京是首都吗"), (19, None),
]


def test_short_items_are_whole_words_with_their_signs(spark, documents):
    table = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontam.contaminated(documents(TEXTS), table).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found) == [(11, 1, 0), (14, 3, 0), (15, 4, 0), (17, 6, 0), (18, 7, 0)]
    places = {r.doc_id: (r.start, r.stop) for r in found}
    assert places[14] == (8, 12) and places[15] == (9, 22)


def test_very_short_items_drop_no_documents(spark, documents):
    table = spark.createDataFrame(ITEMS, "item_id long, text string")
    with pytest.warns(UserWarning, match="4 items are too short"):
        kept = decontam.remove_contaminated(documents(TEXTS), table)
    assert sorted(r.doc_id for r in kept.collect()) == [10, 11, 12, 13, 14, 16, 19]
