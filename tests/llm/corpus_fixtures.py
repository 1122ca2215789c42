"""Small corpora for the operator tests."""

import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) pairs."""

    def build(pairs):
        rows = [(key, text, "en", "src0", len(text or "")) for key, text in pairs]
        return spark.createDataFrame(rows, DOCUMENT)

    return build


def passages(seed, count=60, vocabulary=40, pool=12):
    """Texts put together from shared passages and fresh words, with copies, nulls and empty ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(vocabulary)]
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 90))) for _ in range(pool)]
    texts = []
    for _ in range(count):
        parts = [
            rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
            for _ in range(rng.randint(1, 4))
        ]
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    texts += [texts[0], texts[1] + " tail", "", None, " \n ", "a " * 300, "x" * 3000, "ab" * 1500]
    return texts


@pytest.fixture(scope="session")
def mixed_texts():
    return passages
