"""S12 where keys may be skipped: every split is a request of its own."""

from pyspark import TaskContext

from tidemark.session import discard
from tidemark.sources import keyed


class Pages:
    """Ten pages a key; the last one of a broken key fails behind its first document."""

    def connect(self):
        return object()

    def expired(self, error):
        return False

    def splits(self, key):
        return list(range(10))

    def fetch(self, session, key, split):
        yield {"page": split, "task": TaskContext.get().partitionId()}
        if key == "GBP" and split == 9:
            raise ConnectionError(key)
        yield {"page": split, "task": -1}


def test_s12_splits_of_a_key_that_may_be_skipped_are_read_by_many_tasks(spark):
    found = keyed.read_keys(spark, Pages(), ["EUR", "GBP", "EUR"], skip_errors=(ConnectionError,))
    rows = found.collect()
    assert found.columns == ["key", "payload"] and [r.key for r in rows] == ["EUR"] * 40
    tasks = {r.payload.split('"task":')[1] for r in rows} - {"-1}"}
    assert len(tasks) == 20
    discard(found)
