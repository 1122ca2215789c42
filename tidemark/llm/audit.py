"""Which filter removes what in which order: path counts over the lattice of applied filters."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import table
from tidemark.operators.skew import splittable_join

#: The orders of a filter more would be eight times as many rows.
MOST_FILTERS = 7


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For every state (bits of the filters applied): the orders that reach it, and those that lead on to the last state."""
    last = (1 << n) - 1
    reaching, leaving = [0] * (last + 1), [0] * (last + 1)
    reaching[0] = leaving[last] = 1
    for state in range(last + 1):
        for f in range(n):
            if not state >> f & 1:
                reaching[state | 1 << f] += reaching[state]
    for state in range(last, -1, -1):
        for f in range(n):
            if not state >> f & 1:
                leaving[state] += leaving[state | 1 << f]
    return reaching, leaving


def edges(n: int) -> list[tuple[int, int, int]]:
    """(state, filter applied next, orders that take this step)."""
    reaching, leaving = path_counts(n)
    return [(s, f, reaching[s] * leaving[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def audit(flags: DataFrame, filters: list[str], part: str = "part", losses: dict[str, str] | None = None) -> DataFrame:
    """What each filter does at each step of each order, per part.

    ``flags`` has a row for each document: its part, one boolean column for each filter (true: the document fails it)
    and the boolean columns named by ``losses`` (output name to column). Result: the part, ``filter_order`` (names
    joined; every order of the filters, which are seven at most), ``step`` from 1, and counts of documents: ``kept`` after
    the step, ``removed`` by it, ``redundant`` (fail its filter, but were removed earlier), ``unique_fails`` (fail
    its filter alone), one count of the removed for each loss, and ``shapley``, its filter's removals summed over all orders.

    Documents are counted by their set of failed filters, so 2**filters rows of a part and loss go on however many documents
    there are. Every edge of the lattice of applied filters is summed once and weighted by the orders that pass it. A null flag is
    false, a null part a part of its own; repeated rows count each; further columns are ignored; no rows, no result.
    """
    losses = losses or {}
    n = len(filters)
    if not 0 < n <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {n}")
    spark = flags.sparkSession
    named = lambda name: F.col(f"`{name}`")
    failed = [F.when(F.coalesce(named(name), F.lit(False)), 1 << f).otherwise(0) for f, name in enumerate(filters)]
    lost = {f"lost_{k}": F.coalesce(named(name), F.lit(False)) for k, name in enumerate(losses.values())}
    sets = flags.select(
        named(part).alias("part"), sum(failed[1:], failed[0]).alias("failed"), *[is_lost.alias(name) for name, is_lost in lost.items()]
    )
    sets = sets.groupBy("part", "failed", *lost).agg(F.count(F.lit(1)).alias("n"))

    numbers = {"state": "int", "filter": "int", "own": "int", "orders": "long"}
    rows = [dict(zip(numbers, (state, f, 1 << f, orders))) for state, f, orders in edges(n)]
    step = F.array(*[F.struct(*[F.lit(row[name]).cast(kind).alias(name) for name, kind in numbers.items()]) for row in rows])
    crossed = sets.withColumn("edge", F.explode(step)).select("*", "edge.*")
    own = F.col("own")
    fails, there = F.col("failed").bitwiseAND(own) != 0, F.col("failed").bitwiseAND(F.col("state")) == 0
    counted = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    sums = crossed.groupBy("part", "state", "filter", "orders").agg(
        counted(there & ~fails).alias("kept"),
        counted(there & fails).alias("removed"),
        counted(~there & fails).alias("redundant"),
        counted(F.col("failed") == own).alias("unique_fails"),
        *[counted(there & fails & F.col(name)).alias(name) for name in lost],
    )
    # A part's states of one filter: 2**(filters - 1) rows.
    of_filter = Window.partitionBy("part", "filter")
    sums = sums.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(of_filter))

    steps = [
        (sum(1 << f for f in order[:k]), order[k], "".join(filters[f] for f in order), k + 1)
        for order in permutations(range(n))
        for k in range(n)
    ]
    # Its size is fixed by the number of filters: 600 rows for five.
    steps = F.broadcast(spark.createDataFrame(steps, "state int, filter int, filter_order string, step int"))
    return sums.join(steps, ["state", "filter"]).select(
        F.col("part").alias(part),
        "filter_order",
        "step",
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        *[F.col(name).alias(output) for name, output in zip(lost, losses)],
        "shapley",
    )


def text_flags(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: its source as ``part``, whether it fails A to E, and its labels ``good`` and ``toxic``.

    A: under 200 words; B: under half of the words distinct; C: over 2 % capitals A-Z; D: a sign of ``#$%&*|``; E: the same text
    as a document with a smaller id. A null text is an empty one, a null source the empty part. A null id is not
    larger than any other and has no labels. Of repeated label rows any that says so counts.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+", -1), "")
    # A digest of 256 bits stands for the text.
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    read = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"), words.alias("words"))
    checked = read.select(
        "doc_id",
        "part",
        digest,
        (F.size("words") < 200).alias("A"),
        (100 * F.size(F.array_distinct("words")) < 50 * F.size("words")).alias("B"),
        (100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > 2 * F.length("text")).alias("C"),
        F.col("text").rlike("[#$%&*|]").alias("D"),
    )
    first = documents.select("doc_id", digest).groupBy("digest").agg(F.min("doc_id").alias("first"))
    checked = splittable_join(first, checked, "digest").select("doc_id", "part", *"ABCD", (F.col("doc_id") > F.col("first")).alias("E"))
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return splittable_join(known, checked, "doc_id", "right")


def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every order of five filters over all documents, per source."""
    flags = text_flags(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return audit(flags, list("ABCDE"), "part", {"good_lost": "good", "toxic_lost": "toxic"})


OP12_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS lowest
  FROM documents
), known AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(known.toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN texts.doc_id > lowest THEN 16 ELSE 0 END AS bits
  FROM texts LEFT JOIN known USING (doc_id)
), sets AS (
  SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, bits
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
), orders(filter_order, done, n) AS (
  SELECT '', 0, 0
  UNION ALL
  SELECT filter_order || letter, done | bit, n + 1 FROM orders, letters WHERE done & bit = 0
), steps AS (
  SELECT o.filter_order, CAST(position(l.letter IN o.filter_order) AS INT) AS step, l.bit,
         CAST(coalesce(sum(e.bit), 0) AS INT) AS earlier
  FROM orders o CROSS JOIN letters l
  LEFT JOIN letters e ON position(e.letter IN o.filter_order) < position(l.letter IN o.filter_order)
  WHERE o.n = 5
  GROUP BY o.filter_order, l.letter, l.bit
), counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN bits & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN bits & earlier = 0 AND bits & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN bits & earlier <> 0 AND bits & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN bits = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN bits & earlier = 0 AND bits & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN bits & earlier = 0 AND bits & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
