"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, slices
from tidemark.session import discard, materialise

#: Most labelled rows that a model is fitted on (a fixed share by hash where there are more).
FIT_ROWS = 20_000
#: Most entries of the lexicon, and how many toxic rows of the fit must hold one.
LEXICON_ENTRIES = 512
LEXICON_SHARE, LEXICON_ROWS = 0.02, 8
#: Lengths of word beginnings that the lexicon takes beside whole words: insults are inflected.
STEMS = (4, 5, 6, 7, 8)
#: Logarithm of how much more often an entry stands in toxic text, from which it counts, and counts as strong.
WEAK, STRONG = 1.5, 3.0
THRESHOLD = 0.3
#: Trees of the model.
ROUNDS = 20
NEAR = 6

# Second-person words, and signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine euch ihr sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os".split()
)
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
UPPER = re.compile(r"[A-Z\u00c0-\u00d6\u00d8-\u00de]")
SIGN = re.compile(r"[^\w\s]")
INSIDE = re.compile(r"[^\W\d_][*@$!|#.\-_0-9]+[^\W\d_]")
EDGES = "\"'()[]{}<>,;:?.!*#%&$-–—…"
DOUBLED = re.compile(r"(\w)\1{2,}")
FEATURES = (
    "strong_density weak_density weight_density hits worst_passage near_second_person second_person_density capitals "
    "shouted exclamations punctuation hidden_words hidden_hits doubled_letters length"
).split()


class Lexicon(dict):
    """Weight of each word looked up so far: of the word itself (entry ``=word``), else of its heaviest beginning."""

    def __init__(self, entries: dict[str, float]):
        super().__init__()
        self.entries = entries

    def __missing__(self, word: str) -> float:
        get = self.entries.get
        weight = max([get("=" + word, 0.0), *[get(word[:size], 0.0) for size in STEMS if size < len(word)]])
        if len(self) < 500_000:
            self[word] = weight
        return weight


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Dense features of a whole text, in the order of FEATURES; all zero for one without words and signs."""
    text = text or ""
    if not text or text.isspace():
        return [0.0] * len(FEATURES)
    words = WORD.findall(text)
    lower = [word.lower() for word in words]
    count = max(len(words), 1)
    weights = np.array([lexicon[word] for word in lower]) if lower else np.zeros(0)
    places = np.flatnonzero(weights >= WEAK)
    strong = int((weights >= STRONG).sum())
    second = np.array([place for place, word in enumerate(lower) if word in SECOND_PERSON], np.int64)
    near, worst = 0, 0.0
    if len(places):
        if len(second):
            at = np.searchsorted(second, places)
            after = np.where(at < len(second), second[np.minimum(at, len(second) - 1)] - places, NEAR + 1)
            before = np.where(at > 0, places - second[np.maximum(at - 1, 0)], NEAR + 1)
            near = int((np.minimum(after, before) <= NEAR).sum())
        # Heaviest passage of 50 words, so that a long text cannot thin out a toxic part.
        total = np.concatenate(([0.0], np.cumsum(weights[places])))
        worst = float((total[np.searchsorted(places, places + 50)] - total[:-1]).max())
    capitals = len(UPPER.findall(text))
    shouted = sum(len(word) > 2 and word.isupper() for word in words) if capitals > 2 else 0
    hidden = found = 0
    if INSIDE.search(text):
        for token in text.split():
            bare = token.strip(EDGES)
            if INSIDE.search(bare):
                bare = bare.lower()
                options = (bare.translate(SIGNS), re.sub(r"[\W_\d]", "", bare), re.sub(r"[\W_]", "", bare.translate(SIGNS)))
                hidden += 1
                found += any(lexicon[option] >= STRONG for option in options)
    return [
        100.0 * strong / count,
        100.0 * (len(places) - strong) / count,
        100.0 * float(weights[places].sum()) / count,
        math.log1p(len(places)),
        worst,
        100.0 * near / count,
        100.0 * len(second) / count,
        capitals / (sum(map(len, words)) or 1),
        100.0 * shouted / count,
        100.0 * text.count("!") / count,
        len(SIGN.findall(text)) / len(text),
        100.0 * hidden / count,
        100.0 * found / count,
        sum(len(m[0]) for m in DOUBLED.finditer(text)) / len(text),
        math.log1p(len(words)),
    ]


def with_features(documents: DataFrame, lexicon: dict[str, float], column: str = "text") -> DataFrame:
    """All columns, with ``_features`` (array of double). The lexicon has LEXICON_ENTRIES entries at most."""
    place = documents.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Lexicon(lexicon)
        for batch in slices(batches, column):
            rows = [features(text, weights) for text in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.list_(pa.float64()))], [*batch.schema.names, "_features"]
            )

    return documents.mapInArrow(run, extended(documents, "_features array<double>"))


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; 2 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Words and beginnings of words, with the logarithm of how much more often they stand in toxic rows.

    Every task counts what it reads before the shuffle; the driver gets LEXICON_ENTRIES rows at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def result() -> pa.RecordBatch:
            columns = [pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *columns], ["entry", "bad", "good", "holders"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held: dict[str, int] = {}
                for word in WORD.findall(text.lower()):
                    for entry in ("=" + word, *[word[:size] for size in STEMS if size < len(word)]):
                        held[entry] = held.get(entry, 0) + 1
                for entry, times in held.items():
                    found = counts.setdefault(entry, [0, 0, 0])
                    found[1 - toxic] += times
                    found[2] += toxic
            if len(counts) > 300_000:
                yield result()
                counts = {}
        yield result()

    counted = rows.select("text", "toxic").mapInArrow(count, "entry string, bad long, good long, holders long")
    counted = counted.groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("bad", "good", "holders")])
    counted = materialise(rows.sparkSession, counted, "entries")
    toxic = rows.agg(F.sum("toxic")).first()[0] or 0
    words = F.when(F.col("entry").startswith("="), F.struct("bad", "good"))
    total = counted.agg(F.sum(words["bad"]).alias("bad"), F.sum(words["good"]).alias("good")).first()
    if not total["bad"] or not total["good"]:
        discard(counted)
        return {}
    odds = F.log((F.col("bad") + 0.5) / total["bad"]) - F.log((F.col("good") + 0.5) / total["good"])
    best = (
        counted.where(F.col("holders") >= max(LEXICON_ROWS, LEXICON_SHARE * toxic))
        .withColumn("odds", odds)
        .where(F.col("odds") >= WEAK)
        .orderBy(F.desc(F.col("odds") * F.col("holders")), "entry")
        .limit(LEXICON_ENTRIES)
        .collect()
    )
    discard(counted)
    return {row["entry"]: row["odds"] for row in best}


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float

    def score(self, documents: DataFrame) -> DataFrame:
        """All columns, with ``score`` (0 to 1) and ``predicted``; columns of these names are replaced."""
        clean = documents.drop("score", "predicted")
        if self.trees is None:
            scored = clean.withColumn("score", F.lit(float(self.base)))
        else:
            # The model's columns have fixed names, so the input's get their places as names meanwhile.
            places = {name: f"c{place}" for place, name in enumerate(clean.columns)}
            ready = with_features(clean.toDF(*places.values()), self.lexicon, places["text"])
            ready = self.trees.transform(ready.withColumn("_vector", array_to_vector("_features")))
            ready = ready.withColumn("_margin", vector_to_array("_p")[1])
            ready = self.calibration.transform(ready) if self.calibration is not None else ready.withColumn("score", F.col("_margin"))
            kept = [F.col(place).alias(name) for name, place in places.items()]
            scored = ready.select(*kept, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))
        return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def fit(documents: DataFrame, labels: DataFrame, limit: int = FIT_ROWS, rounds: int = ROUNDS) -> ToxicityModel:
    """Fit on labelled documents whose ``remainder`` is not 2, at most about ``limit`` of them by a hash of the id.

    Remainders 0 and 3 grow the lexicon and the trees, remainder 1 the calibration. Null labels, ids and texts are no
    examples; of several labels for one id the highest counts. Without both classes among the examples
    every score is the share of toxic ones (0 if there are none).
    """
    spark = documents.sparkSession
    # Any other number is no label.
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.withColumn("fold", remainder(F.col("doc_id"))).where("fold <> 2")
    count = known.count()
    if count > limit:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * limit / count))
    examples = documents.where("text IS NOT NULL").select("doc_id", "text").join(known, "doc_id").select("text", "toxic", "fold")
    examples = materialise(spark, examples, "labelled")
    learn = examples.where("fold <> 1")
    counts = examples.groupBy((F.col("fold") == 1).alias("held")).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad"))
    shares = {row["held"]: row for row in counts.collect()}
    total = sum(row["n"] for row in shares.values())
    base = sum(row["bad"] for row in shares.values()) / total if total else 0.0
    grown = shares.get(False)
    if grown is None or grown["bad"] in (0, grown["n"]):
        return ToxicityModel({}, None, None, base)
    lexicon = learn_lexicon(learn)
    rows = with_features(examples, lexicon).select(
        array_to_vector("_features").alias("_vector"), F.col("toxic").cast("double").alias("_label"), "fold"
    )
    stored = materialise(spark, rows, "features")
    rows = stored.coalesce(4)
    booster = GBTClassifier(
        featuresCol="_vector", labelCol="_label", maxIter=rounds, maxDepth=4, stepSize=0.2, maxBins=64, minInstancesPerNode=5, seed=7
    )
    trees = booster.fit(rows.where("fold <> 1"))
    trees.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
    calibrating = shares.get(True)
    calibration = None
    if calibrating is not None and calibrating["bad"] not in (0, calibrating["n"]):
        held = trees.transform(rows.where("fold = 1")).select("_label", vector_to_array("_p")[1].alias("_margin"))
        calibration = IsotonicRegression(featuresCol="_margin", labelCol="_label", predictionCol="score").fit(held)
    discard(examples)
    discard(stored)
    return ToxicityModel(lexicon, trees, calibration, base)


def score_documents(documents: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """All columns of the documents with ``score`` and ``predicted``, by a model fitted on the labelled ones."""
    return fit(documents, labels, rounds=rounds).score(documents)


def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity score, with the mark of those whose labels no model has seen."""
    from tidemark.llm.common import table

    scored = score_documents(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))
    held_out = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
