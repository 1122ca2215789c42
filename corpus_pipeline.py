"""Documents to training tokens: filter, thin out, cut and encode, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read back before the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, rlz, simhash, toxicity
from tidemark.llm.common import table
from tidemark.session import materialise

def packed(docs: DataFrame) -> DataFrame:
    """doc_id and text, which the operators read, and all other columns as one, so that no name can clash."""
    return docs.select("doc_id", "text", F.struct(*[f"`{name}`" for name in docs.columns if name != "text"]).alias("row"))


def unpacked(docs: DataFrame, done: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` out of packed rows; ``changed`` ones have new values."""
    def value(name: str) -> Column:
        return changed.get(name, F.col("text") if name == "text" else F.col(f"row.`{name}`"))

    return done.select(*[value(name).alias(name) for name in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model fitted on the labelled ones does not call toxic.

    A null or empty text has nothing toxic. Rows with a null id and repeated rows are scored like any other. All
    columns stay as they are; an empty table stays empty, and without labels of both classes the score is their share.
    """
    scored = toxicity.score_documents(packed(docs), table(spark, sf_dir, "labels"))
    return unpacked(docs, scored.where("predicted = 0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked by two differing bits or fewer.

    That of the smallest id stays, null ids last, then by a hash of the text; of rows equal in id and text one. Null and
    empty texts have fingerprint zero and so are one group. All columns stay as they are.
    """
    return unpacked(docs, simhash.keep_first(packed(docs)))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 words and more that a document with a smaller id has too.

    A text that loses nothing, a null or empty one too, stays as it is; one that loses all its words stays as an empty
    one. A null id gives way to any other; rows of one id do not cut each other. ``n_chars``, where there is such a column,
    follows the text; all other columns stay as they are.
    """
    cut = rlz.remove_duplicates(packed(docs))
    if "n_chars" not in docs.columns:
        return unpacked(docs, cut)
    size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
    return unpacked(docs, cut, n_chars=size.cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget.

    Null and empty texts hold none. Repeated rows go or stay together. All columns stay as they are; without items all
    documents stay.
    """
    return unpacked(docs, decontam.remove_contaminated(packed(docs), table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns, with n_tokens, ids and round_trip: token ids of every document, and whether they decode to its text.

    A null or empty text has no tokens, and decodes to the empty text. Columns of the three names are replaced.
    """
    made = ["n_tokens", "ids", "round_trip"]
    kept = docs.drop(*made)
    done = bpe.encode(packed(kept), public_tokenizers.path("byte_bpe_50k.json"), verify=True)
    return done.select(*[F.col("text") if name == "text" else F.col(f"row.`{name}`").alias(name) for name in kept.columns], *made)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("bpe encoding", encode),
]

# Trees, factors, edit distances and token ids are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents`` of a folder, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
