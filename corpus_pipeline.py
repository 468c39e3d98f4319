"""The corpus pipeline: documents in, packed training sequences out.

Each stage gets the rows that the one before has left, as re-read Parquet, and
returns rows of the same columns; the last returns the pieces of the packed
sequences.  The language model, the toxicity model, near-duplicate groups and
mixing targets all come from the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, read_table
from tessera.llm.mixing import mixed
from tessera.llm.packing import pack_examples
from tessera.llm.pii import pseudonymise
from tessera.llm.queries import PII_KEY
from tessera.llm.simhash import keep_one
from tessera.llm.toxicity import fit_toxicity, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is at least 0.5 go."""
    return without_toxic(docs, fit_toxicity(docs, read_table(spark, sf_dir, "labels"), folds=5, held_out=0))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that of the smallest doc_id."""
    return keep_one(docs, shingle_words=4, distance=4)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms; n_chars follows the text."""
    return pseudonymise(docs, PII_KEY).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, at most three times."""
    return mixed(docs, weights=(1, 2, 3), cap=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids."""
    return pack_examples(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("pii", pii), ("mixing", mixing), ("packing", packing)]

#: Token ids and model scores are beyond SQL; tests hold the stages against plain Python versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{name}")
    return docs
