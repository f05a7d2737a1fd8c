"""The corpus pipeline: documents in, token ids of the documents worth training on out.

Each stage takes (spark, docs, folder) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluicebox.llm import decontamination, jaccard, pieces, private, toxicity
from sluicebox.llm.common import ship_package, store
from sluicebox.llm.registry import PIECES


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return toxicity.stage(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return jaccard.stage(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontamination.stage(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return private.stage(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return pieces.encode(docs, pieces.read_model(public_tokenizers.path(PIECES)))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_text),
    ("pii", mask_personal_data),
    ("sentencepiece", encode_pieces),
]

#: SQL can express none of the learned, iterated and piece-wise stages.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the folder's documents, each stored in the shared folder before the next begins."""
    ship_package(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, folder), name)
    return docs
