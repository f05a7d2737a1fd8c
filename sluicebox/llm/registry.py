"""The queries of this subpackage, and the same results in DuckDB SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluicebox.llm import decontamination, jaccard, language, oracles, pieces, private, quality, removal, repair, repeats, rules, secrets, tokens, toxicity
from sluicebox.llm.common import documents, ship_package


PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.query(documents(spark, folder))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.query(documents(spark, folder))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.query(documents(spark, folder), _table(spark, folder, "benchmark"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(documents(spark, folder), pieces.read_model(public_tokenizers.path(PIECES)))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.query(documents(spark, folder))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path(WORDS), encoding="utf-8") as file:
        content = file.read()
    return tokens.query(documents(spark, folder), content)


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return private.query(documents(spark, folder))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.query(documents(spark, folder))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.query(documents(spark, folder), _table(spark, folder, "labels"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.query(documents(spark, folder), _table(spark, folder, "labels"))


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.query(documents(spark, folder))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return removal.query(documents(spark, folder), _table(spark, folder, "labels"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.query(_table(spark, folder, "conversations"))


QUERIES = (
    op1_suffix_dedup,
    op2_quality_rules,
    op3_decontamination,
    op4_sentencepiece,
    op5_jaccard_join,
    op6_token_counts,
    op7_personal_data,
    op8_language_id,
    op9_toxicity,
    op10_quality_classifier,
    op11_secret_scan,
    op12_filter_audit,
    op13_conversation_repair,
)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: shipped(f) for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """The other queries learn, iterate or use a tokenizer file; their tests hold them against plain Python and the libraries."""
    return dict(oracles.SQL)
