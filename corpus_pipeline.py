"""A training corpus from `documents`: toxic rows out, exact and near copies out, sources mixed, documents packed."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitalsieve.llm import exact, forest, mixing, packing, toxicity
from vitalsieve.llm.common import table, written

TOKENIZER = "word_bpe_49k.json"


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.without_copies(docs)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return forest.without_near_copies(docs)


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.remixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(packing.pieces(docs, public_tokenizers.path(TOKENIZER)))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out),
    ("exact_dedup", copies_out),
    ("near_dedup", near_copies_out),
    ("mixing", sources_mixed),
    ("packing", packed),
]

#: A learned lexicon, a tokenizer and a hash-ordered schedule have no SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
