"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept;
`run` writes what a stage returns as Parquet and reads it again for the next one. All
stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, jaccard_join, packing, quality_mil
from tidemark.llm.common import on_workers, table
from tidemark.session import scratch_path

SEQUENCE_TOKENS = 2048
END_ID = 0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled ones among them, does not reject.

    Rejected is what scores below 0.5; without labels of both kinds nothing is.
    """
    on_workers(spark)
    return quality_mil.keep_unrejected(docs, quality_mil.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    on_workers(spark)
    return jaccard_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    on_workers(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids and places in sequences."""
    on_workers(spark)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.place(packing.cut(docs, vocabulary, SEQUENCE_TOKENS, END_ID), SEQUENCE_TOKENS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_mil", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("benchmark_decontamination", benchmark),
    ("best_fit_packing", pack),
]

# The first stage is a learned model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
