"""From raw documents to packed training sequences, in five stages that each take what the one before kept.

Documents without text, empty ones and those below twenty words go in the first stage, very long ones are judged whole; rows without doc_id and
repeated rows each stay or go by their own text, but for near duplicates, where rows with an id keep one of each group and those without
stay. Columns beyond those of documents are carried to the last stage whatever their names. An empty table runs through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import mixing, ngram_join, packing, quality, secret_scan, subwords
from meterline.llm.tables import read, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rules reject, and failing lines of the others."""
    return quality.quality_filter(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return ngram_join.keep_one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    return secret_scan.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts documents in the order of their sources' target weights; none is dropped."""
    return mixing.in_mixed_order(docs, mixing.PRODUCTION_SHARES, mixing.OTHERS_SHARE)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts documents into sequences whose lengths are powers of two, numbered in the mixed order.

    Files read again are dealt to partitions by size, so the order is worked out anew: it follows from the documents alone.
    """
    return packing.pack_documents(mix_sources(spark, docs, sf_dir), subwords.vocabulary_path("word_bpe_49k.json"), keep_words=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("secret_scan", secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Near duplicates and subword ids are beyond SQL; tests/llm/test_pipeline.py holds the rows against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
