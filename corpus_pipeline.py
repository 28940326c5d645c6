"""The training-data pipeline: stages over documents, each written and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import exact_dedup, mixing, ngram_join, packing, quality, tokenizer_files
from tidewright.llm.common import importable, read_table
from tidewright.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    importable(spark)
    return quality.kept(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest doc_id stays."""
    importable(spark)
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the smallest doc_id stays."""
    importable(spark)
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: each document appears as often as the mix takes it."""
    return mixing.emitted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of token ids into sequences."""
    importable(spark)
    return packing.packed(docs, tokenizer_files.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", reject_junk),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack),
]
ORACLE_SQL = None  # the classifier is trained; the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for label, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), label.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
