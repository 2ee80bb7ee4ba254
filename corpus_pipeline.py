"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from conformity.llm import decontaminate, near_dup, packing, quality, suffix_dedup
from conformity.llm.common import drop_saved, saved

#: Passages of over 50 words that occur elsewhere are cut, besides the strings of 400 bytes of op6's contract.
PASSAGE_WORDS = suffix_dedup.PASSAGE_WORDS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the cutoffs are learned from ``labels``."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return near_dup.drop_near_duplicates(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of long strings, and of passages of over 50 words, that occur elsewhere too."""
    return suffix_dedup.remove_repeats(docs, words=PASSAGE_WORDS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with the sequence and offset each is packed at."""
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]
#: Risk-controlled cutoffs, banding and packing are not SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last: DataFrame | None = None
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if last is not None:
            drop_saved(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
