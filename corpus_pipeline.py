"""The document pipeline: five stages over ``documents``, each written and read again.

Each stage works on all that the one before kept. The first four return the columns of documents; the last
returns one row per piece of a document with its place in a training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vintara.llm import quality
from vintara.llm.common import table, written
from vintara.llm.decontamination import without_contaminated
from vintara.llm.exact_dedup import without_duplicates
from vintara.llm.packing import packed
from vintara.llm.simhash import without_near_duplicates
from vintara.llm.token_ids import tokenizer_file


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking does not reject; labels train it on the whole ``documents``."""
    ranking = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.without_rejected(docs, ranking)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest id."""
    return without_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose 64-bit fingerprints over four-word shingles link at 4 or fewer differing bits the smallest id stays."""
    return without_near_duplicates(docs, words=4, lanes=1, segments=3, radius=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten words in a row of a benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in sequences of 4096."""
    return packed(docs, tokenizer_file("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]
ORACLE_SQL = None  # a learned score, fingerprints and packing are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
