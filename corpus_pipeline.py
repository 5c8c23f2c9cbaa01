"""The corpus pipeline: filter, deduplicate, decontaminate and pack the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in
the shared folder and read again as the next one's docs, so a lost executor repeats no
earlier stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, near_dedup, packing, quality_rules, suffix_dedup
from sluice.llm.common import store
from sluice.llm.queries import PASSAGE_WORDS, SEQUENCE_TOKENS, table, word_tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the one with the smallest doc_id stays."""
    return near_dedup.deduplicate(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words, and strings of 400 bytes, that occur more than once are
    cut out of the texts."""
    return suffix_dedup.strip(docs, words=PASSAGE_WORDS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Occurrences of benchmark phrases are cut out of the texts."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text is tokenised and placed in sequences; ``ids`` are the pieces' tokens."""
    pieces = packing.pack(docs, word_tokenizer(), end_id=0, capacity=SEQUENCE_TOKENS)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("decontaminate", benchmark_passages),
    ("pack", packed),
]

#: Sketches, MinHash and packing have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
