"""One registered query per operator, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    collocations,
    conversation_trie,
    decontaminate,
    license_scan,
    line_dedup,
    lm_score,
    near_dedup,
    oracles,
    packing,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_counts,
    token_output,
)
from sluice.workspace import new_dir


SEQUENCE_TOKENS = 2048
PASSAGE_WORDS = 51


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "shards")
    token_output.write_shards(table(spark, sf_dir, "documents"), path, word_tokenizer(), end_id=1)
    found = token_output.read_shards(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("broken", ",").alias("broken"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.search(docs, table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), word_tokenizer(), end_id=0, capacity=SEQUENCE_TOKENS)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), word_tokenizer()).drop("name")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_windows",
        F.array_join(F.transform("licenses", lambda x: x["name"]), ",").alias("licenses"),
        F.size("licenses").alias("n_licenses"),
        F.array_max(F.transform("licenses", lambda x: x["containment"])).alias("containment"),
    )


def fold(doc_id: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.classify(docs, labels, fold("doc_id", 5) == 0)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), fold("doc_id", 10) == 0)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove(docs, words=PASSAGE_WORDS, count=True).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2(F.coalesce("kept", F.lit("").cast("binary")), 256).alias("kept_sha256"),
        # What is left, to read; parts of characters (bytes are removed, not letters) are U+FFFD.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
        # Words of passages of more than 50 words that occur elsewhere too, of any number of bytes.
        "n_passage_words",
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.ranked(table(spark, sf_dir, "conversations"))
    c = F.col("conv_id")
    head = F.crc32(c.cast("string").cast("binary")) % 9
    return conversation_trie.summary(*conversation_trie.rebuilt(turns, c - c % 5, head, 8))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.lines_kept(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_token_output,
        op2_quality_rules,
        op3_decontaminate,
        op4_pack,
        op5_near_dedup,
        op6_token_counts,
        op7_license_scan,
        op8_quality_classifier,
        op9_lm_score,
        op10_suffix_dedup,
        op11_conversation_trie,
        op12_line_dedup,
        op13_collocations,
    ]
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    """DuckDB statements of the queries that SQL can express."""
    return {
        "op2_quality_rules": oracles.quality_rules(),
        "op3_decontaminate": oracles.decontaminate(),
        "op5_near_dedup": oracles.near_dedup(),
        "op7_license_scan": license_scan.oracle(),
        "op11_conversation_trie": oracles.conversation_trie(),
        "op12_line_dedup": line_dedup.oracle(),
        "op13_collocations": oracles.collocations(),
    }
