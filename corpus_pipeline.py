"""A training corpus from ``documents``: one operator a stage, each stage on all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import decontamination, line_rules, mixing, simhash, token_output
from shelfcast.llm.queries import END_ID, WORD_TOKENIZER
from shelfcast.session import scratch_path, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line rules keep, without boilerplate lines."""
    return line_rules.quality_filter(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return simhash.keep_first(docs, shingle=3, radius=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, written to files and read back: (doc_id, start, n_tokens, ids_crc32)."""
    folder = scratch_path(spark, "corpus-tokens")
    token_output.write_tokens(docs, folder, WORD_TOKENIZER, END_ID)
    return token_output.read_tokens(spark, folder, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_sources", mixing_sources),
    ("token_files", token_files),
]

# XXH64, CRC-32 and a tokenizer are out of SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
