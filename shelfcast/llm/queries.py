"""Named queries of the operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    decontamination, languages, licences, line_rules, mixing, periodic, prefix_trie, reply_trees, simhash, substring, suffix_tree,
    token_counts, token_output,
)
from shelfcast.session import scratch_path

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1
TOKEN_LIMIT = 1024

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register ``fn`` under its name."""
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the line rules for every document."""
    return line_rules.quality_report(table(spark, sf_dir, "documents"))


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark passage, with the passage."""
    found = decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("doc_key")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return mixing.mixture(table(spark, sf_dir, "documents")).drop("copies")


@query
def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    folder = scratch_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), folder, WORD_TOKENIZER, END_ID)
    return token_output.read_tokens(spark, folder, with_ids=False)


@query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from every formatted conversation."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    messages = reply_trees.chained(rows.unionByName(extra), "conv_id", "turn")
    return reply_trees.digests(reply_trees.conversations(messages)).withColumnRenamed("tree_id", "conv_id")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a passage of an earlier document covers."""
    parsed = substring.parse(table(spark, sf_dir, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept_sha")).alias("kept_sha256"))


@query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a unigram base and the suffix tree."""
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"))


@query
def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every document, with its paragraphs of that family."""
    found = licences.find_licences(table(spark, sf_dir, "documents"))
    return found.groupBy("doc_id", "family").agg(
        F.count("*").alias("n_paragraphs"),
        F.min("paragraph").cast("bigint").alias("first_paragraph"),
        F.max("probability").alias("probability"),
        F.max("similarity").alias("similarity"),
    )


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return languages.identify(table(spark, sf_dir, "documents"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, some of which repeat themselves by the fixed rule."""
    found = periodic.strongest(periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents"))))
    best = F.col("best")
    return found.select(
        "doc_id", F.size("starts").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.lower(F.hex("runs_sha")).alias("runs_sha256"), F.lower(F.hex("kept_sha")).alias("collapsed_sha256"),
    )


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations."""
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.paths(prefix_trie.rebuilt(lists)))
