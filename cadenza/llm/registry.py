"""The queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import (decontaminate, fill_in_middle, language_id, licenses, line_dedup, near_dedup, packing, prefix_trie,
                         secrets, sharding, spotsigs, toxicity, url_filter)
from cadenza.llm.common import table
from cadenza.llm.oracle import SQL as ORACLE  # noqa: F401  (for the entry module)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the last one only."""
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's licence: its own, or that of a directory above it."""
    return licenses.license_scan(licenses.documents_as_files(table(spark, sf_dir, "documents")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled two thirds."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside occurrences of benchmark windows, for each document."""
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return spotsigs.compared_with_next(table(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles are 85 % alike."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate secrets of every document and the forest's judgement."""
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the labelled two thirds."""
    return language_id.language_id(table(spark, sf_dir, "documents"))


# The rules of the URL query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's rule and verdict; aliases of blocked pages are blocked."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, placed in sequences of 4096."""
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), default_tokenizer()))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations."""
    turns = table(spark, sf_dir, "conversations")
    return prefix_trie.prefix_trie(prefix_trie.shared_openings(prefix_trie.sequences(turns)))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 24 shuffled shards."""
    return sharding.placements(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, rewritten for filling in its middle."""
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def default_tokenizer() -> str:
    """The public vocabulary that the packing query counts with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


QUERIES = {f.__name__: f for f in (
    op1_line_dedup,
    op2_license_scan,
    op3_toxicity,
    op4_benchmark_decontamination,
    op5_spotsigs_fingerprints,
    op6_minhash_near_dedup,
    op7_secret_scan,
    op8_language_id,
    op9_url_filter,
    op10_best_fit_packing,
    op11_prefix_trie,
    op12_sharding,
    op13_fill_in_middle,
)}
