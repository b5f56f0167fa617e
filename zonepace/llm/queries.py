"""The registered training-data queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepace.llm.common import load
from zonepace.llm.conversation_repair import repair_report
from zonepace.llm.decontamination import find_matches
from zonepace.llm.exact_dedup import exact_dedup
from zonepace.llm.fill_in_middle import fim_digests
from zonepace.llm.license_scan import scan_licenses
from zonepace.llm.mixing import domain_labels, mixing_rates
from zonepace.llm.near_dedup import near_classes
from zonepace.llm.quality import fit_quality, score_quality
from zonepace.llm.quality_rules import judge_rules
from zonepace.llm.substring_dedup import repeated_passages
from zonepace.llm.token_count import count_tokens
from zonepace.llm.training_order import training_order
from zonepace.llm.url_filter import judge_urls, rules_table

COUNT_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ID_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")

# The URL rules of the query, (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page; null urls and urls without :// have empty host and path."""
    return judge_urls(load(spark, sf_dir, "pages"), rules_table(spark, URL_RULES))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; a null text counts as empty."""
    return count_tokens(load(spark, sf_dir, "documents"), COUNT_VOCABULARY)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, learned from labels outside the held-out fold."""
    docs = load(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, load(spark, sf_dir, "labels")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, class_size, kept, text_hash of every document."""
    return near_classes(load(spark, sf_dir, "documents"))


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packed token sequence of the documents at its slot of the keyed training order."""
    return training_order(load(spark, sf_dir, "documents"), ID_VOCABULARY)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, posteriors of the languages, rate, copies of every document."""
    docs = load(spark, sf_dir, "documents")
    return mixing_rates(docs, domain_labels(docs, load(spark, sf_dir, "labels")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document, dropped ones too."""
    return exact_dedup(load(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = find_matches(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, license, family, dice, unit, place, licenses, n_hits of every document; nulls and 0 without a licence."""
    return scan_licenses(load(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_bytes, n_chunks, first_doc_id, removed_bytes, removed, key of every repeated passage of the documents."""
    return repeated_passages(load(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every damaged conversation."""
    return repair_report(load(spark, sf_dir, "conversations"), damage=True)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every document."""
    return fim_digests(load(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts, base_failed, kept, failed of every document."""
    return judge_rules(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_token_counts, op3_quality_classifier, op4_near_dedup, op5_training_order, op6_mixing,
    op7_exact_dedup, op8_decontamination, op9_license_scan, op10_substring_dedup, op11_conversation_repair, op12_fill_in_middle,
    op13_quality_rules)}
