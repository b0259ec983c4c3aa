"""Queries of this subpackage (whole tables, production parameters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import (chatfmt, decontam, fim, htmltext, licences, mixing, phrases, quality,
                          simhash, substr, tokencount, toxicity, warc)
from logweave.llm.common import table


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return d.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chatfmt.format_chats(table(spark, sf_dir, "conversations"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substr.dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(table(spark, sf_dir, "documents"), with_output=False)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_simhash_dedup, op2_decontamination, op3_token_counts, op4_mixing, op5_toxicity,
    op6_chat_formatting, op7_html_extraction, op8_licence_scan, op9_substring_dedup,
    op10_quality_rules, op11_phrase_mining, op12_fill_in_middle, op13_warc, pipeline)}
