"""Queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embeddings, interaction, merkle, minhash, mixing, packing, pii, quality_classifier, quality_rules, suffix_dedup, url_filter, warc
from .common import table


def vocabulary() -> dict[str, str]:
    """The public byte-level vocabulary, in both forms, and its splitting pattern."""
    import public_tokenizers

    return {"ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "json_path": public_tokenizers.path("byte_bpe_50k.json"), "pattern": public_tokenizers.PATTERN}


def word_vocabulary() -> str:
    """The public vocabulary of lower-case words with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"), url_filter.rule_frame(spark))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return d.select("page_id", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to", "complete")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), **vocabulary())


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(merkle.manifest(table(spark, sf_dir, "documents")))


def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = word_vocabulary()
    d = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return d.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_classifier, op2_warc, op3_quality_rules, op4_url_filter, op5_pii, op6_mixing, op7_embedding_dedup, op8_suffix_dedup, op9_minhash_dedup, op10_packing, op11_merkle_manifest, op12_filter_interaction, op13_bpe)
}

ORACLES: dict[str, str] = {
    "op2_warc": warc.oracle(),
    "op11_merkle_manifest": merkle.oracle(),
    "op12_filter_interaction": interaction.oracle(),
    "op7_embedding_dedup": embeddings.oracle(),
    "op3_quality_rules": f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_stop_words, n_lines, failed_rules FROM ({quality_rules.oracle_measures()})",
    "op4_url_filter": url_filter.oracle(),
    "op6_mixing": f"SELECT doc_id, size, source_size, target, (size * times)::BIGINT AS taken, source, times FROM ({mixing.oracle_copies()})",
}
