"""Corpus pipeline over documents: quality rules, near-dedup, redaction, mixing, packing.

Each stage works on all rows that the one before it left. All but the last return the
columns of documents; the last returns the pieces of the packed sequences.

Defined results: null, empty and white-space texts have too few words and go with the first
stage; a null doc_id, source or lang stays as it is (a null source is a source of its own
in the mix); of repeated rows and near copies one row stays; a text of any length is looked
at whole; further columns pass through all stages but the last, whatever their names; an
empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandflow.llm import minhash, mixing, packing, pii, quality_rules
from strandflow.llm.common import keep, table
from strandflow.llm.queries import vocabulary


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality rules reject."""
    return quality_rules.passing(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document of each near-duplicate class with the least doc_id."""
    return minhash.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; n_chars follows."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that each source meets its share of words."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs tokens into sequences; one row per piece."""
    return packing.pack(docs, **vocabulary())


STAGES = [
    ("quality_rules", keep_good),
    ("minhash_dedup", drop_near_copies),
    ("pii_redaction", redact),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Probabilistic signatures, trained trees and byte-pair merges are beyond SQL; tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
