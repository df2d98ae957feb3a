"""Corpus pipeline: language identification, near-duplicates, mixture, SentencePiece ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraframe.llm import mixing, piece_scan, ppm, simhash
from terraframe.llm.runtime import scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, or in none of the languages learned from ``docs``."""
    return ppm.keep_identified(docs, ppm.train_on(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each component of 5-word-shingle Jaccard >= 0.8."""
    return simhash.keep_distinct(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thin the documents to the rates that bring the labelled domains to their target shares."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.keep_mixed(docs, labels, mixing.label_domain(), mixing.TARGETS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids): SentencePiece ids of every document, little-endian uint32."""
    from pyspark.sql import functions as F

    encoded = piece_scan.encode(docs)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_to_targets),
    ("sentencepiece", encode_pieces),
]

#: A trained classifier, iterative components and a tokenizer are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
