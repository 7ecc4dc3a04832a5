"""Corpus pipeline over ``documents``: toxicity, exact dedup, near-dedup, decontamination, SentencePiece codes.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the last return the
columns of ``documents``; the last returns one row of codes per remaining document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vecspark.llm import exact_dedup, fm_index, near_dup, sentence_pieces, toxicity
from vecspark.llm.queries import toxicity_model
from vecspark.llm.registry import table
from vecspark.session import materialize

ORACLE_SQL = None  # learned scores and SentencePiece codes are beyond SQL


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go; the model learns from the labelled rows that are not held out."""
    return toxicity.drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")), 0.3)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the one with the smallest doc_id stays."""
    return near_dup.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    return fm_index.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the remaining documents."""
    coded = sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("toxicity", reject_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_leaks), ("sentence_pieces", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
