"""Query vectors and vector columns derived from the whole driver tables, with the same in SQL."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.functions.packing import pack_bits, term_vector
from vecspark.session import spread
from workload.registry import table

# Query set A: the mean vector of every label, rounded so that both engines hold the same values.
CENTROIDS_SQL = """q AS (
  SELECT label AS qid, list(c ORDER BY i) AS qvec FROM (
    SELECT label, i, round(avg(embedding[i]::double), 6) AS c
    FROM (SELECT label, embedding, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY label, i)
  GROUP BY label)"""

# Query set B: every stored vector asks for its own neighbours.
SELF_SQL = "q AS (SELECT vec_id AS qid, embedding::double[] AS qvec FROM embeddings)"

L2_SQL = ("list_sum(list_transform(list_zip(q.qvec, e.embedding), "
          "lambda p: (p[1]::double - p[2]::double) * (p[1]::double - p[2]::double)))")
IP_SQL = "list_inner_product(q.qvec::double[], e.embedding::double[])"
COS_SQL = "list_cosine_similarity(q.qvec::double[], e.embedding::double[])"


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = embeddings(spark, sf_dir)
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))))
    per_label = e.groupBy(F.col("label").alias("qid")).agg(mean.alias("m"))
    return per_label.select("qid", F.transform("m", lambda x: F.round(x, 6)).alias("qvec"))


def self_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings(spark, sf_dir).select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))


def rounded(df: DataFrame, places: int = 4, score: str = "score") -> DataFrame:
    return df.withColumn(score, F.round(score, places))


# Sign bits of the embeddings as packed words; the queries are the sign bits of the label means.
HAM_SQL = ("cast(list_sum(list_transform(list_zip(q.qvec, e.embedding), "
           "lambda p: case when (p[1] > 0) <> (p[2] > 0) then 1 else 0 end)) as double)")
AND_SQL = ("cast(list_sum(list_transform(list_zip(q.qvec, e.embedding), "
           "lambda p: case when p[1] > 0 and p[2] > 0 then 1 else 0 end)) as double)")
OR_SQL = ("cast(list_sum(list_transform(list_zip(q.qvec, e.embedding), "
          "lambda p: case when p[1] > 0 or p[2] > 0 then 1 else 0 end)) as double)")
JAC_SQL = f"(1.0::double - {AND_SQL} / {OR_SQL})"

# Term vectors: 32-bit dimension = first 8 hex digits of the term's md5, value = occurrences.
TERMS_SQL = """{name} AS (SELECT {pk}, ('0x' || substr(md5(t), 1, 8))::bigint AS i, count(*)::double AS v
  FROM (SELECT {pk}, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS t FROM {table}) WHERE t <> ''
  GROUP BY 1, 2)"""
DOC_TERMS_SQL = TERMS_SQL.format(name="d", pk="doc_id", table="documents")
ITEM_TERMS_SQL = TERMS_SQL.format(name="b", pk="item_id", table="benchmark")


def binary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = embeddings(spark, sf_dir)
    return e.select("vec_id", "label", pack_bits("embedding", 64).alias("bits"))


def binary_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids(spark, sf_dir).select("qid", pack_bits("qvec", 64).alias("qvec"))


def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).withColumn("terms", term_vector("text"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage as a query over the documents."""
    items = table(spark, sf_dir, "benchmark")
    return items.select(F.col("item_id").alias("qid"), term_vector("text").alias("qvec"))
