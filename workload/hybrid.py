"""Hybrid search over the float and binary fields of ``embeddings`` and the terms of ``documents``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from vecspark.functions.packing import pack_bits
from vecspark.operators.ann import ivf_build
from vecspark.operators.hybrid import BlockIndex, Rrf, SubSearch, Weighted, hybrid_search
from vecspark.operators.sparse import write_blocks
from vecspark.session import scratch_path
from workload.fixtures import (CENTROIDS_SQL, COS_SQL, DOC_TERMS_SQL, HAM_SQL, IP_SQL, ITEM_TERMS_SQL, L2_SQL,
                               benchmark_queries, binary_queries, centroids, document_terms, embeddings, rounded)
from workload.registry import query


def branch_sql(name, score, k, desc=False, where="true", having="true"):
    order = "DESC" if desc else "ASC"
    return f"""{name} AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score {order}, id) AS rank FROM (
    SELECT q.qid, e.vec_id AS id, {score} AS score FROM q, embeddings e WHERE {where}) WHERE {having}) WHERE rank <= {k})"""


def fused_sql(branches, terms, limit, offset=0, pk="vec_id", queries=CENTROIDS_SQL):
    names = [f"b{i}" for i in range(len(branches))]
    union = " UNION ALL ".join(f"SELECT qid, id, {t} AS term FROM {n}" for n, t in zip(names, terms))
    return f"""WITH {queries}, {', '.join(branches)},
f AS (SELECT qid, id, sum(term) AS score FROM ({union}) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM f)
SELECT qid, rank::bigint AS rank, id AS {pk}, round(score, 6) AS score FROM r
WHERE rank > {offset} AND rank <= {offset + limit}"""


RRF = "1.0::double / (60.0::double + rank)"
NORM_L2 = "1.0::double - 2 / pi() * atan(score)"
NORM_IP = "0.5::double + atan(score) / pi()"
NORM_COS = "(1.0::double + score) / 2"


def rows(spark, sf):
    return embeddings(spark, sf).withColumn("bits", pack_bits("embedding", 64))


def dense(spark, sf, metric, k, **options):
    return SubSearch(rows(spark, sf), centroids(spark, sf), k, metric, {"vec": "embedding", **options})


def bits(spark, sf, k, **options):
    return SubSearch(rows(spark, sf), binary_queries(spark, sf), k, "HAMMING", {"vec": "bits", **options})


def fuse(branches, limit, reranker, **kw):
    return rounded(hybrid_search(branches, limit, reranker, pk="vec_id", **kw), 6)


L2_30 = branch_sql("b0", L2_SQL, 30)
HAM_20 = branch_sql("b1", HAM_SQL, 20)


@query("hybrid_rrf", fused_sql([L2_30, HAM_20], [RRF, RRF], 10))
def hybrid_rrf(spark, sf):
    return fuse([dense(spark, sf, "L2", 30), bits(spark, sf, 20)], 10, Rrf())


@query("hybrid_weighted", fused_sql(
    [L2_30, branch_sql("b1", IP_SQL, 20, desc=True), branch_sql("b2", COS_SQL, 20, desc=True)],
    [f"0.5::double * ({NORM_L2})", f"0.3::double * ({NORM_IP})", f"0.2::double * ({NORM_COS})"], 10))
def hybrid_weighted(spark, sf):
    branches = [dense(spark, sf, "L2", 30), dense(spark, sf, "IP", 20), dense(spark, sf, "COSINE", 20)]
    return fuse(branches, 10, Weighted([0.5, 0.3, 0.2]))


@query("hybrid_paged", fused_sql([L2_30, HAM_20], [RRF, RRF], 5, offset=5))
def hybrid_paged(spark, sf):
    branches = [dense(spark, sf, "L2", 30, offset=3), bits(spark, sf, 20)]  # a branch's own offset is ignored
    return fuse(branches, 5, Rrf(), offset=5)


@query("hybrid_filtered", fused_sql(
    [branch_sql("b0", L2_SQL, 20, where="e.label < 5"), branch_sql("b1", HAM_SQL, 20, where="e.label >= 3")], [RRF, RRF], 10))
def hybrid_filtered(spark, sf):
    return fuse([dense(spark, sf, "L2", 20, where="label < 5"), bits(spark, sf, 20, where="label >= 3")], 10, Rrf())


@query("hybrid_range", fused_sql(
    [branch_sql("b0", L2_SQL, 20, having="score >= 0.8 AND score < 0.95"),
     branch_sql("b1", HAM_SQL, 20, having="score >= 10 AND score < 26")], [RRF, RRF], 10))
def hybrid_range(spark, sf):
    branches = [dense(spark, sf, "L2", 20, radius=0.95, range_filter=0.8), bits(spark, sf, 20, radius=26, range_filter=10)]
    return fuse(branches, 10, Rrf())


def _limits_sql():
    one = """SELECT {n}::bigint AS asked, qid, least({n}, count(DISTINCT id))::bigint AS hits FROM (
      SELECT qid, id FROM b0 UNION ALL SELECT qid, id FROM b1) GROUP BY qid"""
    parts = " UNION ALL ".join(one.format(n=n) for n in (8, 15, 20))
    return f"WITH {CENTROIDS_SQL}, {branch_sql('b0', L2_SQL, 10)}, {branch_sql('b1', HAM_SQL, 5)} {parts}"


@query("hybrid_limits", _limits_sql())
def hybrid_limits(spark, sf):
    def counted(limit):
        hits = fuse([dense(spark, sf, "L2", 10), bits(spark, sf, 5)], limit, Rrf())
        return hits.groupBy("qid").agg(F.count("*").alias("hits")).select(F.lit(limit).cast("bigint").alias("asked"), "qid", "hits")

    return reduce(lambda a, b: a.unionByName(b), [counted(n) for n in (8, 15, 20)])


@query("hybrid_sparse_dense", f"""WITH {CENTROIDS_SQL}, {DOC_TERMS_SQL}, {ITEM_TERMS_SQL}, {L2_30},
b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM (
  SELECT b.item_id AS qid, d.doc_id AS id, sum(b.v * d.v) AS score FROM b JOIN d USING (i) GROUP BY 1, 2)) WHERE rank <= 20),
f AS (SELECT qid, id, sum(term) AS score FROM (
  SELECT qid::bigint AS qid, id, {RRF} AS term FROM b0 UNION ALL SELECT qid, id, {RRF} AS term FROM b1) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM f)
SELECT qid, rank::bigint AS rank, id AS vec_id, round(score, 6) AS score FROM r WHERE rank <= 10""")
def hybrid_sparse_dense(spark, sf):
    """Label means ask the vectors, benchmark passages of the same number ask the documents."""
    queries = centroids(spark, sf).withColumn("qid", F.col("qid").cast("bigint"))
    branches = [SubSearch(embeddings(spark, sf), queries, 30, "L2", {"vec": "embedding"}),
                SubSearch(document_terms(spark, sf), benchmark_queries(spark, sf), 20, "IP", {"vec": "terms", "pk": "doc_id"})]
    return fuse(branches, 10, Rrf())


INDEXED_SQL = f"""WITH {CENTROIDS_SQL}, {DOC_TERMS_SQL}, {ITEM_TERMS_SQL}, {L2_30}, {HAM_20.replace('b1 AS', 'b2 AS', 1)},
b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM (
  SELECT b.item_id AS qid, d.doc_id AS id, sum(b.v * d.v) AS score FROM b JOIN d USING (i) GROUP BY 1, 2)) WHERE rank <= 20),
f AS (SELECT qid, id, sum(term) AS score FROM (
  SELECT qid::bigint AS qid, id, {RRF} AS term FROM b0 UNION ALL SELECT qid, id, {RRF} AS term FROM b1
  UNION ALL SELECT qid::bigint AS qid, id, {RRF} AS term FROM b2) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM f)
SELECT qid, rank::bigint AS rank, id AS vec_id, round(score, 6) AS score FROM r WHERE rank <= 10"""


@query("hybrid_indexed", INDEXED_SQL)
def hybrid_indexed(spark, sf):
    """A cell index, sparse blocks and a scan as branches; with all cells probed the fused list is that of three scans."""
    queries = centroids(spark, sf).withColumn("qid", F.col("qid").cast("bigint"))
    index = ivf_build(embeddings(spark, sf), scratch_path(spark, "ivf"), pk="vec_id", vec="embedding", nlist=16)
    path = scratch_path(spark, "blocks")
    write_blocks(document_terms(spark, sf), path, pk="doc_id", vec="terms")
    branches = [SubSearch(index, queries, 30, "L2", {"nprobe": 16}),
                SubSearch(BlockIndex(spark.read.parquet(path)), benchmark_queries(spark, sf), 20, "IP", {"pk": "doc_id"}),
                SubSearch(rows(spark, sf), binary_queries(spark, sf).withColumn("qid", F.col("qid").cast("bigint")), 20, "HAMMING",
                          {"vec": "bits"})]
    return fuse(branches, 10, Rrf())
