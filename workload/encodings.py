"""Binary, half-precision and sparse vectors: packing, row-wise distances and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.functions import distance, packing
from vecspark.operators.distances import calc_distance
from vecspark.operators.search import search
from vecspark.operators.sparse import postings, search_blocks, search_postings, write_blocks, write_postings
from vecspark.session import scratch_path
from workload.fixtures import (AND_SQL, CENTROIDS_SQL, COS_SQL, DOC_TERMS_SQL, HAM_SQL, IP_SQL, ITEM_TERMS_SQL,
                               JAC_SQL, L2_SQL, OR_SQL, benchmark_queries, binary_queries,
                               binary_rows, centroids, document_terms, embeddings, rounded)
from workload.registry import query, table
from workload.search import topk_sql

# ---------------------------------------------------------------- packing


@query("vec_pack_binary", """SELECT vec_id, label,
  list_sum(list_transform(list_zip(embedding, range(64)), lambda p: CASE WHEN p[1] > 0 THEN 1 ELSE 0 END))::bigint AS ones,
  list_sum(list_transform(list_zip(embedding[1:32], range(32)),
    lambda p: CASE WHEN p[1] > 0 THEN (1::bigint << p[2]::int) ELSE 0 END))::bigint AS low_half FROM embeddings""")
def vec_pack_binary(spark, sf):
    low = F.get("bits", F.lit(0)).bitwiseAND(F.lit(2**32 - 1).cast("bigint"))
    return binary_rows(spark, sf).select("vec_id", "label", packing.bit_total("bits").alias("ones"), low.alias("low_half"))


def _half(spark, sf, pack, unpack):
    packed = embeddings(spark, sf).select("vec_id", "embedding", pack("embedding").alias("raw"))
    back = packed.select("vec_id", "embedding", F.length("raw").alias("bytes"), unpack("raw").alias("back"))
    worst = F.array_max(F.zip_with("embedding", "back", lambda x, y: F.abs(x.cast("double") - y)))
    return back.select("vec_id", "bytes", (worst < 0.004).alias("close"))


@query("vec_pack_fp16", "SELECT vec_id, 128 AS bytes, true AS close FROM embeddings")
def vec_pack_fp16(spark, sf):
    return _half(spark, sf, packing.pack_fp16, packing.unpack_fp16)


@query("vec_pack_bf16", "SELECT vec_id, 128 AS bytes, true AS close FROM embeddings")
def vec_pack_bf16(spark, sf):
    return _half(spark, sf, packing.pack_bf16, packing.unpack_bf16)


@query("vec_pack_sparse", f"""WITH {DOC_TERMS_SQL}
SELECT t.doc_id, count(d.i)::bigint AS entries, coalesce(max(d.i) + 1, 0)::bigint AS dim, coalesce(sum(d.v), 0)::double AS total,
  coalesce(min(d.i), -1)::bigint AS first_dim FROM documents t LEFT JOIN d ON d.doc_id = t.doc_id GROUP BY t.doc_id""")
def vec_pack_sparse(spark, sf):
    docs = document_terms(spark, sf)
    shuffled = docs.select(
        "doc_id", F.reverse(F.transform("terms", lambda e: e["i"])).alias("p"), F.reverse(F.transform("terms", lambda e: e["v"])).alias("x"))
    packed = shuffled.select("doc_id", packing.pack_sparse("p", "x").alias("vec"))
    total = F.aggregate("vec", F.lit(0.0), lambda a, e: a + e["v"].cast("double"))
    return packed.select("doc_id", F.size("vec").cast("bigint").alias("entries"), packing.sparse_dim("vec").alias("dim"),
                         total.alias("total"), F.coalesce(F.get("vec", F.lit(0))["i"], F.lit(-1).cast("bigint")).alias("first_dim"))


@query("vec_flatten", """SELECT vec_id, (unnest(range(1, 65)) - 1)::int AS dim,
  round(unnest(embedding)::double, 6) AS value FROM embeddings""")
def vec_flatten(spark, sf):
    long = packing.flatten_vectors(embeddings(spark, sf), "vec_id", "embedding")
    return long.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query("vec_collect", "SELECT vec_id, 64 AS dim, round(embedding[64]::double, 6) AS last FROM embeddings")
def vec_collect(spark, sf):
    back = packing.collect_vectors(packing.flatten_vectors(embeddings(spark, sf), "vec_id", "embedding"), "vec_id")
    return back.select("vec_id", F.size("vector").alias("dim"),
                       F.round(F.get("vector", F.lit(63)).cast("double"), 6).alias("last"))


# ---------------------------------------------------------------- row-wise distances: each vector to its label's mean

def pair_sql(expr: str) -> str:
    return f"WITH {CENTROIDS_SQL} SELECT e.vec_id, {expr} AS distance FROM embeddings e JOIN q ON q.qid = e.label"


def paired(spark, sf):
    return embeddings(spark, sf).join(centroids(spark, sf), F.col("qid") == F.col("label"))


def paired_bits(spark, sf):
    return binary_rows(spark, sf).join(binary_queries(spark, sf), F.col("qid") == F.col("label"))


def _dist(df, expr, places=6):
    return df.select("vec_id", F.round(expr, places).alias("distance"))


@query("dist_l2", pair_sql(f"round({L2_SQL}, 6)"))
def dist_l2(spark, sf):
    return _dist(paired(spark, sf), distance.l2("qvec", "embedding"))


@query("dist_ip", pair_sql(f"round({IP_SQL}, 6)"))
def dist_ip(spark, sf):
    return _dist(paired(spark, sf), distance.ip("qvec", "embedding"))


@query("dist_cosine", pair_sql(f"round({COS_SQL}, 6)"))
def dist_cosine(spark, sf):
    return _dist(paired(spark, sf), distance.cosine("qvec", "embedding"))


@query("dist_hamming", pair_sql(f"({HAM_SQL})::bigint"))
def dist_hamming(spark, sf):
    return paired_bits(spark, sf).select("vec_id", distance.hamming("qvec", "bits").alias("distance"))


@query("dist_jaccard", pair_sql(f"round({JAC_SQL}, 6)"))
def dist_jaccard(spark, sf):
    return _dist(paired_bits(spark, sf), distance.jaccard("qvec", "bits"))


@query("dist_tanimoto", pair_sql(f"round(-log2({AND_SQL} / {OR_SQL}), 6)"))
def dist_tanimoto(spark, sf):
    return _dist(paired_bits(spark, sf), distance.tanimoto("qvec", "bits"))


def _shared(spark, sf, combine):
    """(vec_id, pattern, other): the bits of a vector and the next one combined, and the next (even ids) or the one after it."""
    own = binary_rows(spark, sf).select("vec_id", "bits")
    at = lambda name: own.select(F.col("vec_id").alias(f"{name}_id"), F.col("bits").alias(name))
    asked = own.select("vec_id", "bits", (F.col("vec_id") + 1).alias("next_id"), (F.col("vec_id") + 1 + F.col("vec_id") % 2).alias("other_id"))
    joined = asked.join(at("next"), "next_id").join(at("other"), "other_id")
    return joined.select("vec_id", F.zip_with("bits", "next", combine).alias("pattern"), "other")


SHARED_SQL = """SELECT e.vec_id, list_bool_and(list_transform(range(1, 65), lambda i: {test})) AS is_match FROM embeddings e
JOIN embeddings n ON n.vec_id = e.vec_id + 1 JOIN embeddings o ON o.vec_id = e.vec_id + 1 + e.vec_id % 2"""


@query("match_substructure", SHARED_SQL.format(test="NOT (e.embedding[i] > 0 AND n.embedding[i] > 0) OR o.embedding[i] > 0"))
def match_substructure(spark, sf):
    """The bits that two vectors share are a substructure of both, rarely of a third."""
    pairs = _shared(spark, sf, lambda a, b: a.bitwiseAND(b))
    return pairs.select("vec_id", distance.substructure("pattern", "other").alias("is_match"))


@query("match_superstructure", SHARED_SQL.format(test="NOT o.embedding[i] > 0 OR (e.embedding[i] > 0 OR n.embedding[i] > 0)"))
def match_superstructure(spark, sf):
    """The bits of either of two vectors are a superstructure of both, rarely of a third."""
    pairs = _shared(spark, sf, lambda a, b: a.bitwiseOR(b))
    return pairs.select("vec_id", distance.superstructure("pattern", "other").alias("is_match"))


TURNS_SQL = """d AS (SELECT conv_id, turn, ('0x' || substr(md5(t), 1, 8))::bigint AS i, count(*)::double AS v
  FROM (SELECT conv_id, turn, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS t FROM conversations)
  WHERE t <> '' GROUP BY 1, 2, 3)"""


@query("dist_sparse_ip", f"""WITH {TURNS_SQL}
SELECT a.conv_id, a.turn, sum(a.v * b.v)::double AS score FROM d a JOIN d b
ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND b.i = a.i GROUP BY 1, 2""")
def dist_sparse_ip(spark, sf):
    """Shared terms of every message and the one that follows it."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", packing.term_vector("text").alias("vec"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("vec").alias("next"))
    scored = turns.join(after, ["conv_id", "turn"]).withColumn("score", distance.sparse_ip("vec", "next"))
    return scored.where("score IS NOT NULL").select("conv_id", "turn", "score")


@query("calc_distance", f"""WITH {CENTROIDS_SQL}
SELECT e.vec_id AS left_id, q.qid AS right_id, round({L2_SQL}, 5) AS distance FROM embeddings e, q""")
def calc_distance_dense(spark, sf):
    left = embeddings(spark, sf).select(F.col("vec_id").alias("left_id"), "embedding")
    right = centroids(spark, sf).withColumnRenamed("qid", "right_id")
    pairs = calc_distance(left, right, "L2", left=("left_id", "embedding"), right=("right_id", "qvec"))
    return pairs.withColumn("distance", F.round("distance", 5))


@query("calc_distance_hamming", f"""WITH {CENTROIDS_SQL}
SELECT e.vec_id AS left_id, q.qid AS right_id, ({HAM_SQL})::bigint AS distance FROM embeddings e, q""")
def calc_distance_hamming(spark, sf):
    left = binary_rows(spark, sf).select(F.col("vec_id").alias("left_id"), "bits")
    right = binary_queries(spark, sf).withColumnRenamed("qid", "right_id")
    return calc_distance(left, right, "HAMMING", left=("left_id", "bits"), right=("right_id", "qvec"))


# ---------------------------------------------------------------- search per encoding

def bits_search(spark, sf, metric, k=10, **kw):
    return rounded(search(binary_rows(spark, sf), binary_queries(spark, sf), k, metric=metric, vec="bits", pk="vec_id", **kw))


@query("knn_binary_hamming", topk_sql(HAM_SQL))
def knn_binary_hamming(spark, sf):
    return bits_search(spark, sf, "HAMMING")


@query("knn_binary_jaccard", topk_sql(JAC_SQL))
def knn_binary_jaccard(spark, sf):
    return bits_search(spark, sf, "JACCARD")


@query("range_search_binary", topk_sql(HAM_SQL, having="score >= 10 AND score < 24", k=50))
def range_search_binary(spark, sf):
    return bits_search(spark, sf, "HAMMING", k=50, radius=24, range_filter=10)


CLOSE_SQL = "SELECT q.label AS qid, r.rank::bigint AS rank, true AS close FROM (SELECT DISTINCT label FROM embeddings) q, range(1, 11) r(rank)"


def close_to_exact(hits, spark, sf, within):
    """(qid, rank, close): whether the score at every rank is that of the exact list up to ``within``."""
    exact = search(embeddings(spark, sf), centroids(spark, sf), 10, metric="L2", vec="embedding", pk="vec_id")
    both = hits.select("qid", "rank", "score").join(exact.select("qid", "rank", F.col("score").alias("exact")), ["qid", "rank"])
    return both.select("qid", "rank", (F.abs(F.col("score") - F.col("exact")) < within).alias("close"))


def _half_search(spark, sf, pack, encoding):
    rows = embeddings(spark, sf).select("vec_id", pack("embedding").alias("half"))
    hits = search(rows, centroids(spark, sf), 10, metric="L2", vec="half", pk="vec_id", encoding=encoding)
    return close_to_exact(hits, spark, sf, 0.02)


@query("knn_fp16", CLOSE_SQL)
def knn_fp16(spark, sf):
    return _half_search(spark, sf, packing.pack_fp16, "fp16")


@query("knn_bf16", CLOSE_SQL)
def knn_bf16(spark, sf):
    return _half_search(spark, sf, packing.pack_bf16, "bf16")


SPARSE_SQL = """WITH {d}, {b},
s AS (SELECT b.item_id AS qid, d.doc_id, sum(b.v * d.v)::double AS score FROM b JOIN d USING (i) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM s WHERE {having})
SELECT qid, rank::bigint AS rank, doc_id, score FROM r WHERE rank <= {k}"""


def sparse_sql(d=DOC_TERMS_SQL, b=ITEM_TERMS_SQL, having="true", k=10):
    return SPARSE_SQL.format(d=d, b=b, having=having, k=k)


@query("knn_sparse", sparse_sql())
def knn_sparse(spark, sf):
    return search(document_terms(spark, sf), benchmark_queries(spark, sf), 10, metric="IP", vec="terms", pk="doc_id")


@query("range_search_sparse", sparse_sql(having="score >= 50 AND score < 80", k=20))
def range_search_sparse(spark, sf):
    return search(document_terms(spark, sf), benchmark_queries(spark, sf), 20, metric="IP", vec="terms", pk="doc_id",
                  radius=50, range_filter=80)


@query("search_group_by_sparse", f"""WITH {DOC_TERMS_SQL}, {ITEM_TERMS_SQL},
s AS (SELECT b.item_id AS qid, d.doc_id, t.source, sum(b.v * d.v)::double AS score
  FROM b JOIN d USING (i) JOIN documents t ON t.doc_id = d.doc_id GROUP BY 1, 2, 3),
g AS (SELECT *, row_number() OVER (PARTITION BY qid, source ORDER BY score DESC, doc_id) AS n FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM g WHERE n = 1)
SELECT qid, rank::bigint AS rank, doc_id, score, source FROM r WHERE rank <= 5""")
def search_group_by_sparse(spark, sf):
    return search(document_terms(spark, sf), benchmark_queries(spark, sf), 5, metric="IP", vec="terms", pk="doc_id",
                  group_by="source")


# entries kept after dropping the floor(ratio * n) smallest values (ties: highest dimension first)
KEPT_SQL = """{out} AS (SELECT {pk}, i, v FROM (SELECT *, row_number() OVER (PARTITION BY {pk} ORDER BY v DESC, i) AS n,
  count(*) OVER (PARTITION BY {pk}) AS c FROM {src}) WHERE n <= c - floor(c * {ratio}::double))"""


@query("sparse_index_build", f"""WITH {DOC_TERMS_SQL}, {KEPT_SQL.format(out='x', pk='doc_id', src='d', ratio=0.3)}
SELECT doc_id, i AS dim, v AS value FROM x""")
def sparse_index_build(spark, sf):
    path = scratch_path(spark, "postings")
    write_postings(document_terms(spark, sf), path, pk="doc_id", vec="terms", drop_ratio=0.3)
    return spark.read.parquet(path).select("doc_id", "dim", F.col("value").cast("double").alias("value"))


@query("sparse_index_search", sparse_sql(
    d=f"{DOC_TERMS_SQL.replace('d AS', 'd0 AS', 1)}, {KEPT_SQL.format(out='d', pk='doc_id', src='d0', ratio=0.2)}",
    b=f"{ITEM_TERMS_SQL.replace('b AS', 'b0 AS', 1)}, {KEPT_SQL.format(out='b', pk='item_id', src='b0', ratio=0.25)}"))
def sparse_index_search(spark, sf):
    """Blocks with maxima, of which those that cannot reach a query's tenth score are skipped."""
    path = scratch_path(spark, "blocks")
    write_blocks(document_terms(spark, sf), path, pk="doc_id", vec="terms", drop_ratio=0.2)
    return search_blocks(spark.read.parquet(path), benchmark_queries(spark, sf), 10, pk="doc_id", drop_ratio=0.25)


@query("sparse_postings_search", sparse_sql())
def sparse_postings_search(spark, sf):
    """The exact answer from postings laid out by dimension: every entry of the rows, all of the queries' dimensions scored in full."""
    path = scratch_path(spark, "postings")
    write_postings(document_terms(spark, sf), path, pk="doc_id", vec="terms")
    return search_postings(spark.read.parquet(path), benchmark_queries(spark, sf), 10, pk="doc_id")


@query("sparse_index_filtered", f"""WITH {DOC_TERMS_SQL}, {ITEM_TERMS_SQL},
s AS (SELECT b.item_id AS qid, d.doc_id, t.source, sum(b.v * d.v)::double AS score
  FROM b JOIN d USING (i) JOIN documents t ON t.doc_id = d.doc_id WHERE t.lang = 'en' GROUP BY 1, 2, 3),
g AS (SELECT *, row_number() OVER (PARTITION BY qid, source ORDER BY score DESC, doc_id) AS n FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM g WHERE n = 1)
SELECT qid, rank::bigint AS rank, doc_id, score, source FROM r WHERE rank <= 5""")
def sparse_index_filtered(spark, sf):
    """Filter, grouping and output fields on the postings."""
    path = scratch_path(spark, "postings")
    write_postings(document_terms(spark, sf), path, pk="doc_id", vec="terms", fields=["lang", "source"])
    index = spark.read.parquet(path)
    return search_postings(index, benchmark_queries(spark, sf), 5, pk="doc_id", where="lang = 'en'", group_by="source")


@query("sparse_postings", f"WITH {DOC_TERMS_SQL} SELECT i AS dim, count(*)::bigint AS rows, sum(v)::double AS total FROM d GROUP BY i")
def sparse_postings(spark, sf):
    p = postings(document_terms(spark, sf), pk="doc_id", vec="terms")
    return p.groupBy("dim").agg(F.count("*").alias("rows"), F.sum(F.col("value").cast("double")).alias("total"))
