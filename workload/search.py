"""Dense search queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.functions.predicates import a_get, field, has_field, j_ne, j_num
from vecspark.operators.search import search
from workload.fixtures import (CENTROIDS_SQL, COS_SQL, IP_SQL, L2_SQL, SELF_SQL, centroids, embeddings,
                               rounded, self_queries)
from vecspark.session import materialize
from workload.registry import query, table


def topk_sql(score: str, desc: bool = False, where: str = "true", having: str = "true", k: int = 10,
             offset: int = 0, cols: str = "", queries: str = CENTROIDS_SQL) -> str:
    order = "DESC" if desc else "ASC"
    return f"""WITH {queries},
s AS (SELECT q.qid, e.vec_id, e.label, {score} AS score FROM q, embeddings e WHERE {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score {order}, vec_id) AS rank FROM s WHERE {having})
SELECT qid, rank::bigint AS rank, vec_id{cols}, round(score, 4) AS score FROM r
WHERE rank > {offset} AND rank <= {offset + k}"""


def dense(spark, sf, metric, k=10, queries=None, **kw):
    q = (queries or centroids)(spark, sf)
    return rounded(search(embeddings(spark, sf), q, k, metric=metric, vec="embedding", pk="vec_id", **kw))


@query("knn_l2", topk_sql(L2_SQL))
def knn_l2(spark, sf):
    return dense(spark, sf, "L2")


@query("knn_ip", topk_sql(IP_SQL, desc=True))
def knn_ip(spark, sf):
    return dense(spark, sf, "IP")


@query("knn_cosine", topk_sql(COS_SQL, desc=True))
def knn_cosine(spark, sf):
    return dense(spark, sf, "COSINE")


@query("knn_topk", topk_sql(L2_SQL, queries=SELF_SQL))
def knn_topk(spark, sf):
    return dense(spark, sf, "L2", queries=self_queries)


@query("knn_filtered", topk_sql(COS_SQL, desc=True, where="e.label <> 3"))
def knn_filtered(spark, sf):
    return dense(spark, sf, "COSINE", where="label <> 3")


@query("knn_paged", topk_sql(L2_SQL, offset=10))
def knn_paged(spark, sf):
    return dense(spark, sf, "L2", offset=10)


@query("knn_output_fields", topk_sql(L2_SQL, cols=", label, e0").replace(
    "e.label,", "e.label, round(e.embedding[1]::double, 6) AS e0,"))
def knn_output_fields(spark, sf):
    hits = dense(spark, sf, "L2", fields=["label", "embedding"])
    first = F.round(F.get("embedding", F.lit(0)).cast("double"), 6)
    return hits.select("qid", "rank", "vec_id", "label", first.alias("e0"), "score")


@query("range_search", topk_sql(L2_SQL, having="score >= 1.0 AND score < 1.5", k=50, queries=SELF_SQL))
def range_search(spark, sf):
    return dense(spark, sf, "L2", k=50, radius=1.5, range_filter=1.0, queries=self_queries)


@query("range_search_ip", topk_sql(IP_SQL, desc=True, having="score >= 0.25 AND score < 0.9", k=50, queries=SELF_SQL))
def range_search_ip(spark, sf):
    return dense(spark, sf, "IP", k=50, radius=0.25, range_filter=0.9, queries=self_queries)


GROUP_SQL = """WITH {q},
s AS (SELECT q.qid, e.vec_id, e.label, {score} AS score FROM q, embeddings e),
g AS (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY score {d}, vec_id) AS n FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score {d}, vec_id) AS rank FROM g WHERE n = 1)
SELECT qid, rank::bigint AS rank, vec_id, label, round(score, 4) AS score FROM r
WHERE rank > {o} AND rank <= {o} + {k}"""


@query("search_group_by", GROUP_SQL.format(q=CENTROIDS_SQL, score=L2_SQL, d="ASC", o=0, k=8))
def search_group_by(spark, sf):
    return dense(spark, sf, "L2", k=8, group_by="label")


@query("search_group_by_paged", GROUP_SQL.format(q=CENTROIDS_SQL, score=COS_SQL, d="DESC", o=4, k=4))
def search_group_by_paged(spark, sf):
    return dense(spark, sf, "COSINE", k=4, offset=4, group_by="label")


# ---------------------------------------------------------------- filtered by JSON, dynamic and array fields

EVENT_VEC_SQL = """v AS (SELECT event_id, event_type, regexp_extract(props, '[0-9]+')::int AS k,
  [value, regexp_extract(props, '[0-9]+')::double, user_id::double] AS vec FROM events),
q AS (SELECT event_type AS qid, [round(avg(value), 4), round(avg(vec[2]), 4), round(avg(vec[3]), 4)] AS qvec
  FROM (SELECT event_type, vec, vec[1] AS value FROM v) GROUP BY 1)"""


def event_vectors(spark, sf):
    """Events as points (value, k, user) with their JSON part; the queries are the mean of each type."""
    k = F.get_json_object("props", "$.k").cast("double")
    rows = materialize(table(spark, sf, "events").select(
        "event_id", "event_type", F.parse_json("props").alias("$meta"), F.array("value", k, F.col("user_id").cast("double")).alias("vec")), "events")
    mean = lambda i: F.round(F.avg(F.get("vec", F.lit(i))), 4)
    queries = rows.groupBy(F.col("event_type").alias("qid")).agg(F.array(mean(0), mean(1), mean(2)).alias("qvec"))
    return rows, queries


def event_sql(where):
    return f"""WITH {EVENT_VEC_SQL},
s AS (SELECT q.qid, v.event_id, list_sum(list_transform(list_zip(q.qvec, v.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS score
  FROM q, v WHERE {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, event_id) AS rank FROM s)
SELECT qid, rank::bigint AS rank, event_id, round(score, 4) AS score FROM r WHERE rank <= 10"""


def event_search(spark, sf, predicate, **kw):
    rows, queries = event_vectors(spark, sf)
    return rounded(search(rows, queries, 10, metric="L2", vec="vec", pk="event_id", where=predicate(rows), **kw))


@query("knn_json_filtered", event_sql("v.k < 20 AND v.k <> 7"))
def knn_json_filtered(spark, sf):
    return event_search(spark, sf, lambda r: (j_num("$meta", "k") < 20) & j_ne("$meta", 7, "k"))


@query("knn_dynamic_filtered", event_sql("v.k IN (3, 5, 8)"))
def knn_dynamic_filtered(spark, sf):
    return event_search(spark, sf, lambda r: field(r, "k").isin(3.0, 5.0, 8.0))


@query("knn_array_filtered", event_sql("v.vec[1] > 25 AND v.vec[3] < 100"))
def knn_array_filtered(spark, sf):
    return event_search(spark, sf, lambda r: (a_get("vec", 0) > 25) & (a_get("vec", 2) < 100))


@query("knn_no_hits", "SELECT DISTINCT event_type AS qid, NULL::bigint AS event_id FROM events")
def knn_no_hits(spark, sf):
    """A predicate without matches still gives one (empty) group per query."""
    return event_search(spark, sf, lambda r: has_field(r, "missing"), keep_empty=True).select("qid", "event_id")


@query("knn_join_fields", topk_sql(L2_SQL, cols=", label"))
def knn_join_fields(spark, sf):
    return dense(spark, sf, "L2", fields=["label"], fetch="join")
