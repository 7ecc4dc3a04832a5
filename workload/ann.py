"""Approximate search and streams.  Probing every cell must give the exact answer."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import schema as S
from vecspark.functions import distance
from vecspark.operators import ann
from vecspark.operators.search import search
from vecspark.session import materialize, scratch_path
from vecspark.sources.table import VectorTable
from vecspark.streaming import streams
from vecspark.streaming.changes import ChangeLog
from workload.encodings import CLOSE_SQL, close_to_exact
from workload.fixtures import (COS_SQL, HAM_SQL, L2_SQL, SELF_SQL, binary_queries, binary_rows, centroids, embeddings, rounded,
                               self_queries)
from workload.registry import query, table
from workload.search import topk_sql

NLIST = 16
RECALL = 0.9
REORDER = 100


def build(spark, sf, coding=None, **kw):
    return ann.ivf_build(embeddings(spark, sf), scratch_path(spark, "ivf"), pk="vec_id", vec="embedding", nlist=NLIST,
                         fields=["label"], coding=coding, **kw)


@query("ivf_build", "SELECT count(*)::bigint AS rows, min(vec_id) AS first_id, max(vec_id) AS last_id, true AS in_range FROM embeddings")
def ivf_build(spark, sf):
    rows = ann.ivf_load(spark, build(spark, sf).path).rows()
    return rows.agg(F.count("*").alias("rows"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id"),
                    F.bool_and(F.col("cell").between(0, NLIST - 1)).alias("in_range"))


@query("ivf_search", topk_sql(L2_SQL, queries=SELF_SQL))
def ivf_search(spark, sf):
    return rounded(ann.ivf_search(build(spark, sf), self_queries(spark, sf), 10, metric="L2", nprobe=NLIST))


@query("ivf_search_filtered", topk_sql(COS_SQL, desc=True, where="e.label < 7", cols=", label"))
def ivf_search_filtered(spark, sf):
    hits = ann.ivf_search(build(spark, sf), centroids(spark, sf), 10, metric="COSINE", nprobe=NLIST, where="label < 7", fields=["label"])
    return rounded(hits)


def judged(hits, rows, queries, k, *, tolerance, **options):
    """(qid, hits, distinct, ordered, exact_scores, good_recall) of every query.

    ``exact_scores``: every score is within ``tolerance`` of the pair's exact distance; ``good_recall``: the mean share, over
    all queries, of the k hits of the exact search (with ``options``) that are among the hits is at least RECALL.
    """
    near = search(rows, queries, k, metric="L2", vec="embedding", pk="vec_id", **options).select("qid", "vec_id")
    near = materialize(near, "near").withColumn("true_hit", F.lit(1))  # joined and counted
    off = F.abs(F.col("score") - distance.l2("qvec", "embedding"))
    pairs = hits.join(rows.select("vec_id", "embedding"), "vec_id").join(queries, "qid").select("qid", "vec_id", "rank", "score", off.alias("off"))
    pairs = pairs.join(near, ["qid", "vec_id"], "left")  # without the vectors of a pair
    listed = F.array_sort(F.collect_list(F.struct("rank", "score")))
    per = pairs.groupBy("qid").agg(F.count("*").alias("hits"), F.count_distinct("vec_id").alias("distinct"), listed.alias("l"),
                                   F.max("off").alias("off"), F.count("true_hit").alias("found"))
    rising = F.forall(F.sequence(F.lit(1), F.size("l") - 1), lambda i: F.col("l")[i]["score"] >= F.col("l")[i - 1]["score"])
    per = materialize(per.select("qid", "hits", "distinct", F.when(F.size("l") > 1, rising).otherwise(True).alias("ordered"),
                                 (F.col("off") <= tolerance).alias("exact_scores"), "found"), "judged")
    total = near.agg(F.count("*").alias("n"))
    recall = per.agg(F.sum("found").alias("f")).crossJoin(total).select((F.col("f") >= RECALL * F.col("n")).alias("good_recall"))
    return per.drop("found").crossJoin(F.broadcast(recall))


def judged_sql(qid, source, k=10):
    return (f"SELECT {qid} AS qid, {k}::bigint AS hits, {k}::bigint AS \"distinct\", true AS ordered, true AS exact_scores, "
            f"true AS good_recall FROM {source}")


@query("ivf_search_probed", """SELECT true AS complete, true AS ordered, true AS exact_scores, true AS good_recall, count(*)::bigint AS queries
FROM embeddings""")
def ivf_search_probed(spark, sf):
    """Three quarters of the cells: complete lists, exact scores, and a mean recall of at least RECALL."""
    queries, rows = self_queries(spark, sf), embeddings(spark, sf)
    hits = ann.ivf_search(build(spark, sf), queries, 10, metric="L2", nprobe=12)
    per = judged(hits, rows, queries, 10, tolerance=1e-6)
    return per.agg(F.bool_and(F.col("hits") == 10).alias("complete"), F.bool_and("ordered").alias("ordered"),
                   F.bool_and("exact_scores").alias("exact_scores"),
                   F.bool_and("good_recall").alias("good_recall"), F.count("*").alias("queries"))


@query("ivf_search_group_by", f"""WITH {SELF_SQL},
s AS (SELECT q.qid, e.vec_id, e.label, {L2_SQL} AS score FROM q, embeddings e),
g AS (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY score, vec_id) AS n FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, vec_id) AS rank FROM g WHERE n = 1)
SELECT qid, rank::bigint AS rank, vec_id, round(score, 4) AS score, label FROM r WHERE rank <= 3""")
def ivf_search_group_by(spark, sf):
    """The best row per label from the index; exact when all cells are probed."""
    return rounded(ann.ivf_search(build(spark, sf), self_queries(spark, sf), 3, metric="L2", nprobe=NLIST, group_by="label"))


@query("scann_filtered", judged_sql("DISTINCT label", "embeddings", 5))
def scann_filtered(spark, sf):
    """Filter, fields and offset on re-ranked candidates, against the exact search with the same filter and offset."""
    queries, rows = centroids(spark, sf), embeddings(spark, sf)
    index = build(spark, sf, "pq", m=32, nbits=8)
    hits = ann.scann_search(index, queries, 5, metric="L2", nprobe=NLIST, reorder_k=200, where="label < 7", fields=["label"], offset=2)
    return judged(hits.where("label < 7").drop("label"), rows, queries, 5, tolerance=1e-9, where="label < 7", offset=2)


@query("ivf_self_hit", "SELECT vec_id AS qid, 1::bigint AS rank, vec_id, 0.0::double AS score FROM embeddings")
def ivf_self_hit(spark, sf):
    """Even with one probed cell every stored vector finds itself first."""
    return ann.ivf_search(build(spark, sf), self_queries(spark, sf), 1, metric="L2", nprobe=1)


@query("ivf_binary", topk_sql(HAM_SQL))
def ivf_binary(spark, sf):
    index = ann.ivf_build(binary_rows(spark, sf), scratch_path(spark, "ivf"), pk="vec_id", vec="bits", nlist=NLIST)
    return rounded(ann.ivf_search(index, binary_queries(spark, sf), 10, metric="HAMMING", nprobe=NLIST))


@query("ivf_sq8", CLOSE_SQL)
def ivf_sq8(spark, sf):
    hits = ann.ivf_search(build(spark, sf, "sq8"), centroids(spark, sf), 10, metric="L2", nprobe=NLIST)
    return close_to_exact(hits, spark, sf, 0.05)


@query("ivf_pq", judged_sql("vec_id", "embeddings"))
def ivf_pq(spark, sf):
    """Eight codes of 8 bits for 64 entries, scored by lookup tables; the best REORDER are settled on their stored vectors."""
    queries, rows = self_queries(spark, sf), embeddings(spark, sf)
    hits = ann.scann_search(build(spark, sf, "pq", m=8, nbits=8), queries, 10, metric="L2", nprobe=NLIST, reorder_k=REORDER)
    return judged(hits, rows, queries, 10, tolerance=1e-9)


@query("scann_rerank", judged_sql("DISTINCT label", "embeddings"))
def scann_rerank(spark, sf):
    """200 coded candidates re-ranked: exact scores, and a mean recall of at least RECALL."""
    queries, rows = centroids(spark, sf), embeddings(spark, sf)
    index = build(spark, sf, "pq", m=32, nbits=8)
    hits = ann.scann_search(index, queries, 10, metric="L2", nprobe=NLIST, reorder_k=200)
    return judged(hits, rows, queries, 10, tolerance=1e-9)


RECALL_SQL = f"""WITH {SELF_SQL},
s AS (SELECT q.qid, e.vec_id, e.label, {L2_SQL} AS score FROM q, embeddings e),
x AS (SELECT qid, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, vec_id) AS n FROM s) WHERE n <= 10),
a AS (SELECT qid, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, vec_id) AS n FROM s WHERE label < 8) WHERE n <= 10),
p AS (SELECT x.qid, count(a.vec_id) / count(*)::double AS recall FROM x LEFT JOIN a USING (qid, vec_id) GROUP BY x.qid)"""


def stale_hits(spark, sf):
    """All cells of an index that was built before the labels 8 and 9 came."""
    index = ann.ivf_build(embeddings(spark, sf).where("label < 8"), scratch_path(spark, "ivf"), pk="vec_id", vec="embedding", nlist=NLIST)
    return ann.ivf_search(index, self_queries(spark, sf), 10, metric="L2", nprobe=NLIST)


@query("search_recall", f"{RECALL_SQL} SELECT qid, round(recall, 6) AS recall FROM p")
def search_recall(spark, sf):
    """Recall of a stale index against the exact search, query by query."""
    exact = search(embeddings(spark, sf), self_queries(spark, sf), 10, metric="L2", vec="embedding", pk="vec_id")
    return rounded(ann.recall(stale_hits(spark, sf), exact, pk="vec_id"), 6, "recall")


@query("search_recall_estimate", f"""{RECALL_SQL},
d AS (SELECT * FROM p WHERE ('0x' || substr(md5(qid::varchar), 1, 7))::bigint % 5 = 0),
g AS (SELECT (SELECT count(*) FROM p)::bigint AS asked, count(*)::bigint AS sampled, avg(recall) AS r, var_samp(recall) AS v FROM d)
SELECT asked, sampled, round(r, 6) AS recall, round(greatest(0, r - 1.96 * sqrt(v / sampled * (1 - sampled / asked))), 6) AS low,
       round(least(1, r + 1.96 * sqrt(v / sampled * (1 - sampled / asked))), 6) AS high FROM g""")
def search_recall_estimate(spark, sf):
    """The same from the exact search of a fifth of the queries, with its interval."""
    rows, queries = embeddings(spark, sf), self_queries(spark, sf)
    out = ann.recall_estimate(stale_hits(spark, sf), rows, queries, 10, metric="L2", vec="embedding", pk="vec_id", one_in=5)
    return out.select("asked", "sampled", *[F.round(c, 6).alias(c) for c in ("recall", "low", "high")])


@query("index_progress", "SELECT count(*)::bigint AS total_rows, count(*) FILTER (label < 5)::bigint AS indexed_rows FROM embeddings")
def index_progress(spark, sf):
    part = embeddings(spark, sf).where("label < 5")
    index = ann.ivf_build(part, scratch_path(spark, "ivf"), pk="vec_id", vec="embedding", nlist=8)
    return ann.index_progress(index, embeddings(spark, sf))


# ---------------------------------------------------------------- streams

def event_stream(spark, sf, in_order=False):
    """All events as a stream of several files of one time range each."""
    path = scratch_path(spark, "stream")
    e = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        F.array(F.col("value").cast("float"), F.col("user_id").cast("float")).alias("vec"))
    if not in_order:
        e.repartitionByRange(4, "ts").write.parquet(path)
    else:  # one after the other: a file source takes files by their time
        first, last = e.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
        part = F.floor((F.unix_micros("ts") - first) * 4 / (last - first + 1))
        for n in range(4):
            e.where(part == n).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path)


def user_table(spark, *extra):
    fields = [S.field("user_id", T.LongType(), pk=True), S.field("event_id", T.LongType()), S.field("ts", T.TimestampType()),
              S.field("event_type", T.StringType()), S.field("value", T.DoubleType()), *extra, S.vector("vec", "dense", 2)]
    return VectorTable.create(spark, scratch_path(spark, "table"), S.table_schema(fields))


LATEST = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events"


@query("stream_upsert", "SELECT DISTINCT user_id, event_type, 1::bigint AS seen FROM events")
def stream_upsert(spark, sf):
    """One row per (user, type): however the batches repeat a key, it is stored once."""
    key = F.concat_ws("/", F.col("user_id").cast("string"), F.col("event_type"))
    schema = S.table_schema([S.field("key", T.StringType(), pk=True, max_length=40), S.field("user_id", T.LongType()),
                             S.field("event_type", T.StringType()), S.field("ts", T.TimestampType()), S.vector("vec", "dense", 2)])
    t = VectorTable.create(spark, scratch_path(spark, "table"), schema)
    rows = event_stream(spark, sf).withColumn("key", key).select("key", "user_id", "event_type", "ts", "vec")
    streams.stream_upsert(rows, t, scratch_path(spark, "ckpt"), seq="ts").awaitTermination()
    return t.read().groupBy("user_id", "event_type").agg(F.count("*").alias("seen"))


@query("stream_apply_changes", f"SELECT user_id, event_id, value FROM ({LATEST}) WHERE n = 1 AND event_type <> 'error'")
def stream_apply_changes(spark, sf):
    """Events as a change log by user, clustered by key: an error deletes the user's row, anything else replaces it."""
    stream = event_stream(spark, sf)
    log = ChangeLog.create(spark, scratch_path(spark, "log"), stream.schema, pk="user_id", ts="ts")
    streams.stream_log_changes(stream, log, scratch_path(spark, "ckpt"), op="event_type", delete="error").awaitTermination()
    return log.current_rows().select("user_id", "event_id", "value")


@query("stream_changes_table", f"SELECT user_id, event_id, value FROM ({LATEST}) WHERE n = 1 AND event_type <> 'error'")
def stream_changes_table(spark, sf):
    """The same into a versioned table, which every batch rewrites where its keys are."""
    t = user_table(spark, S.field("deleted", T.BooleanType()))
    streams.stream_apply_changes(event_stream(spark, sf), t, scratch_path(spark, "ckpt"), ts="ts", op="event_type",
                                 delete="error").awaitTermination()
    return streams.current_rows(t).select("user_id", "event_id", "value")


TTL = 6 * 3_600


@query("stream_expire", f"""WITH last AS (SELECT * FROM ({LATEST}) WHERE n = 1)
SELECT user_id, event_id FROM last WHERE epoch_ms(ts) + {TTL}000 >= (SELECT max(epoch_ms(ts)) FROM events)""")
def stream_expire(spark, sf):
    """The latest event of every user, gone once the stream's event time is six hours past it."""
    t, stream = user_table(spark), event_stream(spark, sf, in_order=True)
    streams.stream_upsert(stream, t, scratch_path(spark, "ckpt"), seq="ts").awaitTermination()
    streams.stream_expire(stream, t, scratch_path(spark, "ckpt"), ts="ts", seconds=TTL).awaitTermination()
    return t.read().select("user_id", "event_id")


@query("apply_changes_window", f"""SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events
  WHERE ts >= '2024-01-05' AND ts <= '2024-01-25') WHERE n = 1 AND event_type <> 'error'""")
def apply_changes_window(spark, sf):
    t = user_table(spark, S.field("deleted", T.BooleanType()))
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "vec", F.array(F.col("value").cast("float"), F.col("user_id").cast("float")))
    streams.apply_changes(t, e, ts="ts", op="event_type", delete="error", start=F.lit("2024-01-05").cast("timestamp"),
                          end=F.lit("2024-01-25").cast("timestamp"))
    return streams.current_rows(t).select("user_id", "event_id", "value")


@query("stream_search", topk_sql(L2_SQL, queries=SELF_SQL))
def stream_search(spark, sf):
    index = build(spark, sf)
    path, out = scratch_path(spark, "stream"), scratch_path(spark, "hits")
    q = self_queries(spark, sf)
    q.repartition(3, "qid").write.parquet(path)
    stream = spark.readStream.schema(q.schema).option("maxFilesPerTrigger", 1).parquet(path)
    streams.stream_search(stream, index, out, scratch_path(spark, "ckpt"), 10, metric="L2", nprobe=NLIST).awaitTermination()
    return rounded(spark.read.parquet(out)).drop("batch")
