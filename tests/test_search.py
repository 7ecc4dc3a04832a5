import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import session
from vecspark.functions.packing import pack_bf16, pack_bits, pack_fp16, unpack_bf16, unpack_fp16
from vecspark.operators.distances import calc_distance
from vecspark.operators.hybrid import Rrf, SubSearch, Weighted, hybrid_search
from vecspark.operators.search import search
from vecspark.operators.sparse import search_postings, write_postings
from vecspark.plans import kernel, knn

RNG = np.random.default_rng(7)
DIM = 16
ROW = "id bigint, g string, vec array<float>"


@pytest.fixture(scope="module")
def data(spark):
    """A third of the rows share one vector, a third share one group, some keys repeat."""
    n = 900
    v = RNG.normal(size=(n, DIM)).astype(np.float32)
    v[::3] = v[0]
    g = np.where(np.arange(n) % 3 == 1, "hot", (np.arange(n) % 17).astype(str))
    ids = np.arange(n)
    ids[800:] = 5  # a hundred copies of one key with different vectors
    rows = [(int(i), str(a), x.tolist()) for i, a, x in zip(ids, g, v)]
    q = RNG.normal(size=(7, DIM)).astype(np.float32)
    q[0] = v[0]
    df = spark.createDataFrame(rows, ROW).repartition(5).cache()
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "qid int, qvec array<float>")
    return df, queries, ids, g, v.astype(np.float64), q.astype(np.float64)


def scores(v, q, metric):
    if metric == "L2":
        return ((v[None] - q[:, None]) ** 2).sum(-1)
    dot = (v[None] * q[:, None]).sum(-1)
    if metric == "IP":
        return dot
    return dot / np.linalg.norm(v, axis=1)[None] / np.linalg.norm(q, axis=1)[:, None]


def brute(ids, keys, score, k, offset=0, descending=False, keep=None):
    """Best row per key, ties by id, positions offset .. offset + k."""
    out = []
    for qi, row in enumerate(score):
        order = sorted(range(len(ids)), key=lambda i: (-row[i] if descending else row[i], ids[i]))
        seen, best = set(), []
        for i in order:
            if keep is not None and not keep(row[i]) or keys[i] in seen:
                continue
            seen.add(keys[i])
            best.append((qi, int(ids[i]), round(float(row[i]), 6)))
        out += [(qid, r + 1 + offset, i, s) for r, (qid, i, s) in enumerate(best[offset:offset + k])]
    return out


def found(df, qid="qid"):
    return sorted((r[qid], r["rank"], r["id"], round(r["score"], 6)) for r in df.collect())


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
@pytest.mark.parametrize("paging", [(10, 0), (7, 12), (2000, 0)])
def test_matches_brute_force(data, metric, paging):
    df, queries, ids, _, v, q = data
    k, offset = paging
    got = found(search(df, queries, k, metric=metric, vec="vec", pk="id", offset=offset))
    assert got == brute(ids, ids, scores(v, q, metric), k, offset, metric != "L2")


def test_group_by_takes_the_best_of_every_group(data):
    df, queries, ids, g, v, q = data
    got = found(search(df, queries, 6, metric="L2", vec="vec", pk="id", group_by="g", offset=2))
    assert got == brute(ids, g, scores(v, q, "L2"), 6, 2)


def test_range_bounds_are_half_open(data, spark):
    df, queries, ids, _, v, q = data
    s = scores(v, q, "L2")
    low, high = float(s[1][10]), float(s[1][20])
    low, high = min(low, high), max(low, high)
    got = found(search(df, queries, 900, metric="L2", vec="vec", pk="id", radius=high, range_filter=low))
    want = brute(ids, ids, s, 900, keep=lambda x: low <= x < high)
    assert len(got) == len(want) > 10
    assert [x[:3] for x in got] == [x[:3] for x in want]


def test_grid_gives_the_same_answer(data, monkeypatch):
    df, queries, *_ = data
    expected = {}
    for name, kw in {"plain": {}, "group": {"group_by": "g"}, "range": {"radius": 30.0, "range_filter": 5.0}}.items():
        expected[name] = found(search(df, queries, 9, metric="L2", vec="vec", pk="id", **kw)), kw
    monkeypatch.setattr(session, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(session, "PROBE_ROWS", 2)
    monkeypatch.setattr(knn, "GRID_QUERIES", 3)
    monkeypatch.setattr(knn, "GRID_ROWS", 100)
    for want, kw in expected.values():
        assert found(search(df, queries, 9, metric="L2", vec="vec", pk="id", **kw)) == want


def test_salted_ranking_gives_the_same_answer(data, monkeypatch):
    df, queries, *_ = data
    want = found(search(df, queries, 9, metric="IP", vec="vec", pk="id", offset=3))
    monkeypatch.setattr(knn, "SALT_ABOVE", 100)
    monkeypatch.setattr(session, "estimated_tasks", lambda df: 1000)  # three levels of slices
    assert found(search(df, queries, 9, metric="IP", vec="vec", pk="id", offset=3)) == want


def test_page_is_a_slice(data):
    df, queries, *_ = data
    whole = found(search(df, queries, 20, metric="COSINE", vec="vec", pk="id"))
    page = found(search(df, queries, 10, metric="COSINE", vec="vec", pk="id", offset=10))
    assert page == [x for x in whole if x[1] > 10]


def test_group_hit_is_the_top_hit_of_the_filtered_search(data):
    df, queries, *_ = data
    grouped = search(df, queries, 5, metric="L2", vec="vec", pk="id", group_by="g").collect()
    for group in {r["g"] for r in grouped}:
        top = {r["qid"]: r["id"] for r in search(df, queries, 1, metric="L2", vec="vec", pk="id", where=F.col("g") == group).collect()}
        assert all(top[r["qid"]] == r["id"] for r in grouped if r["g"] == group)


def test_text_keys_nulls_fields_and_empty_groups(spark):
    rows = spark.createDataFrame([("b", [1.0, 0.0], 1), ("a", [1.0, 0.0], 2), ("é", [0.0, 1.0], 3), ("n", None, 4)],
                                 "k string, vec array<float>, x int")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "qid int, qvec array<float>")
    hits = search(rows, q, 2, metric="L2", vec="vec", pk="k", fields=["x"]).orderBy("qid", "rank").collect()
    assert [(r.qid, r.k, r.x) for r in hits] == [(1, "a", 2), (1, "b", 1), (2, "é", 3), (2, "a", 2)]
    empty = search(rows, q, 2, metric="L2", vec="vec", pk="k", where="x > 10", keep_empty=True).collect()
    assert sorted((r.qid, r.k) for r in empty) == [(1, None), (2, None)]
    zero = spark.createDataFrame([(1, [0.0, 0.0])], "qid int, qvec array<float>")
    assert search(rows, zero, 2, metric="COSINE", vec="vec", pk="k").count() == 0


def test_refusals(data, spark):
    df, queries, *_ = data
    bits = df.select("id", "g", pack_bits("vec", DIM).alias("b"))
    bq = queries.select("qid", pack_bits("qvec", DIM).alias("qvec"))
    ok = dict(metric="L2", vec="vec", pk="id")
    for call in (
        lambda: search(df, queries, 0, **ok), lambda: search(df, queries, 16385, **ok), lambda: search(df, queries, 16000, offset=400, **ok),
        lambda: search(df, queries.limit(0), 5, **ok), lambda: search(df, queries, 5, metric="HAMMING", vec="vec", pk="id"),
        lambda: search(df, queries, 5, radius=1.0, range_filter=2.0, **ok),
        lambda: search(df, queries, 5, metric="IP", vec="vec", pk="id", radius=1.0, range_filter=0.5),
        lambda: search(df, queries, 5, group_by="vec", **ok), lambda: search(df, queries, 5, group_by="g", radius=3.0, **ok),
        lambda: search(bits, bq, 5, metric="HAMMING", vec="b", pk="id", group_by="g"),
        lambda: search(bits, bq, 5, metric="TANIMOTO2", vec="b", pk="id"),
    ):
        with pytest.raises(ValueError):
            call()
    short = queries.withColumn("qvec", F.slice("qvec", 1, DIM - 1))
    with pytest.raises(Exception, match="dimension"):
        search(df, short, 5, **ok).collect()


@pytest.mark.parametrize("metric", ["HAMMING", "JACCARD", "TANIMOTO", "SUBSTRUCTURE", "SUPERSTRUCTURE"])
def test_binary_metrics(spark, metric):
    dim = 72  # more than one word
    b = (RNG.random((200, dim)) < 0.5).astype(np.float32)
    b[0] = 0
    b[1] = 1
    q = b[[0, 1, 2]].copy()
    q[2, 5:] = 0
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(b)], "id bigint, x array<float>").select("id", pack_bits("x", dim).alias("b"))
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "qid int, x array<float>").select("qid", pack_bits("x", dim).alias("qvec"))
    both = q @ b.T
    either = q.sum(1)[:, None] + b.sum(1)[None] - both
    jac = np.where(either > 0, 1 - both / np.maximum(either, 1), 0.0).astype(np.float64)
    with np.errstate(divide="ignore"):
        s = {"HAMMING": (q[:, None] != b[None]).sum(-1).astype(float), "JACCARD": jac, "TANIMOTO": -np.log2(1 - jac),
             "SUBSTRUCTURE": np.where(both == q.sum(1)[:, None], 0.0, np.inf), "SUPERSTRUCTURE": np.where(both == b.sum(1)[None], 0.0, np.inf)}[metric]
    ids = np.arange(200)
    got = found(search(rows, queries, 12, metric=metric, vec="b", pk="id"))
    want = brute(ids, ids, s, 12, keep=np.isfinite)
    assert [(a[:3]) for a in got] == [a[:3] for a in want]
    assert np.allclose([a[3] for a in got], [a[3] for a in want], atol=1e-5)


def test_half_precision_round_trip(spark):
    x = RNG.normal(size=(50, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id int, v array<float>")
    for pack, unpack, tolerance in ((pack_fp16, unpack_fp16, 1e-3), (pack_bf16, unpack_bf16, 8e-3)):
        back = {r.id: r.w for r in df.select("id", unpack(pack("v")).alias("w")).collect()}
        assert back[99] is None
        assert all(np.allclose(back[i], x[i], rtol=tolerance, atol=tolerance) for i in range(50))


def _sparse(spark, n, dims, key, vec):
    rows, dense = [], np.zeros((n, dims))
    for i in range(n):
        at = np.sort(RNG.choice(dims, RNG.integers(1, 9), replace=False))
        vals = RNG.integers(1, 5, len(at)).astype(float)
        dense[i, at] = vals
        rows.append((i, [(int(a), float(x)) for a, x in zip(at, vals)]))
    return spark.createDataFrame(rows, f"{key} bigint, {vec} array<struct<i:bigint,v:float>>"), dense


def test_sparse_search_parts_grid_and_postings(spark, monkeypatch, folder):
    rows, d = _sparse(spark, 300, 60, "id", "vec")
    queries, q = _sparse(spark, 12, 60, "qid", "qvec")
    s = q @ d.T
    ids = np.arange(300)
    want = brute(ids, ids, s, 8, descending=True, keep=lambda x: x > 0)
    assert found(search(rows, queries, 8, metric="IP", vec="vec", pk="id")) == want
    write_postings(rows, f"{folder}/postings", pk="id", vec="vec")
    assert found(search_postings(spark.read.parquet(f"{folder}/postings"), queries, 8, pk="id")) == want
    monkeypatch.setattr(session, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(knn, "GRID_QUERIES", 5)
    monkeypatch.setattr(knn, "GRID_ROWS", 64)
    assert found(search(rows, queries, 8, metric="IP", vec="vec", pk="id")) == want


def test_sparse_queries_are_cut_into_bounded_parts(spark, monkeypatch):
    queries, q = _sparse(spark, 40, 60, "qid", "qvec")
    monkeypatch.setattr(kernel, "CELLS", 200)
    parts = list(kernel.Queries(queries.toArrow(), "qid", "qvec", kernel.Codec("sparse")).parts())
    assert len(parts) > 3 and sum(len(at) for _, at, _ in parts) == 40
    assert all(block.matrix.size <= 200 for block, _, _ in parts)


def test_calc_distance_scan_and_grid(data, monkeypatch):
    df, queries, ids, _, v, q = data
    pairs = lambda: calc_distance(df.where("id < 5"), queries, "L2", left=("id", "vec"), right=("qid", "qvec"))
    once = sorted((r.id, r.qid, round(r.distance, 6)) for r in pairs().collect())
    assert once == sorted((i, j, round(float(scores(v, q, "L2")[j][i]), 6)) for i in range(5) for j in range(7))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(knn, "GRID_QUERIES", 2)
    assert sorted((r.id, r.qid, round(r.distance, 6)) for r in pairs().collect()) == once


def test_hybrid(data):
    df, queries, *_ = data
    branch = lambda metric, k, **o: SubSearch(df, queries, k, metric, {"vec": "vec", **o})
    l2 = {(r.qid, r.id): r["rank"] for r in search(df, queries, 10, metric="L2", vec="vec", pk="id").collect()}
    ip = {(r.qid, r.id): r["rank"] for r in search(df, queries, 5, metric="IP", vec="vec", pk="id").collect()}
    fused = hybrid_search([branch("L2", 10, offset=3), branch("IP", 5)], 20, Rrf(), pk="id").collect()
    assert len(fused) == len(set(l2) | set(ip))
    for r in fused:
        want = sum(1 / (60 + part[(r.qid, r.id)]) for part in (l2, ip) if (r.qid, r.id) in part)
        assert abs(r.score - want) < 1e-12
    page = hybrid_search([branch("L2", 10), branch("IP", 5)], 4, Rrf(), pk="id", offset=4)
    assert found(page) == sorted((r.qid, r["rank"], r.id, round(r.score, 6)) for r in fused if 4 < r["rank"] <= 8)
    with pytest.raises(ValueError):
        hybrid_search([branch("L2", 10)], 5, Weighted([0.5, 0.5]), pk="id")
    with pytest.raises(ValueError):
        hybrid_search([branch("L2", 10)], 5, Weighted([1.5]), pk="id")


def test_bool_and_int_group_keys(spark):
    rows = spark.createDataFrame([(1, True, [0.0, 1.0]), (2, True, [0.0, 2.0]), (3, False, [0.0, 3.0]), (4, None, [0.0, 4.0])],
                                 T.StructType([T.StructField("id", T.LongType()), T.StructField("b", T.BooleanType()),
                                               T.StructField("vec", T.ArrayType(T.FloatType()))]))
    q = spark.createDataFrame([(1, [0.0, 0.0])], "qid int, qvec array<float>")
    hits = search(rows, q, 5, metric="L2", vec="vec", pk="id", group_by="b").orderBy("rank").collect()
    assert [(r.id, r.b) for r in hits] == [(1, True), (3, False), (4, None)]


def test_wanted_ranges_cover_and_prune(spark):
    from vecspark.plans.pruning import is_wanted, wanted_ranges

    assert wanted_ranges([5, 1, 2, 3, 9, 10, 40], 3) == [(1, 5), (9, 10), (40, 40)]
    assert wanted_ranges([1, 2, 3]) == [(1, 3)] and wanted_ranges([7, 9], 1) == [(7, 9)]
    values = [int(x) for x in RNG.integers(0, 10**9, 500)]
    df = spark.range(10).select(F.explode(F.array(*[F.lit(x) for x in values[:200]], F.lit(-1))).alias("dim"))
    assert df.where(is_wanted("dim", values)).count() == 2000 and df.where(is_wanted("dim", [])).count() == 0
