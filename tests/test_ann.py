import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark import session
from vecspark.operators import ann
from vecspark.operators.search import search
from vecspark.plans import knn
from vecspark.streaming import streams
from vecspark.sources.table import VectorTable
from vecspark import schema as S
from pyspark.sql import types as T

RNG = np.random.default_rng(3)


@pytest.fixture(scope="module")
def data(spark):
    """Clustered points; a third of the rows are copies of one vector, so one cell is crowded."""
    centers = RNG.normal(size=(12, 16)) * 4
    v = (centers[RNG.integers(0, 12, 1500)] + RNG.normal(size=(1500, 16))).astype(np.float32)
    v[::3] = v[0]
    rows = spark.createDataFrame([(i, x.tolist(), i % 4) for i, x in enumerate(v)], "id bigint, vec array<float>, tag bigint").cache()
    q = spark.createDataFrame([(i, (v[i] + 0.1).tolist()) for i in range(1, 25)], "qid int, qvec array<float>").cache()
    return rows, q


@pytest.fixture(scope="module")
def index(spark, data):
    return ann.ivf_build(data[0], session.scratch_path(spark, "ivf"), pk="id", vec="vec", nlist=12, fields=["tag"])


def listed(df):
    return sorted((r.qid, r["rank"], r.id, round(r.score, 6)) for r in df.collect())


def mean_recall(near, exact):
    return ann.recall(near, exact, pk="id").agg(F.avg("recall")).first()[0]


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_all_cells_give_the_exact_answer(data, index, metric):
    rows, q = data
    exact = search(rows, q, 10, metric=metric, vec="vec", pk="id", where="tag <> 2")
    assert listed(ann.ivf_search(index, q, 10, metric=metric, nprobe=12, where="tag <> 2")) == listed(exact)


def test_few_cells_keep_recall_and_read_only_their_rows(data, index):
    rows, q = data
    near = ann.ivf_search(index, q.limit(1), 10, metric="L2", nprobe=1)
    assert "cell" in near._jdf.queryExecution().toString()
    exact = search(rows, q, 10, metric="L2", vec="vec", pk="id")
    assert mean_recall(ann.ivf_search(index, q, 10, metric="L2", nprobe=4), exact) > 0.9


def test_large_query_sets_take_the_grid(data, index, monkeypatch):
    rows, q = data
    want = {n: listed(ann.ivf_search(index, q, 10, metric="L2", nprobe=n)) for n in (2, 12)}
    monkeypatch.setattr(session, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(knn, "GRID_QUERIES", 7)
    monkeypatch.setattr(knn, "GRID_ROWS", 100)
    for n, expected in want.items():
        assert listed(ann.ivf_search(index, q, 10, metric="L2", nprobe=n)) == expected


def test_saved_index_reads_back(spark, data):
    rows, q = data
    for coding in (None, "sq8", "pq"):
        built = ann.ivf_build(rows, session.scratch_path(spark, "ivf"), pk="id", vec="vec", nlist=6, coding=coding, m=8, nbits=6)
        loaded = ann.ivf_load(spark, built.path)
        assert listed(ann.ivf_search(built, q, 5, metric="L2", nprobe=3)) == listed(ann.ivf_search(loaded, q, 5, metric="L2", nprobe=3))
        assert ann.index_progress(loaded, rows).first().asDict() == {"total_rows": 1500, "indexed_rows": 1500}


def test_codes_and_rerank(spark, data):
    rows, q = data
    exact = search(rows.where("id % 3 <> 0"), q, 10, metric="L2", vec="vec", pk="id")
    some = rows.where("id % 3 <> 0")
    sq8 = ann.ivf_build(some, session.scratch_path(spark, "ivf"), pk="id", vec="vec", nlist=6, coding="sq8")
    assert mean_recall(ann.ivf_search(sq8, q, 10, metric="L2", nprobe=6), exact) > 0.9
    pq = ann.ivf_build(some, session.scratch_path(spark, "ivf"), pk="id", vec="vec", nlist=6, coding="pq", m=8, nbits=6, keep_raw=False)
    rough = mean_recall(ann.ivf_search(pq, q, 10, metric="L2", nprobe=6), exact)
    fine = ann.scann_search(pq, q, 10, metric="L2", nprobe=6, reorder_k=1000, raw=some)
    assert rough > 0.5 and listed(fine) == listed(exact)


@pytest.mark.parametrize("name,call,weak", [("ivf_search_probed", "ivf_search", {"nprobe": 4}), ("scann_filtered", "scann_search", {"reorder_k": 10}),
                                            ("scann_rerank", "scann_search", {"reorder_k": 30})])
def test_judged_queries_fail_with_a_low_recall(spark, monkeypatch, name, call, weak):
    from workload import ann as registered
    from workload.registry import QUERIES

    whole = getattr(ann, call)
    coarse = registered.build
    monkeypatch.setattr(registered, "build", lambda spark, sf, coding=None, **kw: coarse(spark, sf, coding, **{**kw, **({"m": 8, "nbits": 4} if coding else {})}))
    monkeypatch.setattr(ann, call, lambda *a, **kw: whole(*a, **{**kw, **weak}))
    got = QUERIES[name](spark, "/root/testdata/sf0.01").select("good_recall").distinct().collect()
    assert [r[0] for r in got] == [False]


def test_refused_parameters(spark, data, index):
    rows, q = data
    build = lambda **kw: ann.ivf_build(rows, session.scratch_path(spark, "ivf"), pk="id", vec="vec", **{"nlist": 4, **kw})
    for call in (lambda: build(nlist=0), lambda: build(nlist=65537), lambda: build(coding="pq", m=5), lambda: build(coding="pq", nbits=17),
                 lambda: build(coding="zip"), lambda: ann.ivf_search(index, q, 10, metric="L2", nprobe=0),
                 lambda: ann.ivf_search(index, q, 10, metric="HAMMING", nprobe=1),
                 lambda: ann.scann_search(index, q, 10, metric="L2", nprobe=1, reorder_k=0)):
        with pytest.raises(ValueError):
            call()


def test_late_changes_are_ignored(spark, folder):
    schema = S.table_schema([S.field("id", T.LongType(), pk=True), S.field("ts", T.LongType()), S.field("n", T.LongType()),
                             S.field("deleted", T.BooleanType()), S.vector("vec", "dense", 2)])
    t = VectorTable.create(spark, f"{folder}/t", schema)
    log = lambda *rows: spark.createDataFrame([(*r, [0.0, 1.0]) for r in rows], "id bigint, ts bigint, n bigint, op string, vec array<float>")
    change = lambda *rows: streams.apply_changes(t, log(*rows), ts="ts", op="op", delete="d")
    change((1, 10, 1, "u"), (1, 12, 2, "u"), (2, 10, 1, "u"), (3, 5, 1, "d"))
    change((1, 11, 9, "u"), (2, 20, 0, "d"), (3, 4, 9, "u"))
    change((2, 15, 9, "u"), (4, 1, 4, "u"))
    assert sorted((r.id, r.n) for r in streams.current_rows(t).collect()) == [(1, 2), (4, 4)]


def test_few_blocks_are_dealt_evenly(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n in (1, 3, 5 * parts + 1):
        keys = spark.range(n).select(knn.dealt_evenly(spark, F.col("id"), n).alias("key")).distinct()
        at = [r[0] for r in keys.select(F.expr(f"pmod(hash(key), {parts})")).collect()]
        assert len(at) == n and max(at.count(p) for p in range(parts)) == -(-n // parts)


def test_query_blocks_grow_with_the_queries(spark, monkeypatch):
    monkeypatch.setattr(knn, "GRID_QUERIES", 10)
    rows = spark.range(6000).selectExpr("id", "array(float(id % 7), float(id % 11)) AS vec")
    queries = rows.selectExpr("id AS qid", "vec AS qvec")
    most = knn.GRID_ROUNDS * spark.sparkContext.defaultParallelism
    copies = lambda **kw: knn.grid(rows, queries, vec="vec", qvec="qvec", k=10, **kw)[0].count() / 6000
    assert copies(grow=True) <= most < copies() == 600
    monkeypatch.setattr(knn, "STATE_ROWS", 4000)  # best lists of a task stay bounded
    assert copies(grow=True) == 60
