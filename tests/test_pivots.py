import numpy as np
import pytest

from vecspark import session
from vecspark.operators.search import search
from vecspark.plans import knn, pivots

ROWS = "id long, vec array<float>, label int"
ASKED = "qid long, qvec array<float>"


def clustered(seed, n, dims=8, centres=15, spread=0.02):
    rng = np.random.default_rng(seed)
    middle = np.random.default_rng(0).normal(size=(centres, dims))
    return (middle[rng.integers(centres, size=n)] + rng.normal(size=(n, dims)) * spread).astype(np.float32)


def tables(spark, n_rows=3000, n_queries=400, extra=()):
    rows = [(i, v.tolist(), i % 7) for i, v in enumerate(clustered(1, n_rows))] + list(extra)
    asked = [(i, v.tolist()) for i, v in enumerate(clustered(2, n_queries))]
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame(asked, ASKED)


def lists(hits):
    return sorted((r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in hits.collect())


@pytest.fixture()
def lowered(monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(pivots, "CELL_QUERIES", 16)


@pytest.fixture()
def no_grid(monkeypatch):
    def refuse(*args, **kw):
        raise AssertionError("the grid was taken")

    monkeypatch.setattr(knn, "grid_candidates", refuse)


KINDS = [dict(metric="L2"), dict(metric="COSINE"), dict(metric="IP"), dict(metric="L2", group_by="label"), dict(metric="L2", offset=5),
         dict(metric="L2", radius=0.01, range_filter=0.002), dict(metric="COSINE", radius=0.999), dict(metric="IP", radius=8.0, range_filter=20.0),
         dict(metric="L2", where="id % 3 = 1", fields=["label"])]


@pytest.mark.parametrize("kind", KINDS, ids=lambda k: "-".join(map(str, k.values())))
def test_cells_give_the_answer_of_the_scan(spark, monkeypatch, kind):
    odd = [(10_000, [0.0] * 8, 1), (10_001, None, 2), (10_002, [0.5] * 8, 3)] + [(11_000 + i, clustered(1, 1)[0].tolist(), 4) for i in range(50)]
    rows, asked = tables(spark, n_rows=1200, n_queries=150, extra=odd)
    asked = asked.union(spark.createDataFrame([(900, [0.0] * 8), (901, None), (902, [30.0] * 8)], ASKED))
    want = lists(search(rows, asked, 6, vec="vec", pk="id", **kind))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(pivots, "CELL_QUERIES", 16)
    monkeypatch.setattr(pivots, "copies_per_row", lambda *args: 0.0)  # cells, however far they reach
    monkeypatch.setattr(knn, "GRID_QUERIES", 10)
    assert want and lists(search(rows, asked, 6, vec="vec", pk="id", **kind)) == want


def test_clustered_vectors_take_cells_and_scattered_ones_the_grid(spark, lowered, monkeypatch):
    taken = []
    grid = knn.grid_candidates
    monkeypatch.setattr(knn, "grid_candidates", lambda *a, **kw: taken.append(1) or grid(*a, **kw))
    monkeypatch.setattr(knn, "GRID_QUERIES", 32)
    rows, asked = tables(spark)
    found = lists(search(rows, asked, 5, metric="L2", vec="vec", pk="id"))
    assert not taken and len(found) == 400 * 5
    rng = np.random.default_rng(5)
    loose = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(500, 64)))], ROWS)
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 64)))], ASKED)
    assert search(loose, asked, 5, metric="L2", vec="vec", pk="id").count() == 1000 and taken


def test_copies_of_a_row_stay_nearly_flat_while_queries_grow_tenfold(spark, lowered, no_grid, monkeypatch):
    monkeypatch.setattr(knn, "GRID_QUERIES", 64)
    sent, route = [], pivots.route

    def counted(*args):
        out = session.materialize(route(*args))
        sent.append(out.count())
        return out

    monkeypatch.setattr(pivots, "route", counted)
    rng, grid_copies = np.random.default_rng(4), []
    plane = [(i, v.tolist(), 0) for i, v in enumerate(rng.random((4000, 2)))]
    for n in (300, 3000):
        rows = spark.createDataFrame(plane, ROWS)
        asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.random((n, 2)))], ASKED)
        assert search(rows, asked, 3, metric="L2", vec="vec", pk="id").count() == 3 * n
        grid_copies.append(4000 * -(-n // 64))
    assert sent[1] < 2 * sent[0], sent
    assert sent[1] < grid_copies[1] / 10, sent  # the grid sends 9.4 times as many


def test_lone_queries_and_few_rows(spark, lowered, monkeypatch):
    monkeypatch.setattr(pivots, "copies_per_row", lambda *args: 0.0)
    rows = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)], ROWS)
    asked = spark.createDataFrame([(7, [1.0, 0.1])] * 1 + [(8, [0.0, 0.0])] + [(9, [1.0, 0.1])], ASKED)
    assert [x[:3] for x in lists(search(rows, asked, 5, metric="L2", vec="vec", pk="id"))] == [
        (7, 1, 1), (7, 2, 2), (8, 1, 1), (8, 2, 2), (9, 1, 1), (9, 2, 2)]
    zeros = spark.createDataFrame([(7, [0.0, 0.0]), (8, [0.0, 0.0])], ASKED)
    assert search(rows, zeros, 5, metric="COSINE", vec="vec", pk="id").count() == 0
