import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark import session
from vecspark.functions import packing
from vecspark.operators import ann
from vecspark.operators.search import search
from vecspark.plans import kernel, knn
from vecspark.plans.kernel import QueryBlock, Tables


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(12)
    middle = rng.normal(size=(12, 16))
    vectors = (middle[rng.integers(12, size=900)] + rng.normal(size=(900, 16)) * 0.6).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), i % 4) for i, v in enumerate(vectors)], "id long, vec array<float>, n int").repartition(5)
    asked = spark.createDataFrame([(i, (vectors[i * 7] + 0.05).tolist()) for i in range(100)], "qid long, qvec array<float>")
    return rows, asked


def lists(hits):
    return sorted((r["qid"], r["rank"], r["id"], round(r["score"], 6)) for r in hits.collect())


@pytest.mark.parametrize("coding", [None, "sq8", "pq"])
def test_a_build_reads_the_vectors_twice(data, spark, folder, coding):
    rows, read = data[0], spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    index = ann.ivf_build(rows.mapInArrow(counted, rows.schema), f"{folder}/i", pk="id", vec="vec", nlist=8, coding=coding, m=4, nbits=4)
    assert read.value == 2 * 900 and index.rows().count() == 900
    assert index.rows().select("cell").distinct().count() > 4


@pytest.mark.parametrize("pack", [packing.pack_fp16, packing.pack_bf16])
def test_half_precision_cells_are_exact_when_all_are_probed(data, spark, folder, pack):
    rows, asked = data
    encoding = "fp16" if pack is packing.pack_fp16 else "bf16"
    half = rows.select("id", "n", pack("vec").alias("half", metadata={"encoding": encoding}))
    index = ann.ivf_build(half, f"{folder}/i", pk="id", vec="half", nlist=8, fields=["n"])
    assert index.kind == encoding
    for own in ({}, {"where": "n > 1"}):
        got = lists(ann.ivf_search(ann.ivf_load(spark, f"{folder}/i"), asked, 10, metric="L2", nprobe=8, **own))
        assert len(got) == 1000 and got == lists(search(half, asked, 10, metric="L2", vec="half", pk="id", **own))


def test_sample_is_bounded_and_the_same_for_any_partitioning(data, monkeypatch):
    rows = data[0]
    monkeypatch.setattr(ann, "SURVEY_ROWS", 40)
    seen = ann.survey(rows, "id", "vec", "dense", 30)
    again = ann.survey(rows.repartition(1), "id", "vec", "dense", 30)
    one, two = ({r.h for r in s.sample.collect()} for s in (seen, again))
    assert seen.rows == again.rows == 900 and 10 <= len(one) <= 200 and 10 <= len(two) <= 60
    low = min(max(one), max(two))  # both draws are all rows up to some hash
    assert {h for h in one if h <= low} == {h for h in two if h <= low}
    block = np.array([r.vec for r in rows.collect()])
    assert np.allclose(seen.lo, block.min(axis=0)) and np.allclose(seen.hi, block.max(axis=0))


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_lookup_tables_score_like_the_vectors_of_the_codes(metric):
    rng = np.random.default_rng(3)
    books, codes, q = rng.normal(size=(4, 16, 3)), rng.integers(0, 16, (50, 4)).astype(np.uint32), rng.normal(size=(7, 12))
    whole = np.concatenate([books[s][codes[:, s]] for s in range(4)], axis=1)
    got = Tables(books, QueryBlock(q), metric).scores(codes)
    want = kernel.block_scores(whole, (whole ** 2).sum(axis=1), QueryBlock(q), metric)
    assert got.shape == (7, 50) and np.allclose(got, want)
    assert (Tables(books, QueryBlock(q), metric).scores(codes[[5, 5]])[:, 0] == got[:, 5]).all()  # equal codes score alike


def test_product_codes_reach_the_exact_lists_after_reranking(data, spark, folder):
    rows, asked = data
    index = ann.ivf_build(rows, f"{folder}/i", pk="id", vec="vec", nlist=8, coding="pq", m=4, nbits=6, fields=["n"])
    hits = ann.scann_search(index, asked, 10, metric="L2", nprobe=8, reorder_k=80)
    exact = search(rows, asked, 10, metric="L2", vec="vec", pk="id")
    assert ann.recall(hits, exact, pk="id").agg(F.avg("recall")).first()[0] >= 0.9
    plan = hits._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange" in line and "Broadcast" not in line]
    assert "SortMergeJoin" not in plan
    assert moved and not any("vec#" in line for line in moved)


def test_blocks_of_codes_hold_all_cells(data, folder, monkeypatch):
    rows, asked = data
    index = ann.ivf_build(rows, f"{folder}/i", pk="id", vec="vec", nlist=8, coding="pq", m=4, nbits=6)
    want = lists(ann.ivf_search(index, asked, 20, metric="L2", nprobe=8))
    monkeypatch.setattr(knn, "fetch_bounded", lambda *args: None)  # as with a large query set
    met, rank = [], knn.rank_best
    monkeypatch.setattr(knn, "rank_best", lambda found, **kw: met.append(found.count()) or rank(found, **kw))
    assert lists(ann.ivf_search(index, asked, 20, metric="L2", nprobe=8)) == want and len(want) == 2000
    assert met == [2000]  # a list of every query, not of every query and cell


@pytest.mark.parametrize("metric, ends", [("L2", {}), ("IP", {}), ("COSINE", {}), ("L2", {"radius": 9.0, "range_filter": 2.0})])
def test_candidates_too_many_to_be_broadcast_are_met_in_blocks(spark, monkeypatch, metric, ends):
    rng = np.random.default_rng(5)
    vectors = np.rint(rng.normal(size=(60, 4))).astype(np.float32)  # many equal scores, some zero vectors
    key = lambda i: None if i % 20 == 19 else f"k{i % 50}"
    rows = spark.createDataFrame([(key(i), i % 3, i, None if i == 7 else v.tolist()) for i, v in enumerate(vectors)], "id string, cell int, n int, vec array<float>")
    asked = spark.createDataFrame([(None if i == 3 else i % 30, (vectors[i] + 0.5).tolist()) for i in range(33)], "qid long, qvec array<float>")
    pairs = spark.createDataFrame([(q, key(i), i % 3) for q in range(30) for i in range(q % 2, 60, 2)], "qid long, id string, cell int").distinct()
    got = lambda df: sorted(tuple(r) for r in df.withColumn("score", F.round("score", 9)).collect())
    for cells in (pairs, pairs.drop("cell").distinct()):
        call = lambda: ann.rerank(cells, rows, asked, 6, metric=metric, pk="id", vec="vec", offset=2, **ends)
        want = got(call())
        with monkeypatch.context() as m:
            m.setattr(session, "BROADCAST_BYTES", 1 << 10)
            m.setattr(knn, "GRID_ROWS", 25)
            m.setattr(knn, "STATE_ROWS", 400)
            blocks = call()
            assert got(blocks) == want and len(want) > 20
            plan = blocks._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan
        joined = plan[plan.index("SortMergeJoin"):].split("\n")[0] if "SortMergeJoin" in plan else ""
        assert "id#" not in joined.replace("qid#", "")  # keys of pairs meet vectors inside the blocks only


def test_recall_estimate_covers_the_exact_value(data, folder):
    rows, asked = data
    index = ann.ivf_build(rows, f"{folder}/i", pk="id", vec="vec", nlist=12)
    hits = ann.ivf_search(index, asked, 10, metric="L2", nprobe=1)
    exact = ann.recall(hits, search(rows, asked, 10, metric="L2", vec="vec", pk="id"), pk="id").agg(F.avg("recall")).first()[0]
    found = ann.recall_estimate(hits, rows, asked, 10, metric="L2", vec="vec", pk="id", one_in=3).first()
    assert found.asked == 100 and 15 <= found.sampled <= 55 and 0 < found.low < found.high <= 1
    assert found.low <= exact <= found.high and exact < 1
    all_of_them = ann.recall_estimate(hits, rows, asked, 10, metric="L2", vec="vec", pk="id", one_in=1).first()
    assert all_of_them.sampled == 100 and abs(all_of_them.recall - exact) < 1e-12 and all_of_them.high - all_of_them.low < 1e-9
    none = ann.recall_estimate(hits, rows, asked.where("false"), 10, metric="L2", vec="vec", pk="id").first()
    assert tuple(none) == (0, 0, None, 0.0, 1.0)
