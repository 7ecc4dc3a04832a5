import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.operators import hybrid
from vecspark.operators.ann import ivf_build
from vecspark.operators.hybrid import BlockIndex, Rrf, SubSearch, Weighted, hybrid_search
from vecspark.operators.sparse import write_blocks
from vecspark.plans import knn

SPARSE = "array<struct<i:bigint,v:double>>"


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    words = [[(int(d), float(v)) for d, v in zip(np.unique(rng.integers(0, 60, 8)), rng.integers(1, 6, 8))] for _ in range(400)]
    rows = [(i, rng.normal(size=8).tolist(), rng.integers(0, 1 << 60, 1).tolist(), words[i], i % 5) for i in range(400)]
    rows += [(7, rows[9][1], rows[9][2], words[9], 1), (500, None, None, None, 2)]
    rows = spark.createDataFrame(rows, f"id long, vec array<double>, bits array<long>, terms {SPARSE}, n int").repartition(4)
    asked = {kind: spark.createDataFrame([(q, v) for q, v in enumerate(values)], f"qid int, qvec {shape}") for kind, shape, values in [
        ("vec", "array<double>", [rng.normal(size=8).tolist() for _ in range(6)]),
        ("bits", "array<long>", [rng.integers(0, 1 << 60, 1).tolist() for _ in range(6)]),
        ("terms", SPARSE, words[20:26])]}
    return rows, asked


def fused(branches, reranker, limit=15, **kw):
    return sorted((r["qid"], r["rank"], r["id"], round(r["score"], 12)) for r in hybrid_search(branches, limit, reranker, pk="id", **kw).collect())


def of(data, kind, k, metric, **options):
    return SubSearch(data[0], data[1][kind], k, metric, {"vec": kind, **options})


@pytest.mark.parametrize("reranker", [Rrf(), Weighted([0.5, 0.3, 0.9, 0.1])])
@pytest.mark.parametrize("where", [None, "n < 3"])
def test_branches_over_the_same_rows_share_one_scan(data, monkeypatch, reranker, where):
    own = {} if where is None else {"where": where}
    branches = [of(data, "vec", 12, "L2", radius=14.0, range_filter=1.0, **own), of(data, "bits", 9, "HAMMING", offset=4, **own),
                of(data, "terms", 30, "IP", **own), of(data, "vec", 5, "COSINE", **own)]
    got = fused(branches, reranker, offset=2)
    plan = hybrid_search(branches, 15, reranker, pk="id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    monkeypatch.setattr(hybrid, "one_pass", lambda *args: None)
    assert got and got == fused(branches, reranker, offset=2)
    plan = hybrid_search(branches, 15, reranker, pk="id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 4


def test_other_rows_filters_and_large_query_sets_scan_on_their_own(data, monkeypatch):
    mixed = [of(data, "vec", 12, "L2"), of(data, "bits", 9, "HAMMING", where="n = 1"), of(data, "vec", 9, "IP"),
             SubSearch(data[0].where("n > 0"), data[1]["vec"], 4, "L2", {"vec": "vec"})]
    got = fused(mixed, Rrf())
    plan = hybrid_search(mixed, 15, Rrf(), pk="id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 3
    fetch = knn.fetch_bounded
    monkeypatch.setattr(knn, "fetch_bounded", lambda queries, qid, qvec, kind="dense", k=1: None if k > 12 else fetch(queries, qid, qvec, kind, k))
    assert got == fused(mixed, Rrf())


def test_indexed_branches_give_the_list_of_the_scans(data, folder):
    rows, asked = data
    spark = rows.sparkSession
    index = ivf_build(rows, f"{folder}/cells", pk="id", vec="vec", nlist=5, fields=["n"])
    write_blocks(rows, f"{folder}/blocks", pk="id", vec="terms")
    scans = [of(data, "vec", 12, "L2", where="n <> 4"), of(data, "terms", 20, "IP"), of(data, "bits", 9, "HAMMING")]
    branches = [SubSearch(index, asked["vec"], 12, "L2", {"nprobe": 5, "where": "n <> 4"}),
                SubSearch(BlockIndex(spark.read.parquet(f"{folder}/blocks")), asked["terms"], 20, "IP", {"offset": 3}), scans[2]]
    for reranker in (Rrf(), Weighted([0.2, 1.0, 0.4])):
        assert fused(branches, reranker) == fused(scans, reranker)
    with pytest.raises(ValueError, match="inner products"):
        fused([SubSearch(branches[1].rows, asked["terms"], 20, "L2")], Rrf())


def test_fields_of_the_winners(data):
    out = hybrid_search([of(data, "vec", 5, "L2"), of(data, "bits", 5, "HAMMING")], 3, Rrf(), pk="id", rows=data[0].where(F.col("id") != 7), fields=["n"])
    assert out.columns == ["qid", "rank", "id", "score", "n"] and out.count() > 10
