import numpy as np
import pyarrow as pa
import pytest

from vecspark.functions import packing
from vecspark.operators.search import search
from vecspark.operators.sparse import search_blocks, write_blocks
from vecspark.plans import blocks, knn

SPARSE = "array<struct<i:bigint,v:double>>"


def vectors(seed, n, dims=400, most=12, negative=False):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        where = np.unique(rng.zipf(1.3, rng.integers(0, most)) % dims)
        value = rng.integers(1, 9, len(where)) / 4 * (rng.choice([-1, 1], len(where)) if negative else 1)
        out.append([(int(d), float(v)) for d, v in zip(where, value)])
    return out


@pytest.fixture(params=[False, True], ids=["positive", "signed"])
def tables(spark, request):
    rows = [(f"k{i:05d}", v, f"g{i % 9}", i) for i, v in enumerate(vectors(1, 900, negative=request.param))]
    rows += [("none", None, "g1", -1), ("empty", [], "g1", -2)] + [(f"same{i}", rows[5][1], "g2", i) for i in range(30)]
    rows += [("k00003", vectors(9, 1)[0], "g3", 77)]  # a key that two rows share
    asked = [(i, v) for i, v in enumerate(vectors(2, 25, most=6, negative=request.param))] + [(100, []), (101, None)]
    return (spark.createDataFrame(rows, f"id string, vec {SPARSE}, shop string, n int").repartition(5),
            spark.createDataFrame(asked, f"qid int, qvec {SPARSE}"))


def lists(hits):
    return sorted(tuple(r[c] for c in sorted(hits.columns)) for r in hits.collect())


CASES = [dict(k=7), dict(k=5, offset=4), dict(k=4, group_by="shop"), dict(k=9, radius=1.0, range_filter=4.0), dict(k=9, radius=2.0),
         dict(k=6, fields=["n", "shop"]), dict(k=6, where="n % 2 = 0", fields=["n"]), dict(k=2000)]


@pytest.mark.parametrize("case", CASES, ids=str)
def test_blocks_give_the_answer_of_the_scan(tables, folder, monkeypatch, case):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 16)
    rows, asked = tables
    case = dict(case)
    k = case.pop("k")
    want = lists(search(rows, asked, k, metric="IP", vec="vec", pk="id", **case))
    write_blocks(rows, f"{folder}/i", pk="id", vec="vec", fields=["shop", "n"])
    index = rows.sparkSession.read.parquet(f"{folder}/i")
    assert want and lists(search_blocks(index, asked, k, pk="id", **case)) == want


def test_large_query_sets_take_the_unpacked_rows(tables, folder, monkeypatch):
    rows, asked = tables
    want = lists(search(rows, asked, 5, metric="IP", vec="vec", pk="id"))
    write_blocks(rows, f"{folder}/i", pk="id", vec="vec")
    monkeypatch.setattr(knn, "fetch_bounded", lambda *args, **kw: None)
    assert lists(search_blocks(rows.sparkSession.read.parquet(f"{folder}/i"), asked, 5, pk="id")) == want


def test_blocks_that_cannot_reach_the_list_are_skipped_unscored(spark, folder, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(3)
    rows = [(i, [(1, float(rng.integers(1, 10) + (1000 if i // 32 == 20 else 0))), (2, 1.0)]) for i in range(3200)]
    rows = spark.createDataFrame(rows, f"id long, vec {SPARSE}").coalesce(1)
    asked = spark.createDataFrame([(1, [(1, 1.0)]), (2, [(1, 2.0), (2, 1.0)]), (3, [(77, 1.0)])], f"qid int, qvec {SPARSE}")
    write_blocks(rows, f"{folder}/i", pk="id", vec="vec")
    index = spark.read.parquet(f"{folder}/i")
    assert index.count() == 100 and index.select("block").distinct().count() == 100
    skipped, scored = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    hits = search_blocks(index, asked, 10, pk="id", skipped=skipped)
    assert lists(hits) == lists(search(rows, asked, 10, metric="IP", vec="vec", pk="id"))
    assert skipped.value == 2 * 99 and not scored.value  # one of the 100 blocks is worth scoring, for either query


def test_an_empty_index(spark, folder):
    write_blocks(spark.createDataFrame([], f"id long, vec {SPARSE}"), f"{folder}/i", pk="id", vec="vec")
    asked = spark.createDataFrame([(1, [(1, 1.0)])], f"qid int, qvec {SPARSE}")
    assert search_blocks(spark.read.schema("rows array<struct<id:long>>, " + blocks.ENTRY_TYPES).parquet(f"{folder}/i"), asked, 3, pk="id").count() == 0


def test_blocks_and_their_files_are_bounded(spark, folder, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ENTRIES", 40)
    rows = [(i, [(d, 1.0 + (i * d) % 7) for d in range(100 if i % 50 == 0 else 9)]) for i in range(600)] + [(1000, []), (1001, None)]
    rows = spark.createDataFrame(rows, f"id long, vec {SPARSE}").coalesce(1)
    asked = spark.createDataFrame([(1, [(3, 1.0)]), (2, [(5, 2.0), (8, 1.0)]), (3, [(99, 1.0)])], f"qid int, qvec {SPARSE}")
    write_blocks(rows, f"{folder}/i", pk="id", vec="vec")
    index = spark.read.parquet(f"{folder}/i")
    sizes = index.selectExpr("size(at) AS n", "size(rows) AS r", "input_file_name() AS f").collect()
    assert all(x.n <= 40 or x.r == 1 for x in sizes) and sum(x.n for x in sizes) == 12 * 100 + 588 * 9
    held = [sum(x.f == f for x in sizes) for f in {x.f for x in sizes}]
    assert len(held) > 1 and max(held) <= blocks.FILE_BLOCKS
    assert index.select("block").distinct().count() == len(sizes)
    assert lists(search_blocks(index, asked, 10, pk="id")) == lists(search(rows, asked, 10, metric="IP", vec="vec", pk="id"))


def test_terms_and_entries_are_taken_in_groups(monkeypatch):
    texts = pa.array(["a b a", None, "", "x" * 90 + " a", "b b c", "c"] * 3)
    whole = packing.term_vector.func(texts)
    seen, counted = [], packing._counted_terms
    monkeypatch.setattr(packing, "GROUP_BYTES", 10)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 1)
    monkeypatch.setattr(packing, "_counted_terms", lambda t, known: seen.append(sum(len(x or "") for x in t.to_pylist())) or counted(t, known))
    assert packing.term_vector.func(texts).equals(whole) and packing.term_vector.func(texts[:0]).equals(whole[:0])
    assert max(x for x in seen if x < 90) <= 10 and len(seen) > 6
