"""Results that must not depend on company, chance or size: coded search, changes, typed reads, exact scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import schema as S
from vecspark.functions import predicates as P
from vecspark.operators import ann
from vecspark.operators.distances import calc_distance
from vecspark.operators.scans import write_scalar_layout
from vecspark.operators.search import search
from vecspark.operators.sparse import search_postings, write_postings
from vecspark.sources.table import VectorTable, last_per_key


def vectors(spark, n=600, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(n, dim)))], "id long, vec array<float>")


@pytest.mark.parametrize("coding", [None, "sq8", "pq"])
def test_queries_asked_together_get_what_they_get_alone(spark, folder, coding):
    rows = vectors(spark)
    extra = dict(m=1, nbits=1) if coding == "pq" else {}
    index = ann.ivf_build(rows, f"{folder}/i", pk="id", vec="vec", nlist=6, coding=coding, **extra)
    queries = rows.where("id < 10").select(F.col("id").alias("qid"), F.col("vec").alias("qvec"))

    def hits(q):
        found = ann.ivf_search(index, q, 10, metric="L2", nprobe=1)
        return {(r["qid"], r["rank"]): r["id"] for r in found.collect()}

    together = hits(queries)
    alone = {}
    for i in (0, 3, 9):
        alone |= hits(queries.where(f"qid = {i}"))
    assert len(together) == 100 and all(together[k] == v for k, v in alone.items()) and len(alone) == 30


def test_scann_refuses_fewer_candidates_than_hits(spark, folder):
    index = ann.ivf_build(vectors(spark, 100), f"{folder}/i", pk="id", vec="vec", nlist=2, coding="pq", m=2, nbits=3)
    queries = vectors(spark, 3).select(F.col("id").alias("qid"), F.col("vec").alias("qvec"))
    with pytest.raises(ValueError):
        ann.scann_search(index, queries, 10, metric="L2", nprobe=1, reorder_k=5)


def test_binary_cells_take_the_metrics_they_can_answer(spark, folder):
    rows = spark.range(60).select("id", F.array(F.xxhash64("id")).alias("bits"))
    index = ann.ivf_build(rows, f"{folder}/i", pk="id", vec="bits", nlist=2)
    queries = rows.select(F.col("id").alias("qid"), F.col("bits").alias("qvec"))
    for metric in ("SUBSTRUCTURE", "SUPERSTRUCTURE", "TANIMOTO"):
        with pytest.raises(ValueError):
            ann.ivf_search(index, queries, 3, metric=metric, nprobe=1)


def test_rows_that_share_a_key_stay_apart_in_postings(spark, folder):
    rows = spark.createDataFrame([(1, [(10, 1.0)], "a"), (1, [(20, 5.0)], "b"), (2, [(10, 2.0)], "a")],
                                 "pk long, vec array<struct<i:long,v:float>>, tag string")
    queries = spark.createDataFrame([(0, [(10, 1.0), (20, 1.0)])], "qid long, qvec array<struct<i:long,v:float>>")
    write_postings(rows, f"{folder}/p", pk="pk", vec="vec", fields=["tag"])
    index = spark.read.parquet(f"{folder}/p")
    exact = search(rows, queries, 5, metric="IP", vec="vec", pk="pk").collect()
    assert [tuple(r) for r in search_postings(index, queries, 5, pk="pk").collect()] == [tuple(r) for r in exact]
    only = search_postings(index, queries, 5, pk="pk", where="tag = 'a'", fields=["tag"]).collect()
    assert sorted((r["pk"], r["score"], r["tag"]) for r in only) == [(1, 1.0, "a"), (2, 2.0, "a")]


def test_distances_are_exact_pair_by_pair(spark):
    rng = np.random.default_rng(2)
    base = (rng.normal(size=(200, 64)) * 1e3).astype(np.float32)
    near = base[0].astype(np.float64).copy()
    near[0] += 0.01
    rows = [(i, v.tolist()) for i, v in enumerate([*base, near.astype(np.float32)])]
    df = spark.createDataFrame(rows, "l long, v array<float>")
    pairs = calc_distance(df, df.withColumnRenamed("l", "r"), "L2", left=("l", "v"), right=("r", "v"))
    got = {(r["l"], r["r"]): r["distance"] for r in pairs.where("l = r OR (l = 0 AND r = 200)").collect()}
    assert all(got[i, i] == 0.0 for i in range(201))
    want = float(((base[0].astype(np.float64) - near.astype(np.float32).astype(np.float64)) ** 2).sum())
    assert got[0, 200] == pytest.approx(want, rel=1e-9)


def small_table(spark, folder, **kw):
    fields = [S.field("id", T.LongType(), pk=True), S.field("name", T.StringType(), max_length=3), S.vector("vec", "dense", 2)]
    return VectorTable.create(spark, f"{folder}/t", S.table_schema(fields, **kw))


@pytest.mark.parametrize("row", [(1, "abc", [1.0]), (1, "abcdefg", [1.0, 2.0]), (None, "a", [1.0, 2.0]), (1, "a", None)])
def test_upsert_refuses_broken_rows(spark, folder, row):
    table = small_table(spark, folder)
    kind = "id long, name string, vec array<float>"
    table.upsert(spark.createDataFrame([(7, "ok", [0.0, 0.0])], kind))
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([row, (8, "b", [1.0, 1.0])], kind))
    assert [r["id"] for r in table.read().collect()] == [7]


def test_last_row_of_equal_sequence_numbers_is_always_the_same(spark):
    rows = [(1, 5, f"v{i}") for i in range(50)]
    seen = {last_per_key(spark.createDataFrame(part, "k long, s long, v string").repartition(n), "k", ["k", "s", "v"], "s").first()["v"]
            for part, n in ((rows, 1), (rows[::-1], 7), (rows[25:] + rows[:25], 3))}
    assert len(seen) == 1


def test_dynamic_reads_cut_fractions_and_take_any_key(spark):
    meta = """{"a": 1.5, "b": -1.5, "c": 9007199254740993, "d": "x", "it's": 4, "say \\\\"hi\\\\" it's": 6}"""
    df = spark.range(1).select(F.parse_json(F.lit(meta.replace("\\\\", "\\"))).alias("$meta"))

    def read(key, kind="int"):
        return df.select(P.dynamic_typed(df, key, kind).alias("x")).first()["x"]

    assert [read("a"), read("b"), read("c"), read("d"), read("it's"), read('say "hi" it\'s')] == [1, -1, 9007199254740993, None, 4, 6]
    assert read("a", "double") == 1.5 and read('say "hi" it\'s', "double") == 6.0


def test_a_frequent_value_spreads_over_files(spark, folder):
    rows = spark.range(20000).select("id", F.when(F.col("id") < 18000, 1).otherwise(F.col("id")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_scalar_layout(rows, f"{folder}/s", "v")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = spark.read.parquet(f"{folder}/s").groupBy(F.input_file_name()).count().toPandas()["count"]
    assert sizes.max() < 8000


def test_compaction_leaves_settled_partitions_alone(spark, folder):
    table = small_table(spark, folder)
    kind = "id long, name string, vec array<float>"
    for i in range(3):
        table.upsert(spark.createDataFrame([(i, "a", [0.0, 1.0]), (9, str(i), [1.0, 1.0])], kind))
    table.compact()
    settled = table.entries()
    table.compact()
    assert table.entries() == settled
    table.upsert(spark.createDataFrame([(1, "new", [2.0, 2.0])], kind))
    table.compact()
    assert sorted((r["id"], r["name"]) for r in table.read().collect()) == [(0, "a"), (1, "new"), (2, "a"), (9, "2")]
