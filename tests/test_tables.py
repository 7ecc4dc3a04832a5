import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import schema as S
from vecspark.operators import export, scans
from vecspark.sources import ingest
from vecspark.sources.table import VectorTable

L, STR = T.LongType(), T.StringType()


def point_schema(dynamic=False, **flags):
    return S.table_schema([S.field("id", L, pk=True), S.field("n", L, **flags), S.vector("vec", "dense", 2)], dynamic)


def points(spark, start, end, n=None):
    value = F.col("id") if n is None else F.lit(n).cast("bigint")
    return spark.range(start, end).select("id", value.alias("n"), F.array(F.lit(0.5), F.lit(1.5)).cast("array<float>").alias("vec"))


def make(spark, folder, schema=None, **kw):
    return VectorTable.create(spark, f"{folder}/t", schema or point_schema(), **kw)


def test_count_chain(spark, folder):
    t = make(spark, folder)
    counts = []
    for step in (lambda: t.insert(points(spark, 0, 3000)), lambda: t.insert(points(spark, 3000, 4000)),
                 lambda: t.delete_by_filter("id < 1000"), lambda: t.insert(points(spark, 0, 100)),
                 lambda: t.upsert(points(spark, 0, 100, n=-1)), t.compact):
        step()
        counts.append(t.row_count().first()[0])
    assert counts == [3000, 4000, 3000, 3100, 3100, 3100]
    assert t.read().where("n = -1").count() == 100
    assert sum(1 for e in t.entries() if e.seg) == 1
    assert t.read(version=1).count() == 3000  # older versions stay readable


def test_changes_leave_other_folders_alone(spark, folder):
    t = make(spark, folder)
    t.insert(points(spark, 0, 100))
    t.insert(points(spark, 100, 200))
    first, second = [e.seg for e in t.entries() if e.seg]
    t.upsert(points(spark, 150, 160, n=-1))
    replaced = {e.seg: list(e.replaced) for e in t.entries()}
    assert replaced[first] == [] and replaced[second]
    assert t.read().count() == 200
    untouched = t.versions()
    t.delete_by_pk(spark.range(5000, 5010).toDF("id"))  # no match: no new version
    assert t.versions() == untouched


def test_changes_rewrite_only_touched_files(spark, folder):
    t = make(spark, folder)
    t.insert(points(spark, 0, 1000).repartitionByRange(10, "id"), sealed=True)
    files = lambda: {r.file for r in t.file_stats().collect()}
    before = files()
    t.upsert(points(spark, 150, 160, n=-1))
    t.delete_by_filter("id BETWEEN 320 AND 330")
    after = files()
    assert len(before) == 10 and len(before & after) == 8
    assert t.read().count() == 989 and t.read().where("n = -1").count() == 10
    assert t.read(ignore_growing=True).count() == 979  # survivors of sealed files stay sealed
    t.delete_by_pk(spark.range(0, 1000).toDF("id"))
    assert t.read().count() == 0
    t.insert(points(spark, 0, 10))
    assert t.read().count() == 10


def test_many_touched_files_rewrite_folders(spark, folder, monkeypatch):
    from vecspark.sources import table

    monkeypatch.setattr(table, "MAX_FILES", 2)
    t = make(spark, folder)
    t.insert(points(spark, 0, 1000).repartitionByRange(10, "id"))
    t.delete_by_filter("id % 100 = 0")
    t.upsert(points(spark, 0, 1000, n=-1))
    assert t.read().count() == 1000 and t.read().where("n <> -1").count() == 0


def test_upsert_scopes(spark, folder):
    t = make(spark, folder)
    t.create_partition("p")
    t.insert(points(spark, 0, 200))
    t.upsert(points(spark, 0, 100, n=-1), "p")
    assert t.read().count() == 300 and t.read(["_default"]).where("n = -1").count() == 0
    k = VectorTable.create(spark, f"{folder}/k", point_schema(partition_key=True), key_partitions=4)
    k.insert(points(spark, 0, 200))
    k.upsert(points(spark, 0, 200).withColumn("n", F.col("n") + 1000))
    assert k.read().count() == 200 and k.read_key([1005]).count() == 1 and k.read_key([5]).count() == 0
    for call in (lambda: k.insert(points(spark, 0, 1), "p"), lambda: k.read(["0"]), lambda: t.read(["nope"]),
                 lambda: t.insert(points(spark, 0, 1), "nope"), lambda: t.upsert(points(spark, 0, 1), "nope")):
        with pytest.raises(ValueError):
            call()


def test_repeated_keys_in_a_batch(spark, folder):
    t = make(spark, folder)
    batch = spark.range(0, 999).select((F.col("id") % 3).alias("id"), F.col("id").alias("n"), F.array(F.lit(0.0), F.lit(1.0)).cast("array<float>").alias("vec"))
    t.upsert(batch, seq="n")
    assert sorted((r.id, r.n) for r in t.read().collect()) == [(0, 996), (1, 997), (2, 998)]


def test_partition_names_with_special_characters(spark, folder):
    t = make(spark, folder)
    for name in ("a/b=c", "100% ü"):
        t.create_partition(name)
        t.insert(points(spark, 0, 10), name)
        t.upsert(points(spark, 5, 15, n=-1), name)
        assert t.read([name]).count() == 15
    t.compact()
    assert sorted((r[0], r[1]) for r in t.list_partitions().collect()) == [("100% ü", 15), ("a/b=c", 15)]


def test_second_writer_of_a_version_fails(spark, folder):
    t = make(spark, folder)
    t.versions = lambda: [0]
    t.insert(points(spark, 0, 10))
    with pytest.raises(FileExistsError):
        t.insert(points(spark, 0, 10))


def test_refused_batch_leaves_nothing(spark, folder):
    import os

    t = make(spark, folder)
    with pytest.raises(ValueError):
        ingest.ingest(t, points(spark, 0, 9).withColumn("n", F.when(F.col("id") != 4, F.col("id"))))
    assert t.versions() == [0] and os.listdir(f"{folder}/t/data") == []


def test_delete_rules(spark, folder):
    t = make(spark, folder)
    t.create_partition("p")
    t.insert(points(spark, 0, 10))
    t.insert(points(spark, 10, 20), "p")
    t.delete_by_pk(spark.createDataFrame([(1,), (1,), (15,)], "id bigint"), "p")
    assert t.read().count() == 19
    t.delete_by_filter("id >= 10")
    assert t.read().count() == 10 and t.read(["p"]).count() == 0  # the emptied partition still exists
    t.drop_partition("p")
    for call in (lambda: t.delete_by_filter(" "), lambda: t.delete_by_pk(spark.range(0).toDF("id")),
                 lambda: t.delete_by_pk(spark.range(1).toDF("n")), lambda: t.read(["p"]), lambda: t.expire("n", -1, F.current_timestamp())):
        with pytest.raises(ValueError):
            call()


def test_schema_rules():
    pk, vec = S.field("id", L, pk=True), S.vector("v", "dense", 4)
    assert S.quick_schema(8).names == ["id", "vector", "$meta"]
    for bad in (
        lambda: S.table_schema([S.field("id", L), vec]), lambda: S.table_schema([pk]), lambda: S.table_schema([pk, pk, vec]),
        lambda: S.table_schema([pk, S.field("k", L, pk=True), vec]), lambda: S.table_schema([S.field("id", T.DoubleType(), pk=True), vec]),
        lambda: S.table_schema([pk, vec, S.field("a", L, partition_key=True), S.field("b", L, partition_key=True)]),
        lambda: S.table_schema([pk, vec, S.field("a", T.DoubleType(), partition_key=True)]),
        lambda: S.table_schema([pk, *[S.vector(f"v{i}", "dense", 4) for i in range(5)]]),
        lambda: S.vector("v", "dense", 1), lambda: S.vector("v", "dense", 32769), lambda: S.vector("v", "bits", 12),
        lambda: S.table_schema([pk, vec, S.field("s", STR, max_length=65536)]),
        lambda: S.table_schema([pk, vec, S.field("a", T.ArrayType(L), max_capacity=4097)]),
        lambda: S.table_schema([pk, vec, S.field("a", T.ArrayType(T.ArrayType(L)))]),
    ):
        with pytest.raises(ValueError):
            bad()


def test_column_checks(spark):
    df = points(spark, 0, 3)
    schema, loose = point_schema(), point_schema(dynamic=True)
    ingest.check_columns(df, schema)
    meta = F.parse_json(F.lit("{}"))
    for bad, against in (
        (df.withColumn("x", F.lit(1)), schema), (df.drop("n"), schema), (df.withColumn("n", F.lit("a")), schema),
        (df.select("id", "n", "n", "vec"), schema), (df.withColumn("$meta", meta), schema),
        (df.withColumn("$meta", meta).withColumn("x", F.lit(1)), loose), (df.withColumn("$meta", F.lit("{}")), loose),
    ):
        with pytest.raises(ValueError):
            ingest.check_columns(bad, against)


def test_broken_rows_are_found_and_refused(spark, folder):
    t = make(spark, folder)
    bad = points(spark, 0, 5).withColumn("vec", F.when(F.col("id") == 3, F.array(F.lit(1.0).cast("float"))).otherwise(F.col("vec")))
    with pytest.raises(ValueError, match="vec:dim"):
        ingest.ingest(t, bad)
    good, rejected = ingest.split_valid(bad, t.schema)
    assert good.count() == 4 and [r.id for r in rejected.collect()] == [3]
    sparse = S.table_schema([S.field("id", L, pk=True), S.vector("s", "sparse"), S.field("b", T.ArrayType(L), max_capacity=2)])
    rows = spark.createDataFrame([(1, [(1, 1.0), (1, 2.0)], [1]), (2, [(2, 1.0), (1, 2.0)], [1, 2, 3]), (3, [(2**32 - 1, 1.0)], []), (4, [], None),
                                  (5, [(1, 1.0), (7, 2.0)], [1])], "id bigint, s array<struct<i:bigint,v:float>>, b array<bigint>")
    assert sorted((r.id, r.rule) for r in ingest.violations(rows, sparse).collect()) == [
        (1, "s:order"), (2, "b:capacity"), (2, "s:order"), (3, "s:index_range"), (4, "b:missing")]


def test_json_rows(spark):
    schema = S.table_schema([S.field("id", L, pk=True), S.field("d", STR, default="x"), S.vector("vec", "dense", 2)], dynamic=True)
    line = lambda *t: spark.createDataFrame([(x,) for x in t], "value string")
    rows = ingest.rows_from_json(line('{"id": 1, "vec": [1, 2], "a": {"b": [1, "x"]}, "q\\"k": null}', '{"id": 2, "vec": [1, 2], "d": "y"}'), schema)
    got = rows.orderBy("id").select("id", "d", F.to_json("$meta").alias("m")).collect()
    assert [(r.id, r.d) for r in got] == [(1, "x"), (2, "y")] and got[1].m == "{}"
    assert '"a":{"b":[1,"x"]}' in got[0].m
    closed = S.table_schema([S.field("id", L, pk=True), S.vector("vec", "dense", 2)])
    auto = S.table_schema([S.field("id", L, pk=True, auto_id=True), S.vector("vec", "dense", 2)])
    assert ingest.rows_from_json(line('{"id": 9, "vec": [1, 2]}'), auto).columns == ["vec"]
    for text in ('{"id": 1}', '{"id": 1, "vec": [1, 2], "z": 1}', '{"id": "a", "vec": [1, 2]}', '[1]'):
        with pytest.raises(Exception):
            ingest.rows_from_json(line(text), closed).collect()


def test_generated_keys(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("a")).repartition(7)
    got = ingest.with_row_ids(df, "id", ["a"], start=50).orderBy("a").collect()
    assert [r.id for r in got] == list(range(50, 1050))
    one, two = (ingest.with_hash_ids(df, "id", "b", ["a"]).agg(F.sum(F.col("id").cast("decimal(38,0)"))).first()[0] for _ in range(2))
    assert one == two


def test_exports(spark, folder):
    rows = spark.range(201).select((F.lit(200) - F.col("id")).alias("id")).repartition(5)
    batches = export.export_batches(rows, "id", 100)
    export.write_batches(batches, f"{folder}/out", "id")
    back = spark.read.schema("id bigint, row_no bigint, batch_no bigint").parquet(f"{folder}/out")
    assert [r["count"] for r in back.groupBy("batch_no").count().orderBy("batch_no").collect()] == [100, 100, 1]
    assert back.where("row_no <> id + 1").count() == 0
    # copies of one key: every row is still numbered once
    copies = spark.range(300).select((F.col("id") % 2).alias("id"))
    assert sorted(r.row_no for r in export.export_batches(copies, "id", 7).collect()) == list(range(1, 301))


def test_scans(spark):
    df = points(spark, 0, 50).withColumn("$meta", F.parse_json(F.lit('{"k": 5}')))
    assert scans.project(df, ["*", "k", "id"]).columns == ["id", "n", "vec", "$meta", "k"]
    assert [r.id for r in scans.query(df, "id > 10", ["id"], order="id", limit=3, offset=2).collect()] == [13, 14, 15]
    assert scans.query(df, "", ["id"]).count() == 50
    with pytest.raises(ValueError):
        scans.query(df, None, ["id"], limit=3)
    assert scans.get(df, spark.createDataFrame([(3,), (3,), (99,)], "id bigint"), "id", ["id", "k"]).collect() == [(3, 5.0)]


def test_numpy_files(spark, folder):
    import numpy as np

    from vecspark.sources import files

    x = np.arange(5000 * 6, dtype=np.float32).reshape(5000, 6)
    np.save(f"{folder}/v.npy", x)
    old = files.NPY_CHUNK
    try:
        files.NPY_CHUNK = 1000 * 24
        got = files.load_npy(spark, f"{folder}/v.npy").orderBy("row_no").toPandas()
    finally:
        files.NPY_CHUNK = old
    assert list(got.row_no) == list(range(5000)) and np.array_equal(np.stack(got.vector), x)
    np.save(f"{folder}/flat.npy", x[0])
    with pytest.raises(ValueError):
        files.load_npy(spark, f"{folder}/flat.npy")


def _json_lines(spark, folder, *lines):
    path = str(folder / "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write.text(path)
    return path


def test_inferred_kinds_and_mixed_rows(spark, tmp_path):
    path = _json_lines(
        spark, tmp_path,
        '{"id": 1, "d": [1, 2, 3], "w": [1, 2], "h": "AAAAPAAA", "s": [{"i": 3, "v": 1}], "n": 1, "x": 1, "t": null, "o": {"a": 1}, "e": [1]}',
        '{"id": 2, "d": [1e-3, 2.5, 3], "w": [-1, 0], "h": "ADwAAAA8", "s": [], "n": 2.5, "x": "one", "t": null, "o": {"a": 2.5}, "e": []}',
        "", '{"id": 3, "d": [0, 0, 0], "w": [5, 6], "h": "AAAAAAAA", "s": [{"i": 1, "v": 0.5}, {"i": 9, "v": 2e-9}], "n": null}')
    found = ingest.infer_schema(spark, path, "id", vectors={"w": "bits", "h": "bf16"})
    got = {f.name: (f.metadata.get("encoding"), f.metadata.get("dim")) for f in found.fields if f.metadata.get("encoding")}
    assert got == {"d": ("dense", 3), "w": ("bits", 128), "h": ("bf16", 3), "s": ("sparse", None)}
    plain = {f.name: f.dataType.simpleString() for f in found.fields if f.name not in got}
    assert plain == {"id": "bigint", "n": "double", "t": "string", "o": "struct<a:double>", "e": "array<bigint>", "$meta": "variant"}
    rows = ingest.rows_from_json(spark.read.text(path).filter("value <> ''"), found).orderBy("id").collect()
    assert [bytes(r["h"]) for r in rows] == [b"\0\0\0<\0\0", b"\0<\0\0\0<", b"\0" * 6]
    assert [(e["i"], e["v"]) for e in rows[2]["s"]] == [(1, 0.5), (9, pytest.approx(2e-9))] and rows[1]["w"] == [-1, 0]


@pytest.mark.parametrize("lines,options,message", [
    (['{"id": 1, "d": [1, 2]}', '{"id": 2, "d": [1, 2, 3]}'], {"vectors": {"d": "dense"}}, "no dense vectors"),
    (['{"id": 1, "d": "???"}'], {"vectors": {"d": "fp16"}}, "no fp16 vectors"),
    (['{"id": 1, "d": [0.5, 1]}', '{"id": "a", "d": [1, 2]}'], {}, "no common type"),
    (['{"d": [0.5, 1]}'], {}, "no line has the key id"),
    (['{"id": 1, "d": [0.5, 1]}'], {"max_fields": 1}, "more than 1"),
    (['{"id": 1, "d": [0.5, 1]}'], {"vectors": {"d": "odd"}}, "unknown vector kind"),
])
def test_inference_refusals(spark, tmp_path, lines, options, message):
    with pytest.raises(ValueError, match=message):
        ingest.infer_schema(spark, _json_lines(spark, tmp_path, *lines), "id", **options)


def test_inference_reads_the_lines_once(spark, tmp_path):
    path = _json_lines(spark, tmp_path, *['{"id": %d, "d": [0.5, 1]}' % i for i in range(50)])
    spark.sparkContext.setJobGroup("inference", "one read")
    try:
        ingest.infer_schema(spark, path, "id")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("inference")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
    full = [s for s in stages if (i := spark.sparkContext.statusTracker().getStageInfo(s)) and i.numCompletedTasks]
    assert len(full) <= 2  # the scan with partial merging, and the final merge


def _scored_case(spark):
    rows = [(i, [float(i % 7), float(i * i % 11)]) for i in range(200)] + [(900, [1e30, 0.0]), (901, None)]
    queries = [(1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, [-3.0, 5.0])]
    return (spark.createDataFrame(rows, "id long, v array<float>").repartition(4),
            spark.createDataFrame(queries, "qid long, qvec array<float>"))


@pytest.mark.parametrize("metric", ["L2", "IP"])
@pytest.mark.parametrize("first,last", [(0, 0), (0, 3), (4, 6), (19, 25), (30, 40), (0, 100)])
def test_pages_of_a_search_are_those_of_the_full_list(spark, metric, first, last):
    rows, queries = _scored_case(spark)
    full = export.search_export(rows, queries, metric=metric, vec="v", pk="id", size=10)
    page = export.search_export(rows, queries, metric=metric, vec="v", pk="id", size=10, batches=(first, last))
    names = ["qid", "rank", "id", "score", "batch_no"]
    want = sorted(tuple(r) for r in full.select(*names).collect() if first <= r["batch_no"] <= last)
    assert sorted(tuple(r) for r in page.select(*names).collect()) == want


def test_pages_score_every_pair_once_and_shuffle_their_part_only(spark, monkeypatch):
    rows, queries = _scored_case(spark)
    seen, ranked, rank = spark.sparkContext.accumulator(0), [], export.global_rank

    @F.udf("boolean")
    def counted(_):
        seen.add(1)
        return True

    def watched(df, *args, **options):
        ranked.append(df.count())
        return rank(df, *args, **options)

    monkeypatch.setattr(export, "global_rank", watched)
    page = export.search_export(rows, queries, metric="L2", vec="v", pk="id", size=10, batches=(0, 1), where=counted("id"))
    assert page.count() == 60 and seen.value == 202
    assert ranked[0] < 120  # a fifth of the pairs, ties of the last score included; the far row costs nothing
    monkeypatch.setattr(export, "PARTS", 2)
    coarse = export.search_export(rows, queries, metric="L2", vec="v", pk="id", size=10, batches=(0, 1))
    assert sorted(map(tuple, coarse.collect())) == sorted(map(tuple, page.collect()))
    with pytest.raises(ValueError, match="batch numbers"):
        export.search_export(rows, queries, metric="L2", vec="v", pk="id", batches=(3, 2))
