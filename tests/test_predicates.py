import pytest
from pyspark.sql import functions as F

from tests.generator import golden_rows
from vecspark.functions import predicates as p

M = "`$meta`"
c = F.col


def golden():
    """(name, predicate, matching rows of 3000)."""
    return [
        ("all", lambda d: F.lit(True), 3000),
        ("lt", lambda d: c("int64") < 1000, 1000),
        ("in", lambda d: c("int64").isin(0, 1, 2), 3),
        ("and", lambda d: (c("int64") >= 1000) & (c("int64") < 2000), 1000),
        ("or", lambda d: (c("int64") >= 1000) | (c("int64") > 2000), 2000),
        ("float", lambda d: c("float") < 1000, 1000),
        ("number eq", lambda d: p.j_eq("json", 0, "number"), 750),
        ("number lt, ne", lambda d: (p.j_num("json", "number") < 100) & p.j_ne("json", 0, "number"), 50),
        ("dynamic lt", lambda d: p.field(d, "dynamicNumber") < 100, 100),
        ("dynamic mod", lambda d: p.field(d, "dynamicNumber") % 2 == 0, 1500),
        ("bool", lambda d: p.j_eq("json", True, "bool"), 750),
        ("dynamic bool", lambda d: p.field(d, "dynamicBool", "bool") == F.lit(False), 2000),
        ("dynamic in", lambda d: p.j_in(M, ["1", "2"], "dynamicString"), 2),
        ("string in", lambda d: p.j_in("json", ["1", "2", "5"], "string"), 3),
        ("list eq", lambda d: p.j_eq("json", [1, 2], "list"), 1),
        ("list eq none", lambda d: p.j_eq("json", [0, 1], "list"), 0),
        ("list item", lambda d: p.j_num("json", "list", 0) < 10, 5),
        ("missing ne", lambda d: p.j_ne(M, [2, 3], "dynamicList"), 0),
        ("contains", lambda d: p.j_contains("json", 2, "list"), 1),
        ("contains number", lambda d: p.j_contains("json", 0, "number"), 0),
        ("contains all", lambda d: p.j_contains_all("json", [1, 2], "list"), 1),
        ("contains any", lambda d: p.j_contains_any("json", [1, 3], "list"), 2),
        ("like", lambda d: p.field(d, "dynamicString", "string").like("1%"), 1111),
        ("exists list", lambda d: p.j_exists("json", "list"), 750),
        ("exists a", lambda d: p.has_field(d, "a"), 0),
        ("exists dynamicList", lambda d: p.has_field(d, "dynamicList"), 0),
        ("exists dynamicString", lambda d: p.has_field(d, "dynamicString"), 3000),
        ("type strict", lambda d: p.j_eq("json", "0", "number"), 0),
        ("whole ge", lambda d: p.j_num("json") >= 1500, 750),
        ("whole gt fraction", lambda d: p.j_num("json") > 1499.5, 750),
        ("whole like", lambda d: p.j_str("json").like("21%"), 25),
        ("whole list", lambda d: p.j_eq("json", [1503, 1504]), 1),
        ("whole item", lambda d: p.j_num("json", 0) > 1, 375),
        ("whole nested item", lambda d: p.j_num("json", 0, 0) > 1, 0),
        ("bool item", lambda d: p.a_get("boolArray", 0) == F.lit(False), 1500),
        ("int64 item", lambda d: p.a_get("int64Array", 0) > 0, 2999),
        ("int8 item", lambda d: p.a_get("int8Array", 0) > 0, 1524),
        ("int16 contains", lambda d: p.a_contains("int16Array", 100), 100),
        ("int32 contains", lambda d: p.a_contains("int32Array", 1), 2),
        ("int32 contains none", lambda d: p.a_contains("int32Array", 1000000), 0),
        ("contains all 90 91", lambda d: p.a_contains_all("int64Array", [90, 91]), 91),
        ("contains all 1 2", lambda d: p.a_contains_all("int64Array", [1, 2]), 2),
        ("contains any", lambda d: p.a_contains_any("floatArray", [0.0, 100.0, 10000.0]), 101),
        ("contains any 10", lambda d: p.a_contains_any("floatArray", [0.0, 100.0, 10.0]), 101),
        ("array eq", lambda d: p.a_equal("doubleArray", [0, 1], "double"), 0),
        ("length 10", lambda d: p.a_length("varcharArray") == 10, 0),
        ("length 100", lambda d: p.a_length("doubleArray") == 100, 3000),
        ("past the end", lambda d: p.a_get("int64Array", 100) > -1, 0),
    ]


def test_golden_counts(spark):
    df = golden_rows(spark).cache()
    cases = golden()
    got = df.agg(*[F.count_if(make(df)).alias(str(n)) for n, (_, make, _) in enumerate(cases)]).first()
    assert {name: got[n] for n, (name, _, _) in enumerate(cases)} == {name: want for name, _, want in cases}


def test_big_integers_stay_exact(spark):
    df = spark.sql("""SELECT parse_json('{"n": 9007199254740993}') AS v""")
    assert df.where(p.j_eq("v", 9007199254740993, "n")).count() == 1
    assert df.where(p.j_eq("v", 9007199254740992, "n")).count() == 0


def test_refused_forms(spark):
    df = golden_rows(spark)
    with pytest.raises(ValueError):
        p.a_get("int64Array", -1)
    with pytest.raises(ValueError):
        p.j_num("json", "list", -1)
    with pytest.raises(ValueError):
        p.j_contains_all("json", 1, "list")
    with pytest.raises(ValueError):
        p.dynamic_typed(df, "dynamicNumber", "date")


def test_dynamic_typed(spark):
    df = golden_rows(spark)
    row = df.where("int64 = 7").select(
        p.dynamic_typed(df, "dynamicNumber", "int").alias("i"), p.dynamic_typed(df, "dynamicNumber", "double").alias("d"),
        p.dynamic_typed(df, "dynamicString", "string").alias("s"), p.dynamic_typed(df, "dynamicBool", "bool").alias("b"),
        p.dynamic_typed(df, "dynamicNumber", "string").alias("wrong"), p.dynamic_typed(df, "absent", "int", strict=True).alias("none")).first()
    assert tuple(row) == (7, 7.0, "7", False, None, None)
    with pytest.raises(Exception, match="is not string"):
        df.select(p.dynamic_typed(df, "dynamicNumber", "string", strict=True)).collect()
