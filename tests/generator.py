"""The 3000-row table on which the golden predicate counts hold."""

from pyspark.sql import functions as F

ROWS = 3000
CAPACITY = 100


def golden_rows(spark):
    i = F.col("i")
    pair = F.concat(F.lit("["), i, F.lit(","), i + 1, F.lit("]"))
    even = F.concat(F.lit('{"number":0,"string":"'), i, F.lit('","bool":true,"list":null}'))
    odd = F.concat(F.lit('{"number":'), i, F.lit(',"string":"'), i, F.lit('","bool":false,"list":'), pair, F.lit("}"))
    text = (
        F.when(i < ROWS // 2, F.when(i % 2 == 0, even).otherwise(odd))
        .when(i % 4 == 0, i.cast("string")).when(i % 4 == 1, F.concat(i, F.lit(".0")))
        .when(i % 4 == 2, F.concat(F.lit('"'), i, F.lit('"'))).otherwise(pair))
    meta = F.concat(F.lit('{"dynamicNumber":'), i, F.lit(',"dynamicString":"'), i, F.lit('","dynamicBool":'),
                    F.when(i % 3 == 0, "true").otherwise("false"), F.lit("}"))
    run = F.transform(F.sequence(F.lit(0), F.lit(CAPACITY - 1)), lambda j: i + j)
    int8 = F.transform(run, lambda x: (F.pmod(x + 128, F.lit(256)) - 128).cast("tinyint"))
    return spark.range(ROWS).withColumnRenamed("id", "i").select(
        i.alias("int64"), i.cast("float").alias("float"), i.cast("string").alias("varchar"),
        F.parse_json(text).alias("json"), F.parse_json(meta).alias("$meta"),
        F.transform(run, lambda x: i % 2 == 0).alias("boolArray"), int8.alias("int8Array"),
        run.cast("array<smallint>").alias("int16Array"), run.cast("array<int>").alias("int32Array"), run.alias("int64Array"),
        run.cast("array<float>").alias("floatArray"), run.cast("array<double>").alias("doubleArray"),
        run.cast("array<string>").alias("varcharArray"))
