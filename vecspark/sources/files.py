"""Bulk files: JSON, CSV, parquet and NumPy arrays, time windows, load reports, vector CSV."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NPY_CHUNK = 32 << 20  # bytes one task step reads of a NumPy file


def bulk_load(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None, **options) -> DataFrame:
    """Rows of JSON, CSV, ORC or parquet files with the declared types; the format follows the suffix."""
    kind = fmt or path.rstrip("/").rsplit(".", 1)[-1]
    if kind not in ("json", "csv", "orc", "parquet"):
        raise ValueError(f"unsupported bulk format {kind}")
    reader = spark.read.schema(schema)
    if kind == "csv":
        reader = reader.option("header", options.pop("header", True))
    return reader.options(**options).format(kind).load(path)


def in_window(df: DataFrame, ts: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Rows with start <= ts <= end; an open side does not restrict."""
    out = df
    if start is not None:
        out = out.where(F.col(ts) >= start)
    if end is not None:
        out = out.where(F.col(ts) <= end)
    return out


def load_report(df: DataFrame, pk: str) -> DataFrame:
    """(file, rows, first key, last key) per source file of a load."""
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"), F.min(pk).alias("first_id"), F.max(pk).alias("last_id"))


def load_npy(spark: SparkSession, path: str, vec: str = "vector", row: str = "row_no") -> DataFrame:
    """(row number, vector) of a 2-d NumPy file.

    Only the header is read here; the tasks read disjoint row ranges of the file, so its size does not
    matter.  The file must be C-ordered and reachable from the executors.
    """
    fs, inner = _file(path)
    with fs.open_input_file(inner) as f:
        head = pa.PythonFile(f, mode="r")
        version = np.lib.format.read_magic(head)
        reader = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, by_column, dtype = reader(head)
        start = head.tell()
    if len(shape) != 2 or by_column:
        raise ValueError("a vector file holds one row-ordered 2-d array")
    n, dim = shape
    step = max(1, NPY_CHUNK // (dim * dtype.itemsize))
    schema = T.StructType([T.StructField(row, T.LongType()), T.StructField(vec, T.ArrayType(T.FloatType()))])

    def read(batches):
        fs, inner = _file(path)
        with fs.open_input_file(inner) as f:
            for batch in batches:
                for first in batch.column(0).to_pylist():
                    count = min(step, n - first)
                    raw = f.read_at(count * dim * dtype.itemsize, start + first * dim * dtype.itemsize)
                    values = np.frombuffer(raw, dtype).astype(np.float32)
                    ends = pa.array(np.arange(count + 1, dtype=np.int32) * dim)
                    vectors = pa.ListArray.from_arrays(ends, pa.array(values))
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + count)), vectors], names=schema.names)

    chunks = spark.range(0, n, step, numPartitions=max(1, min(-(-n // step), 10000)))
    return chunks.mapInArrow(read, schema)


def _file(path: str):
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return pafs.LocalFileSystem(), path


def load_csv_vectors(spark: SparkSession, path: str, schema: T.StructType, vec: str, dim: int, **options) -> DataFrame:
    """CSV rows whose last declared column is a bracketed vector text; malformed rows are skipped.

    A row is malformed when it has too few columns, a key or number does not parse, or the vector does
    not have ``dim`` parts.  A part that is no number counts as 0.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.schema(raw).options(**options).csv(path)
    parts = F.split(F.regexp_replace(vec, r"[\[\]]", ""), ",", -1)
    numbers = F.transform(parts, lambda x: F.coalesce(F.trim(x).try_cast("float"), F.lit(0.0).cast("float")))
    out = [numbers.alias(vec) if f.name == vec else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    good = F.col(vec).isNotNull() & (F.size(vec) == dim)
    for f in schema.fields:
        if f.name != vec and not isinstance(f.dataType, T.StringType):
            good = good & F.col(f.name).isNotNull()
    return rows.where(F.col(vec).isNotNull()).select(*out).where(good)
