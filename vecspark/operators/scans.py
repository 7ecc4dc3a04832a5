"""Scans, projections and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions.predicates import META, field


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Named output fields; ``*`` stands for all declared fields, undeclared names read the dynamic part.
    A name given twice appears once."""
    wanted: list[str] = []
    for name in names:
        for one in (df.columns if name == "*" else [name]):
            if one not in wanted:
                wanted.append(one)
    return df.select(*[field(df, n).alias(n) for n in wanted])


def query(
    df: DataFrame, where: Column | str | None, fields: Sequence[str], *, order: str | None = None,
    limit: int | None = None, offset: int = 0,
) -> DataFrame:
    """Filter, project and optionally page in primary-key order."""
    out = df if where is None or (isinstance(where, str) and not where.strip()) else df.where(where)
    if limit or offset:
        if order is None:
            raise ValueError("paging needs an order")
        out = out.orderBy(order)
        out = out.offset(offset) if offset else out
        out = out.limit(limit) if limit else out
    return project(out, fields)


def query_by_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose column is in a one-column id table."""
    name = ids.columns[0]
    return df.join(ids.select(F.col(name).alias(column)), column, "left_semi")


def get(df: DataFrame, keys: DataFrame, pk: str, fields: Sequence[str] = ("*",)) -> DataFrame:
    return project(query_by_ids(df, keys, pk), fields)


def count(df: DataFrame, where: Column | str | None = None) -> DataFrame:
    return (df if where is None else df.where(where)).agg(F.count("*").alias("count"))


def widen(df: DataFrame) -> DataFrame:
    """Integers as bigint and floats as double."""
    wide = {T.ByteType: "bigint", T.ShortType: "bigint", T.IntegerType: "bigint", T.FloatType: "double"}
    return df.select(*[
        F.col(f"`{f.name}`").cast(wide[type(f.dataType)]).alias(f.name) if type(f.dataType) in wide else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def load_columns(df: DataFrame, fields: Sequence[str], *, skip_dynamic: bool = True) -> DataFrame:
    """Keep some fields in executor memory (spilling to disk) for repeated queries."""
    names = [*fields] + ([] if skip_dynamic or META not in df.columns else [META])
    return df.select(*[F.col(f"`{n}`") for n in names]).persist()


def write_scalar_layout(df: DataFrame, path: str, by: str, bloom: Sequence[str] = ()) -> None:
    """Files sorted by a field, so min/max statistics skip row groups; bloom filters for point lookups.

    A hash of the row's plain columns behind the field lets a frequent value spread over several files.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.VariantType, T.MapType))]
    writer = df.repartitionByRange(by, F.xxhash64(*[F.col(f"`{c}`") for c in plain])).sortWithinPartitions(by).write
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)
