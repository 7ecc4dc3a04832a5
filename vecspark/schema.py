"""Table schemas: Spark ``StructType`` with vector, key and limit information in field metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

META = "$meta"

# Fixed engine limits.
MAX_DIM = 32768
MAX_BINARY_DIM = 262144
MAX_VARCHAR = 65535
MAX_CAPACITY = 4096
MAX_VECTOR_FIELDS = 4
MAX_PARTITIONS = 1024
DEFAULT_PARTITION = "_default"
DEFAULT_KEY_PARTITIONS = 16

FLOAT_VECTOR = T.ArrayType(T.FloatType())
BINARY_VECTOR = T.ArrayType(T.LongType())
SPARSE_VECTOR = T.ArrayType(T.StructType([T.StructField("i", T.LongType()), T.StructField("v", T.FloatType())]))
HALF_VECTOR = T.BinaryType()
VECTOR_KINDS = {"dense": FLOAT_VECTOR, "bits": BINARY_VECTOR, "fp16": HALF_VECTOR, "bf16": HALF_VECTOR, "sparse": SPARSE_VECTOR}
ARRAY_ELEMENTS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType)


def field(name: str, dtype: T.DataType, *, nullable: bool = False, **options) -> T.StructField:
    """A declared field; options: pk, auto_id, partition_key, clustering_key, max_length, max_capacity, default."""
    return T.StructField(name, dtype, nullable, {k: v for k, v in options.items() if v is not None})


def vector(name: str, kind: str = "dense", dim: int | None = None) -> T.StructField:
    if kind not in VECTOR_KINDS:
        raise ValueError(f"unknown vector kind {kind}")
    if kind != "sparse":
        top = MAX_BINARY_DIM if kind == "bits" else MAX_DIM
        if dim is None or not 2 <= dim <= top:
            raise ValueError(f"dimension of {name} must be in [2, {top}]")
        if kind == "bits" and dim % 8:
            raise ValueError(f"dimension of binary vector {name} must be a multiple of 8")
    metadata = {"encoding": kind} if dim is None else {"encoding": kind, "dim": dim}
    return T.StructField(name, VECTOR_KINDS[kind], False, metadata)


def is_vector(f: T.StructField) -> bool:
    return f.metadata.get("encoding") in VECTOR_KINDS


def flagged(schema: T.StructType, flag: str) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get(flag)]


def primary_key(schema: T.StructType) -> str:
    return flagged(schema, "pk")[0]


def is_dynamic(schema: T.StructType) -> bool:
    return META in schema.names


def declared(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name != META]


def table_schema(fields: Sequence[T.StructField], dynamic: bool = False) -> T.StructType:
    """Check the declaration rules and return the table's ``StructType``."""
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise ValueError("duplicate field name")
    keys = [f for f in fields if f.metadata.get("pk")]
    if len(keys) != 1:
        raise ValueError("exactly one primary key is required")
    if not isinstance(keys[0].dataType, (T.LongType, T.StringType)):
        raise ValueError("the primary key must be bigint or text")
    auto = [f for f in fields if f.metadata.get("auto_id")]
    if len(auto) > 1 or (auto and auto[0] is not keys[0]):
        raise ValueError("only the primary key may be generated, and only once")
    parts = [f for f in fields if f.metadata.get("partition_key")]
    if len(parts) > 1:
        raise ValueError("at most one partition key")
    if parts and not isinstance(parts[0].dataType, (T.LongType, T.StringType)):
        raise ValueError("the partition key must be bigint or text")
    vectors = [f for f in fields if is_vector(f)]
    if not 1 <= len(vectors) <= MAX_VECTOR_FIELDS:
        raise ValueError(f"a table has 1 to {MAX_VECTOR_FIELDS} vector fields")
    for f in fields:
        _check_limits(f)
    extra = [T.StructField(META, T.VariantType(), True)] if dynamic else []
    return T.StructType([*fields, *extra])


def _check_limits(f: T.StructField) -> None:
    if isinstance(f.dataType, T.StringType):
        if not 0 < f.metadata.get("max_length", MAX_VARCHAR) <= MAX_VARCHAR:
            raise ValueError(f"max_length of {f.name} must be in (0, {MAX_VARCHAR}]")
    if isinstance(f.dataType, T.ArrayType) and not is_vector(f):
        if not isinstance(f.dataType.elementType, ARRAY_ELEMENTS):
            raise ValueError(f"array {f.name} has an unsupported element type")
        if not 0 < f.metadata.get("max_capacity", MAX_CAPACITY) <= MAX_CAPACITY:
            raise ValueError(f"max_capacity of {f.name} must be in (0, {MAX_CAPACITY}]")


def quick_schema(dim: int, pk: str = "id", vec: str = "vector") -> T.StructType:
    """``id`` bigint + ``vector``, dynamic."""
    return table_schema([field(pk, T.LongType(), pk=True), vector(vec, "dense", dim)], dynamic=True)
