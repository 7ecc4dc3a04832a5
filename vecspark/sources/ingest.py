"""Getting rows into a table: checks, defaults, dynamic fields, generated keys, JSON rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import schema as S
from vecspark.functions.packing import MAX_SPARSE_INDEX
from vecspark.plans.ranking import global_rank
from vecspark.schema import META


def _same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal apart from nullability."""
    return a.simpleString() == b.simpleString()


# ---------------------------------------------------------------- batch against schema

def check_columns(df: DataFrame, schema: T.StructType) -> None:
    """Raise for duplicate, unknown, mistyped or missing columns."""
    twice = [c for c, n in Counter(df.columns).items() if n > 1]
    if twice:
        raise ValueError(f"the batch names column {twice[0]} more than once")
    names = {f.name: f for f in S.declared(schema)}
    extras = [c for c in df.columns if c not in names and c != META]
    if META in df.columns:
        if not S.is_dynamic(schema):
            raise ValueError("the table has no dynamic part")
        if not isinstance(df.schema[META].dataType, T.VariantType):
            raise ValueError("the dynamic part must be a variant")
        if extras:
            raise ValueError("dynamic columns and an explicit dynamic part cannot be combined")
    elif extras and not S.is_dynamic(schema):
        raise ValueError(f"the table declares no field {extras[0]}")
    for c in df.columns:
        if c in names and not _same_type(df.schema[c].dataType, names[c].dataType):
            raise ValueError(f"column {c} is {df.schema[c].dataType.simpleString()}, "
                             f"the field is {names[c].dataType.simpleString()}")
    for f in names.values():
        optional = f.nullable or "default" in f.metadata or f.metadata.get("auto_id")
        if f.name not in df.columns and not optional:
            raise ValueError(f"the batch lacks the required field {f.name}")


def fill_defaults(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add absent nullable fields as null and absent defaulted fields as their default; a null in a
    defaulted field takes the default too."""
    out = df
    for f in S.declared(schema):
        default = F.lit(f.metadata.get("default")).cast(f.dataType)
        if f.name not in df.columns and not f.metadata.get("auto_id"):
            out = out.withColumn(f.name, default)
        elif f.name in df.columns and "default" in f.metadata:
            out = out.withColumn(f.name, F.coalesce(F.col(f"`{f.name}`"), default))
    return out


def fold_dynamic(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fold undeclared columns into the dynamic JSON value; absent (null) keys are left out."""
    if not S.is_dynamic(schema) or META in df.columns:
        return df
    declared = {f.name for f in S.declared(schema)}
    extras = [c for c in df.columns if c not in declared]
    if not extras:
        return df.withColumn(META, F.parse_json(F.lit("{}")))
    folded = F.parse_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in extras])))
    return df.withColumn(META, folded).drop(*extras)


def rules(schema: T.StructType) -> list[tuple[str, Column]]:
    """(rule name, violated) for every row-level rule of the declared fields."""
    out: list[tuple[str, Column]] = []
    for f in S.declared(schema):
        c, kind, dim = F.col(f"`{f.name}`"), f.metadata.get("encoding"), f.metadata.get("dim")
        required = not f.nullable and "default" not in f.metadata and not f.metadata.get("auto_id")
        if required:
            out.append((f"{f.name}:missing", c.isNull()))
        if kind == "dense":
            out.append((f"{f.name}:dim", F.size(c) != dim))
        elif kind == "bits":
            out.append((f"{f.name}:dim", F.size(c) != -(-dim // 64)))
        elif kind in ("fp16", "bf16"):
            out.append((f"{f.name}:dim", F.length(c) != 2 * dim))
        elif kind == "sparse":
            out.append((f"{f.name}:index_range", F.exists(c, lambda e: (e["i"] < 0) | (e["i"] >= MAX_SPARSE_INDEX))))
            falling = F.exists(F.zip_with(F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), c,
                                          lambda later, first: later["i"] <= first["i"]), lambda bad: F.coalesce(bad, F.lit(False)))
            out.append((f"{f.name}:order", falling))
        elif isinstance(f.dataType, T.ArrayType):
            out.append((f"{f.name}:capacity", F.size(c) > f.metadata.get("max_capacity", S.MAX_CAPACITY)))
        elif isinstance(f.dataType, T.StringType):
            out.append((f"{f.name}:max_length", F.octet_length(c) > f.metadata.get("max_length", S.MAX_VARCHAR)))
    return out


def _broken(schema: T.StructType) -> Column:
    tests = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules(schema)]
    return F.filter(F.array(*tests), lambda r: r.isNotNull())


def violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(pk, rule) of every broken rule."""
    pk = S.primary_key(schema)
    return df.select(pk, F.explode(_broken(schema)).alias("rule"))


def split_valid(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that keep every rule, rejected rows with their broken rules)."""
    marked = df.withColumn("_broken", _broken(schema))
    return marked.where(F.size("_broken") == 0).drop("_broken"), marked.where(F.size("_broken") > 0)


def prepare(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Column checks, defaults and dynamic folding, in the table's column order."""
    check_columns(df, schema)
    full = fold_dynamic(fill_defaults(df, schema), schema)
    return full.select(*[F.col(f"`{n}`") for n in schema.names])


def ingest(table, df: DataFrame, partition: str | None = None) -> None:
    """Validated append: a batch with any broken row is refused as a whole.

    The rules are counted while the rows are written, so the batch is read once; the new files only
    become part of the table when every count is zero.
    """
    watched, accept = checked(df, table.schema)
    table.insert(watched, partition, accept=accept)


def checked(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Callable[[], None]]:
    """The prepared batch, and what raises if the rows written from it broke a rule."""
    checks, seen = rules(schema), Observation()
    watched = prepare(df, schema).observe(seen, F.count("*").alias("rows"), *[
        F.count_if(F.coalesce(bad, F.lit(False))).alias(f"r{i}") for i, (_, bad) in enumerate(checks)])

    def accept() -> None:
        broken = [f"{name} ({seen.get[f'r{i}']} rows)" for i, (name, _) in enumerate(checks) if seen.get[f"r{i}"]]
        if broken:
            raise ValueError("; ".join(sorted(broken)))

    return watched, accept


# ---------------------------------------------------------------- generated keys

def with_hash_ids(df: DataFrame, pk: str, batch: str, row_key: Sequence[str]) -> DataFrame:
    """Stable 64-bit ids from a batch id and the columns that identify a row: a retry gives the same ids."""
    return df.withColumn(pk, F.xxhash64(F.lit(batch), *[F.col(c) for c in row_key]))


def with_row_ids(df: DataFrame, pk: str, order: Sequence[str], start: int = 1) -> DataFrame:
    """Dense ids start, start + 1, ... in the given order; a supplied key column is ignored."""
    ranked = global_rank(df.drop(pk) if pk in df.columns and pk not in order else df, [F.col(c) for c in order], out="_row")
    return ranked.withColumn(pk, F.col("_row") + F.lit(start - 1)).drop("_row")


# ---------------------------------------------------------------- JSON rows

def rows_from_json(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed rows from JSON object lines.

    A declared field missing from a row is an error, undeclared keys go to the dynamic part (or are an
    error without one), and a generated key is ignored when supplied.
    """
    fields = [f for f in S.declared(schema) if not f.metadata.get("auto_id")]
    typed = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    known = [f.name for f in S.declared(schema)]
    needed = [f.name for f in fields if not f.nullable and "default" not in f.metadata]
    parsed = lines.select(
        F.col(value).alias("_line"), F.from_json(value, typed, {"mode": "FAILFAST"}).alias("_row"),
        F.json_object_keys(value).alias("_keys"))
    absent = F.array_except(F.array(*[F.lit(n) for n in needed]), F.col("_keys"))
    extra = F.array_except(F.col("_keys"), F.array(*[F.lit(n) for n in known]))
    fault = (
        F.when(F.col("_keys").isNull(), F.lit("row is not a JSON object"))
        .when(F.size(absent) > 0, F.concat(F.lit("row does not have field "), F.get(absent, F.lit(0))))
        .when(F.size("_keys") != F.size(F.array_distinct("_keys")), F.lit("row has a duplicated name")))
    if not S.is_dynamic(schema):
        fault = fault.when(F.size(extra) > 0, F.concat(F.lit("field does not exist: "), F.get(extra, F.lit(0))))
    checked = parsed.where(F.when(fault.isNotNull(), F.raise_error(fault).cast("boolean")).otherwise(F.lit(True)))
    out = [F.col("_row").getField(n).alias(n) for n in typed.names]
    if S.is_dynamic(schema):
        whole = F.try_variant_get(F.parse_json("_line"), "$", "map<string,variant>")
        out.append(F.to_variant_object(F.map_filter(whole, lambda k, _: ~k.isin(known))).alias(META))
    return fill_defaults(checked.select(*out), schema)


def infer_schema(
    spark: SparkSession, path: str, pk: str, *, partition_key: str | None = None, vectors: dict[str, str] | None = None,
    max_fields: int = 1024,
) -> T.StructType:
    """Typed schema of JSON lines, from one read of the whole dataset.

    Every line is parsed once; types and lengths are merged per key before anything is shuffled.  Number arrays of one
    length, at least 2, with a fraction somewhere are dense vectors, arrays of {i, v} objects are sparse ones.
    ``vectors`` names the kind of fields whose JSON does not tell it: packed bits (64 to a number), half precision
    (Base64 text) or dense vectors of whole numbers.  Whole numbers mixed with fractions are doubles.  Keys whose values have
    no common type are not declared and make the table dynamic; a key that is always null is text.
    """
    kinds = vectors or {}
    value, halves = F.col("value"), [n for n, kind in kinds.items() if kind in ("fp16", "bf16")]
    lines = spark.read.text(path).filter(F.trim("value") != "")
    entries = lines.select(F.explode(F.variant_get(F.parse_json("value"), "$", "map<string,variant>")).alias("key", "value"))
    items, text = F.try_variant_get(value, "$", "array<variant>"), F.try_variant_get(value, "$", "string")
    size = F.when(F.col("key").isin(halves), F.length(F.try_to_binary(text, F.lit("base64")))).when(items.isNotNull(), F.size(items))
    filled = value.isNotNull() & ~F.is_variant_null(value)
    found = entries.groupBy("key").agg(
        F.schema_of_variant_agg(value).alias("type"), F.min(size).alias("least"), F.max(size).alias("most"),
        F.count_if(filled & size.isNull()).alias("unsized"))
    stats = found.orderBy("key").limit(max_fields + 1).collect()
    if len(stats) > max_fields:
        raise ValueError(f"more than {max_fields} different keys")
    absent = sorted({pk, *kinds, *([partition_key] if partition_key else [])} - {r["key"] for r in stats})
    if absent:
        raise ValueError(f"no line has the key {absent[0]}")
    fields, dynamic = [], False
    for r in stats:
        name, made = r["key"], _inferred(r, kinds.get(r["key"]))
        if made is None:
            if name in (pk, partition_key):
                raise ValueError(f"the values of {name} have no common type")
            dynamic = True
        elif isinstance(made, T.StructField):
            fields.append(made)
        else:
            flags = {"pk": True if name == pk else None, "partition_key": True if name == partition_key else None}
            fields.append(S.field(name, made, nullable=name != pk, **flags))
    return S.table_schema(fields, dynamic)


_SPARSE_ENTRY = re.compile(r"ARRAY<OBJECT<i: BIGINT, v: (?:BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\d+\))>>")
_FRACTION = re.compile(r"DECIMAL\(\d+, ?\d+\)|FLOAT")


def _inferred(stats: Row, kind: str | None) -> T.StructField | T.DataType | None:
    """The vector field or plain type of a key; None where its values have no common type."""
    name, found = stats["key"], _FRACTION.sub("DOUBLE", stats["type"])
    even = stats["least"] == stats["most"] and not stats["unsized"]
    wanted = {"dense": ("ARRAY<DOUBLE>", "ARRAY<BIGINT>"), "bits": ("ARRAY<BIGINT>",), "fp16": ("STRING",), "bf16": ("STRING",)}
    sparse = _SPARSE_ENTRY.fullmatch(stats["type"]) is not None
    if kind is not None:
        S.vector(name, kind, 8 if kind != "sparse" else None)  # refuses unknown kinds
        if not (sparse if kind == "sparse" else even and found in wanted[kind]):
            raise ValueError(f"{name} holds no {kind} vectors of one length")
    elif found == "ARRAY<DOUBLE>" and even and stats["least"] >= 2:
        kind = "dense"
    elif sparse:
        kind = "sparse"
    if kind == "sparse":
        return S.vector(name, kind)
    if kind is not None:
        entries = {"dense": stats["least"], "bits": 64 * stats["least"]}.get(kind, stats["least"] // 2)
        return S.vector(name, kind, entries)
    if found == "VOID":
        return T.StringType()
    return None if "VARIANT" in found or "VOID" in found else T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<"))
