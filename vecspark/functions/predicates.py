"""Predicates over JSON (variant), dynamic and array fields.

A JSON comparison only holds when the stored value has the literal's type; a missing key, a JSON null
or another type gives no match, also under ``!=``.  All helpers return plain ``Column`` expressions, so
they combine with ``&``, ``|`` and ``~`` and stay inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = "$meta"
NUMERIC = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


def path_of(*keys: str | int) -> str:
    """JSON path for a chain of object keys and array positions; no keys means the whole value."""
    out = "$"
    for key in keys:
        if isinstance(key, bool) or not isinstance(key, (int, str)):
            raise ValueError("a JSON path takes names and positions")
        if isinstance(key, int) and key < 0:
            raise ValueError("negative positions are not supported")
        quote = '"' if "'" in str(key) else "'"
        out += f"[{key}]" if isinstance(key, int) else f"[{quote}{key}{quote}]"
    return out


def _value(v: Column | str, keys: Sequence[str | int]) -> Column:
    col = F.col(v) if isinstance(v, str) else v
    for at, key in enumerate(keys):
        if isinstance(key, str) and "'" in key and '"' in key:  # no path can name such a key
            outer = F.try_variant_get(_value(col, keys[:at]), "$", "map<string,variant>")
            return _value(F.try_element_at(outer, F.lit(key)), keys[at + 1:])
    return F.try_variant_get(col, path_of(*keys), "variant") if keys else col


def _typed(value: Column, pattern: str, as_type: str) -> Column:
    fits = F.schema_of_variant(value).rlike(pattern)
    return F.when(fits, F.try_variant_get(value, "$", as_type))


def j_num(v: Column | str, *keys: str | int) -> Column:
    """The JSON number at the path as double, null for anything else."""
    return _typed(_value(v, keys), NUMERIC, "double")


def j_int(v: Column | str, *keys: str | int) -> Column:
    """The JSON number at the path as decimal(38, 0): whole numbers beyond 2**53 stay exact."""
    return _typed(_value(v, keys), NUMERIC, "decimal(38,0)")


def j_str(v: Column | str, *keys: str | int) -> Column:
    return _typed(_value(v, keys), "^STRING$", "string")


def j_bool(v: Column | str, *keys: str | int) -> Column:
    return _typed(_value(v, keys), "^BOOLEAN$", "boolean")


def j_arr(v: Column | str, *keys: str | int) -> Column:
    """The JSON array at the path as array<variant>, null for anything else."""
    return _typed(_value(v, keys), "^ARRAY<", "array<variant>")


def j_eq(v: Column | str, literal, *keys: str | int) -> Column:
    """Type-strict equality with a Python literal (bool, number, text or list of those)."""
    value = _value(v, keys)
    if isinstance(literal, bool):
        return j_bool(value) == F.lit(literal)
    if isinstance(literal, int):
        return (j_num(value) == F.lit(float(literal))) if abs(literal) < 2**53 else (
            j_int(value) == F.lit(literal).cast("decimal(38,0)"))
    if isinstance(literal, float):
        return j_num(value) == F.lit(literal)
    if isinstance(literal, str):
        return j_str(value) == F.lit(literal)
    if isinstance(literal, (list, tuple)):
        items = j_arr(value)
        same = F.size(items) == len(literal)
        for i, one in enumerate(literal):
            same = same & F.coalesce(j_eq(F.get(items, F.lit(i)), one), F.lit(False))
        return F.when(items.isNotNull(), same)
    raise ValueError(f"cannot compare JSON with {type(literal).__name__}")


def j_ne(v: Column | str, literal, *keys: str | int) -> Column:
    """Different from the literal, but of a comparable type; a missing key never matches."""
    return ~j_eq(v, literal, *keys)


def j_in(v: Column | str, literals: Sequence, *keys: str | int) -> Column:
    value, match = _value(v, keys), F.lit(False)
    for one in _literal_list(literals):
        match = match | F.coalesce(j_eq(value, one), F.lit(False))
    return match


def j_exists(v: Column | str, *keys: str | int) -> Column:
    return F.coalesce(F.schema_of_variant(_value(v, keys)) != F.lit("VOID"), F.lit(False))


def j_contains(v: Column | str, literal, *keys: str | int) -> Column:
    items = j_arr(v, *keys)
    return F.coalesce(F.exists(items, lambda x: F.coalesce(j_eq(x, literal), F.lit(False))), F.lit(False))


def j_contains_all(v: Column | str, literals: Sequence, *keys: str | int) -> Column:
    match = F.lit(True)
    for one in _literal_list(literals):
        match = match & j_contains(v, one, *keys)
    return match


def j_contains_any(v: Column | str, literals: Sequence, *keys: str | int) -> Column:
    wanted = _literal_list(literals)
    items = j_arr(v, *keys)
    return F.coalesce(F.exists(items, lambda x: j_in(x, wanted)), F.lit(False))


def _literal_list(literals) -> list:
    if not isinstance(literals, (list, tuple)):
        raise ValueError("this predicate needs a list of literals")
    return list(literals)


# ---------------------------------------------------------------- declared and dynamic names

def field(df: DataFrame, name: str, as_type: str = "number") -> Column:
    """A declared column, or the dynamic key of that name read with the given JSON type."""
    if name in df.columns:
        return F.col(f"`{name}`")
    if META not in df.columns:
        raise ValueError(f"field {name} does not exist")
    readers = {"number": j_num, "int": j_int, "string": j_str, "bool": j_bool, "list": j_arr}
    return readers[as_type](F.col(f"`{META}`"), name)


def has_field(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.col(f"`{name}`").isNotNull()
    return j_exists(F.col(f"`{META}`"), name) if META in df.columns else F.lit(False)


def dynamic_typed(df: DataFrame, key: str, as_type: str, strict: bool = False) -> Column:
    """Typed read of a dynamic key (int, string, bool, double); ``strict`` fails on another type."""
    meta = F.col(f"`{META}`")
    readers = {"int": (j_int, "bigint"), "double": (j_num, "double"), "string": (j_str, "string"),
               "bool": (j_bool, "boolean")}
    if as_type not in readers:
        raise ValueError(f"unsupported dynamic type {as_type}")
    reader, spark_type = readers[as_type]
    value = reader(meta, key).cast(spark_type)
    if as_type == "int":  # fractions are cut off towards zero
        whole = F.schema_of_variant(_value(meta, [key])) == F.lit("BIGINT")
        value = F.when(whole, value).otherwise(j_num(meta, key).try_cast("bigint"))
    if not strict:
        return value
    wrong = j_exists(meta, key) & value.isNull()
    return F.when(wrong, F.raise_error(F.lit(f"dynamic key {key} is not {as_type}")).cast(spark_type)).otherwise(value)


def check_scalar(df: DataFrame, name: str) -> Column:
    """Refuse vector fields in scalar predicates."""
    t = df.schema[name].dataType
    if isinstance(t, T.BinaryType) or df.schema[name].metadata.get("dim"):
        raise ValueError(f"vector field {name} cannot be used in a scalar predicate")
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- array fields

def a_get(arr: Column | str, index: int) -> Column:
    """Element at a position; null (so: no match) past the end."""
    if index < 0:
        raise ValueError("negative positions are not supported")
    return F.get(arr, F.lit(index))


def a_contains(arr: Column | str, literal) -> Column:
    return F.coalesce(F.array_contains(arr, F.lit(literal)), F.lit(False))


def a_contains_all(arr: Column | str, literals: Sequence) -> Column:
    match = F.lit(True)
    for one in _literal_list(literals):
        match = match & a_contains(arr, one)
    return match


def a_contains_any(arr: Column | str, literals: Sequence) -> Column:
    match = F.lit(False)
    for one in _literal_list(literals):
        match = match | a_contains(arr, one)
    return match


def a_equal(arr: Column | str, literals: Sequence, element: str) -> Column:
    wanted = F.array(*[F.lit(x) for x in _literal_list(literals)]).cast(f"array<{element}>")
    return (F.col(arr) if isinstance(arr, str) else arr) == wanted


def a_length(arr: Column | str) -> Column:
    return F.size(arr)
