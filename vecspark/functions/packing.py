"""Vector encodings as column expressions: packed bits, half precision, sparse rows, long form."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPARSE = T.ArrayType(T.StructType([T.StructField("i", T.LongType()), T.StructField("v", T.FloatType())]))
MAX_SPARSE_INDEX = 2**32 - 1
GROUP_BYTES = 2 << 20  # text whose terms are counted at once
GROUP_ENTRIES = 1 << 18  # entries that are ranked at once
KNOWN_WORDS = 1 << 16  # words whose dimension is kept between groups


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- packed bits

def pack_bits(vec: Column | str, dim: int) -> Column:
    """Positive entries become set bits, 64 per bigint word, lowest bit first."""
    if dim % 8 or not 2 <= dim <= 262144:
        raise ValueError("a binary vector's dimension is a multiple of 8 up to 262144")
    v = _c(vec)

    def word(w: Column) -> Column:
        part = F.slice(v, w * 64 + 1, F.least(F.lit(64), F.lit(dim) - w * 64))
        bits = F.transform(part, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i))
                           .otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))

    return F.transform(F.sequence(F.lit(0), F.lit(-(-dim // 64) - 1)), word)


def bit_total(words: Column | str) -> Column:
    """Number of set bits."""
    return F.aggregate(_c(words), F.lit(0).cast("bigint"), lambda a, w: a + F.bit_count(w).cast("bigint"))


# ---------------------------------------------------------------- half precision

@F.arrow_udf(T.BinaryType())
def pack_fp16(vec: pa.Array) -> pa.Array:
    return _pack(vec, lambda x: x.astype("<f2"))


@F.arrow_udf(T.BinaryType())
def pack_bf16(vec: pa.Array) -> pa.Array:
    """Keeps the upper 16 bits of every f32."""
    return _pack(vec, lambda x: (x.astype("<f4").view("<u4") >> 16).astype("<u2"))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def unpack_fp16(raw: pa.Array) -> pa.Array:
    return _unpack(raw, lambda x: x.view("<f2").astype(np.float32))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def unpack_bf16(raw: pa.Array) -> pa.Array:
    return _unpack(raw, lambda x: (x.view("<u2").astype("<u4") << 16).view("<f4"))


def _pack(vec: pa.Array, narrow) -> pa.Array:
    values = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    data = narrow(values).view(np.uint8)
    ends = np.concatenate([[0], np.cumsum(vec.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]) * 2
    return _binary(ends, data, vec)


def _binary(ends, data, like: pa.Array) -> pa.Array:
    made = pa.Array.from_buffers(pa.binary(), len(like), [None, pa.py_buffer(ends.astype(np.int32).tobytes()),
                                                          pa.py_buffer(data.tobytes())])
    return pa.compute.if_else(like.is_valid(), made, pa.scalar(None, pa.binary())) if like.null_count else made


def _unpack(raw: pa.Array, widen) -> pa.Array:
    items = raw.to_pylist()
    data = np.frombuffer(b"".join(b or b"" for b in items), np.uint8)
    ends = np.cumsum([0] + [len(b or b"") // 2 for b in items]).astype(np.int32)
    values = pa.array(widen(data).astype(np.float32), pa.float32())
    mask = pa.array([b is None for b in items]) if raw.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=mask)


# ---------------------------------------------------------------- sparse rows

def pack_sparse(positions: Column | str, values: Column | str) -> Column:
    """Parallel position and value arrays -> entries sorted by position."""
    p, v = _c(positions), _c(values)
    pairs = F.zip_with(p, v, lambda i, x: F.struct(i.cast("bigint").alias("i"), x.cast("float").alias("v")))
    same = F.size(p) == F.size(v)
    return F.when(same, F.sort_array(pairs)).otherwise(
        F.raise_error(F.lit("sparse vector: positions and values differ in number")).cast(SPARSE))


def sparse_dim(vec: Column | str) -> Column:
    """Highest position + 1; 0 for an empty row."""
    return F.coalesce(F.array_max(F.transform(_c(vec), lambda e: e["i"])) + 1, F.lit(0).cast("bigint"))


def drop_smallest(vec: Column | str, ratio: float) -> Column:
    """Drop the floor(ratio * entries) entries of smallest magnitude (ties: highest position first)."""
    if not 0 <= ratio < 1:
        raise ValueError("drop ratio must be in [0, 1)")
    if ratio == 0:
        return _c(vec)

    def kept(rows: pa.Array) -> pa.Array:
        count = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(rows)), count)
        entries = rows.flatten()
        size = np.abs(entries.field(1).to_numpy(zero_copy_only=False))
        order = np.lexsort((entries.field(0).to_numpy(zero_copy_only=False), -size, row))
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        keep = np.zeros(len(row), bool)
        keep[order] = place < (count - np.floor(count * ratio))[row]
        left = np.bincount(row[keep], minlength=len(rows))
        ends = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), entries.filter(pa.array(keep)),
                                        mask=rows.is_null() if rows.null_count else None)

    @F.arrow_udf(SPARSE)
    def drop(rows: pa.Array) -> pa.Array:
        sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return _joined([kept(rows.slice(lo, hi - lo)) for lo, hi in row_groups(sizes, GROUP_ENTRIES)] or [kept(rows)])

    return drop(vec)


def row_groups(sizes: np.ndarray, limit: int, most: int | None = None):
    """Ranges of neighbouring rows whose sizes add up to at most ``limit``, or of one larger row; ``most`` bounds their number."""
    ends, lo = np.cumsum(sizes, dtype=np.int64), 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        hi = hi if most is None else min(hi, lo + most)
        yield lo, hi
        lo = hi


def _joined(parts: list[pa.Array]) -> pa.Array:
    return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)


@F.arrow_udf(SPARSE)
def term_vector(text: pa.Array) -> pa.Array:
    """Term counts of a text as a sparse row.

    Terms are runs of a-z and 0-9 after lower-casing; a term's dimension is the first 32 bits of its
    md5.  Only the distinct terms of a batch are hashed, and terms are taken from GROUP_BYTES of text at a time.
    """
    known, sizes = {}, pa.compute.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False)
    groups = list(row_groups(sizes, GROUP_BYTES)) or [(0, 0)]
    return _joined([_counted_terms(text.slice(lo, hi - lo), known) for lo, hi in groups])


def _counted_terms(text: pa.Array, known: dict[str, int]) -> pa.Array:
    pc = pa.compute
    terms = pc.split_pattern_regex(pc.utf8_lower(text), "[^a-z0-9]+")
    row = np.repeat(np.arange(len(text)), terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    coded = terms.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    if len(known) > KNOWN_WORDS:
        known.clear()
    for w in words:
        if w not in known:
            known[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
    dims = np.array([known[w] for w in words], np.uint64)
    code = coded.indices.to_numpy(zero_copy_only=False)
    real = np.array([w != "" for w in words], bool)[code] if len(code) else np.zeros(0, bool)
    pairs = (row[real].astype(np.uint64) << np.uint64(32)) | dims[code[real]]
    entry, count = np.unique(pairs, return_counts=True)
    ends = np.searchsorted(entry >> np.uint64(32), np.arange(len(text) + 1)).astype(np.int32)
    items = pa.StructArray.from_arrays(
        [pa.array((entry & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(count.astype(np.float32))], ["i", "v"])
    mask = text.is_null() if text.null_count else None
    return pa.ListArray.from_arrays(pa.array(ends), items, mask=mask)


# ---------------------------------------------------------------- long form

def flatten_vectors(df: DataFrame, pk: str, vec: str) -> DataFrame:
    """One row per (pk, dimension)."""
    return df.select(pk, F.posexplode(vec).alias("dim", "value"))


def collect_vectors(long: DataFrame, pk: str, element: str = "float") -> DataFrame:
    """Rebuild vectors from (pk, dim, value); a group is one vector, so at most 32768 entries."""
    entries = F.sort_array(F.collect_list(F.struct("dim", "value")))
    return long.groupBy(pk).agg(F.transform(entries, lambda e: e["value"].cast(element)).alias("vector"))
