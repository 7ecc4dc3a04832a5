"""Row-wise distances between two vector columns, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vecspark.functions.packing import _c


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0).cast("double"), lambda a, x: a + x)


def l2(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance."""
    def square(x, y):
        d = x.cast("double") - y.cast("double")
        return d * d

    return _sum(F.zip_with(_c(a), _c(b), square))


def ip(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column | str, b: Column | str, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity; null when a norm is zero.  Pass stored norms to spare recomputing them."""
    scale = (norm_a if norm_a is not None else norm(a)) * (norm_b if norm_b is not None else norm(b))
    return F.when(scale > 0, ip(a, b) / scale)


def _bits(a, b, combine) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: F.bit_count(combine(x, y)).cast("bigint")),
                       F.lit(0).cast("bigint"), lambda s, x: s + x)


def hamming(a: Column | str, b: Column | str) -> Column:
    return _bits(a, b, lambda x, y: x.bitwiseXOR(y))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """1 - shared / all set bits; two empty vectors are at distance 0."""
    either = _bits(a, b, lambda x, y: x.bitwiseOR(y))
    both = _bits(a, b, lambda x, y: x.bitwiseAND(y))
    return F.when(either > 0, F.lit(1.0) - both / either).otherwise(F.lit(0.0))


def tanimoto(a: Column | str, b: Column | str) -> Column:
    """-log2 of the shared part; infinite for disjoint vectors."""
    shared = F.lit(1.0) - jaccard(a, b)
    return F.when(shared > 0, -F.log2(shared)).otherwise(F.lit(float("inf")))


def substructure(q: Column | str, b: Column | str) -> Column:
    """Every bit of ``q`` is set in ``b``."""
    return F.forall(F.zip_with(_c(q), _c(b), lambda x, y: x.bitwiseAND(y) == x), lambda ok: ok)


def superstructure(q: Column | str, b: Column | str) -> Column:
    """Every bit of ``b`` is set in ``q``."""
    return substructure(b, q)


def sparse_ip(a: Column | str, b: Column | str) -> Column:
    """Inner product of two sorted sparse rows; null when they share no dimension.

    The two entry lists are merged by dimension; equal neighbours multiply.
    """
    merged = F.sort_array(F.concat(_c(a), _c(b)))
    start = F.struct(F.lit(-1).cast("bigint").alias("i"), F.lit(0.0).alias("v"),
                     F.lit(0.0).alias("s"), F.lit(False).alias("hit"))

    def step(acc, e):
        v = e["v"].cast("double")
        match = acc["i"] == e["i"]
        return F.struct(e["i"].alias("i"), v.alias("v"),
                        F.when(match, acc["s"] + acc["v"] * v).otherwise(acc["s"]).alias("s"),
                        (acc["hit"] | match).alias("hit"))

    return F.aggregate(merged, start, step, lambda acc: F.when(acc["hit"], acc["s"]))
