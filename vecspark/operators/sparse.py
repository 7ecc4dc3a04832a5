"""Sparse vectors: postings tables with pruned reads, and search over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark import session
from vecspark.functions.packing import drop_smallest
from vecspark.operators.search import check_paging, check_range, search
from vecspark.plans import blocks, knn
from vecspark.plans.kernel import Spec
from vecspark.plans.pruning import is_wanted
from vecspark.session import materialize

ROW = "_row"
FILTER_DIMS = 10000  # up to this many query dimensions the postings scan gets an IN filter


def postings(rows: DataFrame, *, pk: str, vec: str, drop_ratio: float = 0.0, fields: Sequence[str] = ()) -> DataFrame:
    """(dim, pk, row, value, fields) entries, each row's smallest values dropped first.

    ``row`` tells rows apart that share a key; it holds for one evaluation, so the entries of an index are written.
    """
    carried = [f for f in fields if f != pk]
    kept = rows.select(pk, F.monotonically_increasing_id().alias(ROW), drop_smallest(vec, drop_ratio).alias("_v"), *carried)
    # the outer form adds no filter on the vector, which would compute a derived vector twice
    entries = kept.select(pk, ROW, F.inline_outer("_v").alias("dim", "value"), *carried).where(F.col("dim").isNotNull())
    return entries.select("dim", pk, ROW, "value", *carried)


def write_postings(rows: DataFrame, path: str, *, pk: str, vec: str, drop_ratio: float = 0.0, fields: Sequence[str] = ()) -> None:
    """Postings laid out by (dim, pk): range partitions split a frequent dimension over several files,
    and a search reads only the row groups of its own dimensions.  The entries are written once
    before, because choosing the ranges reads them a second time."""
    entries = materialize(postings(rows, pk=pk, vec=vec, drop_ratio=drop_ratio, fields=fields), "entries")
    entries.repartitionByRange("dim", pk).sortWithinPartitions("dim", pk).write.parquet(path)


def search_postings(
    index: DataFrame, queries: DataFrame, k: int, *, pk: str, qid: str = "qid", qvec: str = "qvec",
    drop_ratio: float = 0.0, where: Column | str | None = None, **options,
) -> DataFrame:
    """Top-k by inner product from a postings table; ``where``, ``fields`` and ``group_by`` may name the
    fields stored with the postings.

    Only the postings of the queries' dimensions are read; they are regrouped by row (at most one
    entry per query dimension) and scored block-wise, so no (query, row) pairs are shuffled.
    """
    asked = queries.withColumn(qvec, drop_smallest(qvec, drop_ratio))
    dims = asked.select(F.inline_outer(qvec).alias("dim", "_value")).select("dim").where("dim IS NOT NULL").distinct()
    some = [r.dim for r in dims.limit(FILTER_DIMS + 1).collect()]
    if len(some) <= FILTER_DIMS:
        wanted = index.where(is_wanted("dim", some))
    else:
        wanted = index.join(dims, "dim", "left_semi")
    if where is not None:
        wanted = wanted.where(where)
    carried = [c for c in index.columns if c not in ("dim", "value", pk, ROW)]
    entry = F.struct(F.col("dim").alias("i"), F.col("value").alias("v"))
    rows = wanted.groupBy(pk, ROW).agg(F.collect_set(entry).alias("_vec"), *[F.first(c).alias(c) for c in carried])
    return search(rows, asked, k, metric="IP", vec="_vec", pk=pk, qid=qid, qvec=qvec, **options)


def write_blocks(rows: DataFrame, path: str, *, pk: str, vec: str, drop_ratio: float = 0.0, fields: Sequence[str] = ()) -> None:
    """Postings in blocks of neighbouring rows, each with the bounds of its dimensions.  One narrow pass: rows stay in the
    order of their files, so tables written by key make blocks of key ranges."""
    keys = [pk, *[f for f in fields if f != pk]]
    kept = rows.select(*keys, drop_smallest(vec, drop_ratio).alias(vec))
    blocks.write(blocks.packed(kept, keys, vec), path)


def search_blocks(
    index: DataFrame, queries: DataFrame, k: int, *, pk: str, qid: str = "qid", qvec: str = "qvec", drop_ratio: float = 0.0,
    where: Column | str | None = None, fields: Sequence[str] = (), offset: int = 0, radius: float | None = None,
    range_filter: float | None = None, group_by: str | None = None, score: str = "score", skipped=None,
) -> DataFrame:
    """Top-k by inner product from an index of blocks; blocks that cannot reach a query's k-th score are skipped.

    ``skipped`` is an accumulator for the number of (query, block) pairs left out.  Filters, and query sets too large
    to travel with the scan, work on the unpacked rows.
    """
    asked = materialize(queries.select(qid, drop_smallest(qvec, drop_ratio).alias(qvec)), "asked")
    check_paging(k, offset)
    lower, upper = check_range("IP", radius, range_filter)
    options = dict(fields=fields, offset=offset, radius=radius, range_filter=range_filter, group_by=group_by, score=score)
    table = knn.fetch_bounded(asked, qid, qvec, "sparse", k + offset) if where is None else None
    if table is None:
        return search(blocks.unpacked(index, "_vec"), asked, k, metric="IP", vec="_vec", pk=pk, qid=qid, qvec=qvec, where=where, **options)
    carried = [f for f in fields if f not in (pk, group_by)]
    spec = Spec("IP", k + offset, pk, group_by or pk, carried, lower, upper)
    found = blocks.block_candidates(index, asked, table, qid=qid, qvec=qvec, score=score, spec=spec, skipped=skipped)
    hits = knn.rank_best(found, qid=qid, score=score, pk=pk, key=spec.key, k=k, offset=offset, similarity=True,
                         per_query=session.estimated_tasks(index) * spec.k)
    return hits.select(*dict.fromkeys([qid, "rank", pk, score, spec.key, *carried]))
