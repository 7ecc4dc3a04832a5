"""All-pairs distances between two vector sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vecspark.operators.search import check_metric, vector_kind
from vecspark.plans import kernel, knn
from vecspark.plans.kernel import Codec

INTEGER_METRICS = ("HAMMING",)


def stored_vectors(ids: DataFrame, rows: DataFrame, pk: str, vec: str) -> DataFrame:
    """Turn a side given as ids into their stored vectors."""
    return rows.select(pk, vec).join(ids.select(pk), pk)


def calc_distance(
    left_rows: DataFrame, right_rows: DataFrame, metric: str, *, left: tuple[str, str], right: tuple[str, str],
) -> DataFrame:
    """(left id, right id, distance) for every pair; Hamming distances are integers.

    The result itself is left x right rows.  The smaller-than-bound right side travels with the scan
    of the left side; a larger one is cut into blocks that meet blocks of the left side.
    """
    (lid, lvec), (rid, rvec) = left, right
    metric = metric.upper()
    kind = vector_kind(left_rows.schema[lvec])
    check_metric(kind, metric)
    whole = metric in INTEGER_METRICS
    schema = T.StructType([
        T.StructField(lid, left_rows.schema[lid].dataType), T.StructField(rid, right_rows.schema[rid].dataType),
        T.StructField("distance", T.LongType() if whole else T.DoubleType())])
    codec = Codec(kind)

    def pairs(rows: pa.Table, other: kernel.Queries):
        rows = rows.filter(rows[lvec].is_valid())
        for block, at, own in other.parts():
            width = max(1, kernel.CELLS // max(1, max(len(at) * 4, block.matrix.shape[1])))
            for start in range(0, rows.num_rows, width):
                piece = rows.slice(start, width)
                v, seen = kernel.decode_rows(piece[lvec].combine_chunks(), own)
                if v.shape[1] != block.matrix.shape[1]:
                    raise ValueError("vector dimension does not match the other side")
                score = kernel.block_scores(v, np.einsum("ij,ij->i", v, v), block, metric)
                known = ~np.isnan(score) if seen is None else (block.seen @ seen.T > 0)
                i, j = np.nonzero(known.T)  # pairs of one row together
                exact = score[j, i] if metric in kernel.BINARY else kernel.settled_scores(v, block.matrix, i, j, metric)
                found = exact.astype(np.int64 if whole else np.float64)
                yield pa.RecordBatch.from_arrays([
                    piece[lid].combine_chunks().take(pa.array(i)), other.ids.take(pa.array(at[j])), pa.array(found)],
                    names=schema.names)

    table = knn.fetch_bounded(right_rows, rid, rvec, kind)
    if table is not None:
        def run(batches):
            other = kernel.Queries(table, rid, rvec, codec)
            for batch in batches:
                yield from pairs(pa.Table.from_batches([batch]), other)

        return left_rows.select(lid, lvec).mapInArrow(run, schema)
    dealt, asked, on = knn.grid(left_rows.select(lid, lvec), right_rows.select(rid, rvec), vec=lvec, qvec=rvec, kind=kind)
    empty = to_arrow_schema(schema).empty_table()

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        found = list(pairs(a, kernel.Queries(b, rid, rvec, codec))) if a.num_rows and b.num_rows else []
        return pa.Table.from_batches(found) if found else empty

    return dealt.groupBy(*on).cogroup(asked.groupBy(*on)).applyInArrow(meet, schema)


def score_all(
    rows: DataFrame, queries: DataFrame, metric: str, *, pk: str, vec: str, qid: str, qvec: str, score: str,
) -> DataFrame:
    """(query, row, score) for every pair that has a score."""
    pairs = calc_distance(rows, queries, metric, left=(pk, vec), right=(qid, qvec))
    return pairs.select(qid, pk, pairs["distance"].cast("double").alias(score))
