"""Hybrid search: several searches over their own vector fields, fused into one ranked list.

A branch scans rows, probes the cells of an inverted-file index, or searches an index of sparse blocks.  Branches
that scan the same rows with bounded query sets are answered in one pass: a task keeps the best lists of all
of them, and one shuffle ranks them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.operators.ann import IvfIndex, ivf_search
from vecspark.operators.search import check_metric, check_paging, check_range, search, vector_kind
from vecspark.operators.sparse import search_blocks
from vecspark.plans import kernel, knn
from vecspark.plans.kernel import SIMILARITIES, Codec, Queries, Spec

RRF_K = 60.0  # fixed default of reciprocal rank fusion


@dataclass
class BlockIndex:
    """A written index of sparse blocks as what a branch searches."""

    blocks: DataFrame


@dataclass
class SubSearch:
    """One branch: what it searches, query vectors, limit and search options (an own offset is ignored).

    Options are those of ``search``, ``ivf_search`` (with ``nprobe``) or ``search_blocks``, after the kind of ``rows``.
    """

    rows: DataFrame | IvfIndex | BlockIndex
    queries: DataFrame
    k: int
    metric: str
    options: dict = field(default_factory=dict)


@dataclass
class Rrf:
    """Sum of 1 / (k + rank) over the branches that found the row."""

    k: float = RRF_K

    def term(self, branch: int, metric: str) -> Column:
        return F.lit(1.0) / (F.lit(float(self.k)) + F.col("rank"))

    def check(self, branches: int) -> None:
        if self.k <= 0:
            raise ValueError("rank constant must be positive")


@dataclass
class Weighted:
    """Weighted sum of scores brought into [0, 1]; a branch that missed the row adds nothing."""

    weights: Sequence[float]

    def term(self, branch: int, metric: str) -> Column:
        return F.lit(float(self.weights[branch])) * normalized(F.col("score"), metric)

    def check(self, branches: int) -> None:
        if len(self.weights) != branches:
            raise ValueError("one weight per sub-search is needed")
        if any(not 0 <= w <= 1 for w in self.weights):
            raise ValueError("weights must be in [0, 1]")


def normalized(score: Column, metric: str) -> Column:
    if metric == "IP":
        return F.lit(0.5) + F.atan(score) / F.lit(math.pi)
    if metric == "COSINE":
        return (F.lit(1.0) + score) / F.lit(2.0)
    return F.lit(1.0) - F.lit(2.0 / math.pi) * F.atan(score)


def hybrid_search(
    branches: Sequence[SubSearch], limit: int, reranker: Rrf | Weighted, *, pk: str, qid: str = "qid",
    offset: int = 0, rows: DataFrame | None = None, fields: Sequence[str] = (),
) -> DataFrame:
    """Fused top ``limit`` per query as (qid, rank, pk, score[, fields]).

    A query holds at most branches x 16384 candidates, so one shuffle by query id serves both the
    fusion and the ranking.  ``fields`` are joined from ``rows`` to the winners.
    """
    if not branches:
        raise ValueError("at least one sub-search is needed")
    check_paging(limit, offset)
    reranker.check(len(branches))

    def terms(hits: DataFrame, members: list[int]) -> DataFrame:
        """(qid, pk, branch, term) of ranked hits that name their branch."""
        term = F.coalesce(*[F.when(F.col("_branch") == n, reranker.term(n, branches[n].metric.upper())) for n in members])
        return hits.select(qid, pk, "_branch", term.alias("_term"))

    def alone(n: int, b: SubSearch) -> DataFrame:
        options = {key: v for key, v in b.options.items() if key != "offset"}
        own_pk = options.pop("pk", pk)
        if isinstance(b.rows, IvfIndex):
            own_pk, hits = b.rows.pk, ivf_search(b.rows, b.queries, b.k, metric=b.metric, qid=qid, **options)
        elif isinstance(b.rows, BlockIndex):
            if b.metric.upper() != "IP":
                raise ValueError("sparse blocks answer inner products only")
            hits = search_blocks(b.rows.blocks, b.queries, b.k, pk=own_pk, qid=qid, **options)
        else:
            hits = search(b.rows, b.queries, b.k, metric=b.metric, pk=own_pk, qid=qid, **options)
        return hits.select(qid, F.col(own_pk).alias(pk), F.lit(n).alias("_branch"), "rank", "score")

    found, left = [], list(range(len(branches)))
    while left:
        together = _same_rows(branches, left, pk, qid)
        left = [n for n in left if n not in together]
        ranked = one_pass(branches, together, pk, qid) if len(together) > 1 else None
        if ranked is None:
            found += [terms(alone(n, branches[n]), [n]) for n in together]
        else:
            found.append(terms(ranked, together))
    union = reduce(DataFrame.unionByName, found)
    parts = [F.max(F.when(F.col("_branch") == n, F.col("_term"))).alias(f"_t{n}") for n in range(len(branches))]
    total = reduce(lambda a, b: a + b, [F.coalesce(f"_t{n}", F.lit(0.0)) for n in range(len(branches))])
    fused = union.repartition(F.col(qid)).groupBy(qid, pk).agg(*parts).select(qid, pk, total.alias("score"))
    place = Window.partitionBy(qid).orderBy(F.col("score").desc(), F.col(pk))
    out = fused.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= offset + limit)
    out = out.where(F.col("rank") > offset).withColumn("rank", F.col("rank").cast("bigint"))
    if fields:
        out = out.join(rows.select(pk, *fields), pk)
    return out.select(qid, "rank", pk, "score", *fields)


SHARED_OPTIONS = {"vec", "where", "encoding", "radius", "range_filter", "offset"}


def _source(b: SubSearch) -> DataFrame:
    where = b.options.get("where")
    return b.rows if where is None else b.rows.where(where)


def _same_rows(branches: Sequence[SubSearch], left: list[int], pk: str, qid: str) -> list[int]:
    """The first of the ``left`` branches and those that can share its scan."""
    def plain(b: SubSearch) -> bool:
        return isinstance(b.rows, DataFrame) and "vec" in b.options and set(b.options) <= SHARED_OPTIONS and pk in b.rows.columns

    head = branches[left[0]]
    if not plain(head):
        return left[:1]
    kind = head.queries.schema[qid].dataType
    return [n for n in left if n == left[0] or plain(branches[n]) and branches[n].queries.schema[qid].dataType == kind
            and _source(branches[n]).sameSemantics(_source(head))]


def one_pass(branches: Sequence[SubSearch], members: list[int], pk: str, qid: str) -> DataFrame | None:
    """(qid, pk, _branch, rank, score) of branches over the same rows from one scan; None if a query set is too large for it."""
    source, jobs = _source(branches[members[0]]), []
    for n in members:
        b, metric = branches[n], branches[n].metric.upper()
        kind = vector_kind(b.rows.schema[b.options["vec"]], b.options.get("encoding"))
        check_metric(kind, metric)
        check_paging(b.k, 0)
        lower, upper = check_range(metric, b.options.get("radius"), b.options.get("range_filter"))
        table = knn.fetch_bounded(b.queries, qid, "qvec", kind, b.k * len(members))
        if table is None:
            return None
        jobs.append((n, b.options["vec"], table, Codec(kind), Spec(metric, b.k, pk, pk, [], lower, upper)))
    schema = T.StructType([branches[members[0]].queries.schema[qid], T.StructField("_branch", T.IntegerType()),
                           T.StructField("_cost", T.DoubleType()), source.schema[pk]])

    def run(batches):
        held = []
        for n, vec, table, codec, spec in jobs:
            asked = Queries(table, qid, "qvec", codec)
            held.append((n, vec, asked, kernel.Best(spec, asked.count)))
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for _, vec, asked, best in held:
                kernel.offer(best, rows, vec, asked)
        for n, _, asked, best in held:
            for part in best.batches(asked.ids, [qid, "_cost", pk]):
                cost = pc.multiply(part.column(1), best.spec.sign)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n] * part.num_rows, pa.int32()), cost, part.column(2)], schema.names)

    needed = list(dict.fromkeys([pk, *[vec for _, vec, *_ in jobs]]))
    best = source.select(*needed).mapInArrow(run, schema).repartition(F.col(qid), F.col("_branch"))
    per_key = Window.partitionBy(qid, "_branch", pk).orderBy("_cost")
    per_list = Window.partitionBy(qid, "_branch").orderBy("_cost", pk)
    first = best.withColumn("_n", F.row_number().over(per_key)).where("_n = 1").withColumn("rank", F.row_number().over(per_list))
    limit = F.coalesce(*[F.when(F.col("_branch") == n, F.lit(branches[n].k)) for n in members])
    falls = [n for n in members if branches[n].metric.upper() in SIMILARITIES]
    score = F.when(F.col("_branch").isin(falls), -F.col("_cost")).otherwise(F.col("_cost"))
    return first.where(F.col("rank") <= limit).select(qid, pk, "_branch", F.col("rank").cast("bigint").alias("rank"), score.alias("score"))
