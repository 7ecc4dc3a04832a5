"""Vector search: top-k, filtered, paged, range and best-per-group, over any vector encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import session
from vecspark.plans import knn, pivots
from vecspark.plans.kernel import BINARY, SIMILARITIES, Codec, Spec

# Fixed engine limits.
MAX_TOP_K = 16384
GROUP_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.StringType)
DENSE_METRICS = ("L2", "IP", "COSINE")
SPARSE_METRICS = ("IP",)


def vector_kind(field: T.StructField, encoding: str | None = None) -> str:
    """dense, bits, fp16, bf16 or sparse, from the Spark type plus the field's metadata."""
    kind = encoding or field.metadata.get("encoding")
    if kind:
        return kind
    t = field.dataType
    if isinstance(t, T.ArrayType):
        if isinstance(t.elementType, (T.FloatType, T.DoubleType)):
            return "dense"
        if isinstance(t.elementType, T.LongType):
            return "bits"
        if isinstance(t.elementType, T.StructType):
            return "sparse"
    raise ValueError(f"field {field.name} is not a vector; name a vector field or its encoding")


def vector_fields(schema: T.StructType) -> list[str]:
    found = []
    for f in schema.fields:
        try:
            vector_kind(f)
        except ValueError:
            continue
        found.append(f.name)
    return found


def check_metric(kind: str, metric: str) -> None:
    allowed = {"bits": BINARY, "sparse": SPARSE_METRICS}.get(kind, DENSE_METRICS)
    if metric not in allowed:
        raise ValueError(f"metric {metric} does not fit a {kind} vector; use one of {', '.join(allowed)}")


def check_paging(k: int, offset: int) -> None:
    if not 1 <= k <= MAX_TOP_K:
        raise ValueError(f"top-k must be in [1, {MAX_TOP_K}]")
    if offset < 0 or offset + k > MAX_TOP_K:
        raise ValueError(f"offset + limit must be in [1, {MAX_TOP_K}]")


def check_range(metric: str, radius: float | None, range_filter: float | None) -> tuple[float | None, float | None]:
    """(lower, upper) of the half-open score interval."""
    if range_filter is not None and radius is None:
        raise ValueError("range_filter needs a radius")
    if radius is None:
        return None, None
    if metric in SIMILARITIES:
        if range_filter is not None and range_filter <= radius:
            raise ValueError("range_filter must be above radius for a similarity")
        return radius, range_filter
    if range_filter is not None and range_filter >= radius:
        raise ValueError("range_filter must be below radius for a distance")
    return range_filter, radius


def search(
    rows: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    metric: str,
    vec: str | None = None,
    pk: str,
    qid: str = "qid",
    qvec: str = "qvec",
    where: Column | str | None = None,
    fields: Sequence[str] = (),
    fetch: str = "carry",
    offset: int = 0,
    radius: float | None = None,
    range_filter: float | None = None,
    group_by: str | None = None,
    encoding: str | None = None,
    codec: Codec | None = None,
    keep_empty: bool = False,
    score: str = "score",
) -> DataFrame:
    """Best ``k`` rows per query vector as (qid, rank, pk, score[, group][, fields]).

    ``where`` is applied before ranking.  ``fields`` ride along with the scan (``fetch="carry"``) or,
    for wide payloads of tables with unique primary keys, are joined to the winners afterwards
    (``fetch="join"``).  ``keep_empty`` also returns one row with nulls for a query without hits.
    """
    metric = metric.upper()
    vec = vec or _only_vector(rows)
    kind = codec.kind if codec else vector_kind(rows.schema[vec], encoding)
    check_metric("dense" if kind in ("sq8", "pq") else kind, metric)
    check_paging(k, offset)
    lower, upper = check_range(metric, radius, range_filter)
    if group_by is not None:
        check_group(rows, group_by, kind, radius)
    fields = [f for f in fields if f not in (pk, group_by)]
    carried = fields if fetch == "carry" else []
    source = rows if where is None else rows.where(where)
    spec = Spec(metric, k + offset, pk, group_by or pk, carried, lower, upper)
    opts = dict(vec=vec, qid=qid, qvec=qvec, score=score, codec=codec or Codec(kind), spec=spec)

    table = knn.fetch_bounded(queries, qid, qvec, kind, spec.k)
    if table is not None:
        candidates = knn.scan_candidates(source, queries, table, **opts)
        per_query = session.estimated_tasks(source) * spec.k
    else:
        candidates = pivots.pivot_candidates(source, queries, **opts)
        per_query = session.estimated_tasks(source) * 8 * spec.k  # stored files unpack into several blocks
    hits = knn.rank_best(
        candidates, qid=qid, score=score, pk=pk, key=spec.key, k=k, offset=offset,
        similarity=metric in SIMILARITIES, per_query=per_query,
    )
    if fetch == "join" and fields:
        hits = hits.join(source.select(pk, *fields), pk)
    if keep_empty:
        hits = queries.select(qid).join(hits, qid, "left")
    head = [qid, "rank", pk, score] + ([group_by] if group_by and group_by != pk else [])
    return hits.select(*head, *fields)


def _only_vector(rows: DataFrame) -> str:
    found = vector_fields(rows.schema)
    if len(found) != 1:
        raise ValueError(f"name the vector field; the table has {len(found)}")
    return found[0]


def check_group(rows: DataFrame, group_by: str, kind: str, radius: float | None) -> None:
    if not isinstance(rows.schema[group_by].dataType, GROUP_TYPES):
        raise ValueError("group-by accepts integer, boolean and text fields")
    if kind == "bits":
        raise ValueError("group-by does not accept binary vectors")
    if radius is not None:
        raise ValueError("group-by cannot be combined with range search")


def count_hits(hits: DataFrame, qid: str = "qid") -> DataFrame:
    return hits.groupBy(qid).agg(F.count("*").alias("hits"))
