"""k-nearest-neighbour plans: a broadcast scan for bounded query sets, a block grid beyond.

Broadcast scan: the queries (size checked) travel with the task closure, every scan task keeps its
own k best rows per query, and only those reach the shuffle.

Block grid: rows and queries are cut into bounded blocks, each (query block, row block) pair meets in
one cogroup task that again emits only its k best rows per query.  Both give the same answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vecspark import session
from vecspark.plans import kernel
from vecspark.plans.kernel import Codec, Queries, Spec

GRID_QUERIES = 2048  # rows of one query block, more where a grid has more than GRID_ROUNDS blocks a core
MOST_QUERIES = 1 << 16
GRID_ROUNDS = 2
GRID_ROWS = 1 << 16  # rows of one row block
BLOCK_BYTES = 64 << 20  # stored bytes of one row block
STATE_ROWS = 4 << 20  # best-list entries one task may hold
SALT_ABOVE = 1 << 20  # candidates of one query that one task ranks
DEALT_KEYS = 4096  # more blocks even out by themselves


# ---------------------------------------------------------------- query side

def _unpacked(kind: str) -> int:
    """How much a query grows when decoded in a task."""
    return {"bits": 32, "fp16": 4, "bf16": 4, "sparse": 1}.get(kind, 2)


def fetch_bounded(queries: DataFrame, qid: str, qvec: str, kind: str = "dense", k: int = 1) -> pa.Table | None:
    """The query table if it, decoded, and its running best lists fit in every task; else None."""
    narrow = queries.select(qid, qvec).where(F.col(qvec).isNotNull())
    table = narrow.limit(session.PROBE_ROWS + 1).toArrow()
    if table.num_rows == 0:
        raise ValueError("at least one query vector is needed")
    grown = table.nbytes * _unpacked(kind)
    if grown > session.BROADCAST_BYTES or table.num_rows * k > STATE_ROWS:
        return None
    if table.num_rows <= session.PROBE_ROWS:
        return table
    count, width = narrow.agg(F.count("*"), F.max(_width(queries, qvec))).first()
    if count * (width * 8 + 32) * _unpacked(kind) > session.BROADCAST_BYTES or count * k > STATE_ROWS:
        return None
    return narrow.limit(count).toArrow()


def _width(df: DataFrame, name: str) -> Column:
    """Stored entries of a vector."""
    return F.length(name) if isinstance(df.schema[name].dataType, T.BinaryType) else F.size(name)


def block_sizes(queries: DataFrame, qvec: str, kind: str, k: int = 1, wanted: int = 0, stored: int = 0) -> tuple[int, int]:
    """(rows, queries) per grid block such that decoded blocks and best lists stay bounded.

    A block has ``wanted`` queries if those are more than GRID_QUERIES and within the bounds.  ``stored`` are the bytes of a
    row that is decoded in pieces only.
    """
    entries = max(1, queries.agg(F.max(_width(queries, qvec))).first()[0] or 1)
    decoded = entries * (64 if kind == "bits" else 1)
    rows = BLOCK_BYTES // stored if stored else min(GRID_ROWS, BLOCK_BYTES // (entries * 8))
    asked = min(max(GRID_QUERIES, min(wanted, MOST_QUERIES, STATE_ROWS // (4 * k))), STATE_ROWS // k, 2 * kernel.CELLS // decoded)
    return max(1, rows), max(1, asked)


def dealt_evenly(spark: SparkSession, number: Column, n: int) -> Column:
    """``number``, from 0 to n - 1, as a key that a shuffle deals evenly over its partitions, which hashes of few keys do not."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if n > DEALT_KEYS or parts > DEALT_KEYS:
        return number.cast("long")
    each = -(-n // parts)
    drawn = spark.range(parts * (8 * each + 32)).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("part")).toArrow()
    ids, part = drawn["id"].to_numpy(), drawn["part"].to_numpy()
    order = np.argsort(part, kind="stable")
    turn = np.arange(len(ids)) - np.searchsorted(part[order], part[order])  # place of a key among those of its partition
    keys = ids[order][np.lexsort((part[order], turn))][:n]
    return F.element_at(F.expr(f"array({', '.join(f'{k}L' for k in keys)})"), number.cast("int") + 1)


# ---------------------------------------------------------------- candidate generation

def _output_schema(rows: DataFrame, queries: DataFrame, qid: str, score: str, kept: list[str]) -> T.StructType:
    out = [T.StructField(qid, queries.schema[qid].dataType), T.StructField(score, T.DoubleType())]
    return T.StructType(out + [T.StructField(c, rows.schema[c].dataType) for c in kept])


def kept_columns(spec: Spec) -> list[str]:
    return list(dict.fromkeys([spec.pk, spec.key, *spec.carry]))


def scan_candidates(
    rows: DataFrame, queries: DataFrame, table: pa.Table, *, vec: str, qid: str, qvec: str, score: str,
    codec: Codec, spec: Spec, probes: dict[int, np.ndarray] | None = None, cell: str | None = None,
) -> DataFrame:
    """Broadcast scan: each task emits its k best rows per query."""
    kept = kept_columns(spec)
    schema = _output_schema(rows, queries, qid, score, kept)
    names = schema.names

    def run(batches):
        asked = Queries(table, qid, qvec, codec)
        best = kernel.Best(spec, asked.count)
        for batch in batches:
            kernel.offer(best, pa.Table.from_batches([batch]), vec, asked, probes, cell)
        yield from best.batches(asked.ids, names)

    needed = list(dict.fromkeys([*kept, vec, *([cell] if cell else [])]))
    return rows.select(*needed).mapInArrow(run, schema)


def grid(
    rows: DataFrame, queries: DataFrame, *, vec: str, qvec: str, cell: str | None = None,
    query_cells: str | None = None, kind: str = "dense", k: int = 1, grow: bool = False, stored: int = 0,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides cut into bounded blocks, and the columns on which the blocks meet.

    Rows are dealt round-robin, so no key, cell or group of copies decides a block's size, and dealing
    is repeatable, so a lost task recomputes the same blocks.  With ``cell`` only rows and queries of
    one cell meet; a cell is spread over as many blocks as its row count asks for.  Every row is sent once per query block;
    with ``grow`` these grow with the queries until they reach their bounds, for plans that keep a few rows per query.
    """
    base = rows.where(F.col(vec).isNotNull())
    asked = queries.where(F.col(qvec).isNotNull())
    many = asked.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    block_rows, query_rows = block_sizes(queries, qvec, kind, k, -(-many // (GRID_ROUNDS * cores)) if grow else 0, stored)
    row_blocks = max(1, -(-base.count() // block_rows))
    q_blocks = max(1, -(-many // query_rows))
    # fewer blocks than cores are dealt by as many tasks as there are cores
    dealt = base.repartition(row_blocks * -(-cores // row_blocks)).withColumn("_rb", F.pmod(F.spark_partition_id(), F.lit(row_blocks)))
    asked = asked.repartition(q_blocks).withColumn("_qb", F.spark_partition_id())
    on, blocks = ["_block"], F.lit(row_blocks)
    if cell:
        on = [cell, "_qb", "_rb"]
        sizes = base.groupBy(cell).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("_blocks"))
        dealt = dealt.join(sizes, cell).withColumn("_rb", F.pmod("_rb", "_blocks")).drop("_blocks")
        asked = asked.withColumn(cell, F.explode(query_cells)).drop(query_cells).join(sizes, cell)
        blocks = F.col("_blocks")
    dealt = dealt.withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    asked = asked.withColumn("_rb", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("_blocks")
    if not cell:
        block = dealt_evenly(rows.sparkSession, F.col("_qb") * row_blocks + F.col("_rb"), q_blocks * row_blocks)
        dealt, asked = (side.withColumn("_block", block).drop("_qb", "_rb") for side in (dealt, asked))
    return dealt, asked, on


def grid_candidates(
    rows: DataFrame, queries: DataFrame, *, vec: str, qid: str, qvec: str, score: str, codec: Codec,
    spec: Spec, cell: str | None = None, query_cells: str | None = None,
) -> DataFrame:
    """Block grid for query sets too large to broadcast."""
    rows = rows.select(*dict.fromkeys([*kept_columns(spec), vec, *([cell] if cell else [])]))
    queries = queries.select(qid, qvec, *([query_cells] if query_cells else []))
    narrow = codec.kind == "pq" and all(isinstance(rows.schema[c].dataType, T.NumericType) for c in kept_columns(spec))
    stored = 64 + 8 * len(kept_columns(spec)) + codec.books.shape[0] * np.dtype(kernel.code_type(codec.books)).itemsize if narrow else 0
    dealt, asked, on = grid(rows, queries, vec=vec, qvec=qvec, cell=cell, query_cells=query_cells, kind=codec.kind, k=spec.k, grow=True,
                            stored=stored)
    return met_blocks(dealt, asked, on, rows, queries, vec=vec, qid=qid, qvec=qvec, score=score, codec=codec, spec=spec)


def met_blocks(
    dealt: DataFrame, asked: DataFrame, on: list[str], rows: DataFrame, queries: DataFrame, *, vec: str, qid: str, qvec: str,
    score: str, codec: Codec, spec: Spec,
) -> DataFrame:
    """Best lists of every pair of a row block and a query block; ``on`` names the columns that pair them."""
    schema = _output_schema(rows, queries, qid, score, kept_columns(spec))
    names, nothing = schema.names, to_arrow_schema(schema).empty_table()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return nothing
        asked = Queries(right, qid, qvec, codec)
        best = kernel.Best(spec, asked.count)
        kernel.offer(best, left, vec, asked)
        out = list(best.batches(asked.ids, names))
        return pa.Table.from_batches(out) if out else nothing

    return dealt.groupBy(*on).cogroup(asked.groupBy(*on)).applyInArrow(meet, schema)


# ---------------------------------------------------------------- final ranking

def rank_best(
    candidates: DataFrame, *, qid: str, score: str, pk: str, key: str, k: int, offset: int = 0,
    similarity: bool = False, per_query: int = 0,
) -> DataFrame:
    """Best row per (query, key), then positions offset+1 .. offset+k per query.

    One shuffle on the query id serves both windows.  When a query collects very many candidates they
    are first ranked in slices of about ``SALT_ABOVE`` rows, so no single task sorts them all.
    """
    direction = F.col(score).desc() if similarity else F.col(score).asc()
    need = offset + k

    def best(df: DataFrame, by: list[str]) -> DataFrame:
        per_key = Window.partitionBy(*by, key).orderBy(direction, F.col(pk))
        per_qid = Window.partitionBy(*by).orderBy(direction, F.col(pk))
        df = df.withColumn("_first", F.row_number().over(per_key)).where("_first = 1").drop("_first")
        return df.withColumn("rank", F.row_number().over(per_qid)).where(F.col("rank") <= need)

    while per_query > SALT_ABOVE and need * 2 <= SALT_ABOVE:
        # slice by key so that every candidate of one key is judged in one slice
        slices = -(-per_query // SALT_ABOVE)
        salted = candidates.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(slices)))
        candidates = best(salted.repartition(F.col(qid), F.col("_salt")), [qid, "_salt"]).drop("_salt", "rank")
        per_query = slices * need
    ranked = best(candidates.repartition(F.col(qid)), [qid])
    ranked = ranked.where(F.col("rank") > offset) if offset else ranked
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))

