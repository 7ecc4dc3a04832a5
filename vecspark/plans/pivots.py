"""k-NN join by pivots: rows travel only to the query cells that they can still reach.

Pivots are query vectors, drawn by hash and then chosen far from each other.  Every query belongs to the cell of its nearest pivot; U is the
largest distance of a cell's queries from its pivot, and K the distance of the pivot's own k-th nearest key,
found in one broadcast scan of the rows.  By the triangle inequality every query of the cell has k keys within
U + K, so a row at distance d from the pivot can be among a query's best only if d <= U + (U + K); a range
search replaces U + K by its radius where that is smaller.  Inner products have no triangle inequality; there
p * v + U * |v| bounds what a row can score for a query of the cell, and the k-th largest p * v - U * |v|
what every query has for certain.  Cosine is the distance of unit vectors.

The number of pivots follows the number of queries, so cells shrink as queries grow.  Neighbouring cells form
a group of about one block of queries, and a row is sent once per group, not once per cell.  Vectors too spread out for that (reach measured on rows drawn by hash) take the block grid; both give the
same answer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.plans import kernel, knn
from vecspark.plans.kernel import Codec, QueryBlock, Spec
from vecspark.session import BROADCAST_BYTES, materialize

CELL_QUERIES = 512  # queries aimed at in one cell
MAX_PIVOTS = 4096
DRAWN = 3  # queries drawn for each pivot
SURVEYED = 1 << 14  # rows whose reach decides between cells and grid
KINDS = ("dense", "fp16", "bf16")
CELL, GROUP = "_cell", "_group"
SLACK = 1e-6  # of the vectors' lengths; far above what distances by matrix product lose


@dataclass
class Cells:
    """Pivots with the reach of their query cells; small arrays that travel with every task."""

    metric: str
    codec: Codec
    pivots: np.ndarray
    spread: np.ndarray  # U
    least: np.ndarray  # distance: the largest that reaches the cell; inner product: the smallest score
    group: np.ndarray  # of every cell; -1 where nobody asks

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance from its pivot) of query vectors."""
        away = distances(vectors, self.pivots)
        cell = away.argmin(axis=1)
        return cell, away[np.arange(len(cell)), cell]

    def reached(self, vectors: np.ndarray) -> np.ndarray:
        """Which cells every row can still reach, rows x cells."""
        length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        slack = SLACK * (length[:, None] + np.sqrt(np.einsum("ij,ij->i", self.pivots, self.pivots))[None, :])
        if self.metric == "IP":
            return vectors @ self.pivots.T + self.spread * length[:, None] + slack * (1 + length[:, None]) >= self.least
        return distances(vectors, self.pivots) <= self.least + slack


    def groups_reached(self, vectors: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Which groups every row can still reach, rows x groups."""
        asking = self.group >= 0
        member = np.zeros((asking.sum(), self.group.max(initial=-1) + 1), np.float32)
        member[np.arange(len(member)), self.group[asking]] = 1
        return ((self.reached(vectors)[:, asking] & known[:, None]).astype(np.float32) @ member) > 0


def grouped(pivots: np.ndarray, asked: np.ndarray, size: int) -> np.ndarray:
    """Group of every cell: a free cell and its nearest free neighbours, up to ``size`` queries together."""
    group, number = np.full(len(pivots), -1), 0
    for cell in np.argsort(-asked, kind="stable").tolist():
        if group[cell] >= 0 or not asked[cell]:
            continue
        held = 0
        for near in np.argsort(distances(pivots[cell:cell + 1], pivots)[0], kind="stable").tolist():
            if group[near] >= 0 or not asked[near]:
                continue
            if held and held + asked[near] > size:
                break
            group[near], held = number, held + asked[near]
        number += 1
    return group


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", left, left)[:, None] + np.einsum("ij,ij->i", right, right)[None, :] - 2 * (left @ right.T)
    return np.sqrt(np.maximum(square, 0))


def placed(column, codec: Codec, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(vectors in the space of the bounds, which of them can be hits or have hits)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    vectors = kernel.decode(column, codec)
    if metric != "COSINE":
        return vectors, np.ones(len(vectors), bool)
    length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    known = length > 0  # a zero vector has no direction and is nobody's neighbour
    return vectors / np.where(known, length, 1)[:, None], known


def query_codec(df: DataFrame, qvec: str, kind: str) -> Codec:
    return Codec(kind if isinstance(df.schema[qvec].dataType, T.BinaryType) else "dense")


def draw_pivots(queries: DataFrame, qid: str, qvec: str, codec: Codec, metric: str, many: int) -> np.ndarray:
    """``many`` of the queries drawn by hash, each the farthest from those before it, so that no cell is needlessly wide."""
    drawn = queries.select(qvec).orderBy(F.xxhash64(qid, qvec)).limit(DRAWN * many).toArrow()
    vectors, known = placed(drawn[qvec], codec, metric)
    vectors = np.unique(vectors[known], axis=0)
    if len(vectors) <= many:
        return vectors
    chosen, away = [0], distances(vectors, vectors[:1])[:, 0]
    while len(chosen) < many:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(vectors, vectors[chosen[-1:]])[:, 0])
    return vectors[chosen]


def _cell_tasks(cells: Cells, names: list[str]):
    """Queries with their cell and distance from its pivot."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            vectors, known = placed(table[names[1]], cells.codec, cells.metric)
            if known.any():
                cell, away = cells.nearest(vectors[known])
                yield from table.filter(pa.array(known)).append_column(CELL, pa.array(cell)).append_column("_away", pa.array(away)).to_batches()

    return run


def _bounds(rows: DataFrame, vec: str, cells: Cells, spec: Spec) -> np.ndarray:
    """The k-th best value that each pivot finds among the rows; infinitely bad where there are fewer than k keys."""
    own = Spec("IP" if cells.metric == "IP" else "L2", spec.k, spec.pk, spec.key, [])
    matrix = np.hstack([cells.pivots, -cells.spread[:, None]]) if cells.metric == "IP" else cells.pivots
    kept, codec, metric = list(dict.fromkeys([spec.pk, spec.key])), cells.codec, cells.metric
    out = T.StructType([T.StructField("_pivot", T.LongType()), T.StructField("_score", T.DoubleType()), *[rows.schema[c] for c in kept]])

    def run(batches):
        best, asked = kernel.Best(own, len(matrix)), QueryBlock(matrix)
        for batch in batches:
            for piece in kernel.row_slices(pa.Table.from_batches([batch]), matrix.shape[1]):
                vectors, known = placed(piece[vec], codec, metric)
                if metric == "IP":
                    vectors = np.hstack([vectors, np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]])
                if known.any():
                    kernel.scan_block(best, piece.select(kept).filter(pa.array(known)), vectors[known], asked, np.arange(len(matrix)))
        yield from best.batches(pa.array(np.arange(len(matrix))), out.names)

    found = rows.select(*dict.fromkeys([*kept, vec])).mapInArrow(run, out)
    ranked = knn.rank_best(found, qid="_pivot", score="_score", pk=spec.pk, key=spec.key, k=spec.k, similarity=own.metric == "IP")
    last = ranked.where(F.col("rank") == spec.k).select("_pivot", "_score").toArrow()  # a row per pivot at most
    value = np.full(len(matrix), -np.inf if metric == "IP" else np.inf)
    value[last["_pivot"].to_numpy()] = last["_score"].to_numpy() if metric == "IP" else np.sqrt(np.maximum(last["_score"].to_numpy(), 0))
    return value


def _reach(value: np.ndarray, cells: Cells, spec: Spec) -> np.ndarray:
    """From the k-th best values to what a row needs; a range narrows it."""
    if spec.metric == "IP":
        certain = value if spec.upper is None else np.full(len(value), -np.inf)
        return certain if spec.lower is None else np.maximum(certain, spec.lower)
    if spec.metric == "COSINE":
        nearest_left_out, widest = spec.upper is not None, None if spec.lower is None else np.sqrt(max(0.0, 2 - 2 * spec.lower))
    else:
        nearest_left_out, widest = spec.lower is not None, None if spec.upper is None else np.sqrt(max(0.0, spec.upper))
    within = np.full(len(value), np.inf) if nearest_left_out else cells.spread + value
    return cells.spread + (within if widest is None else np.minimum(within, widest))


def route(rows: DataFrame, vec: str, cells: Cells, kept: list[str]) -> DataFrame:
    """A copy of every row for each group of query cells that it can reach."""
    codec, metric = cells.codec, cells.metric
    wanted = list(dict.fromkeys([*kept, vec]))
    out = T.StructType([*[rows.schema[c] for c in wanted], T.StructField(GROUP, T.LongType())])

    def run(batches):
        for batch in batches:
            for piece in kernel.row_slices(pa.Table.from_batches([batch]), len(cells.pivots)):
                vectors, known = placed(piece[vec], codec, metric)
                row, group = np.nonzero(cells.groups_reached(vectors, known))
                for lo in range(0, len(row), kernel.ROWS):
                    copies = piece.take(pa.array(row[lo:lo + kernel.ROWS]))
                    yield from copies.append_column(GROUP, pa.array(group[lo:lo + kernel.ROWS])).to_batches()

    return rows.select(*wanted).mapInArrow(run, out)


def plan(rows: DataFrame, queries: DataFrame, *, vec: str, qid: str, qvec: str, codec: Codec, spec: Spec,
         block: int) -> tuple[Cells, DataFrame, np.ndarray] | None:
    """Cells with their reach, the written queries with their group, and the queries of every group; None without any query."""
    total = queries.count()
    asked = query_codec(queries, qvec, codec.kind)
    width = queries.agg(F.max(knn._width(queries, qvec))).first()[0] or 1
    many = min(MAX_PIVOTS, max(1, BROADCAST_BYTES // (8 * width * DRAWN)), -(-total // CELL_QUERIES))
    pivots = draw_pivots(queries, qid, qvec, asked, spec.metric, max(2, many))
    if not len(pivots):
        return None
    nothing = np.zeros(len(pivots))
    schema = T.StructType([queries.schema[qid], queries.schema[qvec], T.StructField(CELL, T.LongType()), T.StructField("_away", T.DoubleType())])
    celled = materialize(queries.select(qid, qvec).mapInArrow(
        _cell_tasks(Cells(spec.metric, asked, pivots, nothing, nothing, nothing), [qid, qvec]), schema), "query-cells")
    held = celled.groupBy(CELL).agg(F.max("_away").alias("u"), F.count(F.lit(1)).alias("n")).toArrow()  # a row per pivot at most
    sizes, spread = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    sizes[held[CELL].to_numpy()] = held["n"].to_numpy()
    spread[held[CELL].to_numpy()] = held["u"].to_numpy() * (1 + SLACK) + SLACK
    cells = Cells(spec.metric, codec, pivots, spread, nothing, grouped(pivots, sizes, block))
    cells.least = _reach(_bounds(rows, vec, cells, spec), cells, spec)
    by_cell = queries.sparkSession.createDataFrame([(i, int(g)) for i, g in enumerate(cells.group) if g >= 0], f"{CELL} long, {GROUP} long")
    placed_queries = celled.drop("_away").join(F.broadcast(by_cell), CELL).drop(CELL)  # a row per pivot at most
    return cells, placed_queries, np.bincount(cells.group[cells.group >= 0], sizes[cells.group >= 0]).astype(np.int64)


def copies_per_row(rows: DataFrame, vec: str, cells: Cells, blocks: np.ndarray) -> float:
    """Mean number of query blocks a row reaches, over SURVEYED rows drawn by hash."""
    drawn = rows.select(vec).orderBy(F.xxhash64(vec)).limit(SURVEYED).toArrow()
    reached = total = 0
    for piece in kernel.row_slices(drawn, len(cells.pivots)):
        vectors, known = placed(piece[vec], cells.codec, cells.metric)
        reached += float((cells.groups_reached(vectors, known) @ blocks).sum())
        total += len(vectors)
    return reached / max(1, total)


def pivot_candidates(
    rows: DataFrame, queries: DataFrame, *, vec: str, qid: str, qvec: str, score: str, codec: Codec, spec: Spec,
) -> DataFrame:
    """Best lists of all blocks of queries with the rows that can reach them."""
    def grid():
        return knn.grid_candidates(rows, queries, vec=vec, qid=qid, qvec=qvec, score=score, codec=codec, spec=spec)

    if codec.kind not in KINDS or spec.metric not in ("L2", "IP", "COSINE"):
        return grid()
    kept = knn.kept_columns(spec)
    base = rows.where(F.col(vec).isNotNull()).select(*dict.fromkeys([*kept, vec]))
    asked = queries.where(F.col(qvec).isNotNull()).select(qid, qvec)
    block_rows, block_queries = knn.block_sizes(asked, qvec, codec.kind, spec.k)
    found = plan(base, asked, vec=vec, qid=qid, qvec=qvec, codec=codec, spec=spec, block=block_queries)
    if found is None:
        return grid()
    cells, celled, sizes = found
    q_blocks = -(-sizes // block_queries)
    if copies_per_row(base, vec, cells, q_blocks) >= -(-int(sizes.sum()) // block_queries):
        return grid()

    routed = materialize(route(base, vec, cells, kept), "routed-rows")
    per_group = routed.groupBy(GROUP).agg(F.ceil(F.count("*") / block_rows).cast("long").alias("_rows"))
    asked_blocks = rows.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(q_blocks)], f"{GROUP} long, _queries long")
    blocks = F.broadcast(per_group.join(asked_blocks, GROUP))  # a row per pivot at most: MAX_PIVOTS
    number = F.xxhash64(F.monotonically_increasing_id())  # of a written table, so repeatable
    row_side = routed.withColumn("_n", number).join(blocks, GROUP).withColumn("_rb", F.pmod("_n", "_rows")).withColumn(
        "_qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_queries") - 1))).drop("_n", "_rows", "_queries")
    query_side = celled.withColumn("_n", number).join(blocks, GROUP).withColumn("_qb", F.pmod("_n", "_queries")).withColumn(
        "_rb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1))).drop("_n", "_rows", "_queries")
    return knn.met_blocks(row_side, query_side, [GROUP, "_qb", "_rb"], rows, queries, vec=vec, qid=qid, qvec=qvec, score=score,
                          codec=codec, spec=spec)
