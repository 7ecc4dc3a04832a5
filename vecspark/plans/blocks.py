"""Sparse rows in blocks with a maximum per dimension, and search that skips blocks.

A block holds BLOCK_ROWS rows, fewer if they have more than BLOCK_ENTRIES entries, as small postings (dimension -> rows and
values), the largest and smallest value of every dimension, and the rows' keys and fields.  No query can score a row of the block higher than the sum of
its weights times those values, so a block whose bound is below a query's running k-th score is skipped.  The
first threshold of a query is the k-th score among its PROBED most promising blocks, chosen by the bounds alone.
Postings are never shuffled: a task emits its best lists only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions.packing import row_groups
from vecspark.plans import kernel, knn
from vecspark.plans.kernel import Best, Codec, Queries, QueryBlock, Spec

BLOCK_ROWS = 256
BLOCK_ENTRIES = 1 << 17
SENT_BLOCKS = 4  # blocks that leave a task as one batch
FILE_BLOCKS = 16  # scans decode thousands of rows of a file at once, and a block is a large row
PROBED = 4
BOUNDS = ["block", "dims", "top", "low"]
ENTRY_TYPES = "block bigint, dims array<bigint>, top array<double>, low array<double>, starts array<int>, at array<int>, value array<double>"


def _listed(values: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0] + [len(v) for v in values])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values), kind))


def _block(piece: pa.Table) -> list[np.ndarray]:
    """(dims, top, low, starts, at, value) of the rows of a block; the vector is the last column."""
    column = piece.column(piece.num_columns - 1).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    rows, dims, values, _ = kernel.sparse_entries(column)
    order = np.lexsort((rows, dims))
    rows, dims, values = rows[order], dims[order], values[order]
    heads = np.flatnonzero(np.r_[True, np.diff(dims) != 0]) if len(dims) else np.zeros(0, np.int64)
    top = np.maximum.reduceat(values, heads) if len(heads) else values
    low = np.minimum.reduceat(values, heads) if len(heads) else values
    return [dims[heads], top, low, heads, rows, values]


def _pack(batches):
    held, number = None, TaskContext.get().partitionId() << 32
    kinds = [pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.float64()]

    def packed_blocks(table: pa.Table, cuts: list[tuple[int, int]]):
        nonlocal number
        for some in (cuts[n:n + SENT_BLOCKS] for n in range(0, len(cuts), SENT_BLOCKS)):
            made = [_block(table.slice(lo, hi - lo)) for lo, hi in some]
            own = table.slice(some[0][0], some[-1][1] - some[0][0])
            keys = own.select(own.column_names[:-1]).to_struct_array()
            keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
            ends = np.array([some[0][0]] + [hi for _, hi in some]) - some[0][0]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys), pa.array(number + np.arange(len(some))),
                 *[_listed([m[i] for m in made], k) for i, k in enumerate(kinds)]],
                ["rows", "block", "dims", "top", "low", "starts", "at", "value"])
            number += len(some)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table.filter(table.column(table.num_columns - 1).is_valid())
        held = table if held is None else pa.concat_tables([held, table])
        cuts = _cuts(held)
        if len(cuts) > 1:
            yield from packed_blocks(held, cuts[:-1])
            held = held.slice(cuts[-1][0])
    if held is not None and held.num_rows:
        yield from packed_blocks(held, _cuts(held))


def _cuts(table: pa.Table) -> list[tuple[int, int]]:
    """Ranges of rows that make a block each."""
    sizes = pc.list_value_length(table.column(table.num_columns - 1)).to_numpy()
    return list(row_groups(sizes, BLOCK_ENTRIES, BLOCK_ROWS))


def packed(rows: DataFrame, keys: list[str], vec: str) -> DataFrame:
    """One row per block: rows (keys and fields), its number, its postings and their bounds.  A narrow pass over ``rows``, to be
    written once: numbers follow the tasks that make the blocks."""
    kinds = T.StructType([rows.schema[c] for c in keys]).simpleString()
    return rows.select(*keys, vec).mapInArrow(_pack, f"rows array<{kinds}>, {ENTRY_TYPES}")


def write(blocks: DataFrame, path: str) -> None:
    blocks.write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(path)


def unpacked(index: DataFrame, vec: str) -> DataFrame:
    """The stored rows with their sparse vectors, for queries that need the plain table."""
    entries = F.arrays_zip(F.flatten(F.transform("dims", lambda d, i: F.array_repeat(
        d, F.coalesce(F.get("starts", i + 1), F.size("at")) - F.get("starts", i)))), "at", "value")
    listed = index.select("rows", entries.alias("_e"))
    placed = listed.select("_e", F.posexplode("rows").alias("_n", "_r"))
    own = F.transform(F.filter("_e", lambda e: e["at"] == F.col("_n")), lambda e: F.struct(e["0"].alias("i"), e["value"].alias("v")))
    return placed.select("_r.*", own.alias(vec))


class _Asked:
    """Query parts with what their bounds need."""

    def __init__(self, queries: Queries):
        self.parts = []
        for part, at, codec in queries.parts():
            signed = (part.matrix < 0).any()
            self.parts.append((part, at, codec.dims, np.maximum(part.matrix, 0) if signed else part.matrix,
                               np.minimum(part.matrix, 0) if signed else None))

    def meet(self, dims: np.ndarray, top: np.ndarray, low: np.ndarray):
        """(part, positions, bound, columns of the part, dimensions of the block) of the queries that share a dimension."""
        for part, at, own, positive, negative in self.parts:
            if not len(own) or not len(dims):
                continue
            place = np.minimum(np.searchsorted(own, dims), len(own) - 1)
            mine = np.flatnonzero(own[place] == dims)
            columns = place[mine]
            asks = part.seen[:, columns].any(axis=1) if len(mine) else np.zeros(len(at), bool)
            if asks.any():
                bound = positive[:, columns] @ np.maximum(top[mine], 0)
                if negative is not None:
                    bound += negative[:, columns] @ np.minimum(low[mine], 0)
                yield part, at, np.where(asks, bound, -np.inf), columns, mine


def _list(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(batch.schema.get_field_index(name))
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    ends = ends - ends[0]
    return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _slack(bound: np.ndarray) -> np.ndarray:
    return 1e-9 * np.abs(np.where(np.isfinite(bound), bound, 0))


def _scan(table: pa.Table, qid: str, qvec: str, spec: Spec, names: list[str], first: np.ndarray | None, skipped):
    """Best lists over the blocks of a task; ``first`` are the costs that queries start from."""

    def run(batches):
        queries = Queries(table, qid, qvec, Codec("sparse"))
        asked, best, left_out = _Asked(queries), Best(spec, queries.count), 0
        if first is not None:
            best.limit = first.copy()
        for batch in batches:
            lists = {name: _list(batch, name) for name in ("dims", "top", "low", "starts", "at", "value")}
            keys = batch.column(batch.schema.get_field_index("rows"))
            for n in range(batch.num_rows):
                dims, top, low, starts, rows, values = (lists[name][n] for name in lists)
                own, size = None, len(keys[n])
                ends = np.append(starts[1:], len(rows))
                for part, at, bound, columns, mine in asked.meet(dims, top, low):
                    near = -bound <= best.limit[at] + _slack(bound)
                    near &= np.isfinite(bound)
                    left_out += int(np.isfinite(bound).sum() - near.sum())
                    if not near.any():
                        continue
                    if own is None:
                        own = pa.Table.from_struct_array(keys.slice(n, 1).flatten())
                    counts = (ends - starts)[mine]
                    entry = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts[mine], counts)
                    dense, seen = np.zeros((size, len(mine))), np.zeros((size, len(mine)), np.float32)
                    column = np.repeat(np.arange(len(mine)), counts)
                    dense[rows[entry], column], seen[rows[entry], column] = values[entry], 1.0
                    some = QueryBlock(part.matrix[near][:, columns], part.seen[near][:, columns])
                    kernel.scan_block(best, own, dense, some, at[near], seen)
                best.merge()
                if first is not None:
                    best.limit = np.minimum(best.limit, first)
            del batch, lists, keys  # before the next one arrives
        if skipped is not None:
            skipped.add(left_out)
        yield from best.batches(queries.ids, names)

    return run


def _promising(table: pa.Table, qid: str, qvec: str):
    """(query, block, bound) of every query's PROBED best bounds in a task."""

    def run(batches):
        asked, found = _Asked(Queries(table, qid, qvec, Codec("sparse"))), {}
        for batch in batches:
            numbers, lists = batch.column(0).to_numpy(), [_list(batch, name) for name in ("dims", "top", "low")]
            for block, dims, top, low in zip(numbers.tolist(), *lists):
                for _, at, bound, _, _ in asked.meet(dims, top, low):
                    for q, b in zip(at[np.isfinite(bound)].tolist(), bound[np.isfinite(bound)].tolist()):
                        held = found.setdefault(q, [])
                        held.append((b, block))
                        if len(held) > 4 * PROBED:
                            found[q] = sorted(held, reverse=True)[:PROBED]
        flat = [(q, block, b) for q, held in found.items() for b, block in sorted(held, reverse=True)[:PROBED]]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*flat)], ["q", "block", "bound"])

    return run


def block_candidates(
    index: DataFrame, queries: DataFrame, table: pa.Table, *, qid: str, qvec: str, score: str, spec: Spec, skipped=None,
) -> DataFrame:
    """Best lists of a bounded query set over a written index of blocks."""
    kept = knn.kept_columns(spec)
    fields = {f.name: f for f in index.schema["rows"].dataType.elementType.fields}
    schema = T.StructType([queries.schema[qid], T.StructField(score, T.DoubleType()), *[fields[c] for c in kept]])
    first = None
    if spec.upper is None:  # with an upper end the best of a block need not count
        best = index.select(*BOUNDS).mapInArrow(_promising(table, qid, qvec), "q long, block long, bound double")
        place = Window.partitionBy("q").orderBy(F.desc("bound"), "block")
        wanted = best.withColumn("n", F.row_number().over(place)).where(F.col("n") <= PROBED).select("block").distinct()
        numbers = [r.block for r in wanted.collect()]  # PROBED per query of a bounded set
        first = np.full(table.num_rows, np.inf)
        if numbers:
            near = index.where(F.col("block").isin(numbers)).mapInArrow(_scan(table, qid, qvec, spec, schema.names, None, None), schema)
            ranked = knn.rank_best(near, qid=qid, score=score, pk=spec.pk, key=spec.key, k=spec.k, similarity=True)
            last = {r[qid]: r[score] for r in ranked.where(F.col("rank") == spec.k).select(qid, score).collect()}
            ids = table[qid].to_pylist()
            if len(set(ids)) == len(ids):  # queries that share an id have lists of their own
                first = np.array([-last[i] + 1e-9 * abs(last[i]) if i in last else np.inf for i in ids])
    return index.mapInArrow(_scan(table, qid, qvec, spec, schema.names, first, skipped), schema)
