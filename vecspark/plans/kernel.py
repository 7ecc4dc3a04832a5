"""Arrow/NumPy block kernel: best k rows per query inside one task.

A task sees its rows batch by batch and keeps only the k best distinct keys per query, so a plan
never emits row x query pairs.  A batch is scored with one matrix product; rows that can still be
among the best are then re-scored one pair at a time in a fixed summation order, so equal vectors
always get equal scores and ties fall to the primary key.  Dense vectors are first judged by lower bounds
of their costs in single precision; where that tells too few rows apart, double precision judges them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

CELLS = 4 << 20  # elements of one decoded block
SPARSE_CELLS = 1 << 19  # the same for sparse rows, which are held with flags and marks of their entries
TILE = 1 << 20  # scores computed at once
ROWS = 8192  # rows of one block
ASKED = 256  # queries that bounds in single precision are computed for at once
FIRST_ROWS, MOST_ROWS = 512, 4096  # rows met at once, from the first ones on
GROUP_ROWS = 64  # mean rows of a key from which keys are met one after the other
SINGLE_DIMS = 2048  # beyond, single precision loses too much

DISTANCES = ("L2", "HAMMING", "JACCARD", "TANIMOTO", "SUBSTRUCTURE", "SUPERSTRUCTURE")
SIMILARITIES = ("IP", "COSINE")
BINARY = ("HAMMING", "JACCARD", "TANIMOTO", "SUBSTRUCTURE", "SUPERSTRUCTURE")


# ---------------------------------------------------------------- decoding

@dataclass
class Codec:
    """How the stored vector column turns into a dense block."""

    kind: str = "dense"  # dense | bits | fp16 | bf16 | sparse | sq8 | pq
    lo: np.ndarray | None = None  # sq8
    step: np.ndarray | None = None  # sq8
    books: np.ndarray | None = None  # pq: (m, codes, dim / m)
    dims: np.ndarray | None = None  # sparse: the sorted dimensions the queries use


def code_type(books: np.ndarray) -> str:
    """Storage type of product-quantisation codes."""
    return "<u1" if books.shape[1] <= 256 else "<u2"


def _flat(arr: pa.Array) -> tuple[pa.Array, int]:
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    return arr.flatten(), len(arr)


def _list_block(arr, dtype) -> np.ndarray:
    values, n = _flat(arr)
    if n == 0:
        return np.zeros((0, 0), dtype)
    if values.null_count or len(values) % n:
        raise ValueError("vector dimension does not match the field")
    block = values.to_numpy(zero_copy_only=False).reshape(n, -1)
    lengths = arr.value_lengths().to_numpy(zero_copy_only=False)
    if not (lengths == block.shape[1]).all():
        raise ValueError("vector dimension does not match the field")
    return block.astype(dtype, copy=False)


def _byte_block(arr, dtype) -> np.ndarray:
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if not n:
        return np.zeros((0, 0), dtype)
    _, ends, data = arr.buffers()
    at = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(arr.type) else np.int32)[arr.offset:arr.offset + n + 1]
    if arr.null_count or len(np.unique(np.diff(at))) != 1:
        raise ValueError("vector dimension does not match the field")
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), dtype=dtype).reshape(n, -1)


def bits_of(words: np.ndarray) -> np.ndarray:
    """int64 words -> one f32 column per bit (counts below 2**24 stay exact in f32)."""
    raw = np.ascontiguousarray(words.astype("<i8", copy=False)).view(np.uint8)
    return np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)


def decode(arr, codec: Codec) -> np.ndarray:
    if codec.kind == "dense":
        return _list_block(arr, np.float64)
    if codec.kind == "bits":
        return bits_of(_list_block(arr, np.int64))
    if codec.kind == "fp16":
        return _byte_block(arr, "<f2").astype(np.float64)
    if codec.kind == "bf16":
        wide = _byte_block(arr, "<u2").astype(np.uint32) << 16
        return wide.view(np.float32).astype(np.float64)
    if codec.kind == "sq8":
        return codec.lo + _byte_block(arr, np.uint8).astype(np.float64) * codec.step
    if codec.kind == "pq":  # the codes themselves; scores are looked up
        return _byte_block(arr, code_type(codec.books)).astype(np.uint32)
    raise ValueError(f"unknown vector encoding {codec.kind}")


def sparse_entries(arr) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """list<struct<i, v>> -> (row, dimension, value) triples and the row count."""
    values, n = _flat(arr)
    counts = arr.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(n), counts)
    dims = values.field(0).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    vals = values.field(1).to_numpy(zero_copy_only=False).astype(np.float64)
    return rows, dims, vals, n


def sparse_block(arr, dims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense values and presence flags over the dimensions in ``dims``."""
    rows, found, vals, n = sparse_entries(arr)
    block = np.zeros((n, len(dims)))
    seen = np.zeros((n, len(dims)), np.float32)
    if len(dims) and len(found):
        at = np.minimum(np.searchsorted(dims, found), len(dims) - 1)
        hit = dims[at] == found
        block[rows[hit], at[hit]] = vals[hit]
        seen[rows[hit], at[hit]] = 1.0
    return block, seen


# ---------------------------------------------------------------- scoring

@dataclass
class QueryBlock:
    """Decoded query vectors."""

    matrix: np.ndarray
    seen: np.ndarray | None = None  # sparse presence flags
    sq: np.ndarray = field(init=False)

    def __post_init__(self):
        self.sq = np.einsum("ij,ij->i", self.matrix, self.matrix)

    def take(self, at: np.ndarray) -> "QueryBlock":
        return QueryBlock(self.matrix[at], None if self.seen is None else self.seen[at])


class Queries:
    """A bounded query table inside a task, decoded in parts of bounded size.

    Dense queries form one part.  Sparse queries are cut so that queries x distinct dimensions of a
    part stays within one block; each part only looks at its own dimensions.
    """

    def __init__(self, table: pa.Table, qid: str, qvec: str, codec: Codec):
        self.ids = table[qid].combine_chunks()
        self.codec = codec
        column = table[qvec].combine_chunks()
        self.column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        self.count = len(self.column)
        self.block = None if codec.kind == "sparse" else QueryBlock(self._dense())

    def _dense(self) -> np.ndarray:
        # queries of coded fields arrive as plain values, those of half-precision fields as either
        kind = self.codec.kind if self.codec.kind in ("bits", "fp16", "bf16") else "dense"
        if kind != "bits" and not pa.types.is_binary(self.column.type):
            kind = "dense"
        return decode(self.column, Codec(kind))

    def parts(self):
        """(query block, positions, codec that decodes rows for it)."""
        if self.block is not None:
            yield self.block, np.arange(self.count), self.codec
            return
        lengths = self.column.value_lengths().to_numpy(zero_copy_only=False)
        start = 0
        while start < self.count:
            total, end = int(lengths[start]), start + 1
            while end < self.count and (end + 1 - start) * (total + int(lengths[end])) <= CELLS:
                total, end = total + int(lengths[end]), end + 1
            some = self.column.slice(start, end - start)
            dims = np.unique(sparse_entries(some)[1])
            yield QueryBlock(*sparse_block(some, dims)), np.arange(start, end), Codec("sparse", dims=dims)
            start = end


def decode_rows(column, codec: Codec) -> tuple[np.ndarray, np.ndarray | None]:
    """Dense row block, and presence flags for sparse rows."""
    return sparse_block(column, codec.dims) if codec.kind == "sparse" else (decode(column, codec), None)


def _binary_scores(both, nv, nq, metric):
    if metric == "HAMMING":
        return (nv + nq - 2 * both).astype(np.float64)
    if metric == "SUBSTRUCTURE":
        return np.where(both == nq, 0.0, np.nan)
    if metric == "SUPERSTRUCTURE":
        return np.where(both == nv, 0.0, np.nan)
    either = (nv + nq - both).astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        shared = np.where(either > 0, both.astype(np.float64) / either, 1.0)
        return 1.0 - shared if metric == "JACCARD" else -np.log2(shared)


def block_scores(v, vsq, q: QueryBlock, metric: str) -> np.ndarray:
    """Scores of every query (axis 0) against every row (axis 1) by matrix product."""
    score = q.matrix @ v.T
    if metric in BINARY:
        return _binary_scores(score, vsq[None, :], q.sq[:, None], metric)
    if metric == "L2":
        score *= -2.0
        score += vsq
        score += q.sq[:, None]
    elif metric == "COSINE":
        with np.errstate(divide="ignore", invalid="ignore"):
            score /= np.sqrt(vsq)
            score /= np.sqrt(q.sq)[:, None]
    return score


def _summed(left, right):
    """Products summed over the last axis, one after the other, so that a sum does not depend on what is summed beside it."""
    total = left[..., 0] * right[..., 0]
    for w in range(1, left.shape[-1]):
        total = total + left[..., w] * right[..., w]
    return total


class Tables:
    """What every code adds to a score: one table per query and sub-space, summed up over a row's codes."""

    def __init__(self, books: np.ndarray, q: QueryBlock, metric: str):
        m, codes, width = books.shape
        own = q.matrix.reshape(len(q.matrix), m, width).transpose(1, 0, 2)
        self.metric, self.lengths = metric, np.sqrt(q.sq)
        dot = _summed(books[:, :, None, :], own[:, None, :, :])
        self.squares = _summed(books, books)
        if metric == "L2":
            dot = self.squares[:, :, None] - 2 * dot + _summed(own, own)[:, None, :]
        self.tables = np.ascontiguousarray(dot)  # (sub-space, code, query): a code is one contiguous row

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Queries x rows; always summed in the order of the sub-spaces, so equal codes score alike."""
        total = self.tables[0][codes[:, 0]]
        for s in range(1, len(self.tables)):
            total += self.tables[s][codes[:, s]]
        if self.metric == "COSINE":
            square = self.squares[0][codes[:, 0]]
            for s in range(1, len(self.tables)):
                square = square + self.squares[s][codes[:, s]]
            with np.errstate(divide="ignore", invalid="ignore"):
                total = total / np.sqrt(square)[:, None] / self.lengths[None, :]
        return total.T


def rebuilt(codes, books: np.ndarray) -> np.ndarray:
    """The vectors that product codes stand for."""
    return np.concatenate([book[codes[:, s]] for s, book in enumerate(books)], axis=1)


def code_scores(books: np.ndarray, codes, q: QueryBlock, i, j, metric: str) -> np.ndarray:
    """Scores of single pairs of a coded row and a query, to the last bit those of ``Tables``."""
    m, _, width = books.shape
    own, sub = q.matrix.reshape(len(q.matrix), m, width), np.arange(m)
    out, step = np.empty(len(i)), max(1, TILE // (m * width))
    for lo in range(0, len(i), step):
        some, who = books[sub, codes[i[lo:lo + step]]], j[lo:lo + step]
        dot, square = _summed(some, own[who]), _summed(some, some)
        if metric == "L2":
            dot = square - 2 * dot + _summed(own, own)[who]
        total, length = dot[:, 0], square[:, 0]
        for s in range(1, m):
            total, length = total + dot[:, s], length + square[:, s]
        if metric == "COSINE":
            with np.errstate(divide="ignore", invalid="ignore"):
                total = total / np.sqrt(length) / np.sqrt(q.sq)[who]
        out[lo:lo + step] = total
    return out


def pair_scores(v, q, metric: str) -> np.ndarray:
    """Scores of aligned rows, summed in one fixed order."""
    if metric == "L2":
        return ((v - q) ** 2).sum(axis=1)
    dot = (v * q).sum(axis=1)
    if metric == "COSINE":
        with np.errstate(divide="ignore", invalid="ignore"):
            return dot / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((q * q).sum(axis=1)))
    return dot


def _slack(vsq, q: QueryBlock, metric: str) -> np.ndarray:
    """Bound on |matrix-product score - pair score| per query."""
    if metric in BINARY:
        return np.zeros(len(q.sq))
    unit = 8 * (q.matrix.shape[1] + 16) * np.finfo(np.float64).eps
    top = vsq.max(initial=0.0)
    if metric == "COSINE":
        return np.full(len(q.sq), unit)
    if metric == "IP":
        return unit * np.sqrt(top * q.sq)
    return unit * (top + q.sq)


# ---------------------------------------------------------------- running best k

@dataclass
class Spec:
    """What one search keeps."""

    metric: str
    k: int
    pk: str
    key: str  # at most one row per (query, key): the primary key, or the group-by field
    carry: list[str]
    lower: float | None = None  # lower <= score < upper
    upper: float | None = None

    @property
    def sign(self) -> float:
        return -1.0 if self.metric in SIMILARITIES else 1.0


def _codes(column) -> np.ndarray:
    enc = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    enc = enc.dictionary_encode(null_encoding="encode")
    return enc.indices.to_numpy(zero_copy_only=False)


def _order_of(column) -> np.ndarray:
    """Sortable numbers for a primary-key column (text sorts by code point, as Spark does)."""
    values = column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()
    if values.dtype == object:
        return np.unique(values, return_inverse=True)[1]
    return values


class Best:
    """The k best distinct keys per query seen so far in this task."""

    def __init__(self, spec: Spec, nq: int):
        self.spec, self.nq = spec, nq
        self.limit = np.full(nq, np.inf)
        self.q = np.zeros(0, np.int64)
        self.cost = np.zeros(0)
        self.rows: pa.Table | None = None
        self.waiting: list[tuple[pa.Table, np.ndarray, np.ndarray]] = []
        self.waiting_rows = 0

    def add(self, rows: pa.Table, q: np.ndarray, cost: np.ndarray) -> None:
        """Take candidates; they are merged once they outnumber the lists, so merging stays linear."""
        if len(q):
            self.waiting.append((rows, q, cost))
            self.waiting_rows += len(q)
            if self.waiting_rows >= max(4096, len(self.q)):
                self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        parts = self.waiting if self.rows is None else [(self.rows, self.q, self.cost), *self.waiting]
        self.waiting, self.waiting_rows = [], 0
        rows = pa.concat_tables([p[0] for p in parts])
        q, cost = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        order = np.lexsort((_order_of(rows[self.spec.pk]), cost, q))
        key = _codes(rows[self.spec.key])[order].astype(np.int64)
        first = np.unique(q[order] * (key.max() + 1) + key, return_index=True)[1]
        order = order[np.sort(first)]
        qs = q[order]
        place = np.arange(len(qs)) - np.searchsorted(qs, qs, side="left")
        order = order[place < self.spec.k]
        last = order[place[place < self.spec.k] == self.spec.k - 1]
        self.q, self.cost, self.rows = q[order], cost[order], rows.take(pa.array(order))
        self.limit[q[last]] = cost[last]

    def batches(self, ids: pa.Array, names: list[str]):
        self.merge()
        if self.rows is None:
            return
        cols = [ids.take(pa.array(self.q)), pa.array(self.cost * self.spec.sign)]
        cols += [self.rows[c] for c in names[2:]]
        yield from pa.table(cols, names=names).to_batches(max_chunksize=65536)


def scan_block(best: Best, rows: pa.Table, v, q: QueryBlock, at: np.ndarray, seen=None, books=None) -> None:
    """Offer one block of rows to the queries of ``q``; ``at`` are their positions in the full query set.

    With ``books`` the block holds product codes.
    """
    done, left = 0, None
    if best.spec.metric not in BINARY and seen is None:
        done, left = _scan_single(best, rows, v, q, at, books)
    if done and left is not None:
        some = np.arange(done)
        _scan_double(best, rows.take(pa.array(left)), v[left], q.take(some), at[some], books=books)
    if done < len(at):
        some = np.arange(done, len(at))
        rest = q.take(some) if done else q
        for lo in range(0, len(v), ROWS):
            _scan_double(best, rows.slice(lo, ROWS), v[lo:lo + ROWS], rest, at[some], None if seen is None else seen[lo:lo + ROWS], books)


def _scan_double(best: Best, rows: pa.Table, v, q: QueryBlock, at: np.ndarray, seen=None, books=None) -> None:
    """``scan_block`` by scores in double precision."""
    spec = best.spec
    keys = _KeyGroups(_codes(rows[spec.key]))
    vsq = np.einsum("ij,ij->i", v, v) if books is None else None
    width = max(1, TILE // max(1, len(v)))
    rough = spec.metric not in BINARY and books is None
    for start in range(0, len(at), width):
        pick = np.arange(start, min(start + width, len(at)))
        part = q.take(pick) if len(pick) < len(at) else q
        score = block_scores(v, vsq, part, spec.metric) if books is None else Tables(books, part, spec.metric).scores(v)
        if seen is not None:
            score[(part.seen @ seen.T) <= 0] = np.nan
        slack = 2 * _slack(vsq, part, spec.metric) if rough else np.zeros(len(pick))
        _keep_range(score, v if rough else None, part, slack, spec)
        cost = np.negative(score, out=score) if spec.sign < 0 else score
        limit = np.minimum(best.limit[at[pick]] + slack, np.finfo(np.float64).max)
        keep = cost <= limit[:, None]  # never true for NaN
        crowded = np.flatnonzero(keep.sum(axis=1) > spec.k)
        if len(crowded):
            keep[crowded] &= keys.nearest(cost[crowded], spec.k, slack[crowded])
        j, i = np.nonzero(keep)
        if len(i):
            exact = settled_scores(v, part.matrix, i, j, spec.metric) * spec.sign if rough else cost[j, i]
            best.add(rows.take(pa.array(i)), at[pick][j], exact)


class _LowerBounds:
    """Lower bounds of the costs of a block's rows, less what depends on the query alone, by one product in single precision.

    A row's last entry takes off what its length can lose, so a long row loosens no bound but its own.  Squared
    distances are taken from the mean row.
    """

    def __init__(self, v, vsq, metric: str):
        n, dim = v.shape
        self.metric, self.unit = metric, 4 * (dim + 16) * float(np.finfo(np.float32).eps)
        self.middle = v.mean(axis=0) if metric == "L2" else None
        self.rows = np.empty((n, dim + 1), np.float32)
        if metric == "L2":
            own = v - self.middle
            self.square = np.einsum("ij,ij->i", own, own)
            self.rows[:, :dim], self.rows[:, dim] = own, self.square * (1 - self.unit)
        elif metric == "IP":
            self.square = vsq
            self.rows[:, :dim], self.rows[:, dim] = v, np.sqrt(vsq)
        else:
            self.square = np.ones(n)
            self.rows[:, :dim], self.rows[:, dim] = v / np.sqrt(vsq)[:, None], 1

    def asked(self, q: QueryBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(factors, what a query adds to its bounds, its squared length)."""
        dim = q.matrix.shape[1]
        out, nothing = np.empty((len(q.sq), dim + 1), np.float32), np.zeros(len(q.sq))
        if self.metric == "L2":
            own = q.matrix - self.middle
            square = np.einsum("ij,ij->i", own, own)
            out[:, :dim], out[:, dim] = -2 * own, 1
            return out, square * (1 - self.unit), square
        if self.metric == "IP":
            out[:, :dim], out[:, dim] = -q.matrix, -self.unit * np.sqrt(q.sq)
            return out, nothing, q.sq
        out[:, :dim], out[:, dim] = -q.matrix / np.sqrt(np.where(q.sq > 0, q.sq, 1))[:, None], -self.unit
        return out, nothing, np.ones(len(q.sq))

    def gap(self, square: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """How far above its bound a cost can be, per query."""
        top = self.square[lo:hi].max()
        return 2 * self.unit * (top + square if self.metric == "L2" else np.sqrt(top * square))


def _single_fits(v, vsq, q: QueryBlock, metric: str, coded: bool = False) -> bool:
    """Whether single precision holds the block and the queries without losing small or large numbers."""
    top, most = vsq.max(initial=0.0), q.sq.max(initial=0.0)
    if v.shape[1] > SINGLE_DIMS or not 1e-20 < top < 1e30 or not most < 1e30:  # also without any NaN
        return False
    if metric == "L2":  # the mean row must not lie so far away that little is left of the differences
        # tables add up squared lengths, so they lose more than differences do
        return (v.max(axis=0) - v.min(axis=0)).max() ** 2 > (1e-6 if coded else 1e-14) * top
    if metric == "COSINE":
        return vsq.min() > 1e-30 and (q.sq[q.sq > 0].min(initial=1.0) > 1e-30)
    return True


def _rounded_up(limit: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(limit.astype(np.float32), np.float32(np.inf))


def _cost_range(spec: Spec) -> tuple[float | None, float | None]:
    lower, upper = (spec.lower, spec.upper) if spec.sign > 0 else (spec.upper, spec.lower)
    return None if lower is None else lower * spec.sign, None if upper is None else upper * spec.sign


def _growing(lo: int, hi: int, most: int):
    """Ranges of rows that double from FIRST_ROWS to ``most``, as the first ones are met without a limit."""
    size = min(FIRST_ROWS, most)
    while lo < hi:
        yield lo, min(lo + size, hi)
        lo, size = lo + size, min(most, 2 * size)


def _scan_single(best: Best, rows: pa.Table, v, q: QueryBlock, at: np.ndarray, books=None) -> tuple[int, np.ndarray | None]:
    """Offer a block by bounds in single precision: (queries served, rows that those have still to meet).

    Every query keeps the k smallest upper bounds of distinct keys, the largest of which is its limit; rows whose
    lower bound is beyond it are out.  What is left in the end is scored pair by pair.  Queries are served until one tile
    keeps many more rows than k.  Product codes are bounded by the vectors they stand for and scored as their tables do.
    """
    spec = best.spec
    whole = v if books is None else rebuilt(v, books)
    vsq = np.einsum("ij,ij->i", whole, whole)
    if not len(at) or not _single_fits(whole, vsq, q, spec.metric, books is not None):
        return 0, None
    groups = _KeyGroups(_codes(rows[spec.key]))
    sizes = np.diff(np.r_[groups.heads, len(v)])
    grouped, left = not groups.unique and len(sizes) * GROUP_ROWS <= len(v), None
    order = groups.order if grouped else groups.order[groups.heads[sizes == 1]]
    if not grouped and len(order) < len(v):  # keys that repeat now and then
        left = groups.order[np.repeat(sizes > 1, sizes)]
        if not len(order):
            return 0, None
    order = order if grouped else np.sort(order)
    segments = list(zip(groups.heads.tolist(), (groups.heads + sizes).tolist())) if grouped else [(0, len(order))]
    segment = np.repeat(np.arange(len(sizes)), sizes) if grouped else None
    bounds = _LowerBounds(whole[order], vsq[order], spec.metric)
    kept = 1 if grouped else spec.k
    least, most = _cost_range(spec)
    tile = max(16, min(ASKED, TILE // (4 * max(spec.k, len(segments)))))
    room = np.empty(tile * MOST_ROWS, np.float32)
    for start in range(0, len(at), tile):
        own, part = at[start:start + tile], QueryBlock(q.matrix[start:start + tile])
        n = len(own)
        factors, base, square = bounds.asked(part)
        limit = best.limit[own] if most is None else np.minimum(best.limit[own], most)
        if spec.metric == "COSINE":
            limit = np.where(part.sq > 0, limit, -np.inf)  # no direction, no hits
        top = np.full((n, len(segments) if grouped else spec.k), np.inf)
        found, held, enough = [], 0, n * (16 * top.shape[1] + 64)

        def in_reach(j, i, low):
            near = low <= (np.minimum(limit[j], top[j, segment[i]]) if grouped else limit[j])
            return j[near], i[near], low[near]

        for number, (first, last) in enumerate(segments):
            for lo, hi in _growing(first, last, MOST_ROWS):
                width, gap = hi - lo, bounds.gap(square, lo, hi)
                score = np.matmul(factors, bounds.rows[lo:hi].T, out=room[:n * width].reshape(n, width))
                reach = np.minimum(limit, top[:, number]) if grouped else limit
                keep = score <= _rounded_up(reach - base)[:, None]
                if least is not None:
                    keep &= score >= -_rounded_up(base + gap - least)[:, None]
                flat = np.flatnonzero(keep)
                j, i = np.divmod(flat, width)
                low = score.ravel()[flat].astype(np.float64)
                crowded = np.flatnonzero(np.bincount(j, minlength=n) > 4 * kept)
                if len(crowded):
                    some = score[crowded]
                    if least is not None:
                        some[some <= _rounded_up(least - base[crowded])[:, None]] = np.inf
                    if most is not None:
                        some[some >= -_rounded_up((base + gap)[crowded] - most)[:, None]] = np.inf
                    nearest = some.min(axis=1) if kept == 1 else np.partition(some, kept - 1, axis=1)[:, kept - 1]
                    cut = np.full(n, np.inf)
                    cut[crowded] = nearest.astype(np.float64) + gap[crowded]
                    near = low <= cut[j]
                    j, i, low = j[near], i[near], low[near]
                if not len(j):
                    continue
                low += base[j]
                found.append((j, i + lo, low))
                held += len(j)
                high = low + gap[j]
                if least is not None or most is not None:
                    sure = (low > (-np.inf if least is None else least)) & (high < (np.inf if most is None else most))
                    j, high = j[sure], high[sure]
                if len(j):
                    heads = np.flatnonzero(np.r_[True, np.diff(j) != 0])
                    who = j[heads]
                    if grouped:
                        top[who, number] = np.minimum(top[who, number], np.minimum.reduceat(high, heads))
                        if len(segments) >= spec.k:
                            limit[who] = np.minimum(limit[who], np.partition(top[who], spec.k - 1, axis=1)[:, spec.k - 1])
                    else:
                        counts = np.diff(np.r_[heads, len(j)])
                        wide = np.full((len(who), spec.k + counts.max()), np.inf)
                        wide[:, :spec.k] = top[who]
                        wide[np.repeat(np.arange(len(who)), counts), spec.k + np.arange(len(j)) - np.repeat(heads, counts)] = high
                        wide.partition(spec.k - 1, axis=1)
                        top[who] = wide[:, :spec.k]
                        limit[who] = np.minimum(limit[who], wide[:, spec.k - 1])
                if held > enough:
                    found = [in_reach(*(np.concatenate(x) for x in zip(*found)))]
                    held = len(found[0][0])
                    if held > enough:
                        return start, left
        if not found:
            continue
        j, i, _ = in_reach(*(np.concatenate(x) for x in zip(*found)))
        i = order[i]
        cost = settled_scores(v, part.matrix, i, j, spec.metric) if books is None else code_scores(books, v, part, i, j, spec.metric)
        cost = cost * spec.sign
        near = cost <= limit[j]  # never true for NaN
        if spec.lower is not None:
            near &= cost * spec.sign >= spec.lower
        if spec.upper is not None:
            near &= cost * spec.sign < spec.upper
        j, i, cost = j[near], i[near], cost[near]
        best.add(rows.take(pa.array(i)), own[j], cost)
        best.limit[own] = np.minimum(best.limit[own], limit)
    return len(at), left


def _keep_range(score, v, q: QueryBlock, slack, spec: Spec) -> None:
    """Blank scores outside the range; those too close to a bound to call are settled pair by pair."""
    for bound in (spec.lower, spec.upper):
        if bound is not None and v is not None:
            j, i = np.nonzero(np.abs(score - bound) <= slack[:, None])
            score[j, i] = settled_scores(v, q.matrix, i, j, spec.metric)
    if spec.lower is not None:
        score[~(score >= spec.lower)] = np.nan
    if spec.upper is not None:
        score[~(score < spec.upper)] = np.nan


class _KeyGroups:
    """The rows of a block grouped by key."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(codes, kind="stable")
        self.heads = np.flatnonzero(np.r_[True, np.diff(codes[self.order]) != 0])
        self.unique = len(self.heads) == len(codes)

    def nearest(self, cost, k: int, slack) -> np.ndarray:
        """Rows that can be among the best k keys of their query: near their key's best row, and that
        row near the k-th best key."""
        cost = np.where(np.isnan(cost), np.inf, cost)
        per_key = cost if self.unique else np.minimum.reduceat(cost[:, self.order], self.heads, axis=1)
        keep = np.ones(cost.shape, bool)
        if per_key.shape[1] > k:
            keep = cost <= (np.partition(per_key, k - 1, axis=1)[:, k - 1] + slack)[:, None]
        if not self.unique:
            group = np.empty(cost.shape[1], np.int64)
            group[self.order] = np.repeat(np.arange(len(self.heads)), np.diff(np.r_[self.heads, cost.shape[1]]))
            keep &= cost <= per_key[:, group] + slack[:, None]
        return keep


def without_surplus_copies(rows: pa.Table, v, seen, spec: Spec) -> np.ndarray | None:
    """Row positions to keep when a block holds more copies of one vector than can be hits.

    Copies score the same for every query, so of one vector only the k keys with the smallest primary
    keys matter.  None if no vector has more than k copies.
    """
    bits = np.ascontiguousarray(v).view(np.uint64 if v.itemsize == 8 else np.uint32).astype(np.uint64, copy=False)
    mix = np.random.default_rng(1).integers(1, 2**63, bits.shape[1], dtype=np.uint64) | np.uint64(1)
    mark = (bits * mix).sum(axis=1, dtype=np.uint64)
    if seen is not None:
        mark = mark * np.uint64(31) + (seen.astype(np.uint64) * mix[::-1]).sum(axis=1, dtype=np.uint64)
    group, first, size = np.unique(mark, return_index=True, return_counts=True)
    if size.max() <= spec.k:
        return None
    of = np.searchsorted(group, mark)
    same = (v == v[first[of]]).all(axis=1)  # a row that merely shares the mark is kept as it is
    if seen is not None:
        same &= (seen == seen[first[of]]).all(axis=1)
    copies = np.flatnonzero(same & (size[of] > spec.k))
    keys, ranks = _codes(rows[spec.key])[copies].astype(np.int64), _order_of(rows[spec.pk])[copies]
    order = np.lexsort((ranks, of[copies]))
    by_key = of[copies][order] * (keys.max(initial=0) + 1) + keys[order]
    order = order[np.sort(np.unique(by_key, return_index=True)[1])]
    groups = of[copies][order]
    kept = copies[order[np.arange(len(order)) - np.searchsorted(groups, groups, side="left") < spec.k]]
    others = np.ones(len(v), bool)
    others[copies] = False
    return np.sort(np.concatenate([np.flatnonzero(others), kept]))


def settled_scores(v, q, i, j, metric):
    """Scores of single pairs, summed in a fixed order: copies score alike, a vector is at distance 0 from itself."""
    out = np.empty(len(i))
    width = max(1, CELLS // max(1, v.shape[1]))
    for s in range(0, len(i), width):
        e = s + width
        out[s:e] = pair_scores(v[i[s:e]], q[j[s:e]], metric)
    return out


def row_slices(table: pa.Table, dim: int, cells: int | None = None, rows: int | None = None):
    width = min(rows or ROWS, max(64, (cells or CELLS) // max(1, dim)))
    for start in range(0, table.num_rows, width):
        yield table.slice(start, width)


def offer(best: Best, table: pa.Table, vec: str, queries: Queries, probes=None, cell=None) -> None:
    """Offer a batch of rows to all queries, or with ``probes`` only to those probing the row's cell."""
    if table[vec].null_count:
        table = table.filter(table[vec].is_valid())
    kept = list(dict.fromkeys([best.spec.pk, best.spec.key, *best.spec.carry]))
    for part, at, codec in queries.parts():
        dim = part.matrix.shape[1]
        single = best.spec.metric not in BINARY and codec.kind != "sparse"
        for piece in row_slices(table, dim, SPARSE_CELLS if codec.kind == "sparse" else None, CELLS if single else ROWS):
            v, seen = decode_rows(piece[vec].combine_chunks(), codec)
            if not len(v):
                continue
            if (v.shape[1] if codec.books is None else codec.books.shape[0] * codec.books.shape[2]) != part.matrix.shape[1]:
                raise ValueError("vector dimension does not match the field")
            rows = piece.select(kept)
            cells = None if probes is None else piece[cell].to_numpy()
            if probes is None:
                _scan_distinct(best, rows, v, part, at, seen, codec.books)
                continue
            for c in np.unique(cells):
                asking = probes.get(int(c))
                if asking is not None:
                    mine = np.flatnonzero(cells == c)
                    _scan_distinct(best, rows.take(pa.array(mine)), v[mine], part.take(asking), asking, books=codec.books)


def _scan_distinct(best: Best, rows: pa.Table, v, q: QueryBlock, at: np.ndarray, seen=None, books=None) -> None:
    """``scan_block`` of rows that all meet the same queries, surplus copies of a vector left out."""
    few = without_surplus_copies(rows, v, seen, best.spec)
    if few is not None:
        rows, v, seen = rows.take(pa.array(few)), v[few], None if seen is None else seen[few]
    scan_block(best, rows, v, q, at, seen, books)
