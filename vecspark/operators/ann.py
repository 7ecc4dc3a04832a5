"""Approximate search: an inverted-file index whose cells bound what a search reads.

Building reads the vectors twice.  The first read surveys them: row count, dimension, range of every entry and
a sample drawn by hash.  Centroids and code books are trained together on that sample, one pass over it
a round.  The second read assigns every row to its cell and lays the rows out by cell, so a search reads only the
row groups of the cells it probes.  Rows may also hold compact codes (8-bit scalar or product quantisation),
which are searched instead of the vectors, product codes by lookup tables.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vecspark import session
from vecspark.functions import distance
from vecspark.operators.search import check_group, check_metric, check_paging, check_range, search, vector_kind
from vecspark.plans import kernel, knn
from vecspark.plans.kernel import SIMILARITIES, Codec, Queries, Spec
from vecspark.plans.pruning import is_wanted

CELL = "cell"
CODE = "code"
CELL_METRICS = ("HAMMING", "JACCARD")  # metrics whose answer nearby cells of binary vectors can give
MAX_LIST = 65536  # fixed limit of cells and probes
INDEX_BYTES = 256 << 20  # bound of centroids or code books shipped to every task
FILE_BYTES = 128 << 20  # aimed size of one index file
TRAIN_ROWS = 1 << 16  # rows trained on, or TRAIN_PER_CODE per centroid or code if that is more
TRAIN_PER_CODE = 64
SURVEY_ROWS = 1 << 12  # sample rows of one survey task
MERGED_CODES = 1 << 12  # sums of so many centroids or codes travel as one row


@dataclass
class IvfIndex:
    spark: SparkSession
    path: str
    pk: str
    vec: str
    kind: str
    centers: np.ndarray
    coding: str | None = None
    lo: np.ndarray | None = None
    step: np.ndarray | None = None
    books: np.ndarray | None = None
    fields: list[str] = field(default_factory=list)

    @property
    def nlist(self) -> int:
        return len(self.centers)

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def codec(self) -> Codec:
        if self.coding == "sq8":
            return Codec("sq8", lo=self.lo, step=self.step)
        if self.coding == "pq":
            return Codec("pq", books=self.books)
        return Codec(self.kind)


# ---------------------------------------------------------------- build

def _survey_tasks(kind: str):
    """Per task the SURVEY_ROWS rows with the smallest hashes, and one row of count, range and the largest hash kept."""
    def run(batches):
        kept, held, n, lo, hi = [], 0, 0, None, None

        def smallest(parts):
            hashes, block = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            pick = np.argsort(hashes, kind="stable")[:SURVEY_ROWS]
            return hashes[pick], block[pick]

        for batch in batches:
            table = pa.Table.from_batches([batch])
            for piece in kernel.row_slices(table.filter(table[1].is_valid()), 64):
                block = kernel.decode(piece[1].combine_chunks(), Codec(kind)).astype(np.float64) if piece.num_rows else None
                if block is None:
                    continue
                n += len(block)
                ends = block.min(axis=0), block.max(axis=0)
                if lo is not None and len(lo) != block.shape[1]:
                    raise ValueError("vector dimension does not match the field")
                lo, hi = ends if lo is None else (np.minimum(lo, ends[0]), np.maximum(hi, ends[1]))
                kept.append((piece[0].to_numpy(), block))
                held += len(block)
                if held > 2 * SURVEY_ROWS:
                    kept = [smallest(kept)]
                    held = len(kept[0][0])
        if not n:
            return
        hashes, block = smallest(kept)
        names = ["h", "v", "n", "lo", "hi"]
        nothing = pa.nulls(len(hashes), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(block)), pa.nulls(len(hashes), pa.int64()), nothing, nothing], names)
        full = int(hashes[-1]) if n > len(hashes) else None  # beyond it this task has rows that it did not keep
        yield pa.RecordBatch.from_arrays([pa.array([full], pa.int64()), pa.nulls(1, pa.list_(pa.float64())), pa.array([n]),
                                          pa.array([lo.tolist()]), pa.array([hi.tolist()])], names)

    return run


@dataclass
class Survey:
    """What the first read of the vectors found."""

    rows: int
    lo: np.ndarray
    hi: np.ndarray
    sample: DataFrame  # (h, v): a uniform draw, by hash


def survey(rows: DataFrame, pk: str, vec: str, kind: str, wanted: int) -> Survey:
    found = rows.select(F.xxhash64(pk, vec).alias("h"), vec).mapInArrow(
        _survey_tasks(kind), "h long, v array<double>, n long, lo array<double>, hi array<double>")
    found = session.materialize(found, "survey")
    tasks = found.where("n IS NOT NULL")
    n, cut = tasks.agg(F.sum("n"), F.min("h")).first()
    if not n:
        return Survey(0, np.zeros(0), np.zeros(0), found.where("false").select("h", "v"))
    zipped = tasks.select(F.posexplode(F.arrays_zip("lo", "hi")).alias("dim", "e"))
    ends = zipped.groupBy("dim").agg(F.min("e.lo").alias("lo"), F.max("e.hi").alias("hi")).orderBy("dim").toArrow()
    if len({r.d for r in tasks.select(F.size("lo").alias("d")).distinct().collect()}) > 1:
        raise ValueError("vector dimension does not match the field")
    # Up to the smallest hash at which some task stopped, every row of the table with such a hash is in the sample.
    sample = found.where("n IS NULL").select("h", "v")
    sample = sample if cut is None else sample.where(F.col("h") <= cut)
    held = sample.count()
    if held > 2 * wanted:  # hashes are even: a share of their range is that share of the rows
        top = (1 << 63) - 1 if cut is None else cut
        sample = sample.where(F.col("h") <= int(-(1 << 63) + (top + (1 << 63)) * wanted // held))
    return Survey(n, ends["lo"].to_numpy(), ends["hi"].to_numpy(), sample)


def _sums(centers: np.ndarray, books: np.ndarray | None):
    """Per task the counts and sums of the rows nearest to every centroid, and to every code in its sub-space."""
    parts = [centers] if books is None else [centers, *books]
    cuts = np.cumsum([0, *([] if books is None else [b.shape[1] for b in books])])

    def run(batches):
        counts = [np.zeros(len(p), np.int64) for p in parts]
        totals = [np.zeros(p.shape) for p in parts]
        for batch in batches:
            block = kernel.decode(batch.column(0), Codec("dense"))
            for i, part in enumerate(parts if len(block) else []):
                own = block if i == 0 else block[:, cuts[i - 1]:cuts[i]]
                near = _near_codes(own, part)
                counts[i] += np.bincount(near, minlength=len(part))
                order = np.argsort(near, kind="stable")
                heads = np.flatnonzero(np.r_[True, np.diff(near[order]) != 0])
                totals[i][near[order][heads]] += np.add.reduceat(own[order], heads, axis=0)
        for i, (count, total) in enumerate(zip(counts, totals)):
            for lo in range(0, len(count), MERGED_CODES):
                some = slice(lo, lo + MERGED_CODES)
                if count[some].any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([lo], pa.int32()), pa.array([count[some].tobytes()], pa.binary()),
                         pa.array([total[some].tobytes()], pa.binary())], ["part", "first", "counts", "totals"])

    return run


def _merge_sums(rows: pa.Table) -> pa.Table:
    counts = sum(np.frombuffer(b.as_buffer(), np.int64) for b in rows["counts"])
    totals = sum(np.frombuffer(b.as_buffer(), np.float64) for b in rows["totals"])
    return rows.slice(0, 1).select(["part", "first"]).append_column("counts", pa.array([counts.tobytes()], pa.binary())).append_column(
        "totals", pa.array([totals.tobytes()], pa.binary()))


def _train(sample: DataFrame, centers: np.ndarray, books: np.ndarray | None, rounds: int) -> np.ndarray:
    """k-means of the cells and of every sub-space, all in the same passes over the sample; returns the cells' sizes.

    Sums of the tasks are merged by Spark; what reaches the driver is as large as centroids and books.
    """
    shape, sizes = "part int, first int, counts binary, totals binary", np.zeros(len(centers), np.int64)
    parts = [centers] if books is None else [centers, *books]
    for _ in range(rounds):
        merged = sample.select("v").mapInArrow(_sums(centers, books), shape).groupBy("part", "first").applyInArrow(_merge_sums, shape)
        moved = 0.0
        for row in merged.toArrow().to_pylist():
            part, some = parts[row["part"]], slice(row["first"], row["first"] + MERGED_CODES)
            count = np.frombuffer(row["counts"], np.int64)
            mean = np.frombuffer(row["totals"], np.float64).reshape(len(count), -1) / np.maximum(1, count)[:, None]
            old = part[some][count > 0]
            moved = max(moved, float(np.abs(mean[count > 0] - old).max(initial=0.0)))
            part[some][count > 0] = mean[count > 0]
            if row["part"] == 0:
                sizes[some] = count
        if moved < 1e-9:
            break
    return sizes


def _assigner(centers: np.ndarray, kind: str):
    half = (centers ** 2).sum(axis=1) / 2

    @F.arrow_udf(T.IntegerType())
    def assign(vec: pa.Array) -> pa.Array:
        out = np.empty(len(vec), np.int32)
        block = kernel.decode(vec, Codec(kind)) if len(vec) else np.zeros((0, centers.shape[1]))
        width = max(1, kernel.CELLS // len(centers))
        for s in range(0, len(block), width):
            out[s:s + width] = (half - block[s:s + width] @ centers.T).argmin(axis=1)
        return pa.array(out)

    return assign


def ivf_build(
    rows: DataFrame, path: str, *, pk: str, vec: str, nlist: int, fields: Sequence[str] = (),
    coding: str | None = None, m: int = 8, nbits: int = 8, max_iter: int = 10, keep_raw: bool = True,
) -> IvfIndex:
    """Train, assign and write the index; ``fields`` are stored for filters and output."""
    if not 1 <= nlist <= MAX_LIST:
        raise ValueError(f"nlist must be in [1, {MAX_LIST}]")
    if coding not in (None, "sq8", "pq"):
        raise ValueError(f"unknown coding {coding}")
    spark = rows.sparkSession
    kind = vector_kind(rows.schema[vec])
    if kind == "sparse" or (kind == "bits" and coding):
        raise ValueError("cells need dense or uncoded binary vectors")
    if coding == "pq" and not 1 <= nbits <= 16:
        raise ValueError("nbits must be in [1, 16]")
    codes = 1 << nbits if coding == "pq" else 1
    base = rows.where(F.col(vec).isNotNull()).select(*dict.fromkeys([pk, vec, *fields]))
    seen = survey(base, pk, vec, kind, max(TRAIN_ROWS, TRAIN_PER_CODE * max(nlist, codes)))
    dim = len(seen.lo)
    if not seen.rows:
        raise ValueError("an index needs at least one vector")
    if nlist * dim * 8 > INDEX_BYTES:
        raise ValueError("centroids exceed the size every task can hold; use fewer cells")
    if coding == "pq" and (m < 1 or dim % m):
        raise ValueError("m must divide the dimension")
    if codes * dim * 8 > INDEX_BYTES:
        raise ValueError("code books exceed the size every task can hold; use fewer bits")
    seeds = seen.sample.orderBy("h", "v").limit(max(nlist, codes)).select("v").toArrow()["v"].combine_chunks()
    seeds = kernel.decode(seeds.chunk(0) if isinstance(seeds, pa.ChunkedArray) else seeds, Codec("dense"))
    centers = np.resize(seeds, (nlist, dim))  # fewer rows than cells or codes: they repeat
    books = np.resize(seeds, (codes, dim)).reshape(codes, m, dim // m).transpose(1, 0, 2).copy() if coding == "pq" else None
    sizes = _train(seen.sample, centers, books, max_iter)
    index = IvfIndex(spark, path, pk, vec, kind, centers, coding, books=books, fields=list(fields))
    out = base.withColumn(CELL, _assigner(centers, kind)(vec))
    if coding == "sq8":
        index.lo, index.step = seen.lo, np.where(seen.hi > seen.lo, (seen.hi - seen.lo) / 255.0, 1.0)
        out = out.withColumn(CODE, _sq8_encoder(index.lo, index.step, kind)(vec))
    elif coding == "pq":
        out = out.withColumn(CODE, _pq_encoder(books, kind)(vec))
    if coding and not keep_raw:
        out = out.drop(vec)
    _lay_out(index, out, sizes.tolist(), seen.rows).write.parquet(f"{path}/rows")
    _save(index)
    return index


def _lay_out(index: IvfIndex, rows: DataFrame, sampled: list[int], n: int) -> DataFrame:
    """Rows sorted by cell in files of even size, with one shuffle and no extra pass.

    The unit interval is divided among the cells by their share of the trained rows and cut into
    equal file slots; a row's place is its cell's start plus a hash.  Small cells share a slot, and a
    cell holding a third of all rows takes a third of the slots.
    """
    spark = index.spark
    total = float(sum(sampled) + len(sampled))
    share = (np.array(sampled, np.float64) + 1) / total
    places = pa.table({CELL: pa.array(range(len(share)), pa.int32()), "_start": np.cumsum(share) - share, "_share": share})
    stored = n * (index.centers.shape[1] * 4 + 256)
    slots = max(min(index.nlist, spark.sparkContext.defaultParallelism), -(-stored // FILE_BYTES))
    placed = rows.join(spark.createDataFrame(places), CELL)
    content = CODE if index.coding else index.vec
    even = F.pmod(F.xxhash64(F.col(index.pk), F.col(content)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    slot = F.floor((F.col("_start") + even * F.col("_share")) * F.lit(slots)).cast("int")
    return placed.withColumn("_slot", slot).repartitionById(slots, F.col("_slot")).sortWithinPartitions(CELL, index.pk).drop(
        "_slot", "_start", "_share")


def _save(index: IvfIndex) -> None:
    spark = index.spark
    centers = pa.table({"cell": pa.array(range(index.nlist), pa.int32()), "center": pa.array(index.centers.tolist())})
    spark.createDataFrame(centers).write.parquet(f"{index.path}/centers")
    meta = {"pk": index.pk, "vec": index.vec, "kind": index.kind, "coding": index.coding, "fields": index.fields,
            "lo": None if index.lo is None else index.lo.tolist(), "step": None if index.step is None else index.step.tolist()}
    if index.books is not None:
        books = [(s, c, v.tolist()) for s, book in enumerate(index.books) for c, v in enumerate(book)]
        spark.createDataFrame(books, "sub int, code int, center array<double>").write.parquet(f"{index.path}/books")
    session.put_text(spark, f"{index.path}/meta.json", json.dumps(meta))  # last: an index without it is unfinished


def ivf_load(spark: SparkSession, path: str) -> IvfIndex:
    meta = json.loads(session.get_text(spark, f"{path}/meta.json"))
    centers = np.array([r.center for r in spark.read.parquet(f"{path}/centers").orderBy("cell").collect()])
    books = None
    if meta["coding"] == "pq":
        rows = spark.read.parquet(f"{path}/books").orderBy("sub", "code").collect()
        subs = rows[-1].sub + 1
        books = np.array([r.center for r in rows]).reshape(subs, len(rows) // subs, -1)
    as_array = lambda v: None if v is None else np.array(v)
    return IvfIndex(spark, path, meta["pk"], meta["vec"], meta["kind"], centers, meta["coding"],
                    as_array(meta["lo"]), as_array(meta["step"]), books, meta["fields"])


def _bytes_rows(block: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(block)
    width = raw.shape[1] * raw.itemsize if raw.size else 0
    ends = (np.arange(len(raw) + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])


def _sq8_encoder(lo: np.ndarray, step: np.ndarray, kind: str):
    @F.arrow_udf(T.BinaryType())
    def encode(vec: pa.Array) -> pa.Array:
        block = kernel.decode(vec, Codec(kind))
        return _bytes_rows(np.clip(np.rint((block - lo) / step), 0, 255).astype(np.uint8))

    return encode


def _near_codes(block: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest code of every row, in slices of bounded size."""
    out, half, step = np.empty(len(block), np.int64), (book ** 2).sum(axis=1) / 2, max(1, kernel.CELLS // len(book))
    for a in range(0, len(block), step):
        out[a:a + step] = (half - block[a:a + step] @ book.T).argmin(axis=1)
    return out


def _pq_encoder(books: np.ndarray, kind: str):
    dtype = kernel.code_type(books)

    @F.arrow_udf(T.BinaryType())
    def encode(vec: pa.Array) -> pa.Array:
        block = kernel.decode(vec, Codec(kind))
        m, _, width = books.shape
        out = np.empty((len(block), m), dtype)
        for s in range(m):
            out[:, s] = _near_codes(block[:, s * width:(s + 1) * width], books[s])
        return _bytes_rows(out)

    return encode


# ---------------------------------------------------------------- search

def _nearest_cells(block: np.ndarray, centers: np.ndarray, metric: str, nprobe: int) -> np.ndarray:
    """Cells to probe per query, in tiles of bounded size."""
    tile = max(1, kernel.CELLS // len(centers))
    if len(block) > tile:
        return np.concatenate([_nearest_cells(block[a:a + tile], centers, metric, nprobe) for a in range(0, len(block), tile)])
    score = block @ centers.T
    if metric == "COSINE":
        score = score / np.maximum(np.linalg.norm(centers, axis=1), 1e-300)
    elif metric != "IP":
        score = score - (centers ** 2).sum(axis=1) / 2
    top = min(nprobe, len(centers))
    if top == len(centers):
        return np.tile(np.arange(top), (len(block), 1))
    return np.argpartition(-score, top - 1, axis=1)[:, :top]


def ivf_search(
    index: IvfIndex, queries: DataFrame, k: int, *, metric: str, nprobe: int, qid: str = "qid", qvec: str = "qvec",
    where: Column | str | None = None, fields: Sequence[str] = (), offset: int = 0, radius: float | None = None,
    range_filter: float | None = None, group_by: str | None = None, score: str = "score",
) -> DataFrame:
    """Top-k among the rows of the ``nprobe`` nearest cells of each query, with ``group_by`` the best row per group.

    A bounded query set travels with the scan, which reads only probed cells; a larger one meets the
    rows in block-sized (cell, query block, row block) groups, so a crowded cell is never one task.
    """
    metric = metric.upper()
    if not 1 <= nprobe <= MAX_LIST:
        raise ValueError(f"nprobe must be in [1, {MAX_LIST}]")
    check_metric(index.kind, metric)
    if index.kind == "bits" and metric not in CELL_METRICS:
        raise ValueError(f"cells of binary vectors cannot answer {metric}; use one of {', '.join(CELL_METRICS)}")
    check_paging(k, offset)
    lower, upper = check_range(metric, radius, range_filter)
    target = CODE if index.coding else index.vec
    source = index.rows() if where is None else index.rows().where(where)
    if group_by is not None:
        check_group(source, group_by, index.kind, radius)
    carried = [f for f in fields if f not in (index.pk, group_by)]
    key = group_by or index.pk
    spec = Spec(metric, k + offset, index.pk, key, carried, lower, upper)
    opts = dict(vec=target, qid=qid, qvec=qvec, score=score, codec=index.codec(), spec=spec, cell=CELL)
    table = knn.fetch_bounded(queries, qid, qvec, index.kind, spec.k)
    if table is not None and table.num_rows * min(nprobe, index.nlist) * 8 <= session.BROADCAST_BYTES:
        block = kernel.Queries(table, qid, qvec, index.codec()).block.matrix
        _check_dim(block.shape[1], index)
        cells = _nearest_cells(block.astype(np.float64), index.centers, metric, nprobe)
        flat, asker = cells.ravel(), np.repeat(np.arange(len(cells)), cells.shape[1])
        order = np.argsort(flat, kind="stable")
        found, heads = np.unique(flat[order], return_index=True)
        probes = {int(c): a for c, a in zip(found, np.split(asker[order], heads[1:]))}
        if len(found) < index.nlist:
            source = source.where(is_wanted(CELL, found.tolist()))
        candidates = knn.scan_candidates(source, queries, table, probes=probes, **opts)
    elif index.coding == "pq" and nprobe >= index.nlist:  # all cells: blocks of codes may be larger than a cell, with one list a query
        candidates = knn.grid_candidates(source, queries, **{**opts, "cell": None})
    else:
        asked = queries.withColumn("_cells", _prober(index, metric, nprobe)(qvec))
        candidates = knn.grid_candidates(source, asked, query_cells="_cells", **opts)
    hits = knn.rank_best(candidates, qid=qid, score=score, pk=index.pk, key=key, k=k, offset=offset,
                         similarity=metric in SIMILARITIES, per_query=session.estimated_tasks(source) * spec.k)
    return hits.select(*dict.fromkeys([qid, "rank", index.pk, score, key, *carried]))


def _check_dim(dim: int, index: IvfIndex) -> None:
    if dim != index.centers.shape[1]:
        raise ValueError("vector dimension does not match the field")


def _prober(index: IvfIndex, metric: str, nprobe: int):
    centers, kind = index.centers, index.kind

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def probe(vec: pa.Array) -> pa.Array:
        if not len(vec):
            return pa.array([], pa.list_(pa.int32()))
        own = Codec(kind if kind == "bits" or pa.types.is_binary(vec.type) else "dense")
        cells = _nearest_cells(kernel.decode(vec, own).astype(np.float64), centers, metric, nprobe).astype(np.int32)
        ends = (np.arange(len(cells) + 1) * cells.shape[1]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.ravel()))

    return probe


def rerank(
    candidates: DataFrame, rows: DataFrame, queries: DataFrame, k: int, *, metric: str, pk: str, vec: str,
    qid: str = "qid", qvec: str = "qvec", score: str = "score", fields: Sequence[str] = (), offset: int = 0,
    radius: float | None = None, range_filter: float | None = None,
) -> DataFrame:
    """Exact top-k of approximate candidates: their stored vectors are joined by key, or by (cell, key) if both sides
    have cells, and re-scored.  Candidates too many to be broadcast are met in blocks of rows and queries."""
    metric = metric.upper()
    lower, upper = check_range(metric, radius, range_filter)
    pair = {"L2": distance.l2, "IP": distance.ip, "COSINE": distance.cosine}[metric]
    asked = queries.select(qid, qvec)
    if knn.fetch_bounded(queries, qid, qvec) is not None:
        asked = F.broadcast(asked)  # its decoded size has been checked
    on, pairs, rows, few = _pairs(candidates, rows, pk, qid)
    plain = all(isinstance(t, T.ArrayType) and not isinstance(t.elementType, T.StructType) for t in (rows.schema[vec].dataType, queries.schema[qvec].dataType))
    if not few and plain and all(pairs.schema[c].dataType == rows.schema[c].dataType for c in on):
        spec = Spec(metric, k + offset, pk, pk, [f for f in fields if f != pk], lower, upper)
        found = _rescored(pairs, rows, queries.select(qid, qvec), on, vec=vec, qid=qid, qvec=qvec, score=score, spec=spec)
        hits = knn.rank_best(found, qid=qid, score=score, pk=pk, key=pk, k=k, offset=offset, similarity=metric in SIMILARITIES)
        return hits.select(qid, "rank", pk, score, *fields)
    best = rows.select(*dict.fromkeys([*on, vec, *fields])).join(F.broadcast(pairs) if few else pairs, on).join(asked, qid)
    scored = best.select(qid, pk, pair(qvec, vec).alias(score), *fields).where(F.col(score).isNotNull())
    if lower is not None:
        scored = scored.where(F.col(score) >= lower)
    if upper is not None:
        scored = scored.where(F.col(score) < upper)
    hits = knn.rank_best(scored, qid=qid, score=score, pk=pk, key=pk, k=k, offset=offset, similarity=metric in SIMILARITIES)
    return hits.select(qid, "rank", pk, score, *fields)


def _pairs(candidates: DataFrame, rows: DataFrame, pk: str, qid: str) -> tuple[list[str], DataFrame, DataFrame, bool]:
    """(key columns, written candidates, the rows of their cells, whether the candidates are few enough to be broadcast, so
    that stored vectors stay where they are)."""
    on = [CELL, pk] if CELL in candidates.columns and CELL in rows.columns else [pk]
    asked = session.materialize(candidates.select(qid, *on), "candidates")
    if len(on) == 2:
        cells = [r[0] for r in asked.select(CELL).distinct().collect()]  # at most MAX_LIST
        rows = rows.where(is_wanted(CELL, cells))
    width = 64 + (asked.agg(F.max(F.length(pk))).first()[0] or 0 if isinstance(asked.schema[pk].dataType, T.StringType) else 0)
    return on, asked, rows, asked.count() * width <= session.BROADCAST_BYTES


def _rescored(pairs: DataFrame, rows: DataFrame, queries: DataFrame, on: list[str], *, vec: str, qid: str, qvec: str, score: str,
              spec: Spec) -> DataFrame:
    """The best of every query's candidates in every block of rows, by exact scores.

    A block of rows meets a block of queries, each with the keys of its candidates in the block: a vector travels once per
    block of the other side, not once per pair.
    """
    kept, names = knn.kept_columns(spec), list(on)
    base = rows.where(F.col(vec).isNotNull()).select(*dict.fromkeys([*on, *kept, vec]))
    asked = queries.where(F.col(qvec).isNotNull())
    many, cores = max(1, asked.count()), rows.sparkSession.sparkContext.defaultParallelism
    listed = -(-pairs.count() // many)  # keys of a query; best lists are shorter
    _, query_rows = knn.block_sizes(asked, qvec, "dense", max(listed, spec.k), -(-many // (knn.GRID_ROUNDS * cores)))
    row_rows, _ = knn.block_sizes(asked, qvec, "dense")
    q_blocks, row_blocks = -(-many // query_rows), max(1, -(-base.count() // row_rows))
    block = F.pmod(F.xxhash64(*on), F.lit(row_blocks)).alias("_rb")
    keys = pairs.select(qid, F.struct(*on).alias("_key"), block).repartition(F.col(qid)).groupBy(qid, "_rb").agg(
        F.collect_list("_key").alias("_keys"))
    query_side = keys.join(asked, qid).withColumn("_qb", F.pmod(F.xxhash64(qid, qvec), F.lit(q_blocks)))
    row_side = base.select("*", block, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))).alias("_qb"))
    schema = knn._output_schema(rows, queries, qid, score, kept)
    nothing, out = to_arrow_schema(schema).empty_table(), schema.names

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return nothing
        keys = right["_keys"].combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        flat, owner = keys.flatten(), np.repeat(np.arange(len(keys)), keys.value_lengths().to_numpy(zero_copy_only=False))
        wanted = pa.table([*[flat.field(c) for c in names], pa.array(owner)], names=[*names, "_j"])
        stored = left.select(names).append_column("_i", pa.array(np.arange(left.num_rows)))
        both = wanted.join(stored, names, join_type="inner", use_threads=False)
        j, i = both["_j"].to_numpy(), both["_i"].to_numpy()
        asked, dense = Queries(right, qid, qvec, Codec("dense")), kernel.decode(left[vec].combine_chunks(), Codec("dense"))
        if asked.block.matrix.shape[1] != dense.shape[1]:
            raise ValueError("vector dimension does not match the field")
        cost = kernel.settled_scores(dense, asked.block.matrix, i, j, spec.metric)
        known = ~np.isnan(cost) if spec.metric == "COSINE" else np.ones(len(cost), bool)  # no direction, no hits
        if spec.lower is not None:
            known &= cost >= spec.lower
        if spec.upper is not None:
            known &= cost < spec.upper
        best = kernel.Best(spec, asked.count)
        best.add(left.select(kept).take(pa.array(i[known])), j[known], cost[known] * spec.sign)
        found = list(best.batches(asked.ids, out))
        return pa.Table.from_batches(found) if found else nothing

    block = knn.dealt_evenly(rows.sparkSession, F.col("_qb") * row_blocks + F.col("_rb"), q_blocks * row_blocks)
    row_side, query_side = (side.withColumn("_block", block).drop("_qb", "_rb") for side in (row_side, query_side))
    return row_side.groupBy("_block").cogroup(query_side.groupBy("_block")).applyInArrow(meet, schema)


def scann_search(
    index: IvfIndex, queries: DataFrame, k: int, *, metric: str, nprobe: int, reorder_k: int, raw: DataFrame | None = None,
    qid: str = "qid", qvec: str = "qvec", where: Column | str | None = None, fields: Sequence[str] = (), offset: int = 0,
    radius: float | None = None, range_filter: float | None = None,
) -> DataFrame:
    """``reorder_k`` coded candidates per query that pass ``where``, re-ranked exactly to ``k``; ``raw``
    supplies the vectors and fields of an index built without them.  A range holds for the exact scores."""
    check_paging(k, offset)
    if reorder_k < k + offset:
        raise ValueError("reorder_k must be at least offset + k")
    rough = ivf_search(index, queries, reorder_k, metric=metric, nprobe=nprobe, qid=qid, qvec=qvec, where=where, fields=[CELL])
    source = raw if raw is not None else index.rows()
    return rerank(rough, source, queries, k, metric=metric, pk=index.pk, vec=index.vec, qid=qid, qvec=qvec, fields=fields,
                  offset=offset, radius=radius, range_filter=range_filter)


def recall(approximate: DataFrame, exact: DataFrame, *, pk: str, qid: str = "qid") -> DataFrame:
    """(qid, recall): the share of the exact hits that the approximate result holds."""
    found = approximate.select(qid, pk).withColumn("_hit", F.lit(1.0))
    joined = exact.select(qid, pk).join(found, [qid, pk], "left")
    return joined.groupBy(qid).agg((F.sum(F.coalesce("_hit", F.lit(0.0))) / F.count("*")).alias("recall"))


def recall_estimate(
    hits: DataFrame, rows: DataFrame, queries: DataFrame, k: int, *, metric: str, vec: str, pk: str, qid: str = "qid",
    qvec: str = "qvec", one_in: int = 10, z: float = 1.96, **options,
) -> DataFrame:
    """(asked, sampled, recall, low, high): the mean recall of ``hits`` from the exact search of one in ``one_in`` queries.

    Queries are drawn by the MD5 of their id, so the draw is the same in every run.  The interval is the mean plus or
    minus z standard errors of a draw without replacement, from 0 to 1 where fewer than two queries were drawn.
    ``options`` are those of the exact search (filters, ranges).
    """
    if one_in < 1:
        raise ValueError("one_in must be at least 1")
    known = queries.where(F.col(qvec).isNotNull())
    draw = F.pmod(F.conv(F.substring(F.md5(F.col(qid).cast("string")), 1, 7), 16, 10).cast("bigint"), F.lit(one_in))
    some = session.materialize(known.where(draw == 0), "drawn-queries")
    total = known.select(qid).distinct().agg(F.count("*").alias("asked"))
    if some.isEmpty():
        return total.select("asked", F.lit(0).cast("bigint").alias("sampled"), F.lit(None).cast("double").alias("recall"),
                            F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
    exact = session.materialize(search(rows, some, k, metric=metric, vec=vec, pk=pk, qid=qid, qvec=qvec, **options), "exact")
    per = recall(hits.join(F.broadcast(some.select(qid).distinct()), qid, "left_semi") if some.count() * 64 <= session.BROADCAST_BYTES
                 else hits.join(some.select(qid).distinct(), qid, "left_semi"), exact, pk=pk, qid=qid)
    found = per.agg(F.count("*").alias("sampled"), F.avg("recall").alias("recall"), F.var_samp("recall").alias("_v"))
    error = F.lit(z) * F.sqrt(F.col("_v") / F.col("sampled") * (1 - F.col("sampled") / F.col("asked")))
    return total.crossJoin(found).select(  # one row each
        "asked", "sampled", "recall", F.coalesce(F.greatest(F.lit(0.0), F.col("recall") - error), F.lit(0.0)).alias("low"),
        F.coalesce(F.least(F.lit(1.0), F.col("recall") + error), F.lit(1.0)).alias("high"))


def index_progress(index: IvfIndex, rows: DataFrame) -> DataFrame:
    """(total_rows, indexed_rows)."""
    total = rows.agg(F.count("*").alias("total_rows")).withColumn("_one", F.lit(1))
    done = index.rows().where(F.col(CELL).isNotNull()).agg(F.count("*").alias("indexed_rows")).withColumn("_one", F.lit(1))
    return total.join(done, "_one").drop("_one")
