"""Hard negatives by segment summaries: bounds on inner products before any exact score.

Every vector is cut into LEAVES segments; the table keeps each segment's mean and deviation.  For two
vectors x and y and a segment of n components,

    n * mean(x) * mean(y)  -  n * dev(x) * dev(y)  <=  sum(x * y)  <=  n * mean(x) * mean(y)  +  n * dev(x) * dev(y),

and summed over the segments of a cut this bounds the whole score.  Pairs are judged on one segment first,
then on 2, 4 ... LEAVES segments (summaries of wider segments follow from those of their halves); only
pairs that every cut leaves open are scored exactly, in integers.

1. Rows and anchors are written in blocks of ROWS and ANCHORS.  A pair of blocks is one task, so rows move
   once per anchor block and anchors once per row block; a block pair emits best lists only.
2. Positives: of an anchor's rows with the same label the N_POSITIVES best.  A pair is open while its upper
   bound reaches the anchor's running last place.
3. Negatives: each (anchor, positive) has a window of scores.  A pair is open while it may fall into a
   window of its anchor and reach that window's running last place.

Defined cases: rows with a null label, a null or empty vector, or any null or non-finite component take no part;
shorter vectors count as filled up with zeros; a null id is never an anchor and comes last in ties; equal
scores and ids fall to the earlier row; rows that repeat an id are rows of their own, so a second row of
the anchor's id may be its positive or negative; components of 2**15 or more are refused with a ValueError, so that
scores stay exact; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecspark.session import materialize

LEAVES = 16
ROWS = 4096
ANCHORS = 4096
TILE = 512
PAIRS = 1 << 16
SPARSE = 16  # one open pair of so many is worth a matrix product
N_POSITIVES = 5
N_NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score
LARGEST = 1 << 23  # of 256 * x: scores of up to 65536 components fit 63 bits
LAST = np.iinfo(np.int64).max
NO_SCORE = np.iinfo(np.int64).min
ROUNDING = 1e-9  # of the product of the lengths: far above what 64-bit floats lose on bounds


def quantised(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """floor(256 * x) of ragged vectors as one matrix, a multiple of LEAVES wide, zeros behind short vectors."""
    values = np.floor(256 * flat.astype(np.float64))
    if len(values) and np.abs(values).max() >= LARGEST:
        raise ValueError("components of 2**15 or more are not supported")
    width = -(-max(int(lengths.max(initial=0)), 1) // LEAVES) * LEAVES
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values.astype(np.int64)
    return out


def summaries(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean, deviation) of every row's LEAVES segments."""
    parts = block.reshape(len(block), LEAVES, -1).astype(np.float64)
    return parts.mean(axis=2), parts.std(axis=2)


def widened(mean: np.ndarray, deviation: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of neighbouring segments joined in twos."""
    left, right = mean[:, 0::2], mean[:, 1::2]
    joined = (left + right) / 2
    spread = (deviation[:, 0::2] ** 2 + deviation[:, 1::2] ** 2) / 2 + ((left - right) / 2) ** 2
    return joined, np.sqrt(spread)


def cuts_of(mean: np.ndarray, deviation: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Summaries from one segment to LEAVES, scaled by the root of the segment's size; the vector's length, for rounding, behind
    the deviations."""
    cuts, size = [], width // LEAVES
    length = np.sqrt(size * (mean**2 + deviation**2).sum(axis=1, keepdims=True))
    while True:
        cuts.append((mean * np.sqrt(size), np.hstack([deviation * np.sqrt(size), length * np.sqrt(ROUNDING)])))
        if mean.shape[1] == 1:
            return cuts[::-1]
        mean, deviation = widened(mean, deviation)
        size *= 2


def inner(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (i, j) of rows."""
    out = np.empty(len(i), left.dtype)
    for lo in range(0, len(i), PAIRS):
        part = slice(lo, lo + PAIRS)
        out[part] = np.einsum("ij,ij->i", left[i[part]], right[j[part]])
    return out


def bounds(left, right) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of all pairs of two blocks on one cut."""
    middle, reach = left[0] @ right[0].T, left[1] @ right[1].T
    return middle - reach, middle + reach


def survivors(left_cuts, right_cuts, allowed: np.ndarray, is_open) -> np.ndarray:
    """Which pairs of ``allowed`` stay open on every cut; ``is_open(i, lower, upper)`` judges bounds of anchors i.

    While many pairs are open a cut is a matrix product; the few of later cuts are judged one by one.
    """
    still, every = allowed, np.arange(len(allowed))[:, None]
    for left, right in zip(left_cuts, right_cuts):
        if np.count_nonzero(still) * SPARSE > still.size:
            still = still & is_open(every, *bounds(left, right))
            continue
        i, j = np.nonzero(still)
        middle, reach = inner(left[0], right[0], i, j), inner(left[1], right[1], i, j)
        shut = ~is_open(i, middle - reach, middle + reach)
        still = still.copy()
        still[i[shut], j[shut]] = False
    return still


def exact(left: np.ndarray, right: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the wanted pairs, in integers."""
    i, j = np.nonzero(wanted)
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if len(i) * SPARSE > wanted.size and largest < 2**53:  # every sum is a whole number that a 64-bit float holds
        return i, j, (left.astype(np.float64) @ right.astype(np.float64).T)[i, j].astype(np.int64)
    return i, j, inner(left, right, i, j)


class BestLists:
    """The ``size`` best (score, id, row) of every slot; higher scores first, then smaller ids and rows."""

    def __init__(self, slots: int, size: int):
        self.size, self.slots = size, slots
        self.slot = self.score = self.id = self.row = np.zeros(0, np.int64)
        self.last = np.full(slots, NO_SCORE)  # the score a newcomer has to reach

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray, row: np.ndarray) -> None:
        near = score >= self.last[slot]
        slot, score, ident, row = (np.concatenate([a, b[near]]) for a, b in zip(
            (self.slot, self.score, self.id, self.row), (slot, score, ident, row)))
        order = np.lexsort((row, ident, -score, slot))
        slot = slot[order]
        begins = np.searchsorted(slot, np.arange(self.slots))
        place = np.arange(len(slot)) - begins[slot]
        best = order[place < self.size]
        full = slot[place == self.size - 1]
        self.slot, self.score, self.id, self.row = slot[place < self.size], score[best], ident[best], row[best]
        self.last[full] = score[order[place == self.size - 1]]


class Block:
    """One side of a block pair, from its Arrow table."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        lists = [rows[name].combine_chunks() for name in ("values", "mean", "deviation")]
        values, mean, deviation = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
        lengths = pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False)
        self.values = np.zeros((len(lengths), int(lengths.max(initial=LEAVES))), np.int64)
        self.values[np.arange(self.values.shape[1]) < lengths[:, None]] = values
        if (lengths == self.values.shape[1]).all():
            self.mean, self.deviation = mean.reshape(-1, LEAVES), deviation.reshape(-1, LEAVES)
        else:
            self.mean, self.deviation = summaries(self.values)
        self.id, self.row, self.label = (
            rows[name].combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False) for name in ("id", "row", "label"))

    def padded(self, width: int) -> "Block":
        if self.values.shape[1] < width:
            self.values = np.pad(self.values, ((0, 0), (0, width - self.values.shape[1])))
            self.mean, self.deviation = summaries(self.values)
        return self

    def cuts(self):
        return cuts_of(self.mean, self.deviation, self.values.shape[1])


def _meet(left: pa.Table, right: pa.Table) -> tuple[Block, Block]:
    a, b = Block(left), Block(right)
    width = max(a.values.shape[1], b.values.shape[1])
    return a.padded(width), b.padded(width)


def _tiles(cuts, n: int):
    for lo in range(0, n, TILE):
        yield lo, [(mean[lo:lo + TILE], deviation[lo:lo + TILE]) for mean, deviation in cuts]


def positives_of(anchors: pa.Table, rows: pa.Table, n_positives: int = N_POSITIVES) -> pa.Table:
    """(anchor, id, row, score): each anchor's best rows of its label within one block pair."""
    a, r = _meet(anchors, rows)
    best, left = BestLists(len(a.id), n_positives), a.cuts()
    for lo, right in _tiles(r.cuts(), len(r.id)):
        part = slice(lo, lo + TILE)
        allowed = (a.label[:, None] == r.label[None, part]) & (a.row[:, None] != r.row[None, part])
        still = survivors(left, right, allowed, lambda i, lower, upper: upper >= best.last[i])
        i, j, score = exact(a.values, r.values[part], still)
        best.add(i, score, r.id[j + lo], r.row[j + lo])
    return pa.table({"anchor": a.row[best.slot], "anchor_id": a.id[best.slot], "id": pa.array(best.id, mask=best.id == LAST),
                     "row": best.row, "score": best.score})


def negatives_of(anchors: pa.Table, rows: pa.Table, n_negatives: int = N_NEGATIVES, low: int = LOW, high: int = HIGH) -> pa.Table:
    """(anchor, nth, id, row, score): the best rows of other labels in the window of every positive, within one block pair.

    ``anchors`` carries the scores of its positives, best first.
    """
    a, r = _meet(anchors, rows)
    scores = [np.array(s, np.int64) for s in anchors["scores"].to_pylist()]
    many = max([len(s) for s in scores], default=0)
    floor, ceiling = np.full((len(scores), many), LAST), np.full((len(scores), many), NO_SCORE)
    for i, s in enumerate(scores):
        floor[i, :len(s)], ceiling[i, :len(s)] = -(-low * s // 100), high * s // 100
    ceiling[ceiling < floor] = NO_SCORE  # an empty window
    best, left, most = BestLists(len(scores) * many, n_negatives), a.cuts(), ceiling.max(axis=1, initial=NO_SCORE)
    for lo, right in _tiles(r.cuts(), len(r.id)):
        part = slice(lo, lo + TILE)
        need = np.maximum(floor, best.last.reshape(len(scores), many))
        least = need.min(axis=1, initial=LAST)
        still = survivors(left, right, a.label[:, None] != r.label[None, part],
                          lambda i, lower, upper: (upper >= least[i]) & (lower <= most[i]))
        i, j, score = exact(a.values, r.values[part], still)
        near = score >= least[i]
        i, j, score = i[near], j[near] + lo, score[near]
        for nth in range(many):
            fits = (score >= need[i, nth]) & (score <= ceiling[i, nth])
            best.add(i[fits] * many + nth, score[fits], r.id[j[fits]], r.row[j[fits]])
    slot = best.slot // max(many, 1)
    return pa.table({"anchor": a.row[slot], "nth": pa.array(best.slot - slot * many, pa.int32()),
                     "id": pa.array(best.id, mask=best.id == LAST), "row": best.row, "score": best.score})


def _prepare(batches):
    """Integer vectors with their summaries, numbered in the order they are read."""
    task, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            vectors = part.column(1)
            values = quantised(vectors.flatten().to_numpy(zero_copy_only=False), np.diff(vectors.offsets.to_numpy()))
            n, width = values.shape
            row = (task << 40) + at + np.arange(n, dtype=np.int64)
            at += n

            def lists(flat, size):
                return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(flat.ravel()))

            mean, deviation = summaries(values)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3), pa.array(row), lists(values.astype(np.int32), width),
                 lists(mean, LEAVES), lists(deviation, LEAVES)],
                ["id", "label", "is_anchor", "row", "values", "mean", "deviation"])


def _grid(anchors: DataFrame, rows: DataFrame, task, schema: str) -> DataFrame:
    """``task`` on every pair of an anchor block and a row block; both are dealt by hash."""
    many_a, many_r = max(1, -(-anchors.count() // ANCHORS)), max(1, -(-rows.count() // ROWS))
    left = anchors.withColumn("a", F.pmod(F.xxhash64("row"), F.lit(many_a))).withColumn(
        "r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many_r - 1).cast("long"))))
    right = rows.withColumn("r", F.pmod(F.xxhash64("row"), F.lit(many_r))).withColumn(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many_a - 1).cast("long"))))
    return left.groupBy("a", "r").cogroup(right.groupBy("a", "r")).applyInArrow(task, schema)


def _first(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)


def mine(table: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec: str = "embedding", label: str | Column = "label",
         n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    An anchor's positives are its ``n_positives`` best other rows of its label; its negatives for a positive
    of score p the ``n_negatives`` best rows of other labels with low * p <= 100 * score <= high * p.
    ``label`` may be of any type; what is no whole number is compared by a 64-bit hash.
    """
    label = F.col(label) if isinstance(label, str) else label
    whole = table.select(label.alias("l")).schema["l"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = table.filter(label.isNotNull() & F.col(vec).isNotNull() & (F.size(vec) > 0) & finite)
    raw = taken.select(
        F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vector"),
        (label.cast("long") if whole else F.xxhash64(label)).alias("label"),
        (F.coalesce(is_anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("is_anchor"))
    rows = materialize(raw.mapInArrow(
        _prepare, "id long, label long, is_anchor boolean, row long, values array<int>, mean array<double>, deviation array<double>"),
        "vectors")
    anchors, rows = rows.filter("is_anchor").drop("is_anchor"), rows.drop("is_anchor")

    found = _grid(anchors, rows, lambda a, r: positives_of(a, r, n_positives),
                  "anchor long, anchor_id long, id long, row long, score long")
    positives = materialize(_first(found, ["anchor"], n_positives), "positives")

    scores = positives.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("scores"))
    scored = materialize(anchors.join(scores.select("row", F.col("scores.score").alias("scores")), "row"), "anchors")
    found = _grid(scored, rows, lambda a, r: negatives_of(a, r, n_negatives, low, high),
                  "anchor long, nth int, id long, row long, score long")
    negatives = _first(found, ["anchor", "nth"], n_negatives).select(
        "anchor", (F.col("nth") + 1).alias("place"), F.col("place").alias("rank"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    own = positives.select("anchor", "place", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return own.join(negatives, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
