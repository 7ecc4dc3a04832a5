"""Whole results in ordered batches: table export and the full ranked list of a search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark.operators.distances import score_all
from vecspark.plans.kernel import SIMILARITIES
from vecspark.plans.ranking import global_rank, in_batches
from vecspark.session import materialize

BATCH = 1000  # fixed default batch size
PARTS = 1000  # of the sketch of a query's scores


def export_batches(rows: DataFrame, pk: str, size: int = BATCH, where: Column | str | None = None) -> DataFrame:
    """All (matching) rows in primary-key order with their row number and batch number."""
    source = rows if where is None else rows.where(where)
    return in_batches(global_rank(source, [F.col(pk)], out="row_no"), size, "row_no")


def search_export(
    rows: DataFrame, queries: DataFrame, *, metric: str, vec: str, pk: str, qid: str = "qid", qvec: str = "qvec",
    size: int = BATCH, where: Column | str | None = None, score: str = "score", batches: tuple[int, int] | None = None,
) -> DataFrame:
    """Every row's rank per query, in batches; the whole result has rows x queries rows by definition.

    ``batches``: only the batches from the first to the last of these numbers.  All pairs are scored and written once
    either way; only rows of about the asked-for ranks, found by a sketch of every query's scores, are shuffled and ranked.
    """
    if batches is not None and not 0 <= batches[0] <= batches[1]:
        raise ValueError("batch numbers run from 0, the first not beyond the last")
    source = rows if where is None else rows.where(where)
    scored = materialize(score_all(source, queries, metric, pk=pk, vec=vec, qid=qid, qvec=qvec, score=score), "scores")
    direction = F.col(score).desc() if metric.upper() in SIMILARITIES else F.col(score).asc()
    if batches is None:
        return in_batches(global_rank(scored, [direction, F.col(pk)], within=qid), size)
    first, last = batches
    near = _part(scored, qid, F.col(score), metric.upper() not in SIMILARITIES, first * size, (last + 1) * size)
    ranked = global_rank(near, [direction, F.col(pk)], within=qid, out="_rank").withColumn("rank", F.col("_rank") + F.col("_before_part"))
    return in_batches(ranked.drop("_rank", "_before_part"), size).where(F.col("batch_no").between(first, last))


def _part(scored: DataFrame, qid: str, score: Column, rising: bool, start: int, stop: int) -> DataFrame:
    """Rows among which every query's ranks start + 1 to stop lie, with the number of rows in front of them.

    A sketch of every query's scores has PARTS parts of about equally many rows.  The parts around the ranks give two
    borders, one part to spare on both sides; rows outside are then counted exactly, and a border that shut out an
    asked-for rank would be lifted, so the sketch's error costs rows to rank but never rows of the result.
    """
    place = score if rising else F.when(F.isnan(score), float("-inf")).otherwise(-score)
    rows = scored.withColumn("_place", place)
    shares = [i / PARTS for i in range(PARTS + 1)]
    sketch = rows.groupBy(F.col(qid).alias("_q")).agg(F.percentile_approx("_place", shares, 10 * PARTS).alias("_cuts"), F.count("*").alias("_n"))
    low, high = F.floor(F.lit(start) / F.col("_n") * PARTS).cast("long") - 1, F.ceil(F.lit(stop) / F.col("_n") * PARTS).cast("long") + 1
    borders = materialize(sketch.where(F.col("_n") > start).select(
        "_q", F.when(low >= 0, F.get("_cuts", low.cast("int"))).otherwise(float("-inf")).alias("_low"),
        F.when(high <= PARTS, F.get("_cuts", F.least(high, F.lit(PARTS)).cast("int"))).otherwise(float("nan")).alias("_high")), "borders")
    same = F.col(qid).eqNullSafe(F.col("_q"))
    counts = rows.join(borders, same).groupBy("_q").agg(
        F.count_if(F.col("_place") < F.col("_low")).alias("_front"), F.count_if(F.col("_place") <= F.col("_high")).alias("_upto"), F.count("*").alias("_n"))
    held = borders.join(counts.withColumnRenamed("_q", "_own"), F.col("_q").eqNullSafe(F.col("_own"))).select(
        "_q", F.when(F.col("_front") <= start, F.col("_low")).otherwise(float("-inf")).alias("_low"),
        F.when(F.col("_upto") >= F.least(F.lit(stop), "_n"), F.col("_high")).otherwise(float("nan")).alias("_high"),
        F.when(F.col("_front") <= start, F.col("_front")).otherwise(0).alias("_before_part"))
    met = same & (F.col("_place") >= F.col("_low")) & (F.col("_place") <= F.col("_high"))  # NaN is above all
    return rows.join(held, met).drop("_q", "_place", "_low", "_high")


def write_batches(batches: DataFrame, path: str, order: str) -> None:
    """One folder per batch, rows in order."""
    batches.sortWithinPartitions("batch_no", order).write.partitionBy("batch_no").parquet(path)
