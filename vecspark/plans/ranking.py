"""Row numbers over a whole distributed result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecspark.session import materialize

POSITION_BITS = (1 << 33) - 1  # row position inside a task in monotonically_increasing_id()


def global_rank(df: DataFrame, order: Sequence[Column], *, within: str | None = None, out: str = "rank") -> DataFrame:
    """Number all rows 1..n in ``order`` (restarting per ``within`` value) without a one-task window.

    Rows are range-partitioned and sorted, written once, and numbered as position in the partition
    plus the sizes of the partitions before it; only those sizes are ever summed centrally.
    """
    keys = ([F.col(within)] if within else []) + list(order)
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id(), "_pos": place.bitwiseAND(F.lit(POSITION_BITS))})
    )
    placed = materialize(placed, "ranked")
    by = [within] if within else []
    sizes = placed.groupBy(*by, "_part").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    numbered = placed.join(starts, [*by, "_part"])
    rank = (F.col("_before") + F.col("_pos") - F.col("_first") + 1).cast("bigint")
    return numbered.withColumn(out, rank).drop("_part", "_pos", "_first", "_before")


def in_batches(ranked: DataFrame, size: int, rank: str = "rank", out: str = "batch_no") -> DataFrame:
    if size < 1:
        raise ValueError("batch size must be positive")
    return ranked.withColumn(out, F.floor((F.col(rank) - 1) / F.lit(size)).cast("bigint"))
