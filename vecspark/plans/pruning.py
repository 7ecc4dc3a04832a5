"""Filters that let a parquet scan skip row groups for a long list of wanted numbers."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

RANGES = 32


def wanted_ranges(values: Iterable[int], most: int = RANGES) -> list[tuple[int, int]]:
    """Cover the values with at most ``most`` closed ranges, split at the widest gaps."""
    v = np.unique(np.fromiter(values, np.int64))
    gaps = np.diff(v)
    cuts = np.sort(np.argsort(-gaps, kind="stable")[: most - 1])
    cuts = cuts[gaps[cuts] > 1]
    starts, ends = np.r_[v[:1], v[cuts + 1]], np.r_[v[cuts], v[-1:]]
    return list(zip(starts.tolist(), ends.tolist()))


def is_wanted(column: str, values: Iterable[int]) -> Column:
    """``column IN (values)`` together with ranges that cover them.

    Scans only compare a long IN list with a row group's overall minimum and maximum; the ranges are
    compared one by one.
    """
    listed = sorted(set(values))
    if not listed:
        return F.lit(False)
    near = " OR ".join(f"{column} BETWEEN {a} AND {b}" for a, b in wanted_ranges(listed))
    return F.expr(f"{column} IN ({', '.join(map(str, listed))}) AND ({near})")
