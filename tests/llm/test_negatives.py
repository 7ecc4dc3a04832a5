import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecspark.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, anchor string, row int"


def brute(rows, anchor, n_positives=5, n_negatives=3, low=50, high=95):
    """Plain loops over (id, vector, label); ties of score and id by position."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if y is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (ident, vector, label) in enumerate(kept):
        if ident is None or not anchor(ident):
            continue
        scored = [(-sum(a * b for a, b in zip(vector, w)), math.inf if i is None else i, m, i, y)
                  for m, (i, w, y) in enumerate(kept) if m != n]
        scored.sort(key=lambda x: x[:3])
        for p, _, _, positive, _ in [x for x in scored if x[4] == label][:n_positives]:
            fits = [(-s, i) for s, _, _, i, y in scored if y != label and low * -p <= 100 * -s <= high * -p]
            out += [(ident, positive, rank, i, -p, s) for rank, (s, i) in enumerate(fits[:n_negatives], 1)]
    return sorted(out, key=str)


def vectors(seed, n, dims, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims)
    out = []
    for i in range(n):
        v = (rng.normal(size=dims) * rng.choice([0.2, 1.0]) + centre * rng.choice([0.0, 0.6, 1.0])) / math.sqrt(dims)
        out.append((i, v.astype(np.float32).tolist(), int(rng.integers(labels))))
    return out


def mined(spark, rows, **kind):
    df = spark.createDataFrame([(*r, "s", "a", 1) for r in rows], SCHEMA).coalesce(1)
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 5 == 0, **kind).collect()), key=str)


@pytest.mark.parametrize("dims", [3, 16, 40])
def test_negatives_are_those_of_plain_loops(spark, dims, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 16)
    rows = vectors(dims, 300, dims)
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(40)]  # one very common vector, every label
    got = mined(spark, rows)
    assert got and got == brute(rows, lambda i: i % 5 == 0)


def test_other_sizes_and_windows(spark):
    rows = vectors(5, 120, 8)
    kind = dict(n_positives=2, n_negatives=7, low=10, high=99)
    got = mined(spark, rows, **kind)
    assert got and got == brute(rows, lambda i: i % 5 == 0, **kind)


def test_rows_that_take_no_part_and_repeated_rows(spark):
    rows = vectors(9, 60, 6, labels=2)
    rows += [(100, None, 1), (105, [], 1), (110, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (115, [float("nan")] * 6, 0),
             (120, [float("inf")] * 6, 0), (125, rows[3][1], None), (None, rows[5][1], 0), (None, rows[5][1], 1),
             (10, rows[10][1], rows[10][2]), (10, rows[11][1], 1 - rows[10][2]), (130, [0.5, 0.25], 1), (135, [0.0] * 6, 0)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 5 == 0)
    assert {r[0] for r in got} >= {10, 130} and not {r[0] for r in got} & {100, 105, 110, 115, 120, 125, None}


def test_empty_table_and_lone_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 0.0], 1)]) == []
    assert mined(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.6, 0.0], 2)]) == [(0, 1, 1, 2, 65536, 256 * 153)]


def test_text_labels(spark):
    rows = vectors(11, 80, 5)
    df = spark.createDataFrame([(i, v, f"class {y}") for i, v, y in rows], "vec_id long, embedding array<float>, label string")
    got = hard_negatives.mine(df.coalesce(1), F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, lambda i: i % 5 == 0)


def test_huge_components_are_refused(spark):
    with pytest.raises(Exception, match="not supported"):
        mined(spark, [(0, [40000.0], 1), (1, [1.0], 1)])


def test_bounds_hold_and_shut_pairs_out(monkeypatch):
    rng = np.random.default_rng(3)
    a, b = (np.repeat(rng.integers(-256, 256, (n, 16)), 4, axis=1) + rng.integers(-20, 20, (n, 64)) for n in (40, 50))
    left, right = (hard_negatives.cuts_of(*hard_negatives.summaries(x), 64) for x in (a, b))
    exact, widths = a @ b.T, []
    for one, other in zip(left, right):
        lower, upper = hard_negatives.bounds(one, other)
        assert (lower <= exact).all() and (exact <= upper).all()
        widths.append((upper - lower).mean())
    assert len(widths) == 5 and widths == sorted(widths, reverse=True)
    least = np.sort(exact, axis=None)[-5]
    for sparse in (1, 16, 1 << 30):  # by matrix products, by both, pair by pair
        monkeypatch.setattr(hard_negatives, "SPARSE", sparse)
        still = hard_negatives.survivors(left, right, np.ones(exact.shape, bool), lambda i, lower, upper: upper >= least)
        assert 5 <= still.sum() < exact.size // 4 and still[exact >= least].all()
        i, j, score = hard_negatives.exact(a, b, still)
        assert (score == exact[i, j]).all() and len(i) == still.sum()
