"""The block kernel without Spark: bounds in single precision give the lists of double precision."""

import numpy as np
import pyarrow as pa
import pytest

from vecspark.plans import kernel
from vecspark.plans.kernel import Best, Codec, Queries, Spec

DIM = 12
CASES = [("L2", "pk", None, None), ("IP", "pk", None, None), ("COSINE", "pk", None, None), ("L2", "label", None, None),
         ("IP", "label", None, None), ("COSINE", "label", None, None), ("L2", "twice", None, None), ("IP", "twice", None, None),
         ("L2", "pk", 9.0, 14.0), ("IP", "pk", 2.0, 6.0), ("COSINE", "pk", 0.2, 0.7), ("L2", "twice", 9.0, 14.0)]


def table(vectors):
    n = len(vectors)
    pk = np.random.default_rng(3).permutation(n)
    labels = pa.array([None if p % 11 == 0 else int(p % 5) for p in pk.tolist()], pa.int32())
    twice = np.where(pk % 9 == 0, pk // 2, pk)  # some keys repeat
    vec = pa.array([v.tolist() for v in vectors], pa.list_(pa.float64()))
    return pa.table({"pk": pk, "label": labels, "twice": twice, "vec": vec})


def data(kind):
    rng = np.random.default_rng(8)
    rows, asked = rng.normal(size=(3000, DIM)), rng.normal(size=(70, DIM))
    if kind == "copies":
        rows = np.repeat(rows[:60], 50, axis=0)
    elif kind == "grid points":  # many equal distances
        rows, asked = np.rint(rows), np.rint(asked)
    elif kind == "far away":
        rows, asked = rows + 3e5, asked + 3e5
    elif kind == "long rows":
        rows[::300] *= 1e6
        asked[5] *= 1e6
    elif kind == "tiny":
        rows, asked = rows * 1e-30, asked * 1e-30
    elif kind == "not numbers":
        asked[2, 3], asked[4, 2] = np.nan, np.inf
    elif kind == "zeros":
        rows[::50], asked[3] = 0, 0
    elif kind == "nearer and nearer":
        rows = rows[np.argsort(-np.linalg.norm(rows, axis=1))]
        asked = asked * 0.01
    elif kind == "one direction":  # single precision cannot tell these apart
        rows = 1 + rng.normal(size=(3000, DIM)) * 1e-9
    return table(rows), pa.table({"qid": np.arange(len(asked)), "qvec": pa.array([v.tolist() for v in asked])})


KINDS = ["plain", "copies", "grid points", "far away", "long rows", "tiny", "not numbers", "zeros", "nearer and nearer", "one direction"]


def lists(rows, asked, spec, pieces=1):
    queries = Queries(asked, "qid", "qvec", Codec("dense"))
    best = Best(spec, queries.count)
    for lo in range(0, rows.num_rows, -(-rows.num_rows // pieces)):
        kernel.offer(best, rows.slice(lo, -(-rows.num_rows // pieces)), "vec", queries)
    names = ["qid", "score", *dict.fromkeys(["pk", spec.key])]
    return [tuple(r.values()) for b in best.batches(queries.ids, names) for r in b.to_pylist()]


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("metric, key, lower, upper", CASES)
def test_bounds_in_single_precision_give_the_lists_of_double_precision(monkeypatch, kind, metric, key, lower, upper):
    rows, asked = data(kind)
    monkeypatch.setattr(kernel, "ASKED", 32)
    monkeypatch.setattr(kernel, "FIRST_ROWS", 64)
    for k in (1, 4, 30):
        spec = Spec(metric, k, "pk", key, [], lower, upper)
        found = [lists(rows, asked, spec), lists(rows, asked, spec, pieces=3)]
        with monkeypatch.context() as m:
            m.setattr(kernel, "_single_fits", lambda *args: False)
            want = lists(rows, asked, spec)
        assert repr(found[0]) == repr(want) and repr(found[1]) == repr(want)


def coded(vectors, codes=16):
    """The rows as product codes of 4 sub-spaces, with code books of some of the rows."""
    books = np.unique(vectors, axis=0)[:codes].reshape(-1, 4, DIM // 4).transpose(1, 0, 2).copy()
    own = vectors.reshape(len(vectors), 4, 1, DIM // 4)
    return ((own - books[None]) ** 2).sum(axis=3).argmin(axis=2).astype(np.uint8), books


def code_lists(rows, vectors, asked, spec, pieces=1):
    codes, books = coded(vectors)
    rows = rows.set_column(rows.column_names.index("vec"), "vec", pa.array([c.tobytes() for c in codes]))
    queries = Queries(asked, "qid", "qvec", Codec("pq", books=books))
    best = Best(spec, queries.count)
    for lo in range(0, rows.num_rows, -(-rows.num_rows // pieces)):
        kernel.offer(best, rows.slice(lo, -(-rows.num_rows // pieces)), "vec", queries)
    return [tuple(r.values()) for b in best.batches(queries.ids, ["qid", "score", "pk"]) for r in b.to_pylist()]


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
@pytest.mark.parametrize("kind", ["plain", "copies", "grid points", "far away", "long rows", "not numbers", "zeros"])
@pytest.mark.parametrize("metric, key, lower, upper", [CASES[i] for i in (0, 1, 2, 3, 6, 8)])
def test_bounds_of_product_codes_give_the_lists_of_the_tables(monkeypatch, kind, metric, key, lower, upper):
    rows, asked = data(kind)
    vectors = np.array(rows["vec"].to_pylist())
    monkeypatch.setattr(kernel, "ASKED", 32)
    monkeypatch.setattr(kernel, "FIRST_ROWS", 64)
    for k in (1, 30):
        spec = Spec(metric, k, "pk", key, [], lower, upper)
        found = [code_lists(rows, vectors, asked, spec), code_lists(rows, vectors, asked, spec, pieces=3)]
        with monkeypatch.context() as m:
            m.setattr(kernel, "_single_fits", lambda *args: False)
            want = code_lists(rows, vectors, asked, spec)
        assert repr(found[0]) == repr(want) and repr(found[1]) == repr(want)


@pytest.mark.parametrize("metric", ["L2", "IP", "COSINE"])
def test_few_coded_rows_are_looked_up(monkeypatch, metric):
    rng = np.random.default_rng(8)
    vectors, asked = rng.normal(size=(30_000, DIM)), pa.table({"qid": np.arange(40), "qvec": pa.array(rng.normal(size=(40, DIM)).tolist())})
    scored, settle = [], kernel.code_scores
    monkeypatch.setattr(kernel, "code_scores", lambda books, v, q, i, j, m: scored.append(len(i)) or settle(books, v, q, i, j, m))
    monkeypatch.setattr(kernel.Tables, "scores", lambda *args: pytest.fail("all pairs were looked up"))
    assert len(code_lists(table(vectors), vectors, asked, Spec(metric, 5, "pk", "pk", []))) == 200
    assert sum(scored) < 40 * 5 * 16, scored


@pytest.mark.parametrize("metric, key, lower, upper", [c for c in CASES if c[1] != "twice"])
def test_few_pairs_are_scored_in_double_precision(monkeypatch, metric, key, lower, upper):
    rng = np.random.default_rng(8)
    rows, asked = table(rng.normal(size=(30_000, DIM))), pa.table({"qid": np.arange(40), "qvec": pa.array(rng.normal(size=(40, DIM)).tolist())})
    scored, settle = [], kernel.settled_scores
    monkeypatch.setattr(kernel, "settled_scores", lambda v, q, i, j, m: scored.append(len(i)) or settle(v, q, i, j, m))
    monkeypatch.setattr(kernel, "block_scores", lambda *args: pytest.fail("all pairs were scored in double precision"))
    assert lists(rows, asked, Spec(metric, 5, "pk", key, [], lower, upper))
    assert sum(scored) < 40 * 5 * 8, scored
