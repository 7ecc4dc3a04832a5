import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import BLANK, documents, frame, lower
from vecspark.llm import components, exact_dedup, line_runs, near_dup


def copies(rows):
    norm = [(i, hashlib.sha256(re.sub(f"[{BLANK}]+", " ", t or "").encode()).hexdigest()) for i, t in rows]
    first, size, taken, out = {}, Counter(h for _, h in norm), set(), []
    for i, h in norm:
        if h not in first or (i is not None and (first[h] is None or i < first[h])):
            first[h] = i
    for i, h in norm:
        kept = i == first[h] and h not in taken
        taken |= {h} if kept else set()
        out.append((i, first[h], size[h], kept, h))
    return out


def as_set(rows):
    return Counter(tuple(r) for r in rows)


def test_exact_groups(spark):
    rows = documents() + [(3, documents()[3][1]), (None, ""), (None, "only null id")]
    assert as_set(exact_dedup.find_copies(frame(spark, rows)).collect()) == as_set(copies(rows))


def test_exact_groups_of_an_empty_table(spark):
    assert exact_dedup.find_copies(frame(spark, [])).count() == 0
    assert exact_dedup.drop_copies(frame(spark, [], extra=True)).count() == 0


def test_slices_and_heavy_groups_give_the_same(spark, monkeypatch):
    rows = documents() + [(1000 + i, "copy") for i in range(500)]
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 1 << 12)
    monkeypatch.setattr(exact_dedup, "HEAVY", 4)
    assert as_set(exact_dedup.find_copies(frame(spark, rows)).collect()) == as_set(copies(rows))


def test_drop_copies_keeps_rows_as_they_are(spark):
    rows = documents() + [(3, documents()[3][1])]
    df = frame(spark, rows, extra=True)
    got = exact_dedup.drop_copies(df)
    assert got.columns == df.columns
    kept = Counter(r[0] for r in copies(rows) if r[3])
    assert Counter(r["doc_id"] for r in got.collect()) == kept
    assert got.filter("score <> concat('score', doc_id)").count() == 0


def test_unique_rows_do_not_shuffle(spark):
    df = frame(spark, [(i, f"text {i}") for i in range(3000)])
    digests = df.select("doc_id", exact_dedup.text_digest().alias("k"))
    flagged = exact_dedup.Repeats(digests, "k").flag(digests, "k", "maybe")
    assert flagged.filter("maybe").count() < 300


def test_bloom_has_no_false_negatives(spark):
    hashes = spark.range(2000).select(F.xxhash64("id").alias("h"))
    probe = exact_dedup.Bloom(hashes, 2000, 1).probe
    own = np.array([r[0] for r in hashes.collect()], np.int64)
    assert probe.test(own).all()
    assert probe.test(np.random.default_rng(0).integers(0, 1 << 62, 2000)).mean() < 0.1


def cleaned(rows, min_length=40, min_docs=5):
    def key(x):
        return lower(x.strip(BLANK))

    holders = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            holders[k].append(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_length or len(holders[key(x)]) < min_docs
                or i == max((h for h in holders[key(x)] if h is not None), default=None)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 7])
def test_repeated_lines(spark, batches):
    rows = documents() + [(None, documents()[0][1])]
    got = line_runs.drop_repeated_lines(frame(spark, rows), batches=batches)
    assert as_set(got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()) == as_set(cleaned(rows))


def test_repeated_lines_of_rows_with_text_ids_and_without_ids(spark):
    rows = [(None if i % 3 == 0 else f"d{i}", t) for i, t in documents()]
    rows += rows[:9]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = line_runs.drop_repeated_lines(df, batches=3).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert as_set(got) == as_set(cleaned(rows))
    assert sum(r["n_dropped"] for r in got if r["doc_id"] is None) > 0
    alone = [(None, f"{line} {i}") for i in range(6) for line in ["This one line is longer than forty characters, for all of them.\n"]]
    got = line_runs.drop_repeated_lines(spark.createDataFrame(alone, "doc_id string, text string"))
    assert got.filter("n_dropped > 0").count() == 0  # every holder has a null id


def test_repeated_lines_keep_clashing_columns(spark):
    df = frame(spark, extra=True)
    got = line_runs.drop_repeated_lines(df)
    assert got.columns[:len(df.columns)] == df.columns and len(got.columns) == len(df.columns) + 3
    assert line_runs.drop_repeated_lines(frame(spark, [])).count() == 0


def test_runs_compact_and_add_up(spark):
    runs = line_runs.LineRuns(fanout=2)
    for doc in range(9, 0, -1):
        rows = [(f"h{j}".encode(), doc) for j in range(doc % 4 + 1)]
        runs.add(spark.createDataFrame(rows, "hash binary, doc long"))
    assert sum(len(level) for level in runs.levels) <= 4
    got = {bytes(r["hash"]).decode(): (r["n_docs"], r["max_doc"]) for r in runs.counts().collect()}
    want = defaultdict(list)
    for doc in range(1, 10):
        for j in range(doc % 4 + 1):
            want[f"h{j}"].append(doc)
    assert got == {k: (len(v), max(v)) for k, v in want.items()}


def shingles(text):
    w = re.findall(f"[^{BLANK}]+", lower(text or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def groups(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(x)] = find(y)
    low = defaultdict(list)
    for x, (i, s) in enumerate(sets):
        low[find(x)].append(i)
    return [(i, len(s), min(low[find(x)]), i == min(low[find(x)])) for x, (i, s) in enumerate(sets)]


@pytest.mark.parametrize("crowded,block", [(64, 1 << 17), (2, 400)])
def test_near_copies(spark, monkeypatch, crowded, block):
    monkeypatch.setattr(near_dup, "CROWDED", crowded)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = documents() + [(3, documents()[3][1])]
    got = near_dup.find_near_copies(frame(spark, rows))
    assert as_set(got.collect()) == as_set(groups(rows))


def test_near_copies_drop(spark):
    df = frame(spark, extra=True)
    got = near_dup.drop_near_copies(df)
    assert got.columns == df.columns
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(r[0] for r in groups(documents()) if r[3])
    assert near_dup.find_near_copies(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", range(7))
def test_shingles_of_one_short_text(n):
    data = np.frombuffer(" ".join("abcdef"[:n]).encode(), np.uint8)
    assert [len(s) for s in near_dup.shingle_sets(data, np.array([0, len(data)]))] == [max(min(n, 1), n - 4)]


def test_near_copies_of_single_rows_of_three_words(spark):
    rows = [(1, "one two three"), (2, "One  two three"), (3, "four five six")]
    got = near_dup.find_near_copies(frame(spark, rows).repartition(3, "doc_id"))
    assert as_set(got.collect()) == as_set(groups(rows))


@pytest.mark.parametrize("percent,left", [(80, [0]), (85, [0, 1])])
def test_threshold_is_a_parameter(spark, percent, left):
    words = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(words)), (1, " ".join("changed" if i in (20, 60) else w for i, w in enumerate(words)))]
    a, b = (shingles(t) for _, t in rows)
    assert 80 <= 100 * len(a & b) / len(a | b) < 85
    assert sorted(r["doc_id"] for r in near_dup.drop_near_copies(frame(spark, rows), percent=percent).collect()) == left


def test_near_copies_drop_rows_not_ids(spark):
    words = [f"w{i}" for i in range(60)]
    base, near = " ".join(words), " ".join([*words[:-1], "changed"])
    rows = [(1, base), (2, near), (2, "clean text of a repeated id"), (2, None), (None, near), (None, "clean text without an id"), (None, "")]
    got = near_dup.drop_near_copies(frame(spark, rows, extra=True))
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([rows[0], *rows[2:4], *rows[5:]])


def test_matches_miss_few_pairs_at_the_threshold():
    assert [near_dup.matches_for(p) for p in (80, 85, 100)] == [35, 40, 64]
    for percent in (0, 5, 101):
        with pytest.raises(ValueError):
            near_dup.matches_for(percent)


def test_block_links_span_what_all_pairs_link():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 1 << 62, 100, dtype=np.int64).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[:100 - k % 30], rnd.integers(0, 1 << 62, k % 9, dtype=np.int64).astype(np.uint64)])) for k in range(40)]
    rows = pd.DataFrame({"node": [bytes([k]) for k in range(40)], "component": list(range(40)), "side": 0,
                         "members": [s.tobytes() for s in sets]})
    links = near_dup.block_links(rows)
    assert len(links) < 40

    def parts(pairs):
        root = list(range(40))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [x if r == y else r for r in root]
        return sorted(map(tuple, (np.flatnonzero(np.array(root) == r).tolist() for r in set(root))))

    every = [(a, b) for a in range(40) for b in range(a)
             if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]
    assert parts(every) == parts([(a[0], b[0]) for a, b in zip(links["a"], links["b"])])


def test_components(spark):
    rnd = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 150)]
    other = [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)]
    links = chain + star + other
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = {x: x for x in nodes}
    for _ in nodes:
        for a, b in links:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- groups met without an anti join

def test_large_groups_are_spread_over_salts(spark, monkeypatch):
    from vecspark.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "HEAVY", 8)
    rows = [(b"hot", i) for i in range(400)] + [(b"k%d" % (i % 50), i) for i in range(300)] + [(None, 1), (b"alone", 2)]
    members = spark.createDataFrame(rows, "k binary, salt long")
    groups = spark.createDataFrame([(b"hot", 400, "a")] + [(b"k%d" % i, 6, "b") for i in range(50)], "k binary, size long, name string")
    met = exact_dedup.with_groups(members, groups, "k", "size", len(rows))
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and plan.count("Join Inner") == 1
    want = sorted((k, i, 400 if k == b"hot" else 6, "a" if k == b"hot" else "b") for k, i in rows if k not in (None, b"alone"))
    assert sorted((bytes(r["k"]), r["salt"], r["size"], r["name"]) for r in met.collect()) == want
    assert sorted(met.columns) == ["k", "name", "salt", "size"]


@pytest.mark.parametrize("percent", [55, 85])
def test_crowded_families_of_short_templates(spark, monkeypatch, percent):
    rows = [(i, f"order {i} has been shipped to the usual customer again today") for i in range(200)]
    rows += [(1000, "order 7 has been shipped to the usual customer again today"), (1001, "order 7 has been shipped to the usual customer again now")]
    want = {r["doc_id"]: r["component_id"] for r in near_dup.find_near_copies(frame(spark, rows), percent=percent).collect()}
    for name, value in (("BLOCK_CLASSES", 32), ("CROWDED", 8)):
        monkeypatch.setattr(near_dup, name, value)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.find_near_copies(frame(spark, rows), percent=percent).collect()}
    assert got == want and want[1000] == want[7] and (len(set(want.values())) < 5) == (percent == 55)
    assert max(want[i] for i in range(200)) == (0 if percent == 55 else 199)


def test_crowded_lists_are_not_joined_posting_by_posting(spark, monkeypatch):
    rows = [(i, f"order {i} has been shipped to the usual customer again today") for i in range(200)]
    rows += [(1000 + i, f"{i} cats sat on {i} mats and looked at {i % 9} dogs") for i in range(90)]
    monkeypatch.setattr(near_dup, "CROWDED", 8)
    want = {r["doc_id"]: r["component_id"] for r in near_dup.find_near_copies(frame(spark, rows), percent=55).collect()}
    met, joined = [], near_dup.with_groups

    def watched(members, groups, key, size, total):
        met.append((key, joined(members, groups, key, size, total).count()))
        return joined(members, groups, key, size, total)

    monkeypatch.setattr(near_dup, "with_groups", watched)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.find_near_copies(frame(spark, rows), percent=55).collect()}
    assert got == want and {got[i] for i in range(200)} == {0}
    assert len(met) >= 4 and all(n <= len(rows) for _, n in met), met
