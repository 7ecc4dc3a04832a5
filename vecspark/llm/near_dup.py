"""Near-duplicate documents: MinHash signatures joined through their coordinates, links confirmed on full sets.

1. Every document becomes the set of its five-word shingles (64-bit hashes), a signature of K minimum
   hashes and a fingerprint.  Documents with equal sets are one class from here on.
2. Inverted join.  Classes are posted under (coordinate, value).  A pair of the wanted similarity agrees
   in at least m = matches_for(percent) of the K coordinates (all but MISSED of the pairs at the threshold, more above it),
   so each agreeing value has two or more postings, and a class with fewer than m such values has no partner.  The
   others post only a prefix: of their c shared values the c - m + 1 rarest, one of which any
   partner must share.
3. Merging.  Posting lists of up to CROWDED classes are merged into candidate pairs; pairs of compatible sizes
   that agree in m coordinates are compared on their full sets.
4. Skipping.  Longer lists are not merged pair by pair.  Lists that share classes form a family.
   Classes of a family that steps before have already put into its largest component need no comparison with each
   other; the rest meet everything in the family in blocks of about BLOCK shingles and BLOCK_CLASSES classes at most.  A block task counts
   all intersections exactly and returns links between different components only, at most one less than
   its classes.
5. Connected components of the links, then one row per document.

No step emits the pairs of a large group, holds a large group in one task, or broadcasts more than a Bloom
filter of the candidate classes (MAX_BITS / 8 bytes at most).

Defined cases: null or empty texts, and texts of white space, have an empty set and are linked with
nothing; with one to four words the whole sequence is the only shingle; rows that repeat a doc_id are
documents of their own, judged each by id and text; a null doc_id counts as larger than any other; an empty
table gives an empty table.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.components import components
from vecspark.llm.exact_dedup import HEAVY, Bloom, drop_rows, row_key, with_groups
from vecspark.llm.words import BLANK_BYTES, flat_text, groups_of, mix, word_hashes, word_spans
from vecspark.llm.registry import free_name
from vecspark.session import materialize

SHINGLE = 5
K = 64
PERCENT = 85
MISSED = 3e-6
CROWDED = 64
BLOCK = 1 << 17
BLOCK_CLASSES = 1 << 11
GROUP_BYTES = 2 << 20
COLUMNS = 4096

_rng = np.random.default_rng(20240301)
_PLACE = _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SCALE = _rng.integers(0, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 1 << 63, K, dtype=np.uint64)


def matches_for(percent: int) -> int:
    """The most coordinates in which all but MISSED of the pairs with a similarity of ``percent`` / 100 agree."""
    if not 1 <= percent <= 100:
        raise ValueError(f"a similarity of {percent} percent; 1 to 100 are possible")
    t, missed, m = percent / 100, 0.0, 0
    while m < K and (missed := missed + comb(K, m) * t**m * (1 - t)**(K - m)) <= MISSED:
        m += 1
    if not m:
        raise ValueError(f"{K} coordinates are too few for a similarity of {percent} percent")
    return m


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    starts, ends, first = word_spans(data, offsets, BLANK_BYTES)
    hashes = word_hashes(data, starts, ends, BLANK_BYTES)
    rolled = np.zeros(max(0, len(hashes) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        rolled += hashes[j:j + len(rolled)] * _PLACE[j]
    rolled, out = mix(rolled), []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a:b - SHINGLE + 1]))
        elif b > a:
            out.append(mix((hashes[a:b] * _PLACE[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprints(sets: list[np.ndarray]) -> list[bytes | None]:
    """16 bytes that stand for a set; None for an empty one."""
    out = []
    for s in sets:
        if len(s):
            x = mix(s ^ np.uint64(0x5851F42D4C957F2D))
            out.append((s.sum(dtype=np.uint64) + np.uint64(len(s))).tobytes() + x.sum(dtype=np.uint64).tobytes())
        else:
            out.append(None)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """K 32-bit minimum hashes of every set; zeros for empty sets."""
    out = np.zeros((len(sets), K), np.int32)
    filled = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    if len(filled):
        flat = np.concatenate([sets[i] for i in filled])
        begin = np.cumsum([0] + [len(sets[i]) for i in filled])[:-1]
        for k in range(K):
            low = np.minimum.reduceat(flat * _SCALE[k] + _SHIFT[k], begin)
            out[filled, k] = (low >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _profile_tasks(batches):
    for batch in batches:
        data, offsets = flat_text(batch.column(1))
        for lo, hi in groups_of(offsets, GROUP_BYTES):
            sets = shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            flat = pa.array(signatures(sets).ravel())
            own = [c.slice(lo, hi - lo) for i, c in enumerate(batch.columns) if i != 1]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array([len(s) for s in sets], pa.int64()), pa.array(fingerprints(sets), pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * K, pa.int32()), flat)],
                [*[f"c{i}" for i in range(len(own))], "n_shingles", "node", "signature"])


def _hash_of(nodes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(n[:8] for n in nodes), np.int64)


def _node_hashes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_hash_of(batch.column(0).to_pylist()))], ["h"])


def _set_tasks(wanted):
    def run(batches):
        for batch in batches:
            data, offsets = flat_text(batch.column(0))
            for lo, hi in groups_of(offsets, GROUP_BYTES):
                sets = shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                nodes = fingerprints(sets)
                some = [i for i, node in enumerate(nodes) if node is not None]
                found = wanted.test(_hash_of([nodes[i] for i in some]))
                some = [i for i, yes in zip(some, found) if yes]
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i in some], pa.binary()),
                                                  pa.array([sets[i].tobytes() for i in some], pa.binary())], ["node", "members"])

    return run


def linked(common: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (left + right - common)


def _confirm_tasks(percent: int):
    """(a, b) of the candidate pairs (a, b, signature_a, signature_b, set_a, set_b) that are links."""
    matches = matches_for(percent)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = [batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(n, K) for i in (2, 3)]
            agree = (sig[0] == sig[1]).sum(axis=1) >= matches
            keep = np.zeros(n, bool)
            left, right = batch.column(4), batch.column(5)
            for i in np.flatnonzero(agree).tolist():
                a, b = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                if len(a) > len(b):
                    a, b = b, a
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                keep[i] = linked(np.count_nonzero(b[at] == a), len(a), len(b), percent)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def block_links(rows: pd.DataFrame, percent: int = PERCENT) -> pd.DataFrame:
    """Links between the two sides of one block pair (node, component, side, members), a spanning forest of them.

    ``side`` is 0 or 1; in a block that meets itself all rows have side 0.
    """
    sets = [np.frombuffer(m, np.uint64) for m in rows["members"]]
    side = rows["side"].to_numpy()
    sizes = np.array([len(s) for s in sets], np.int64)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, number, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    use = shared[number]
    column, owner = column[number[use]], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        common += part[left] @ part[right].T  # counts below 2**24: exact
    x, y = np.nonzero(linked(common.astype(np.int64), sizes[left][:, None], sizes[right][None, :], percent))
    x, y = left[x], right[y]
    component = pd.factorize(rows["component"])[0]
    root = list(range(int(component.max()) + 1))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    apart = component[x] != component[y]
    for i, j in zip(x[apart].tolist(), y[apart].tolist()):
        p, q = find(component[i]), find(component[j])
        if p != q:
            root[p] = q
            out.append((i, j))
    nodes = rows["node"].to_numpy()
    return pd.DataFrame({"a": [nodes[i] for i, _ in out], "b": [nodes[j] for _, j in out]}, dtype=object)


def _prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """(node, tokens): the rarest shared values of every class that can have a partner."""
    tokens = classes.select("node", F.posexplode("signature")).select(
        "node", F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("token"))
    shared = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df >= 2"), "shared-values")
    met = _counted(tokens, shared, classes.count() * K)
    by_class = met.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("s"))
    prefix = F.slice("s", F.lit(1), F.size("s") - (matches - 1))
    return materialize(by_class.filter(F.size("s") >= matches).select(
        "node", F.transform(prefix, lambda p: p["token"]).alias("tokens")), "prefixes")


def _counted(tokens: DataFrame, shared: DataFrame, rows: int) -> DataFrame:
    """(node, token, df) of the shared tokens.  The fewer than HEAVY most frequent ones are looked up in place, the others joined."""
    most = sorted(tuple(r) for r in shared.filter(F.col("df") * HEAVY > rows).select("token", "df").collect())
    if not most:
        return tokens.join(shared, "token").select("node", "token", "df")
    keys, counts = (np.array(x, np.int64) for x in zip(*most))

    @F.arrow_udf("long")
    def known(token: pa.Array) -> pa.Array:
        wanted = token.to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return pa.array(counts[at], mask=keys[at] != wanted)

    looked_up = tokens.withColumn("df", known("token"))
    others = looked_up.filter(F.col("df").isNull()).drop("df").join(shared, "token")
    return looked_up.filter(F.col("df").isNotNull()).select("node", "token", "df").unionByName(others.select("node", "token", "df"))


def _token_hashes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mix(batch.column(0).to_numpy().view(np.uint64)).view(np.int64))], ["h"])


def _head_tasks(crowded, pairs: bool):
    """From (node, tokens): the smallest crowded token of every class that has one (node, head), or the distinct (a, b) of
    crowded tokens and such heads."""
    def run(batches):
        for batch in batches:
            tokens, sizes = batch.column(1).flatten().to_numpy(), batch.column(1).value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            use = crowded.test(mix(tokens.view(np.uint64)).view(np.int64)) if len(tokens) else np.zeros(0, bool)
            tokens, owner = tokens[use], owner[use]
            order = np.lexsort((tokens, owner))
            tokens, owner = tokens[order], owner[order]
            some, first, times = np.unique(owner, return_index=True, return_counts=True)
            if pairs:
                both = np.unique(np.stack([tokens, np.repeat(tokens[first], times)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.array(tokens[first])], ["node", "head"])

    return run


def _families(prefixes: DataFrame, lists: DataFrame) -> DataFrame:
    """(node, family) of the classes on crowded lists; classes that share such a list have one family.

    Tokens are linked, not classes: each with the smallest crowded token of every class that posts it, so a list counts by
    its distinct neighbours.  False alarms of the filter join families, which adds comparisons and loses none.
    """
    hashes = materialize(lists.filter(F.col("m") > CROWDED).select("token").mapInArrow(_token_hashes, "h long"), "crowded-tokens")
    crowded = Bloom(hashes, hashes.count(), 1).probe
    heads = materialize(prefixes.mapInArrow(_head_tasks(crowded, False), "node binary, head long"), "heads")
    linked_tokens = components(prefixes.mapInArrow(_head_tasks(crowded, True), "a long, b long").distinct())
    uses = heads.groupBy("head").agg(F.count(F.lit(1)).alias("uses"))
    groups = materialize(uses.join(linked_tokens.select(F.col("node").alias("head"), "label"), "head", "left").select(
        "head", F.coalesce("label", "head").alias("family"), "uses"), "families")
    return with_groups(heads, groups, "head", "uses", heads.count()).select("node", "family")


def _list_pairs(postings: DataFrame, lists: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of classes that share a list of at most CROWDED classes."""
    short = postings.join(lists.filter(F.col("m") <= CROWDED), "token")
    merged = short.groupBy("token").agg(F.sort_array(F.collect_list("node")).alias("l"))
    pairs = F.flatten(F.transform("l", lambda x, i: F.transform(
        F.slice(F.col("l"), i + 2, F.size("l")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return merged.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()


def _crowded_links(prefixes: DataFrame, lists: DataFrame, classes: DataFrame, sets: DataFrame, labels: DataFrame,
                   percent: int) -> DataFrame:
    """Links between components inside the families of crowded lists."""
    family = _families(prefixes, lists)
    own = classes.select("node", "n_shingles")
    nodes = family.join(own, "node").join(labels, "node", "left").select(
        "family", "node", "n_shingles", F.coalesce("label", "node").alias("component"))
    nodes = materialize(nodes, "family-members")
    parts = nodes.groupBy("family", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n_shingles").alias("w"))
    largest = parts.groupBy("family").agg(F.max(F.struct("c", "component", "w")).alias("top"), F.sum("w").alias("w"),
                                          F.sum("c").alias("members"))
    def blocks(shingles, classes):
        return F.greatest(F.ceil(shingles / BLOCK), F.ceil(classes / BLOCK_CLASSES)).cast("int")

    plan = largest.select(
        "family", F.col("top.component").alias("settled"), "members",
        blocks(F.col("w") - F.col("top.w"), F.col("members") - F.col("top.c")).alias("n_open"),
        blocks(F.col("top.w"), F.col("top.c")).alias("n_settled"))
    plan = materialize(plan.filter("n_open > 0"), "family-plan")
    met = with_groups(nodes, plan, "family", "members", nodes.count()).join(sets, "node")
    is_open = F.col("component") != F.col("settled")
    spot = F.xxhash64("node")
    block = F.when(is_open, F.pmod(spot, F.col("n_open"))).otherwise(F.pmod(spot, F.col("n_settled")) + F.col("n_open")).cast("int")
    against = F.when(is_open, F.sequence(F.lit(0), F.col("n_open") + F.col("n_settled") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("n_open") - 1))
    placed = met.withColumn("block", block).withColumn("other", F.explode(against)).select(
        "family", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node", "component",
        (F.col("block") > F.col("other")).cast("int").alias("side"), "members_")
    return placed.withColumnRenamed("members_", "members").groupBy("family", "x", "y").applyInPandas(
        lambda rows: block_links(rows[["node", "component", "side", "members"]], percent), "a binary, b binary")


def find_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT,
                     carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable), kept (is that document).

    Documents are linked from a similarity of ``percent`` / 100 on.  The ``carried`` columns follow the id.
    """
    own = [id_col, *carried]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    profiles = materialize(docs.select(F.col(id_col), F.col(text), *carried).mapInArrow(
        _profile_tasks, f"{kinds}, n_shingles long, node binary, signature array<int>"), "profiles")
    classes = materialize(profiles.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(id_col).alias("first"), F.count(F.lit(1)).alias("size"), F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature")), "classes")
    prefixes = _prefixes(classes, matches_for(percent))
    postings = prefixes.select(F.explode("tokens").alias("token"), "node")
    lists = materialize(postings.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m >= 2"), "lists")
    posted = materialize(prefixes.select("node").mapInArrow(_node_hashes, "h long"), "posted")
    wanted = Bloom(posted, posted.count(), 1).probe
    sets = docs.select(F.col(text)).mapInArrow(_set_tasks(wanted), "node binary, members binary")
    sets = materialize(sets.groupBy("node").agg(F.first("members").alias("members_")), "sets")
    half = classes.select(F.col("node"), "n_shingles", "signature").join(sets, "node")
    pairs = _list_pairs(postings, lists)
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    weights = classes.select("node", "n_shingles")
    sized = pairs.join(weights.select(F.col("node").alias("a"), F.col("n_shingles").alias("na")), "a").join(
        weights.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb")), "b").filter(100 * small >= percent * large)
    candidates = sized.select("a", "b").join(
        half.select(F.col("node").alias("a"), F.col("signature").alias("sa"), F.col("members_").alias("ma")), "a").join(
        half.select(F.col("node").alias("b"), F.col("signature").alias("sb"), F.col("members_").alias("mb")), "b")
    links = materialize(candidates.select("a", "b", "sa", "sb", "ma", "mb").mapInArrow(_confirm_tasks(percent), "a binary, b binary"), "links")
    labels = components(links)
    if lists.filter(F.col("m") > CROWDED).limit(1).count():
        more = materialize(_crowded_links(prefixes, lists, classes, sets, labels, percent), "crowded-links")
        labels = components(links.unionByName(more))
    named = classes.join(labels, "node", "left").select("node", "first", "size", F.coalesce("label", "node").alias("label"))
    named = materialize(named, "named-classes")
    lowest = named.groupBy("label").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    lowest = materialize(lowest, "component-ids")
    total = profiles.count()
    placed = with_groups(named, lowest, "label", "classes", total).select("node", "component_id", "size")
    placed = materialize(placed, "placed-classes")
    some = with_groups(profiles.filter(F.col("node").isNotNull()).select(*own, "n_shingles", "node"), placed, "node", "size", total)
    alone = profiles.filter(F.col("node").isNull()).select(*own, "n_shingles", F.col(id_col).alias("component_id"))
    return some.select(*own, "n_shingles", "component_id").unionByName(alone).withColumn(
        "kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that ``find_near_copies`` does not keep, all columns as they were."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key(id_col, text))
    found = find_near_copies(keyed, id_col, text, percent, carried=(key,))
    return drop_rows(keyed, found.filter("not kept").select(key), key).select(*[F.col(f"`{c}`") for c in docs.columns])
