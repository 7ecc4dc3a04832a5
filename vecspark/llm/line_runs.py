"""Line dedup over levelled sorted runs of line hashes, in DataFrame operations only.

A run is a written table of line hashes (hash, n_docs, max_doc), partitioned and sorted by hash.
Batches of documents arrive one after the other, largest doc_ids first (ids without a distance between them,
such as texts, in batches by hash; then a known hash passes its largest document on too).  The hashes of a batch are counted
(partial counts before the shuffle) and merge-anti-joined with the runs: a hash that no run holds is new,
and the largest document of the batch becomes its holder; a known hash only adds to the count and leaves
the holder as it is.  Both become the batch's own run.  When a level holds FANOUT runs, they are compacted
into one run of the next level, so a batch meets few runs however many came before it.

The merged runs decide: a line whose key has at least ``min_length`` code points and occurs in at least
``min_docs`` documents is dropped everywhere but in its holder.  The (document, hash) pairs to drop meet
the documents in one join by doc_id; texts are never exploded.  Lines found in very many documents (more
than 1 / HEAVY of all pairs) meet their pairs by broadcast, so no task holds all pairs of a line.

Defined cases: null and empty texts are one empty line.  A line that repeats inside a document counts once
and is dropped or kept in all its places.  Every row counts as a document; rows that repeat a doc_id are
cleaned alike.  A null doc_id is smaller than any other; rows without an id are told apart by their texts, so
they fill no single group.  An empty table gives an empty table.  Keys are
compared by their 128-bit MD5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.llm.exact_dedup import with_groups
from vecspark.llm.registry import BLANKS, LOWER, UPPER, filled, free_name
from vecspark.session import materialize

FANOUT = 3
BATCHES = 4


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def lines_of(text: str | Column = "text") -> Column:
    return F.split(filled(text), "\n", -1)


def line_hash(line: Column) -> Column:
    return F.unhex(F.md5(line_key(line)))


def merged(runs: list[DataFrame]) -> DataFrame:
    """One row per hash."""
    rows = runs[0]
    for run in runs[1:]:
        rows = rows.unionByName(run)
    return rows.groupBy("hash").agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))


class LineRuns:
    """The runs, level by level."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        return materialize(rows.sortWithinPartitions("hash"), "line-run")

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, pairs: DataFrame, falling: bool = True) -> None:
        """Merge-anti-join the (hash, doc) pairs of a batch with the runs and add its own run.

        A document lies in one batch; ``falling``: batches come in descending order of doc, so a known hash has its holder.
        """
        rows = pairs.groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("max_doc"))
        known = F.lit(False)
        for i, run in enumerate(self.runs()):
            rows = rows.join(run.select("hash", F.col("n_docs").alias(f"in_{i}")), "hash", "left")
            known = known | F.col(f"in_{i}").isNotNull()
        holder = F.when(~known, F.col("max_doc")) if falling else F.col("max_doc")
        self.levels = self.levels or [[]]
        self.levels[0].append(self._write(rows.select("hash", "n_docs", holder.alias("max_doc"))))
        at = 0
        while len(self.levels[at]) >= self.fanout:
            if at + 1 == len(self.levels):
                self.levels.append([])
            self.levels[at + 1].append(self._write(merged(self.levels[at])))
            self.levels[at] = []
            at += 1

    def counts(self) -> DataFrame:
        """One row per hash over all runs: n_docs, max_doc (the holder)."""
        return merged(self.runs())


def line_pairs(docs: DataFrame, id_col: str, text: str, min_length: int) -> DataFrame:
    """(hash, doc, own) of every distinct long line of every row."""
    long_lines = F.filter(lines_of(text), lambda x: F.length(line_key(x)) >= min_length)
    hashes = F.array_distinct(F.transform(long_lines, line_hash))
    return docs.select(F.col(id_col).alias("doc"), own_text(id_col, text).alias("own"), F.explode(hashes).alias("hash"))


def own_text(id_col: str, text: str) -> Column:
    """What tells rows without an id apart; null for all others."""
    return F.when(F.col(id_col).isNull(), F.unhex(F.md5(filled(text))))


def has_ranges(pairs: DataFrame) -> bool:
    """Whether ranges of equal size can be cut from the type of doc."""
    return isinstance(pairs.schema["doc"].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def batches_of(pairs: DataFrame, batches: int) -> list[DataFrame]:
    """The pairs by ranges of doc, largest first (by hash of doc where its type has no ranges); every pair is in one batch."""
    if not has_ranges(pairs):
        return [pairs.filter(F.pmod(F.xxhash64("doc"), F.lit(batches)) == b) for b in range(batches)]
    cuts = [i / batches for i in range(batches - 1, 0, -1)]
    bounds = pairs.agg(F.percentile_approx("doc", cuts).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds), reverse=True)
    parts, upper = [], None
    for low in bounds:
        here = F.col("doc") > low
        parts.append(pairs.filter(here if upper is None else here & (F.col("doc") <= upper)))
        upper = low
    last = F.lit(True) if upper is None else (F.col("doc") <= upper) | F.col("doc").isNull()
    return parts + [pairs.filter(last)]


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = 40,
                        min_docs: int = 5, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the columns n_lines, n_dropped and kept_text."""
    pairs = materialize(line_pairs(docs, id_col, text, min_length), "line-pairs")
    runs = LineRuns()
    for batch in batches_of(pairs, batches):
        runs.add(batch, has_ranges(pairs))
    repeated = materialize(runs.counts().filter(F.col("n_docs") >= min_docs), "repeated-lines")
    met = with_groups(pairs, repeated, "hash", "n_docs", pairs.count())
    drops = met.filter(~F.col("doc").eqNullSafe(F.col("max_doc"))).groupBy("doc", "own").agg(F.collect_set("hash").alias("_drop"))
    lines, drop = lines_of(F.col(text)), F.col("_drop")
    kept = F.filter(lines, lambda x: ~((F.length(line_key(x)) >= min_length) & F.array_contains(drop, line_hash(x))))
    n_lines = F.size(lines).cast("long")
    kept_text = F.when(drop.isNull(), filled(text)).otherwise(F.array_join(kept, "\n"))
    n_kept = F.when(drop.isNull(), n_lines).otherwise(F.size(kept).cast("long"))
    drops = drops.withColumnsRenamed({"doc": "_doc", "own": "_own"})
    same = F.col(id_col).eqNullSafe(F.col("_doc")) & own_text(id_col, text).eqNullSafe(F.col("_own"))
    joined = docs.join(drops, same, "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], n_lines.alias(free_name(docs, "n_lines")),
                         (n_lines - n_kept).alias(free_name(docs, "n_dropped")), kept_text.alias(free_name(docs, "kept_text")))
