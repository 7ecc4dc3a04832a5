"""Exact dedup with two Bloom passes.

Pass 1 sets k bits for every text hash and notes the bits that were set again: by another task, or by a
repeat inside one.  Pass 2 tests every row against those bits.  A row with a clear bit is the only one
with its text and passes straight through; the others, true repeats and a few false alarms, are the only
rows that shuffle, and an exact comparison of their SHA-256 settles them.

The filter holds BITS_PER_ROW bits a row in pages of 4 KB.  Tasks send the set positions of a page, not
the page, so pass 1 moves about 8 bytes a row.  What travels to the executors is at most MAX_BITS / 8
bytes; tables that need more are worked on in slices of the hash range, each with a filter of its own.
Groups that hold more than 1 / HEAVY of all rows (fewer than HEAVY, so their keys may be listed) are spread over
SALTS tasks.

Defined cases: null text is empty text, and all empty texts are equal.  Of equal texts the row with the
smallest doc_id stays; a null doc_id counts as larger than any other.  Rows that repeat text and doc_id
count one by one, and exactly one of them stays.  An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecspark.llm.registry import filled, free_name
from vecspark.session import materialize

BITS_PER_ROW = 16
PROBES = 4
MAX_BITS = 1 << 28
PAGE_BITS = 1 << 15
HEAVY = 1024
SALTS = 64
BLOCK_ROWS = 1 << 20


def normalised(text: str | Column = "text") -> Column:
    return F.regexp_replace(filled(text), "[\\x20\\x09-\\x0D]+", " ")


def text_digest(text: str | Column = "text") -> Column:
    return F.sha2(normalised(text), 256)


def probe_positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The PROBES bit positions of every hash, one row per hash; ``bits`` is a power of two."""
    h = hashes.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    i = np.arange(PROBES, dtype=np.uint64)
    return ((h[:, None] + i * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _marks(hashes: np.ndarray, bits: int):
    """(page, positions set once or more, positions set again) of one block of hashes."""
    distinct, times = np.unique(hashes, return_counts=True)
    at = probe_positions(distinct, bits)
    own = np.sort(at, axis=1)
    own[:, 1:][own[:, 1:] == own[:, :-1]] = -1  # a hash sets a bit once
    seen, count = np.unique(own[own >= 0], return_counts=True)
    again = np.union1d(seen[count > 1], at[times > 1].ravel())
    pages = seen // PAGE_BITS
    cuts = np.flatnonzero(np.diff(pages)) + 1
    for part in np.split(seen, cuts):
        if len(part):
            page = part[0] // PAGE_BITS
            lo, hi = np.searchsorted(again, [page * PAGE_BITS, (page + 1) * PAGE_BITS])
            yield page, (part % PAGE_BITS).astype("<u2").tobytes(), (again[lo:hi] % PAGE_BITS).astype("<u2").tobytes()


def _mark_tasks(bits: int):
    def run(batches):
        held, rows = [], 0

        def flush():
            out = list(_marks(np.concatenate(held), bits))
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary()),
                 pa.array([x[2] for x in out], pa.binary())], ["page", "once", "again"])

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield flush()
                held, rows = [], 0
        if rows:
            yield flush()

    return run


def _merge_pages(times: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        count = np.zeros(PAGE_BITS, np.uint8)
        for once, again in zip(pdf["once"], pdf["again"]):
            at = np.frombuffer(once, "<u2")
            count[at] = np.minimum(count[at] + 1, 2)
            count[np.frombuffer(again, "<u2")] = 2
        return pd.DataFrame({"page": [key[0]], "bits": [np.packbits(count >= times, bitorder="little").tobytes()]})

    return run


class Bloom:
    """Filter of the hashes that were seen ``times`` (1 or 2) times; a negative answer is certain.

    It has at most MAX_BITS bits; with more rows than they are meant for, more answers are false alarms.
    """

    def __init__(self, hashes: DataFrame, rows: int, times: int):
        """``hashes``: one non-null long column; ``rows``: how many rows it has."""
        bits = PAGE_BITS
        while bits < min(MAX_BITS, rows * BITS_PER_ROW):
            bits *= 2
        marks = hashes.mapInArrow(_mark_tasks(bits), "page long, once binary, again binary")
        pages = marks.groupBy("page").applyInPandas(_merge_pages(times), "page long, bits binary").toArrow()  # bits / 8 bytes
        table = np.zeros(bits // 8, np.uint8)
        for page, packed in zip(pages["page"].to_pylist(), pages["bits"].to_pylist()):
            table[page * PAGE_BITS // 8:(page + 1) * PAGE_BITS // 8] = np.frombuffer(packed, np.uint8)
        self.probe = BloomProbe(hashes.sparkSession.sparkContext.broadcast(table), bits)

    def maybe(self, column: Column) -> Column:
        probe = self.probe

        @F.pandas_udf("boolean")
        def test(h: pd.Series) -> pd.Series:
            return pd.Series(probe.test(h.to_numpy()))

        return test(column)


class BloomProbe:
    """The part of a filter that tasks hold."""

    def __init__(self, shared, bits: int):
        self.shared, self.bits = shared, bits

    def test(self, hashes: np.ndarray) -> np.ndarray:
        at = probe_positions(hashes, self.bits)
        return ((self.shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


class Repeats:
    """The filters of all slices of the hash range, built from the keys of a table."""

    def __init__(self, keys: DataFrame, key: str):
        """``keys`` is read once or more per slice, so it should be a written table."""
        hashed = keys.select(F.xxhash64(F.col(key)).alias("h"))
        rows = hashed.count()
        self.slices = 1
        while rows * BITS_PER_ROW > MAX_BITS * self.slices:
            self.slices *= 2
        self.filters = [Bloom(self._part(hashed, F.col("h"), s), -(-rows // self.slices), 2) for s in range(self.slices)]

    def _part(self, df: DataFrame, hashed: Column, s: int) -> DataFrame:
        return df if self.slices == 1 else df.filter(F.pmod(F.shiftrightunsigned(hashed, 40), F.lit(self.slices)) == s)

    def flag(self, df: DataFrame, key: str, flag: str) -> DataFrame:
        """``df`` with a boolean column: may another row hold the same ``key``?  A clear flag is certain."""
        hashed, out = F.xxhash64(F.col(key)), None
        for s, bits in enumerate(self.filters):
            part = self._part(df, hashed, s).withColumn(flag, bits.maybe(hashed))
            out = part if out is None else out.unionByName(part)
        return out


def row_key(id_col: str, text: str) -> Column:
    """32 bytes that stand for id and raw text of a row.  Rows that agree in both have the same key; null texts are empty."""
    return F.unhex(F.sha2(F.concat_ws(":", F.col(id_col).cast("string"), F.sha2(filled(F.col(text)), 256)), 256))


def drop_rows(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``gone`` (one column).  Rows that a Bloom filter of ``gone`` clears
    pass straight through; only the others shuffle."""
    flag = free_name(docs, "maybe_gone")
    gone = materialize(gone.select(F.col(gone.columns[0]).alias("_gone")).distinct(), "gone")
    probe = Bloom(gone.select(F.xxhash64("_gone").alias("h")), gone.count(), 1)
    flagged = docs.withColumn(flag, probe.maybe(F.xxhash64(F.col(key))))
    stay = flagged.filter(flag).join(gone, F.col(key).eqNullSafe(F.col("_gone")), "left_anti")
    return flagged.filter(~F.col(flag)).unionByName(stay).select(*[F.col(f"`{c}`") for c in docs.columns])


def with_groups(members: DataFrame, groups: DataFrame, key: str, size: str, rows: int) -> DataFrame:
    """Inner join on ``key`` in which the members of a large group meet it in SALTS tasks.

    ``groups`` has one row per key and is read more than once, so it should be a written table.  A group is
    large if it has more than 1 / HEAVY of all rows; sizes add up to rows, so fewer than HEAVY keys come to the driver.
    """
    large = [key_ for (key_,) in groups.filter(F.col(size) * HEAVY > rows).select(key).collect()]
    if not large:
        return members.join(groups, key)
    salt = free_name(members, "salt")
    spread = F.col(key).isin(large)
    own = F.pmod(F.xxhash64(*[F.col(c) for c in members.columns if c != key]), F.lit(SALTS))
    salted = members.withColumn(salt, F.when(spread, own).otherwise(F.lit(0)).cast("int"))
    copies = F.when(spread, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(groups.withColumn(salt, F.explode(copies)), [key, salt]).drop(salt)


def exact_groups(digests: DataFrame, id_col: str = "doc_id", key: str = "text_sha256") -> DataFrame:
    """One row per row of ``digests`` (id, key): id, keep_id, group_size, kept, key.

    ``digests`` is read several times, so it should be a written table.
    """
    rows = digests.count()
    flagged = Repeats(digests, key).flag(digests.select(id_col, key), key, "maybe")
    single = flagged.filter(~F.col("maybe")).select(
        id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), key)
    suspects = materialize(flagged.filter("maybe").groupBy(key, id_col).agg(F.count(F.lit(1)).alias("times")), "suspects")
    groups = materialize(suspects.groupBy(key).agg(F.min(id_col).alias("keep_id"), F.sum("times").alias("group_size")),
                         "groups")
    settled = with_groups(suspects, groups, key, "group_size", rows)
    copies = settled.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth")).select(
        id_col, "keep_id", "group_size",
        (F.col(id_col).eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), key)
    return single.unionByName(copies)


def find_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The table of ``exact_groups`` for whole texts."""
    digests = materialize(docs.select(F.col(id_col), text_digest(text).alias("text_sha256")), "digests")
    return exact_groups(digests, id_col)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``find_copies`` does not keep, all columns as they were."""
    key, flag = free_name(docs, "text_sha256"), free_name(docs, "maybe")
    digests = materialize(docs.select(text_digest(text).alias(key)), "digests")
    flagged = Repeats(digests, key).flag(docs.withColumn(key, text_digest(text)), key, flag)
    suspects = flagged.filter(flag)
    keep = suspects.groupBy(F.col(key).alias("_key")).agg(F.min(id_col).alias("_id"))
    first = F.col(key).eqNullSafe(F.col("_key")) & F.col(id_col).eqNullSafe(F.col("_id"))
    stay = suspects.join(keep, first, "left_semi").dropDuplicates([key, id_col])
    return flagged.filter(~F.col(flag)).unionByName(stay).select(*[F.col(f"`{c}`") for c in docs.columns])
