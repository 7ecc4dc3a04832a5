"""Versioned vector tables on parquet.

Data lives in write-once folders ``data/_seg=<id>/_partition=<name>/``; a version is a small list of
those folders, published as a whole by one rename.  A change rewrites only the files that hold
matching rows and notes their names as replaced; everything else is carried over.  One writer at a
time is assumed: a second writer of the same version fails on the existing file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import schema as S
from vecspark.schema import DEFAULT_PARTITION, MAX_PARTITIONS
from vecspark.session import filesystem, get_text, materialize, put_text
from vecspark.sources.ingest import checked

PARTITION = "_partition"
SEGMENT = "_seg"
FILE = "_file"
FILE_NAME = "substring_index(_metadata.file_path, '/data/', -1)"  # the same wherever the table lies
MAX_FILES = 10000  # a change that touches more files than this rewrites whole folders


class Entry(NamedTuple):
    """One folder of a version; without a segment it only names a partition."""

    seg: str
    part: str
    sealed: bool
    folder: str = ""  # the partition's folder name, special characters escaped
    replaced: Sequence[str] = ()  # files of the folder whose rows now live elsewhere


class VectorTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        saved = json.loads(get_text(spark, f"{self.path}/_schema"))
        self.schema = T.StructType.fromJson(saved["schema"])
        self.key_partitions = saved["key_partitions"]
        self.pk = S.primary_key(self.schema)
        self._known: dict[int, list] = {}
        keys = S.flagged(self.schema, "partition_key")
        self.partition_key = keys[0] if keys else None

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType,
               key_partitions: int = S.DEFAULT_KEY_PARTITIONS) -> "VectorTable":
        if not 1 <= key_partitions <= MAX_PARTITIONS:
            raise ValueError(f"partitions must be in [1, {MAX_PARTITIONS}]")
        saved = json.dumps({"schema": schema.jsonValue(), "key_partitions": key_partitions})
        put_text(spark, f"{path}/_schema", saved)
        table = cls(spark, path)
        table._commit([] if table.partition_key else [Entry("", DEFAULT_PARTITION, True)])
        return table

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        fs, pattern = filesystem(self.spark, f"{self.path}/_versions/*.json")
        return sorted(int(s.getPath().getName().split(".")[0]) for s in fs.globStatus(pattern) or [])

    def entries(self, version: int | None = None) -> list:
        """(segment, partition, sealed) folders of a version, and one row without a segment per named
        partition; at most writes x partitions rows."""
        at = self.versions()[-1] if version is None else version
        if at not in self._known:  # a version never changes once committed
            self._known[at] = [Entry(*e) for e in json.loads(get_text(self.spark, f"{self.path}/_versions/{at}.json"))]
        return list(self._known[at])

    def _commit(self, entries: Sequence[Entry]) -> None:
        past = self.versions()
        number = past[-1] + 1 if past else 0
        put_text(self.spark, f"{self.path}/_versions/{number}.json", json.dumps(list(entries)))

    # ------------------------------------------------------------ reading

    def read(self, partitions: Sequence[str] | None = None, *, version: int | None = None,
             ignore_growing: bool = False, located: bool = False) -> DataFrame:
        """Rows of the named partitions (all if none); unknown names are an error.

        ``ignore_growing`` leaves out folders written since the last compaction; ``located`` keeps the
        folder columns.
        """
        entries = self.entries(version)
        if partitions:
            if self.partition_key:
                raise ValueError("partitions cannot be named on a table with a partition key")
            self._check_known(partitions, entries)
            entries = [e for e in entries if e.part in set(partitions)]
        if ignore_growing:
            entries = [e for e in entries if e.sealed]
        return self._read_entries(entries, located)

    def read_key(self, values: Sequence) -> DataFrame:
        """Rows of a partition-key table with one of the key values; other buckets are not opened."""
        probe = self.spark.createDataFrame([(v,) for v in values], T.StructType([self.schema[self.partition_key]]))
        buckets = {r[0] for r in probe.select(self._bucket()).collect()}
        entries = [e for e in self.entries() if e.part in buckets]
        return self._read_entries(entries).where(F.col(self.partition_key).isin(list(values)))

    def _read_entries(self, entries: Sequence, located: bool = False) -> DataFrame:
        entries = [e for e in entries if e.seg]
        folders = [T.StructField(SEGMENT, T.StringType()), T.StructField(PARTITION, T.StringType())]
        full = T.StructType([*self.schema.fields, *folders])
        if not entries:
            df = self.spark.createDataFrame([], full).withColumn(FILE, F.lit(None).cast("string"))
        else:
            paths = [f"{self.path}/data/{SEGMENT}={e.seg}/{e.folder}" for e in entries]
            df = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths)
            # a predicate on file metadata alone is settled when files are listed
            replaced = [f for e in entries for f in e.replaced]
            df = df.where(f"NOT {_one_of(FILE_NAME, replaced)}") if replaced else df
            df = df.withColumn(FILE, F.expr(FILE_NAME)) if located else df
        return df if located else df.select(*[self._declared(f) for f in self.schema.fields])

    @staticmethod
    def _declared(f: T.StructField) -> Column:
        return F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata)

    def partitions(self) -> list[str]:
        return sorted({e.part for e in self.entries()})

    def list_partitions(self) -> DataFrame:
        rows = self._read_entries(self.entries(), located=True)
        return rows.groupBy(PARTITION).agg(F.count("*").alias("rows"))

    def _check_known(self, names: Sequence[str], entries: Sequence) -> None:
        known = {e.part for e in entries}
        unknown = [n for n in names if n not in known]
        if unknown:
            raise ValueError(f"partition not found: {', '.join(unknown)}")

    # ------------------------------------------------------------ writing

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.partition_key), F.lit(self.key_partitions)).cast("string")

    def _placed(self, df: DataFrame, partition: str | Column | None) -> DataFrame:
        if self.partition_key:
            if partition is not None:
                raise ValueError("partitions cannot be named on a table with a partition key")
            return df.withColumn(PARTITION, self._bucket())
        where = F.lit(partition or DEFAULT_PARTITION) if not isinstance(partition, Column) else partition
        return df.withColumn(PARTITION, where)

    def _write(self, placed: DataFrame, sealed: bool, balance: bool = False, ordered: bool = False,
               only: str | None = None) -> list[Entry]:
        """Write rows as one new segment.

        ``only`` names the partition all rows belong to: they go straight into its folder, without the
        sort that writing to several folders needs.

        ``ordered`` (and a clustering key) sorts rows into files of disjoint key ranges.

        ``balance`` shuffles rows to their partitions first (large ones split, small ones merged); rows
        of one known partition are written where they are.
        """
        seg = uuid.uuid4().hex
        path = f"{self.path}/data/{SEGMENT}={seg}"
        clustering = S.flagged(self.schema, "clustering_key")
        columns = [*self.schema.names, PARTITION]
        out = placed.select(*[F.col(f"`{c}`") for c in columns])
        if clustering or ordered:
            order = [PARTITION, *(clustering or [self.pk])]
            spread = F.xxhash64(*[f.name for f in S.declared(self.schema) if not isinstance(f.dataType, T.VariantType)])
            out = out.repartitionByRange(*order, spread).sortWithinPartitions(*order)
        elif balance:
            out = out.hint("rebalance", F.col(PARTITION))
        if only is not None:
            escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
            folder = f"{PARTITION}={escape(only)}"
            out.drop(PARTITION).write.parquet(f"{path}/{folder}")
            return [Entry(seg, only, sealed, folder)]
        out.write.partitionBy(PARTITION).parquet(path)
        fs, root = filesystem(self.spark, path)
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        return [Entry(seg, unquote(n.split("=", 1)[1]), sealed, n) for n in names if n.startswith(f"{PARTITION}=")]

    def _discard(self, written: Sequence[Entry]) -> None:
        """Remove a segment that was written but will not be committed."""
        for seg in {e.seg for e in written}:
            fs, root = filesystem(self.spark, f"{self.path}/data/{SEGMENT}={seg}")
            fs.delete(root, True)

    def _accept(self, written: Sequence[Entry], accept: Callable[[], None]) -> None:
        try:
            accept()
        except Exception:
            self._discard(written)
            raise

    def insert(self, df: DataFrame, partition: str | Column | None = None, *, sealed: bool = False,
               accept: Callable[[], None] | None = None) -> None:
        """Append rows; existing folders are untouched.  Uniqueness of keys is not checked.

        ``accept`` is called after the write and before the commit; if it raises, nothing is added.
        """
        entries = self.entries()
        if isinstance(partition, str) and partition:
            self._check_known([partition], entries)
        new = self._write(self._placed(df, partition), sealed, self._spreads(partition), only=self._single(partition))
        if accept is not None:
            self._accept(new, accept)
        known = {e.part for e in entries}
        named = [] if self.partition_key else [Entry("", p, True) for p in {e.part for e in new} - known]
        if len(known) + len(named) > MAX_PARTITIONS:
            raise ValueError(f"a table has at most {MAX_PARTITIONS} partitions")
        self._commit([*entries, *named, *new])

    def _spreads(self, partition: str | Column | None) -> bool:
        return self.partition_key is not None or isinstance(partition, Column)

    def _single(self, partition: str | Column | None) -> str | None:
        """The one partition a write goes to, if it is known."""
        return None if self._spreads(partition) else (partition or DEFAULT_PARTITION)

    def create_partition(self, name: str) -> None:
        if self.partition_key:
            raise ValueError("partitions cannot be named on a table with a partition key")
        entries = self.entries()
        known = {e.part for e in entries}
        if len(known) >= MAX_PARTITIONS:
            raise ValueError(f"a table has at most {MAX_PARTITIONS} partitions")
        if name not in known:
            self._commit([*entries, Entry("", name, True)])

    def _touched(self, scope: Sequence[Entry], matching: Callable[[DataFrame], DataFrame]) -> dict[tuple[str, str], list[str]]:
        """Files with at least one matching row, by folder; an empty list stands for the whole folder."""
        matches = matching(self._read_entries(scope, located=True))
        files = matches.select(SEGMENT, PARTITION, FILE).distinct().limit(MAX_FILES + 1).collect()
        if len(files) > MAX_FILES:
            return {(r[0], r[1]): [] for r in matches.select(SEGMENT, PARTITION).distinct().collect()}
        found: dict[tuple[str, str], list[str]] = {}
        for seg, part, name in files:
            found.setdefault((seg, part), []).append(name)
        return found

    def _rewrite(self, entries: Sequence[Entry], touched: dict[tuple[str, str], list[str]],
                 keep: Callable[[DataFrame], DataFrame]) -> list[Entry]:
        """The version's folders after passing the rows of touched files through ``keep``; rows of
        sealed folders stay sealed."""
        out = [e for e in entries if (e.seg, e.part) not in touched]
        hit = [e for e in entries if (e.seg, e.part) in touched]
        for sealed in (True, False):
            part = [e for e in hit if e.sealed == sealed]
            if not part:
                continue
            rows = self._read_entries(part, located=True)
            names = [n for e in part for n in touched[(e.seg, e.part)]]
            if names:
                rows = rows.where(_one_of(FILE, names))
                gone = [e._replace(replaced=[*e.replaced, *touched[(e.seg, e.part)]]) for e in part]
                out += [e for e in gone if len(e.replaced) < self._files_in(e)]
            parts = {e.part for e in part}
            out += self._write(keep(rows), sealed, only=parts.pop() if len(parts) == 1 else None)
        return out

    def _files_in(self, entry: Entry) -> int:
        fs, root = filesystem(self.spark, f"{self.path}/data/{SEGMENT}={entry.seg}/{entry.folder}")
        return sum(1 for s in fs.listStatus(root) if s.isFile() and not s.getPath().getName().startswith(("_", ".")))

    def _by_keys(self, keys: DataFrame) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]:
        """(rows with one of the keys, rows without); the search for files skips row groups outside
        the range of the keys."""
        low, high = keys.agg(F.min(self.pk), F.max(self.pk)).first()
        near = lambda rows: rows.where(F.col(self.pk).between(low, high))
        return (lambda rows: near(rows).join(keys, self.pk, "left_semi"), lambda rows: rows.join(keys, self.pk, "left_anti"))

    def upsert(self, batch: DataFrame, partition: str | None = None, *, seq: str | None = None) -> None:
        """Replace whole rows by primary key, else insert; the last row of a key in the batch wins.

        Keys are unique within the named partition, or across a table with a partition key (there a
        changed partition key moves the row).  The batch is checked as in an ingest and refused as a whole
        if a row breaks a rule.  It is computed once, as the new segment; its keys are then read back to
        find and rewrite the old files that hold them.
        """
        entries = self.entries()
        if partition:
            self._check_known([partition], entries)
        if self.pk not in batch.columns:
            raise ValueError(f"the batch lacks the primary key {self.pk}")
        last = last_per_key(batch, self.pk, batch.columns, seq)
        ready, accept = checked(last if seq is None or seq in self.schema.names else last.drop(seq), self.schema)
        new = self._write(self._placed(ready, partition), False, self._spreads(partition), only=self._single(partition))
        self._accept(new, accept)
        keys = self._read_entries(new, located=True).select(self.pk)
        scope = entries if self.partition_key else [e for e in entries if e.part == (partition or DEFAULT_PARTITION)]
        having, lacking = self._by_keys(keys)
        touched = self._touched(scope, having)
        self._commit([*self._rewrite(entries, touched, lacking), *new])

    def delete_by_pk(self, keys: DataFrame, partition: str | None = None) -> None:
        """Delete the listed primary keys; duplicates are fine, an empty list is an error."""
        if keys.columns != [self.pk]:
            raise ValueError(f"deletion takes the primary key column {self.pk} only")
        if keys.isEmpty():
            raise ValueError("no keys given")
        keys = materialize(keys.distinct(), "keys")
        entries = self.entries()
        scope = self._scope(entries, partition)
        having, lacking = self._by_keys(keys)
        touched = self._touched(scope, having)
        if touched:
            self._commit(self._rewrite(entries, touched, lacking))

    def delete_by_filter(self, predicate: Column | str, partition: str | None = None) -> None:
        """Delete the rows for which the predicate is true (not null); an empty predicate is refused."""
        if isinstance(predicate, str) and not predicate.strip():
            raise ValueError("an empty predicate cannot be used to delete")
        hit = F.expr(predicate) if isinstance(predicate, str) else predicate
        entries = self.entries()
        scope = self._scope(entries, partition)
        touched = self._touched(scope, lambda rows: rows.where(hit))
        if touched:
            self._commit(self._rewrite(entries, touched, lambda old: old.where(~F.coalesce(hit, F.lit(False)))))

    def _scope(self, entries: Sequence, partition: str | None) -> list:
        if not partition:
            return list(entries)
        self._check_known([partition], entries)
        return [e for e in entries if e.part == partition]

    def drop_partition(self, name: str) -> None:
        entries = self.entries()
        self._check_known([name], entries)
        self._commit([e for e in entries if e.part != name])

    def expire(self, ts: str, seconds: int, now: Column) -> None:
        """Drop rows older than ``seconds`` before ``now``."""
        if seconds < 0:
            raise ValueError("ttl must not be negative")
        self.delete_by_filter(F.col(ts) < now - F.make_dt_interval(secs=F.lit(seconds)))

    # ------------------------------------------------------------ maintenance and statistics

    def compact(self) -> None:
        """Merge the folders of every changed partition into one sealed folder in key order; the row set stays the same.

        Files then hold disjoint key ranges, so later changes and lookups touch few of them.  A partition
        that already is one sealed folder without replaced files is left as it is.
        """
        entries = self.entries()
        by_part: dict[str, list] = {}
        for e in entries:
            if e.seg:
                by_part.setdefault(e.part, []).append(e)
        settled = [p[0] for p in by_part.values() if len(p) == 1 and p[0].sealed and not p[0].replaced]
        changed = [e for p in by_part.values() for e in p if e not in settled]
        if changed:
            names = [e for e in entries if not e.seg]
            self._commit([*names, *settled, *self._write(self._read_entries(changed, located=True), True, ordered=True)])

    def compact_plan(self, target_bytes: int) -> DataFrame:
        """(partition, target, sources): which files would be merged into files of the target size."""
        files = self.file_stats().select(PARTITION, "file", "bytes")
        order = Window.partitionBy(PARTITION).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("bytes").over(order), F.lit(0))
        binned = files.withColumn("target", F.floor(before / F.lit(target_bytes)).cast("bigint"))
        return binned.groupBy(PARTITION, "target").agg(
            F.sort_array(F.collect_list("file")).alias("sources"), F.sum("bytes").alias("bytes"))

    def row_count(self) -> DataFrame:
        return self.read().agg(F.count("*").alias("row_count"))

    def file_stats(self) -> DataFrame:
        """Rows and bytes per file; only file metadata and row counts are read."""
        rows = self._read_entries(self.entries(), located=True)
        return rows.groupBy(PARTITION, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count("*").alias("rows"))


def _one_of(expression: str, names: Sequence[str]) -> str:
    quoted = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names)
    return f"({expression} IN ({quoted}))"


def last_per_key(batch: DataFrame, pk: str, columns: Sequence[str], seq: str | None = None) -> DataFrame:
    """One row per key: the one with the highest ``seq``, or the last in the batch's row order.

    Rows with equal ``seq`` are told apart by a hash of their plain columns, so the choice is the same in every run.
    """
    if seq is None:
        order = F.monotonically_increasing_id()
    else:
        plain = [f.name for f in batch.schema.fields if not isinstance(f.dataType, (T.VariantType, T.MapType))]
        order = F.struct(F.col(f"`{seq}`"), F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in columns])
    keyed = batch.select(F.col(f"`{pk}`").alias("_key"), whole.alias("_whole"), order.alias("_order"))
    best = keyed.groupBy("_key").agg(F.max_by("_whole", "_order").alias("_row"))
    return best.select(*[F.col("_row").getField(c).alias(c) for c in columns])
