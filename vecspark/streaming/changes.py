"""Change logs clustered by key: a batch is appended to the buckets of its keys and never meets stored rows.

The log is one bucketed table.  A batch is shuffled once, by the bucketing's own hash, so it adds one sorted file to each
bucket it touches; no stored row is read.  The current rows are the latest change of every key, found inside the
buckets: the scan is already partitioned by the key, so reading and compacting shuffle nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.session import filesystem, get_text, put_text

DELETED = "deleted"
BUCKETS = 16


class ChangeLog:
    """The latest change per key wins; of equally old ones the one with the larger columns.  Deletions are kept, so a late change cannot
    bring a deleted key back; applying a batch twice changes nothing."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, pk: str, ts: str, buckets: int, generation: int):
        self.spark, self.path, self.schema, self.pk, self.ts = spark, path, schema, pk, ts
        self.buckets, self.generation = buckets, generation
        self.name = f"changes_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY (`{pk}`) SORTED BY (`{pk}`) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}/rows-{generation}'")

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, *, pk: str, ts: str, buckets: int = BUCKETS) -> "ChangeLog":
        """``schema``: the rows as they are kept, with ``pk`` and ``ts``; the deletion mark is added."""
        if buckets < 1:
            raise ValueError("a log needs at least one bucket")
        for name in (pk, ts):
            if name not in schema.names:
                raise ValueError(f"the schema lacks the column {name}")
        if DELETED not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(DELETED, T.BooleanType())])
        _publish(spark, path, schema, pk, ts, buckets, 0)
        return cls(spark, path, schema, pk, ts, buckets, 0)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "ChangeLog":
        """The newest published generation of a log."""
        generation = 0
        while _exists(spark, f"{path}/log-{generation + 1}.json"):
            generation += 1
        meta = json.loads(get_text(spark, f"{path}/log-{generation}.json"))
        return cls(spark, path, T.StructType.fromJson(meta["schema"]), meta["pk"], meta["ts"], meta["buckets"], generation)

    def _latest(self, rows: DataFrame) -> DataFrame:
        # what does not order (maps, variants) cannot be part of a table of changes; arrays and structs do
        whole = F.struct(F.col(self.ts), F.struct(*[F.col(f"`{c}`") for c in self.schema.names]))
        newest = rows.groupBy(F.col(self.pk).alias("_key")).agg(F.max(whole).alias("_row"))
        return newest.select("_row.col2.*")

    def apply(self, changes: DataFrame, *, op: str, delete: str, start: Column | None = None, end: Column | None = None) -> None:
        """Append the latest change of every key in the batch; rows without a key are left out."""
        within = changes.where(F.col(self.pk).isNotNull())
        if start is not None:
            within = within.where(F.col(self.ts) >= start)
        if end is not None:
            within = within.where(F.col(self.ts) <= end)
        marked = within.withColumn(DELETED, F.coalesce(F.col(op) == F.lit(delete), F.lit(False)))
        rows = marked.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        latest = self._latest(rows.repartition(self.buckets, self.pk))
        self._append(latest, self.name)

    def _append(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("append").format("parquet").bucketBy(self.buckets, self.pk).sortBy(self.pk).saveAsTable(name)

    def changes(self) -> DataFrame:
        """All kept changes, several per key between compactions."""
        return self.spark.table(self.name)

    def latest(self) -> DataFrame:
        """The latest change of every key, deletions included."""
        return self._latest(self.changes())

    def current_rows(self) -> DataFrame:
        return self.latest().where(~F.col(DELETED)).drop(DELETED)

    def compact(self, forget_before: Column | None = None) -> None:
        """Rewrite the log as one file per bucket; deletions older than ``forget_before`` are dropped."""
        kept = self.latest()
        if forget_before is not None:
            kept = kept.where(~(F.col(DELETED) & (F.col(self.ts) < forget_before)))
        after = ChangeLog(self.spark, self.path, self.schema, self.pk, self.ts, self.buckets, self.generation + 1)
        after._append(kept, after.name)
        _publish(self.spark, self.path, self.schema, self.pk, self.ts, self.buckets, after.generation)
        self.spark.sql(f"DROP TABLE {self.name}")  # the catalog's entry; files stay with the folder's owner
        self.name, self.generation = after.name, after.generation


def _publish(spark: SparkSession, path: str, schema: T.StructType, pk: str, ts: str, buckets: int, generation: int) -> None:
    meta = {"schema": schema.jsonValue(), "pk": pk, "ts": ts, "buckets": buckets}
    put_text(spark, f"{path}/log-{generation}.json", json.dumps(meta))


def _exists(spark: SparkSession, path: str) -> bool:
    system, at = filesystem(spark, path)
    return system.exists(at)
