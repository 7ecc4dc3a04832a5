"""Structured Streaming over vector tables: continuous upsert, change logs, search of arriving queries."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from vecspark.operators.ann import IvfIndex, ivf_search
from vecspark.session import materialize
from vecspark.sources.table import VectorTable, last_per_key
from vecspark.streaming.changes import ChangeLog

DELETED = "deleted"


def run_batches(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None],
                interval: str | None = None) -> StreamingQuery:
    """Apply every micro-batch; without an interval, drain what is there and stop."""
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stream_upsert(stream: DataFrame, table: VectorTable, checkpoint: str, *, seq: str,
                  partition: str | None = None, interval: str | None = None) -> StreamingQuery:
    """Continuous upsert; applying a batch twice gives the same table."""
    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            table.upsert(batch, partition, seq=seq)

    return run_batches(stream, checkpoint, apply, interval)


def apply_changes(table: VectorTable, changes: DataFrame, *, ts: str, op: str, delete: str,
                  start: Column | None = None, end: Column | None = None) -> None:
    """Apply a change log: per key the latest change wins, changes older than the stored one are ignored.

    The table keeps ``ts`` and a ``deleted`` flag, so a late change cannot bring a deleted key back.
    """
    within = changes
    if start is not None:
        within = within.where(F.col(ts) >= start)
    if end is not None:
        within = within.where(F.col(ts) <= end)
    rows = within.withColumn(DELETED, F.col(op) == F.lit(delete))
    named = [c for c in rows.columns if c in table.schema.names]
    latest = materialize(last_per_key(rows, table.pk, named, ts), "changes")  # read for the range, the join and the upsert
    low, high = latest.agg(F.min(table.pk), F.max(table.pk)).first()
    stored = table.read().where(F.col(table.pk).between(low, high)).select(F.col(table.pk), F.col(ts).alias("_stored"))
    newer = latest.join(stored, table.pk, "left").where(F.col("_stored").isNull() | (F.col(ts) > F.col("_stored")))
    table.upsert(newer.drop("_stored"), seq=ts)


def current_rows(table: VectorTable) -> DataFrame:
    return table.read().where(~F.col(DELETED))


def stream_log_changes(stream: DataFrame, log: ChangeLog, checkpoint: str, *, op: str, delete: str,
                       interval: str | None = None) -> StreamingQuery:
    """Append every batch to the buckets of its keys; stored rows are not read."""
    return run_batches(stream, checkpoint, lambda batch, _: log.apply(batch, op=op, delete=delete), interval)


def stream_apply_changes(stream: DataFrame, table: VectorTable, checkpoint: str, *, interval: str | None = None,
                         **options) -> StreamingQuery:
    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            apply_changes(table, batch, **options)

    return run_batches(stream, checkpoint, apply, interval)


def stream_search(stream: DataFrame, index: IvfIndex, out: str, checkpoint: str, k: int, *, metric: str, nprobe: int,
                  qid: str = "qid", qvec: str = "qvec", interval: str | None = None) -> StreamingQuery:
    """Search arriving query vectors against a fixed index; a repeated batch overwrites its own folder."""
    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            hits = ivf_search(index, batch, k, metric=metric, nprobe=nprobe, qid=qid, qvec=qvec)
            hits.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return run_batches(stream, checkpoint, apply, interval)


EXPIRED = "expired_ts"


def expiries(stream: DataFrame, *, pk: str, ts: str, seconds: int, delay: str = "0 seconds") -> DataFrame:
    """(pk, expired_ts) of keys whose latest row the watermark has left more than ``seconds`` behind.

    State holds the latest time per key and a timer.  A repeated or newer row sets the timer anew, an older one changes nothing, a
    key that comes back after its expiry starts again.  Rows that arrive more than ``delay`` behind the stream's newest are not
    followed, as the watermark drops them; rows within it that are expired on arrival are reported at once.
    """
    if seconds < 0:
        raise ValueError("ttl must not be negative")
    kind = stream.schema[pk].dataType.simpleString()

    def follow(key, batches, state):
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            yield pd.DataFrame({pk: [key[0]], EXPIRED: [pd.Timestamp(last, unit="us")]})
            return
        last = state.get[0] if state.exists else None
        for batch in batches:
            newest = int(batch["_us"].max())
            last = newest if last is None else max(last, newest)
        timer, now = last // 1000 + seconds * 1000, state.getCurrentWatermarkMs()
        if timer < now:
            if state.exists:
                state.remove()
            yield pd.DataFrame({pk: [key[0]], EXPIRED: [pd.Timestamp(last, unit="us")]})
            return
        state.update((last,))
        state.setTimeoutTimestamp(max(timer, now + 1))

    rows = stream.where(F.col(pk).isNotNull() & F.col(ts).isNotNull()).select(pk, ts, F.unix_micros(ts).alias("_us"))
    return rows.withWatermark(ts, delay).groupBy(pk).applyInPandasWithState(
        follow, f"`{pk}` {kind}, {EXPIRED} timestamp", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def stream_expire(stream: DataFrame, table: VectorTable, checkpoint: str, *, ts: str, seconds: int, delay: str = "0 seconds",
                  interval: str | None = None) -> StreamingQuery:
    """Delete rows of the table as the event time of ``stream`` leaves them behind; a row newer than the expired one stays."""
    def apply(batch: DataFrame, _: int) -> None:
        gone = materialize(batch.groupBy(table.pk).agg(F.max(EXPIRED).alias(EXPIRED)), "expired")
        old = table.read().select(F.col(table.pk), F.col(ts).alias("_ts")).join(gone, table.pk).where(F.col("_ts") <= F.col(EXPIRED))
        keys = materialize(old.select(table.pk), "expired-keys")
        if not keys.isEmpty():
            table.delete_by_pk(keys)

    return run_batches(expiries(stream, pk=table.pk, ts=ts, seconds=seconds, delay=delay), checkpoint, apply, interval)
