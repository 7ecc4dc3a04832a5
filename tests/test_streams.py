import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark import schema as S
from vecspark.sources.table import VectorTable
from vecspark.streaming import streams
from vecspark.streaming.changes import ChangeLog

START = datetime(2024, 1, 1)
SHAPE = "id long, at timestamp, op string, v double, tags array<string>"


def written(spark, folder, batches, schema):
    """Batches as a stream of one file each, in order."""
    import time

    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(1.1 if n + 1 < len(batches) else 0)  # files are read by their time
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def changes(seed, n, keys):
    rnd = random.Random(seed)
    return [(rnd.choice(keys), START + timedelta(seconds=rnd.randrange(5000)), rnd.choice(["put", "put", "drop"]), float(i), [str(i)])
            for i in range(n)]


def last_of(rows):
    last = {}
    for row in rows:
        if row[0] not in last or (row[1], row[3]) > (last[row[0]][1], last[row[0]][3]):
            last[row[0]] = row
    return sorted((k, r[3]) for k, r in last.items() if r[2] != "drop")


def log_of(spark, folder, buckets=4):
    return ChangeLog.create(spark, f"{folder}/log", T._parse_datatype_string(SHAPE), pk="id", ts="at", buckets=buckets)


def held(log):
    return sorted((r["id"], r["v"]) for r in log.current_rows().collect())


@pytest.mark.filterwarnings("ignore")
def test_random_keys_never_move_stored_rows(spark, folder):
    keys = random.Random(1).sample(range(1 << 60), 60)
    batches = [changes(seed, 200, keys) for seed in range(3)]
    every = [(k, t, op, seed * 1000 + v, tags) for seed, rows in enumerate(batches) for k, t, op, v, tags in rows]
    batches = [every[i:i + 200] for i in (0, 200, 400)]
    log = log_of(spark, folder)
    stream = written(spark, folder, batches, SHAPE)
    streams.stream_log_changes(stream, log, f"{folder}/ckpt", op="op", delete="drop").awaitTermination()
    # of equally old changes the one with the larger columns: op before v
    want = {}
    for row in every:
        if row[0] not in want or (row[1], row[2], row[3]) > (want[row[0]][1], want[row[0]][2], want[row[0]][3]):
            want[row[0]] = row
    want = sorted((k, r[3]) for k, r in want.items() if r[2] != "drop")
    assert held(log) == want and want
    plan = log.current_rows()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    log.apply(spark.createDataFrame(batches[1], SHAPE), op="op", delete="drop")  # a batch applied twice
    assert held(log) == want and log.changes().count() > log.latest().count()
    log.compact()
    assert held(log) == want and log.changes().count() == log.latest().count()
    again = ChangeLog.open(spark, f"{folder}/log")
    assert again.generation == 1 and held(again) == want


def test_late_changes_deletions_and_windows(spark, folder):
    log = log_of(spark, folder)

    def put(*rows, **kw):
        log.apply(spark.createDataFrame([(k, START + timedelta(seconds=t), op, v, None) for k, t, op, v in rows], SHAPE), op="op", delete="drop", **kw)

    put((1, 10, "put", 1.0), (2, 10, "put", 2.0), (None, 10, "put", 9.0))
    put((1, 20, "drop", 0.0), (2, 5, "put", 7.0), (3, 1, None, 3.0))
    put((1, 15, "put", 8.0))  # older than the deletion
    assert held(log) == [(2, 2.0), (3, 3.0)]
    put((1, 30, "put", 4.0), (2, 99, "drop", 0.0), start=F.lit(START), end=F.lit(START + timedelta(seconds=50)))
    assert held(log) == [(1, 4.0), (2, 2.0), (3, 3.0)]
    put((3, 40, "drop", 0.0))
    log.compact(forget_before=F.lit(START + timedelta(seconds=41)))
    assert log.changes().count() == 2 and held(log) == [(1, 4.0), (2, 2.0)]
    put()
    assert held(log) == [(1, 4.0), (2, 2.0)]
    with pytest.raises(ValueError):
        ChangeLog.create(spark, f"{folder}/x", T._parse_datatype_string("a long"), pk="id", ts="a")


def test_expiry_by_event_time(spark, folder):
    at = lambda s: START + timedelta(seconds=s)
    batches = [[(1, at(0), 1.0), (2, at(0), 1.0), (3, at(50), 1.0), (3, at(50), 1.0)],
               [(2, at(90), 2.0), (4, at(100), 1.0)],  # 2 is refreshed in time
               [(5, at(260), 1.0), (1, at(255), 2.0)],  # 1 expired before and comes back
               [(6, at(300), 1.0), (7, None, 1.0)]]
    schema = "id long, at timestamp, v double"
    fields = [S.field("id", T.LongType(), pk=True), S.field("at", T.TimestampType()), S.field("v", T.DoubleType()), S.vector("vec", "dense", 2)]
    table = VectorTable.create(spark, f"{folder}/t", S.table_schema(fields))
    stream = written(spark, folder, batches, schema)
    rows = [r for b in batches for r in b if r[1] is not None]
    latest = {}
    for r in rows:
        latest[r[0]] = max(latest.get(r[0], r), r, key=lambda x: x[1])
    df = spark.createDataFrame([(*r, [0.5, 0.5]) for r in latest.values()], f"{schema}, vec array<float>")
    table.insert(df)
    streams.stream_expire(stream, table, f"{folder}/ckpt", ts="at", seconds=100).awaitTermination()
    want = sorted(k for k, r in latest.items() if r[1] + timedelta(seconds=100) >= at(300))
    assert sorted(r["id"] for r in table.read().collect()) == want == [1, 5, 6]
    with pytest.raises(ValueError):
        streams.expiries(stream, pk="id", ts="at", seconds=-1)
