"""Session helpers: shared scratch space, durable materialisation and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Upper bound of what one plan may ship to every task (query vectors, centroids, code books).
BROADCAST_BYTES = 64 << 20
# A query set up to this many rows is fetched without a counting job first; with the
# 32768-dimension limit that is at most 128 MB of f32 values.
PROBE_ROWS = 1024
_LOCAL_FOLDERS: dict[str, str] = {}  # per application, local masters only
# Size estimates above this stand for "unknown".
UNKNOWN_BYTES = 1 << 60


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder of the cluster; a temporary one only for a local master without the setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="vecspark-")
    return _LOCAL_FOLDERS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor; used where a later step must see exactly
    the rows (and positions) of an earlier one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a small text file; it appears whole, and an existing one is never replaced."""
    fs, final = filesystem(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise FileExistsError(path)


def get_text(spark: SparkSession, path: str) -> str:
    fs, at = filesystem(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan (an upper bound for scans, filters and projections)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def estimated_tasks(df: DataFrame) -> int:
    """How many scan tasks the plan will need at the session's split size.

    Inputs whose size the optimizer does not know count as a few tasks per core.
    """
    spark = df.sparkSession
    size = estimated_bytes(df)
    if size > UNKNOWN_BYTES:
        return 4 * spark.sparkContext.defaultParallelism
    split = spark.conf.get("spark.sql.files.maxPartitionBytes", "134217728b")
    return max(1, size // max(1, _to_bytes(split)))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of an input too small to occupy the cluster over all cores.

    For row-wise work that costs more than moving the row.  Inputs with at least one scan task per
    core are returned as they are, so at most cores x split size is ever moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_tasks(df) < cores else df


def _to_bytes(text: str) -> int:
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    t = text.strip().lower()
    t = t[:-1] if t.endswith("b") else t
    return int(t[:-1]) << units[t[-1]] if t and t[-1] in units else int(t)
