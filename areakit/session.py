"""Session set-up, the shared scratch folder, and cutting lineage."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Paths of settled frames that are still in the shared folder.
_SETTLED: list[str] = []

# Rows of a small frame that one task writes.
ROWS_PER_FILE = 50_000

# Runtime SQL settings the plans count on. The last one lets a skewed join be
# split even where the aggregate above it then needs a shuffle of its own.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def new_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the runtime settings; ``settings`` use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


@functools.cache
def _own_folder() -> str:
    """A folder of this process, removed when it ends."""
    folder = tempfile.TemporaryDirectory(prefix="areakit-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    return folder.name


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        folder = _own_folder()
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path for a table one job writes and another reads."""
    return f"{shared_dir(spark)}/areakit/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", rows: int | None = None) -> DataFrame:
    """Compute ``df`` once into Parquet files of the shared folder and read them back.

    For frames that several jobs read: the files outlive a lost executor, readers
    prune columns, and Spark knows their size when it plans a join. They are removed
    by ``discard`` once nothing reads them any more, or else when the process ends.

    ``rows``, if known, is the most that ``df`` may hold: few rows are written by few tasks.
    On a local disk each file costs the executor several forks (Hadoop calls chmod), so a
    small frame in as many files as there are shuffle partitions is slow and heavy.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    path = scratch(spark, label)
    df.write.parquet(path)
    _SETTLED.append(path)
    settled = spark.read.schema(df.schema).parquet(path)
    settled.settled_path = path
    return settled


def discard(*frames: DataFrame) -> None:
    """Remove the files of frames that ``settle`` returned; nothing may read them afterwards."""
    for frame in frames:
        path = getattr(frame, "settled_path", None)
        if path in _SETTLED:
            _SETTLED.remove(path)
            _delete(frame.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def pin(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` with its partitions and their order kept."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Remove the files of all settled frames; none of them can be read afterwards."""
    while _SETTLED:
        _delete(spark, _SETTLED.pop())


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _SETTLED else None
    if spark is not None:
        release(spark)
