"""Session helpers: builder defaults and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "wattloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is designed for.

    Cluster sizing (executors, memory, shuffle partitions) stays with the
    submitter; only behaviour is set here.  AQE is on so that skewed join
    partitions are split and small shuffle partitions merged at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a single-machine session (master ``local``) uses its
    warehouse folder; any other master raises, as no folder of our choosing
    would be visible to all executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return folder.rstrip("/")


#: A side with at most this many rows may be broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a count finds few enough rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


_written: dict[str, object] = {}


@atexit.register
def remove_scratch() -> None:
    """Delete what ``scratch_path`` has handed out; runs at the end of the session's process."""
    for path, context in _written.items():
        with contextlib.suppress(Exception):
            _delete(context, path)
    _written.clear()


def _delete(context, path: str) -> None:
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet."""
    path = f"{shared_folder(spark)}/wattloom-{uuid.uuid4().hex}"
    _written[path] = spark.sparkContext
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting lineage.

    For frames read by several jobs or branches.  The written table survives
    the loss of any executor, and its known size lets the optimizer decide
    which joins to broadcast.  The write's shuffle files go once it is done,
    the table itself with ``discard`` or when the process ends.  ``options`` are
    the writer's.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def packed(df: DataFrame) -> DataFrame:
    """``materialize`` for tables of texts, which shrink much more under a slower codec."""
    return materialize(df, compression="zstd")


def discard(*frames: DataFrame) -> None:
    """Delete the tables of ``materialize`` that nothing reads any more."""
    for df in frames:
        path = df.scratch_path
        if context := _written.pop(path, None):
            _delete(context, path)
