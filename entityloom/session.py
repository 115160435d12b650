"""Session set-up for local runs, and the shared folder for staged tables."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str | int = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("entityloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, else the context's own.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _OWN_DIRS:
        _OWN_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="entityloom-")
    return _OWN_DIRS[context.applicationId]


#: Scratch paths made in the innermost open scope; None outside any.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)
#: Where staged frames lie, for as long as the frames are held.
_STAGED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never reused, so reruns cannot mix results."""
    path = os.path.join(shared_dir(spark), "entityloom", f"{label}-{uuid.uuid4().hex}")
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever file system its path names; False if it is not there."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Tables staged inside are deleted at the end, also after an error.

    Frames that read them must have been written elsewhere by then.  Threads started inside belong to
    the scope if they run in a copy of the context (``contextvars.copy_context``).
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            delete_path(spark, path)


def discard(*frames: DataFrame | None) -> None:
    """Delete staged tables that no later step reads, as those of the round before last."""
    for df in frames:
        path = _STAGED.pop(df, None) if df is not None else None
        if path is not None:
            delete_path(df.sparkSession, path)


def staged(
    df: DataFrame, label: str, metrics: dict | None = None, partition_by: tuple[str, ...] = ()
) -> tuple[DataFrame, dict]:
    """Write ``df`` to the shared folder and read it back, so that its lineage is cut.

    The written table survives the loss of executors.  ``metrics`` (name -> aggregate
    column) are taken during the same write, so that counting costs no further job.  With
    ``partition_by`` later filters on those columns read their own folders only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    wanted = {"n_rows": F.count(F.lit(1)), **(metrics or {})}
    seen = Observation(f"{label}-{uuid.uuid4().hex[:8]}")
    observed = df.observe(seen, *[expr.alias(name) for name, expr in wanted.items()])
    writer = observed.write.partitionBy(*partition_by) if partition_by else observed.write
    writer.parquet(path)
    read = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    _STAGED[read] = path
    return read, seen.get
