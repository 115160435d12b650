"""Incremental refresh: new records arrive as files, the latest one per key counts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.operators.latest import WIDE, latest_rows


def latest_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key under ``order``; combines on the map side, no sort of a group."""
    others = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("r"))
    return best.select(*[F.col(key) if c == key else F.col(f"r.{c}").alias(c) for c in df.columns])


def latest_pages(pages: DataFrame, url: str = "url", counted: bool = False) -> DataFrame | tuple[DataFrame, int]:
    """One row for each address: the last by ``fetched_at`` where the table has it.

    Rows of one time, or of none, are told apart by their content, so reruns agree.  The choice is made
    on narrow rows, and contents are read where they lie.  With ``counted`` also the number of rows given.
    """
    times = tuple(c for c in ("fetched_at",) if c in pages.columns)
    keys = ("source", url) if "source" in pages.columns else (url,)
    chosen, n_given = latest_rows(pages, keys, times)
    return (chosen, n_given) if counted else chosen


def is_wide(schema: str | T.StructType) -> bool:
    """Whether records hold page contents, which should not be shuffled."""
    names = schema.names if isinstance(schema, T.StructType) else T.DataType.fromDDL(schema).names
    return any(c in WIDE for c in names)


def refresh(stream: DataFrame, key: str, order: tuple[str, ...], target: str, checkpoint: str, also=None) -> None:
    """Take in all files present, then stop.

    Every micro-batch writes its rows to its own folder and replaces it when it is replayed, so that a
    restart neither loses nor doubles rows: narrow records the latest of each key, pages as they are.
    Nothing written before is rewritten; ``current`` merges on read and ``compact`` folds the folders into
    one.  ``also(batch rows, batch id)`` is called once the rows of a batch are written.
    """
    wide = is_wide(stream.schema)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        path = os.path.join(target, f"batch={batch_id}")
        rows = batch if wide else latest_per_key(batch, key, *order)
        rows.write.mode("overwrite").parquet(path)
        if also is not None:
            also(batch.sparkSession.read.schema(stream.schema).parquet(path), batch_id)

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def all_batches(spark: SparkSession, target: str, schema: str | T.StructType) -> DataFrame:
    """The rows of all batches, whether superseded or not."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(target)


def current(spark: SparkSession, target: str, schema: str | T.StructType, key: str, order: tuple[str, ...]) -> DataFrame:
    """The present state: the latest row per key over all batches.

    For pages, contents in ``order`` stand for their hash.
    """
    deltas = all_batches(spark, target, schema)
    if is_wide(schema):
        return latest_rows(deltas, (key,), tuple(c for c in order if c not in WIDE))[0]
    return latest_per_key(deltas, key, *order)


def compact(spark: SparkSession, target: str, compacted: str, schema: str, key: str, order: tuple[str, ...]) -> None:
    """Write the present state to a new folder, from which a later refresh may go on."""
    current(spark, target, schema, key, order).write.parquet(os.path.join(compacted, "batch=base"))
