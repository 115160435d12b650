"""Versions of a set of tables that belong together.

All tables of a version are written to a folder of their own; then one row is appended to the list
of commits, as one file.  Readers take the version of the last commit, so they see all tables of one
version, or, while the next is being written or after it failed, all tables of the one before.
Nothing is ever overwritten.  One writer at a time is assumed, as for any reload.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.session import delete_path

_COMMITS, _VERSIONS = "commits", "_versions"
_COMMIT_SCHEMA = "number long, version string, tables array<string>, label string"


def _listed(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(_COMMIT_SCHEMA).json(os.path.join(folder, _COMMITS))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """(number, version, tables, label): all commits of a folder; none if it is new."""
    listed = _listed(spark, folder)
    return listed if listed is not None else spark.createDataFrame([], _COMMIT_SCHEMA)


def last_commit(spark: SparkSession, folder: str):
    """The row of the last commit, None before the first."""
    listed = _listed(spark, folder)
    if listed is None:
        return None
    return listed.agg(F.max(F.struct("number", "version", "tables", "label")).alias("m")).select("m.*").where("number is not null").first()


def _paths(folder: str, version: str, tables) -> dict[str, str]:
    return {t: os.path.join(folder, _VERSIONS, version, t) for t in tables}


def write_version(frames: dict[str, DataFrame], folder: str, label: str = "") -> dict[str, str]:
    """Write all tables, then commit them together; their paths.

    If a table fails, nothing is committed and the version before stays the one that readers find.
    """
    spark = next(iter(frames.values())).sparkSession
    last = last_commit(spark, folder)
    version = uuid.uuid4().hex
    paths = _paths(folder, version, frames)
    try:
        for table, df in frames.items():
            df.write.parquet(paths[table])
    except Exception:
        delete_path(spark, os.path.join(folder, _VERSIONS, version))
        raise
    row = spark.range(0, 1, 1, 1).select(
        F.lit(last.number + 1 if last else 1).alias("number"),
        F.lit(version).alias("version"),
        F.array(*[F.lit(t) for t in frames]).alias("tables"),
        F.lit(label).alias("label"),
    )
    row.write.mode("append").json(os.path.join(folder, _COMMITS))
    return paths


def table_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """Paths of the tables of the last committed version; none before the first commit."""
    last = last_commit(spark, folder)
    return _paths(folder, last.version, last.tables) if last else {}


def drop_versions(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Delete the tables of all but the last ``keep`` committed versions; how many were deleted.

    A reader that resolved its paths before the last ``keep`` commits loses them.
    """
    # One short row for each commit that is still listed.
    old = commits(spark, folder).orderBy(F.desc("number")).offset(max(keep, 1)).select("version").collect()
    return sum(delete_path(spark, os.path.join(folder, _VERSIONS, row.version)) for row in old)
