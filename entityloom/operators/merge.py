"""Merging the records of one entity field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.functions.text import drop_quotes
from entityloom.schema import SOURCE_PRIORITY


def source_priority(source: Column, table: dict[str, int] = SOURCE_PRIORITY) -> Column:
    """Priority of a source; an unknown one comes last."""
    out = F.lit(max(table.values()) + 1)
    for name, rank in table.items():
        out = F.when(source == name, rank).otherwise(out)
    return out


def best_known(column: str, *order: str) -> Column:
    """The first known value of a column under ``order``; merges partially before a shuffle."""
    key = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), key)).alias(column)


def merge_by_priority(df: DataFrame, entity: str, fields: tuple[str, ...], *order: str, counts: str | None = None) -> DataFrame:
    """One row per entity: every field from the best record that knows it.

    Spark combines records of one entity already on the map side, so that an entity with
    very many records sends one partial row per task.  ``counts`` names a column for the
    number of records.
    """
    n_records = [F.count(F.lit(1)).alias(counts)] if counts else []
    return df.groupBy(entity).agg(*n_records, *[best_known(f, *order) for f in fields])


def clean_strings(df: DataFrame) -> DataFrame:
    """Drop double quotes and outer white space from all text columns."""
    return df.select(*[drop_quotes(F.col(n)).alias(n) if t == "string" else F.col(n) for n, t in df.dtypes])
