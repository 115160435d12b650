"""Validity filters, stage counts and rejects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REQUIRED = ("name", "ticker")
MIN_KNOWN = 5


def completeness(*columns: str) -> Column:
    """How many of the columns are known in a row."""
    known = [F.col(c).isNotNull().cast("int") for c in columns]
    return reduce(lambda a, b: a + b, known)


def is_valid(fields: tuple[str, ...], required: tuple[str, ...] = REQUIRED, minimum: int = MIN_KNOWN) -> Column:
    """All required fields known, and at least ``minimum`` of ``fields``."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return present & (completeness(*fields) >= minimum)


def keep_valid(df: DataFrame, required: tuple[str, ...] = REQUIRED, fields: tuple[str, ...] | None = None, minimum: int = MIN_KNOWN) -> DataFrame:
    """Rows with all required fields and at least ``minimum`` known fields."""
    return df.where(is_valid(tuple(fields or df.columns), required, minimum))


def counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count rows while some later action reads them; no extra job."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def unparsed(raw: Column, parsed: Column) -> Column:
    """A text that holds digits but fits no layout."""
    return raw.rlike("[0-9]") & parsed.isNull()


def unparsed_counts(df: DataFrame, by: str, **pairs: tuple[Column, Column]) -> DataFrame:
    """Per group: how many texts of each named (raw, parsed) pair failed to parse."""
    aggs = [F.count_if(unparsed(raw, parsed)).alias(name) for name, (raw, parsed) in pairs.items()]
    return df.groupBy(by).agg(*aggs)


def rejects(df: DataFrame, key: str, **checks: tuple[Column, Column, str]) -> DataFrame:
    """Long table of failed fields: ``(key, field, raw, reason)``; one pass over the input.

    Each check is (raw value, failed?, reason).
    """
    found = F.array(
        *[
            F.when(bad, F.struct(F.lit(name).alias("field"), raw.cast("string").alias("raw"), F.lit(reason).alias("reason")))
            for name, (raw, bad, reason) in checks.items()
        ]
    )
    failed = df.select(key, F.explode(F.filter(found, F.isnotnull)).alias("r"))
    return failed.select(key, "r.field", "r.raw", "r.reason")
