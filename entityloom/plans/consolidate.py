"""Whole consolidation of profile records: validity, clusters, merge, clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.operators.merge import clean_strings, merge_by_priority, source_priority
from entityloom.operators.quality import MIN_KNOWN, REQUIRED, keep_valid
from entityloom.operators.resolve import greedy_clusters, transitive_clusters
from entityloom.schema import FIELDS, SOURCE_PRIORITY
from entityloom.session import staged

MATCH_KEYS = ("name", "ticker", "web_page")


def consolidate(
    records: DataFrame,
    rank: str = "rank",
    fields: tuple[str, ...] = FIELDS,
    required: tuple[str, ...] = REQUIRED,
    minimum: int = MIN_KNOWN,
    match_keys: tuple[str, ...] = MATCH_KEYS,
    priority: dict[str, int] = SOURCE_PRIORITY,
    transitive: bool = False,
    null_matches: bool = False,
) -> DataFrame:
    """One merged record per entity: ``entity`` and the fields.

    ``records`` carry a unique long ``rank`` (merge order, lowest first) next to the fields.
    """
    # Written before it is filtered: a filter on computed fields would compute them a second time.
    given, _ = staged(records.select(rank, source_priority(F.col("source"), priority).alias("_priority"), *fields), "records")
    valid = keep_valid(given, required, fields, minimum)
    form = transitive_clusters if transitive else greedy_clusters
    entities = form(valid, rank, {k: F.col(k) for k in match_keys}, null_matches)
    joined = valid.join(entities.withColumnRenamed("rank", rank), rank)
    return clean_strings(merge_by_priority(joined, "entity", fields, "_priority", rank))
