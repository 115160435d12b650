"""Consolidation kept up to date: a batch of changed records recomputes the entities it touches.

What records match depends only on the records they are connected with through key values, so the
state keeps for each record its component, and an index from key values to components.  A batch touches

* the components of the records it changes or removes, and
* the components that hold a key value of its new records.

No other record shares a key value with any of these, so clusters and merged rows of just their records
are formed anew, and all others stay as they are.  A component that was touched is listed as gone, and its records
come back in components of the new version; when it fell apart, or several grew together, they
are the new ones.

The state is a list of versions (``sinks.versions``).  A version holds the rows that its batch wrote, so a
small batch writes little; readers leave out rows of components that a later version lists as gone.
``compact`` writes the present rows as one version, from which reading starts again.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.operators.merge import clean_strings, merge_by_priority, source_priority
from entityloom.operators.quality import MIN_KNOWN, REQUIRED, keep_valid
from entityloom.operators.resolve import by_shuffle, greedy_clusters, key_blocks, transitive_clusters
from entityloom.plans.consolidate import MATCH_KEYS
from entityloom.schema import FIELDS, SOURCE_PRIORITY
from entityloom.session import scratch_scope, staged
from entityloom.sinks.tables import number_rows
from entityloom.sinks.versions import commits, write_version

_TABLES = ("records", "index", "merged", "gone")
_BASE = "base"


@dataclass(frozen=True)
class EntityState:
    """Where the state lies and how records are told apart, ordered, matched and merged.

    ``order`` names the columns that give the merge order; together they are unique, and they hold
    ``key``, which names a record over all its versions.
    """

    folder: str
    key: tuple[str, ...] = ("source", "ico_url")
    order: tuple[str, ...] = ("turn", "source", "ico_url")
    fields: tuple[str, ...] = FIELDS
    required: tuple[str, ...] = REQUIRED
    minimum: int = MIN_KNOWN
    match_keys: tuple[str, ...] = MATCH_KEYS
    priority: tuple[tuple[str, int], ...] = tuple(SOURCE_PRIORITY.items())

    def columns(self) -> tuple[str, ...]:
        """Columns of a record: key, order and fields, each once."""
        return tuple(dict.fromkeys((*self.key, *self.order, *self.fields)))

    def keys(self) -> dict[str, Column]:
        return {k: F.col(k) for k in self.match_keys}


def _present(spark: SparkSession, state: EntityState) -> dict[str, DataFrame] | None:
    """Rows of each table that no later version lists as gone; None before the first batch."""
    # One short row for each batch since the state was compacted.
    listed = sorted(commits(spark, state.folder).collect(), key=lambda c: c.number)
    starts = [i for i, c in enumerate(listed) if c.label == _BASE]
    listed = listed[starts[-1] if starts else 0 :]
    if not listed:
        return None
    path = lambda c, t: os.path.join(state.folder, "_versions", c.version, t)
    read = {t: spark.read.parquet(*[path(c, t) for c in listed]) for t in _TABLES}
    return {t: read[t].join(by_shuffle(read["gone"]), ["version", "component"], "left_anti") for t in _TABLES if t != "gone"}


def _next_version(spark: SparkSession, state: EntityState) -> int:
    return (commits(spark, state.folder).agg(F.max("number").alias("n")).first().n or 0) + 1


def _touched(present: dict[str, DataFrame], keys: DataFrame, n_keys: int | None, fresh: DataFrame, state: EntityState) -> DataFrame:
    """(version, component) that a batch touches, by its records' keys and by its key values."""
    n_blocks = n_keys * len(state.match_keys) if n_keys is not None else None
    of_keys = present["records"].join(by_shuffle(keys, n_keys), list(state.key), "left_semi").select("version", "component")
    blocks = fresh.select(F.explode(key_blocks(state.keys())).alias("block")).distinct()
    of_blocks = present["index"].join(by_shuffle(blocks, n_blocks), "block", "left_semi").select("version", "component")
    return of_keys.unionByName(of_blocks).distinct()


def apply_changes(state: EntityState, changed: DataFrame, removed: DataFrame | None = None) -> dict[str, int]:
    """Take in a batch and commit a version; how many rows each step met.

    ``changed`` has one row for each changed or new record (columns of the state); a record that is not
    valid any more leaves its entity.  ``removed`` names keys whose records are gone.
    """
    spark = changed.sparkSession
    with scratch_scope(spark):
        columns = state.columns()
        given, n_given = staged(changed.select(*columns), "changed")
        fresh = keep_valid(given, state.required, state.fields, state.minimum)
        keys = given.select(*state.key)
        keys = (keys.unionByName(removed.select(*state.key)) if removed is not None else keys).distinct()
        # How many are removed is not known before they are read.
        n_keys = int(n_given["n_rows"]) if removed is None else None
        present = _present(spark, state)
        version = _next_version(spark, state)
        if present is None:
            touched = spark.createDataFrame([], "version long, component long")
            members, n_touched = fresh, 0
        else:
            touched, seen = staged(_touched(present, keys, n_keys, fresh, state), "touched")
            n_touched = int(seen["n_rows"])
            kept = present["records"].join(by_shuffle(touched, n_touched), ["version", "component"], "left_semi")
            kept = kept.join(by_shuffle(keys, n_keys), list(state.key), "left_anti")
            members = kept.select(*columns).unionByName(fresh)
        ranked, n_members = staged(number_rows(members, *state.order, name="_rank"), "members")
        frames, n_entities = _recomputed(ranked, int(n_members["n_rows"]), state)
        frames["gone"] = touched
        for table in ("records", "index", "merged"):
            frames[table] = frames[table].withColumn("version", F.lit(version).cast("long"))
        write_version(frames, state.folder)
        return {
            "changed": int(n_given["n_rows"]),
            "components_touched": n_touched,
            "records_recomputed": int(n_members["n_rows"]),
            "entities_recomputed": n_entities,
        }


def _recomputed(ranked: DataFrame, n_members: int, state: EntityState) -> tuple[dict[str, DataFrame], int]:
    """Records with their component, the index of key values, and merged entities."""
    named = lambda df, name: df.withColumnsRenamed({"rank": "_rank", "entity": name})
    component = named(transitive_clusters(ranked, "_rank", state.keys()), "component")
    cluster = named(greedy_clusters(ranked, "_rank", state.keys()), "_entity")
    placed, _ = staged(ranked.join(by_shuffle(component, n_members), "_rank").join(by_shuffle(cluster, n_members), "_rank"), "clustered")
    # A seed is a member of its own entity: no join with all records is needed to name it.
    seeds = placed.where("_rank = _entity").select("_entity", "component", F.struct(*state.order).alias("seed"))
    ready = placed.withColumn("_priority", source_priority(F.col("source"), dict(state.priority)))
    merged = clean_strings(merge_by_priority(ready, "_entity", state.fields, "_priority", "_rank"))
    merged, seen = staged(merged.join(by_shuffle(seeds, n_members), "_entity").drop("_entity"), "merged-entities")
    index = placed.select("component", F.explode(key_blocks(state.keys())).alias("block")).distinct()
    records = placed.select("component", *state.columns())
    return {"records": records, "index": index, "merged": merged}, int(seen["n_rows"])


def current_entities(spark: SparkSession, state: EntityState) -> DataFrame:
    """The merged entities as they stand: ``seed`` (the order columns of the first record) and the fields."""
    present = _present(spark, state)
    if present is None:
        raise ValueError(f"no batch was taken in at {state.folder}")
    return present["merged"].select("seed", *state.fields)


def compact(spark: SparkSession, state: EntityState) -> None:
    """Write the present rows as one version, from which readers start."""
    present = _present(spark, state)
    if present is None:
        return
    # Components keep the version they were written in: the pair stays unique.
    write_version({**present, "gone": spark.createDataFrame([], "version long, component long")}, state.folder, _BASE)
