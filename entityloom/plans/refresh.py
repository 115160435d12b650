"""Repeat refresh: page files as they arrive, then the whole run, or just the entities they touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.operators.extract import SourceRules
from entityloom.operators.latest import content_hash, placed, rows_at, winners
from entityloom.operators.packs import PACKS
from entityloom.plans.incremental import EntityState, apply_changes
from entityloom.plans.profiles import Community, extract_sources, full_run, merge_turn, page_roles, typed_profiles
from entityloom.session import scratch_scope, staged
from entityloom.sources.pages import decode_pages
from entityloom.streaming.refresh import all_batches, current, refresh

#: The latest fetch of an address counts; the body decides between fetches of one time.
ORDER = ("fetched_at", "body")


def refresh_run(
    page_stream: DataFrame, state: str, checkpoint: str, community: Community, as_of: Column, out_dir: str, run_ts: str
) -> dict[str, str]:
    """Take in all page files present and rebuild the tables from the latest page of each address.

    ``page_stream`` has source, url, content_type, body and fetched_at.  Runs over several
    batches of files give the tables that one run over all of them gives.
    """
    refresh(page_stream, "url", ORDER, state, checkpoint)
    with scratch_scope(page_stream.sparkSession):
        pages = current(page_stream.sparkSession, state, page_stream.schema, "url", ORDER)
        return full_run(pages, community, as_of, out_dir, run_ts, latest=True)


def latest_of_addresses(pages: DataFrame, addresses: DataFrame, packs: tuple[SourceRules, ...] = PACKS) -> DataFrame:
    """The latest pages, main and second ones, of the profiles in ``addresses`` (source, ico_url).

    Only their bodies are read: they are chosen by narrow rows.
    """
    rows = placed(pages)
    _, main = page_roles(packs)
    narrow = rows.select("source", "url", main.alias("ico_url"), "fetched_at", content_hash(pages).alias("_content"), "_row_file", "_row_at")
    mine = narrow.join(addresses, ["source", "ico_url"], "left_semi")
    return rows_at(rows, winners(mine, ("url",), (F.col("fetched_at"), F.col("_content"))))


def refresh_entities(
    page_stream: DataFrame,
    pages: str,
    checkpoint: str,
    state: EntityState,
    as_of: Column,
    packs: tuple[SourceRules, ...] = PACKS,
) -> list[dict[str, int]]:
    """Take in all page files present; extract the profiles they change, and recompute the entities those touch.

    Pages are kept below ``pages``.  The entities (``incremental.current_entities``) are those of a full
    run on the latest pages; ``as_of`` should be that of the batches before, or statuses that depend on it
    are of the day on which a profile was last seen.  Returns the counts of each batch.
    """
    counts: list[dict[str, int]] = []
    spark = page_stream.sparkSession

    def take_in(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            _, main = page_roles(packs)
            addresses, _ = staged(batch.select("source", main.alias("ico_url")).distinct(), "addresses")
            stored = all_batches(spark, pages, page_stream.schema)
            html, seen = staged(decode_pages(latest_of_addresses(stored, addresses, packs)), "decoded", partition_by=("source",))
            known = extract_sources(html.where("html is not null"), packs).profiles.where("raw is not null")
            profiles = typed_profiles(known, as_of, packs).withColumn("turn", merge_turn(F.col("source")))
            done = apply_changes(state, profiles, removed=addresses)
            counts.append({"batch": batch_id, "pages_read": int(seen["n_rows"]), **done})

    refresh(page_stream, "url", ORDER, pages, checkpoint, also=take_in)
    return counts
