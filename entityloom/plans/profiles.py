"""The full run: crawled pages to related tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.functions import text as tx
from entityloom.functions.urls import thread_base
from entityloom.operators import enrich
from entityloom.operators.countries import convert_countries, country_table, dim_map
from entityloom.operators.extract import SourceRules, extract, unmapped_labels
from entityloom.operators.links import follow_next
from entityloom.operators.normalize import DATES, SCORES, normalize, profile_texts
from entityloom.operators.packs import PACKS
from entityloom.operators.quality import is_valid, rejects, unparsed
from entityloom.operators.shred import shred
from entityloom.plans.consolidate import consolidate
from entityloom.schema import FIELDS, SOURCE_ORDER
from entityloom.session import scratch_scope, staged
from entityloom.sinks.files import write_by_source, write_stage
from entityloom.sinks.tables import fan_out, number_rows
from entityloom.sinks.versions import drop_versions, write_version
from entityloom.sources.pages import decode_pages
from entityloom.streaming.refresh import latest_pages


COUNTRIES = ("country", "countries_restricted")
CODE_LIST = r"^[A-Za-z]{3}(, [A-Za-z]{3})*$"


def extract_pages(pages: DataFrame, packs: tuple[SourceRules, ...] = PACKS) -> DataFrame:
    """``source, ico_url, raw, unmapped`` per profile from ``source, url, html``.

    Two sources spread a profile over two pages.  Only their rows take part in a join;
    where both pages name a field, the main page wins.
    """
    return extract_with_orphans(pages, packs)[0]


def page_roles(packs: tuple[SourceRules, ...] = PACKS) -> tuple[Column, Column]:
    """Whether a page is the second one of its profile, and the address of the profile's main page."""
    is_sub, main_url = F.lit(False), F.col("url")
    for pack in packs:
        if pack.sub_page:
            hit = (F.col("source") == pack.source) & F.endswith(F.col("url"), F.lit(pack.sub_page))
            is_sub = is_sub | hit
            main_url = F.when(hit, F.substring(F.col("url"), F.lit(1), F.length("url") - len(pack.sub_page))).otherwise(main_url)
    return F.coalesce(is_sub, F.lit(False)), main_url


def extract_with_orphans(pages: DataFrame, packs: tuple[SourceRules, ...] = PACKS) -> tuple[DataFrame, DataFrame]:
    """The profiles, and the second pages (``source, ico_url, url``) whose main page is missing."""
    endings = {p.source: p.sub_page for p in packs if p.sub_page}
    is_sub, main_url = page_roles(packs)
    marked = pages.withColumn("ico_url", main_url).withColumn("is_sub", is_sub)
    found = extract(shred(marked.select("source", "ico_url", "url", "is_sub", "html"), index=True), packs)
    # Both sides of the join below read these rows: shred every page once, and let each side
    # read its own folders.
    found = found.select("source", "ico_url", "url", "is_sub", "raw", "unmapped")
    found, _ = staged(found, "extracted", partition_by=("source", "is_sub"))
    two_paged = F.coalesce(F.col("source").isin(*endings), F.lit(False)) if endings else F.lit(False)
    single = found.where(~two_paged).drop("is_sub", "url")
    main = found.where(two_paged & ~F.col("is_sub")).drop("is_sub", "url")
    sub_pages = found.where("is_sub")
    sub = sub_pages.select("source", "ico_url", F.col("raw").alias("raw2"), F.col("unmapped").alias("unmapped2"))
    extra = F.map_filter(F.col("raw2"), lambda k, v: ~F.map_contains_key(F.col("raw"), k))
    both = main.join(sub, ["source", "ico_url"], "left").select(
        "source",
        "ico_url",
        F.when(F.col("raw2").isNull(), F.col("raw")).otherwise(F.map_concat("raw", extra)).alias("raw"),
        F.when(F.col("unmapped2").isNull(), F.col("unmapped")).otherwise(F.concat("unmapped", "unmapped2")).alias("unmapped"),
    )
    orphans = sub_pages.join(main, ["source", "ico_url"], "left_anti").select("source", "ico_url", "url")
    return single.unionByName(both), orphans


@dataclass
class Extracted:
    """What extraction made of a page table, source by source."""

    profiles: DataFrame
    orphans: DataFrame
    failed_pages: DataFrame
    outcomes: list[tuple[str, str, int, str]]


OUTCOME_SCHEMA = "source string, state string, n_profiles long, reason string"


def extract_sources(pages: DataFrame, packs: tuple[SourceRules, ...] = PACKS) -> Extracted:
    """Each source extracted by a plan of its own: one that fails costs its own pages alone.

    ``pages`` (source, url, html) should be a table divided by source, so that each plan reads its own part.
    Pages of a source that failed come back as ``failed_pages`` (source, url, reason), and each source gets an
    outcome (source, state, number of profiles, reason).
    """

    def of_source(pack: SourceRules) -> tuple[tuple[DataFrame, DataFrame] | None, tuple[str, str, int, str]]:
        try:
            found, orphans = extract_with_orphans(pages.where(F.col("source") == pack.source), (pack,))
            found, seen = staged(found, f"found-{pack.source}")
            return (found, orphans), (pack.source, "done", int(seen["n_rows"]), "")
        except Exception as error:  # noqa: BLE001 - whatever it is, the other sources go on
            return None, (pack.source, "failed", 0, f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"[:300])

    with ThreadPoolExecutor(max_workers=max(len(packs), 1)) as pool:
        running = [pool.submit(copy_context().run, of_source, pack) for pack in packs]
        results = [r.result() for r in running]
    unknown = pages.where(~F.coalesce(F.col("source").isin(*[p.source for p in packs]), F.lit(False)))
    # A page of no known source has no rules: its profile is NULL, which is a reject.
    empty = extract_with_orphans(unknown, ())
    frames = [f for f, _ in results if f is not None] + [empty]
    outcomes = [o for _, o in results]
    reasons = F.lit(None).cast("string")
    for source, state, _, reason in outcomes:
        if state == "failed":
            reasons = F.when(F.col("source") == source, F.lit(f"source failed: {reason}")).otherwise(reasons)
    failed = pages.select("source", "url", reasons.alias("reason")).where("reason is not null")
    union = lambda i: reduce(DataFrame.unionByName, [f[i] for f in frames])
    return Extracted(union(0), union(1), failed, outcomes)


def typed_profiles(
    extracted: DataFrame, as_of: Column, packs: tuple[SourceRules, ...] = PACKS, countries: dict[str, str] | None = None
) -> DataFrame:
    """Typed profiles from extracted texts; map-only.  ``countries`` replaces the country table."""
    codes = dim_map(countries or country_table(extracted.sparkSession))
    return convert_countries(normalize(profile_texts(extracted, packs), as_of), codes)


def build_profiles(pages: DataFrame, as_of: Column, packs: tuple[SourceRules, ...] = PACKS) -> DataFrame:
    """Typed profiles, one per (source, profile page)."""
    return typed_profiles(extract_pages(pages, packs), as_of, packs)


def merge_turn(source: Column, order: tuple[str, ...] = SOURCE_ORDER) -> Column:
    """A number that grows with the turn in which a source's records become seeds."""
    return -F.coalesce(F.array_position(F.array(*[F.lit(s) for s in order]), source), F.lit(0))


def merge_order(profiles: DataFrame, order: tuple[str, ...] = SOURCE_ORDER) -> DataFrame:
    """Adds ``rank`` 1..n, the order in which records become seeds: the source read last comes
    first, and within a source the address decides."""
    placed, _ = staged(profiles.withColumn("_turn", merge_turn(F.col("source"), order)), "turns")
    return number_rows(placed, "_turn", "source", "ico_url", name="rank").drop("_turn")


REJECT_COLUMNS = ("source", "url", "field", "raw", "reason")


def _reject(df: DataFrame, url: str, field: str, reason: str) -> DataFrame:
    """Rejected pages as rows of the rejects table."""
    text = lambda v: F.lit(v).cast("string")
    return df.select("source", F.col(url).alias("url"), text(field).alias("field"), text(None).alias("raw"), text(reason).alias("reason"))


def page_rejects(decoded: DataFrame, extracted: DataFrame, orphans: DataFrame) -> DataFrame:
    """What could not be used of the pages: ``source, url, field, raw, reason``."""
    labels = unmapped_labels(extracted, "source", "ico_url").select(
        "source", F.col("ico_url").alias("url"), F.col("label").alias("field"), F.col("value").alias("raw"), F.lit("label feeds no field").alias("reason")
    )
    return (
        _reject(decoded.where("html is null"), "url", "body", "body does not fit its charset")
        .unionByName(_reject(extracted.where("raw is null"), "ico_url", "page", "page not readable or source unknown"))
        .unionByName(_reject(orphans, "url", "page", "second page without its main page"))
        .unionByName(labels)
    )


def failed_rejects(failed_pages: DataFrame) -> DataFrame:
    """Pages of a source whose extraction failed as a whole."""
    text = lambda v: F.lit(v).cast("string")
    return failed_pages.select("source", "url", text("page").alias("field"), text(None).alias("raw"), "reason")


def value_rejects(texts: DataFrame, profiles: DataFrame) -> DataFrame:
    """Dates and scores that fit no form, and countries that have no code.

    ``texts`` and ``profiles`` are the same records, before and after typing; both have one row
    for each (source, ico_url).
    """
    raw = {f: tx.known_text(F.col(f"t.{f}")) for f in (*DATES, *SCORES, *COUNTRIES)}
    checks = {d: (raw[d], unparsed(raw[d], F.col(f"p.{d}")), "date fits no form") for d in DATES}
    checks |= {s: (raw[s], raw[s].isNotNull() & F.col(f"p.{s}").isNull(), "score fits no scale") for s in SCORES}
    codes = {c: F.col(f"p.{c}") for c in COUNTRIES}
    strange = lambda c: F.coalesce(~c.cast("string").rlike(CODE_LIST), F.lit(False))
    checks |= {c: (codes[c].cast("string"), strange(codes[c]), "country has no code") for c in COUNTRIES}
    both = texts.alias("t").join(profiles.alias("p"), ["source", "ico_url"])
    found = rejects(both.withColumn("_key", F.struct("source", "ico_url")), "_key", **checks)
    return found.select(F.col("_key.source").alias("source"), F.col("_key.ico_url").alias("url"), "field", "raw", "reason")


def record_rejects(ranked: DataFrame) -> DataFrame:
    """Records that take no part in the consolidation."""
    return _reject(ranked.where(~is_valid(FIELDS)), "ico_url", "record", "a required field is missing or too few are known")


@dataclass
class Community:
    """Crawled community pages: each frame has ``url`` and ``html``."""

    member_pages: DataFrame
    post_pages: DataFrame
    author_pages: DataFrame
    thread_pages: DataFrame


def add_members(profiles: DataFrame, pages: DataFrame) -> DataFrame:
    counts = pages.select("url", enrich.member_count(F.col("html")).alias("teleg_subs_count")).where("teleg_subs_count is not null")
    return enrich.attach(profiles, counts, "telegram_page", clear_unmatched=True)


def add_communities(profiles: DataFrame, post_pages: DataFrame, author_pages: DataFrame) -> DataFrame:
    """Post, comment and reputation figures of the communities the profiles link to.

    A community may go over many pages, each linking to the next one; all of them count
    for the page the profile names.
    """
    eligible = profiles.where(enrich.eligible_community(F.col("reddit_page"))).select(F.col("reddit_page").alias("url")).distinct()
    elements, texts = F.col("elements"), F.col("texts")
    read = shred(post_pages.select("url", "html")).select(
        "url", enrich.next_page(elements, texts).alias("next_url"), enrich.page_posts(elements, texts).alias("posts")
    )
    read, _ = staged(read, "post-pages")
    walk = follow_next(read, "url", "next_url", eligible)
    posts = read.join(walk.select("start", "url"), "url").select(F.col("start").alias("url"), F.explode("posts").alias("p"))
    # An author may have been read under several addresses: one figure counts.
    karma = (
        author_pages.select(
            F.regexp_extract("url", r"/user/([^/?#]+)", 1).alias("author"), enrich.reputation(F.col("html")).alias("karma")
        )
        .where("karma is not null")
        .groupBy("author")
        .agg(F.max("karma").alias("karma"))
    )
    figures = enrich.community_figures(posts.select("url", "p.comment_label", "p.author"), karma)
    return enrich.attach(profiles, figures, "reddit_page")


def add_threads(profiles: DataFrame, thread_pages: DataFrame) -> DataFrame:
    mean, n = enrich.page_activity(F.col("html"))
    pages = thread_pages.select(thread_base(F.col("url")).alias("thread"), mean.alias("page_mean"), n.alias("n_comments"))
    figures = enrich.thread_figures(pages.where("thread is not null"))
    keyed = profiles.withColumn("_thread", thread_base(F.col("btc_page")))
    return enrich.attach(keyed, figures, "_thread", url="thread").drop("_thread")


def full_run(
    pages: DataFrame,
    community: Community,
    as_of: Column,
    out_dir: str,
    run_ts: str,
    packs: tuple[SourceRules, ...] = PACKS,
    snapshots: str = "csv",
    latest: bool = False,
) -> dict[str, str]:
    """Crawled bytes in, snapshots and related tables out; returns the table paths.

    As in a run that writes early and again, a stage is written before the next one starts, and the tables
    are loaded as one version after each stage: a reader sees the tables of one stage.
    ``snapshots`` is the format of the stage snapshots, ``csv`` or ``parquet``.  ``latest`` says that
    ``pages`` have one row for each address already.
    """
    spark = pages.sparkSession
    with scratch_scope(spark):
        n_given = None
        if not latest:
            pages, n_given = latest_pages(pages, counted=True)
        community = Community(*(latest_pages(p) for p in vars(community).values()))
        html = decode_pages(pages) if "body" in pages.columns else pages
        # Divided by source, so that each source is extracted from its own files.
        html, n_pages = staged(html, "decoded", partition_by=("source",))
        found = extract_sources(html.where("html is not null"), packs)
        extracted, n_found = staged(found.profiles, "found")
        known = extracted.where("raw is not null")
        texts, _ = staged(profile_texts(known, packs), "texts")
        profiles, n_profiles = staged(typed_profiles(known, as_of, packs), "profiles")
        write_by_source(profiles, f"{out_dir}/by_source", run_ts)
        ranked, n_valid = staged(merge_order(profiles), "ranked", {"n_valid": F.count_if(is_valid(FIELDS))})
        refused = (
            page_rejects(html, extracted, found.orphans)
            .unionByName(failed_rejects(found.failed_pages))
            .unionByName(value_rejects(texts, profiles))
            .unionByName(record_rejects(ranked))
        )
        refused.write.parquet(f"{out_dir}/rejects/run_ts={run_ts}")
        spark.createDataFrame(found.outcomes, OUTCOME_SCHEMA).write.parquet(f"{out_dir}/outcomes/run_ts={run_ts}")
        merged, n_merged = staged(consolidate(ranked).select("entity", *FIELDS), "merged")
        numbered = number_rows(merged, "entity")

        def load(stage: str, df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
            """A stage is written, and the tables are loaded anew from it, before the next one starts."""
            df, _ = staged(df, stage)
            write_stage(df, out_dir, stage, run_ts, snapshots)
            return df, write_version(fan_out(df, F.lit(run_ts)), f"{out_dir}/tables", f"{run_ts} {stage}")

        with_members, _ = load("members", add_members(numbered, community.member_pages))
        with_posts, _ = load("posts", add_communities(with_members, community.post_pages, community.author_pages))
        _, paths = load("threads", add_threads(with_posts, community.thread_pages))
        drop_versions(spark, f"{out_dir}/tables")
        counts = {
            "pages_given": n_pages["n_rows"] if n_given is None else n_given,
            "pages": n_pages["n_rows"],
            "pages_extracted": n_found["n_rows"],
            "profiles": n_profiles["n_rows"],
            "profiles_valid": n_valid["n_valid"],
            "entities": n_merged["n_rows"],
        }
        rows = [(stage, int(n)) for stage, n in counts.items()]
        spark.createDataFrame(rows, "stage string, n_rows long").write.parquet(f"{out_dir}/counts/run_ts={run_ts}")
        return paths
