"""Community figures: members, posts, comments, reputation and forum activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.functions import text as tx
from entityloom.functions import urls
from entityloom.operators.extract import Move, Part, Sel, find_all, read_part
from entityloom.operators.links import numbers_exploded


def eligible_community(url: Column) -> Column:
    """A community link: known, not a user page, and below ``/r/``."""
    known = url.isNotNull() & ~F.contains(url, F.lit("/user/")) & F.contains(url, F.lit("/r/"))
    return F.coalesce(known, F.lit(False))


# Patterns of the community pages.
MEMBERS_PATTERN = r'tgme_page_extra">\s*([0-9][0-9\s]*?)\s*members'
KARMA_PATTERN = r"<span>([,0-9\s]+)Karma"
POST_KARMA_PATTERN = r'<span class="karma">(-?[,0-9\s]+)</span>'
COMMENT_KARMA_PATTERN = r'span class="karma comment-karma">(-?[,0-9\s]+)</span>'
ACTIVITY_PATTERN = r"Activity:\s*([0-9]+)"


def member_count(html: Column) -> Column:
    """``tgme_page_extra"> 12 345 members`` -> 12345."""
    found = F.regexp_extract(html, MEMBERS_PATTERN, 1)
    return tx.digits_only(found)


def comment_number(label: Column) -> Column:
    """First integer of a comment label, 0 where it has none."""
    return F.coalesce(tx.first_integer(label), F.lit(0).cast("bigint"))


def _counter(html: Column, pattern: str) -> Column:
    return F.replace(tx.strip(F.regexp_extract(html, pattern, 1)), F.lit(","), F.lit("")).try_cast("bigint")


def reputation(html: Column) -> Column:
    """User reputation on a profile page: one figure, or the sum of two on the older layout."""
    one = _counter(html, KARMA_PATTERN)
    posts = _counter(html, POST_KARMA_PATTERN)
    comments = _counter(html, COMMENT_KARMA_PATTERN)
    return F.coalesce(one, posts + comments)


def floor_mean(total: Column, n: Column) -> Column:
    """Mean rounded down, also below zero."""
    return F.when(n > 0, F.floor(total / n))


def page_posts(elements: Column, texts: Column) -> Column:
    """Posts on a shredded page: ``array<struct<comment_label,author>>``."""
    label = Part((Move("find", Sel("li", ("first",))), Move("find", Sel("a"))))
    author = Part((Move("find", Sel("p", ("tagline",))), Move("find", Sel("a"))))
    return F.transform(
        find_all(elements, texts, Sel("div", ("top-matter",))),
        lambda p: F.struct(
            read_part(elements, texts, p, label).alias("comment_label"), read_part(elements, texts, p, author).alias("author")
        ),
    )


def community_posts(shredded: DataFrame, url: str = "url") -> DataFrame:
    """Posts on shredded community pages: ``(url, comment_label, author)``, one row each."""
    rows = shredded.select(F.col(url).alias("url"), F.explode(page_posts(F.col("elements"), F.col("texts"))).alias("p"))
    return rows.select("url", "p.comment_label", "p.author")


def next_page(elements: Column, texts: Column) -> Column:
    """Link to the next page of a community, NULL on its last page."""
    button = find_all(elements, texts, Sel("a"), (Sel("span", ("next-button",)),))
    return F.try_element_at(F.get(button, F.lit(0))["attrs"], F.lit("href"))


def thread_offsets(shredded: DataFrame, url: str = "url", step: int = 20) -> DataFrame:
    """All page addresses of a forum thread, from the links on its first page."""
    elements, texts = F.col("elements"), F.col("texts")
    links = F.transform(find_all(elements, texts, Sel("a", ("navPages",), {"href": None})), lambda e: F.try_element_at(e["attrs"], F.lit("href")))
    number = lambda u: F.regexp_extract(u, r"topic=[0-9]+\.([0-9]+)", 1).try_cast("int")
    last = F.coalesce(F.array_max(F.transform(F.concat(links, F.array(F.col(url))), number)), F.lit(0))
    base = urls.thread_base(F.col(url))
    threads = shredded.select(F.col(url).alias("url"), base.alias("thread"), last.alias("last")).where(F.col("thread").isNotNull())
    pages = numbers_exploded(threads, "page_offset", 0, "last", step)
    return pages.select(
        "url", "thread", F.col("page_offset").cast("int").alias("page_offset"), F.concat_ws(".", "thread", F.col("page_offset").cast("string")).alias("page_url")
    )


def community_totals(posts: DataFrame) -> DataFrame:
    """Posts and comments per community."""
    return posts.groupBy("url").agg(
        F.count(F.lit(1)).alias("rdt_post_count"), F.sum(comment_number(F.col("comment_label"))).alias("rdt_comment_count")
    )


def community_authors(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("author").isNotNull()).select("url", "author").distinct()


#: Tasks that the rows of one author may be dealt over, before run-time skew handling.
_SALTS = 16


def mean_reputation(authors: DataFrame, karma: DataFrame) -> DataFrame:
    """Floor-mean reputation per community over its distinct authors with a non-zero figure."""
    # A bot or a deleted-user name writes nearly everywhere: its rows are dealt over several tasks.
    salt = F.pmod(F.xxhash64("url"), F.lit(_SALTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    figures = karma.where("karma <> 0").select("author", "karma", every.alias("salt"))
    rated = authors.withColumn("salt", salt).join(figures, ["author", "salt"])
    means = rated.groupBy("url").agg(F.sum("karma").alias("total"), F.count(F.lit(1)).alias("n"))
    return means.select("url", floor_mean(F.col("total"), F.col("n")).alias("rdt_usr_avg_karma"))


def community_figures(posts: DataFrame, karma: DataFrame) -> DataFrame:
    """All figures of communities that have at least one author with a reputation."""
    return community_totals(posts).join(mean_reputation(community_authors(posts), karma), "url")


def page_activity(text: Column) -> tuple[Column, Column]:
    """(floor-mean, number) of all ``Activity: n`` figures on a forum page; NULL, 0 if none."""
    figures = F.transform(F.regexp_extract_all(text, F.lit(ACTIVITY_PATTERN), F.lit(1)), lambda s: s.try_cast("bigint"))
    n = F.size(figures)
    total = F.aggregate(figures, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return floor_mean(total, n), n.cast("bigint")


def thread_figures(pages: DataFrame, thread: str = "thread") -> DataFrame:
    """Per thread: floor-mean of the page means and total comments; all-zero threads are out.

    ``pages`` has one row per page with ``page_mean`` and ``n_comments``.
    """
    known = pages.where(F.col("page_mean").isNotNull())
    sums = known.groupBy(thread).agg(
        F.sum("page_mean").alias("total"), F.count(F.lit(1)).alias("n_pages"), F.sum("n_comments").alias("btc_num_comments")
    )
    figures = sums.where("total <> 0")
    return figures.select(thread, floor_mean(F.col("total"), F.col("n_pages")).alias("btc_avg_activ"), "btc_num_comments")


def first_entities(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first ``n`` entities under ``order``; all of them without ``n``."""
    return df if n is None else df.orderBy(*order).limit(n)


def attach(profiles: DataFrame, figures: DataFrame, link: str, url: str = "url", clear_unmatched: bool = False) -> DataFrame:
    """Put figures on the profiles whose ``link`` they belong to; other profiles keep NULL.

    With ``clear_unmatched`` a profile without figures also loses its link.
    """
    names = [c for c in figures.columns if c != url]
    # One row for each link, so that a profile is never doubled: the largest of several.
    figures = figures.groupBy(url).agg(F.max(F.struct(*names)).alias("_f")).select(url, *[F.col(f"_f.{c}").alias(c) for c in names])
    right = figures.select(F.col(url).alias("_key"), F.lit(True).alias("_hit"), *names)
    # Profiles without a link would all meet in one task of a shuffle join: give each a
    # key of its own, which no link equals.
    rest = profiles.drop(*names)
    spread = F.concat(F.lit("\0"), F.xxhash64(*rest.columns).cast("string"))
    keyed = rest.withColumn("_key", F.coalesce(F.col(link).cast("string"), spread))
    out = keyed.join(right.withColumn("_key", F.col("_key").cast("string")), "_key", "left")
    kept = F.when(F.col("_hit"), F.col(link)) if clear_unmatched else F.col(link)
    return out.withColumn(link, kept).drop("_key", "_hit").select(*_ordered(profiles.columns, names))


def _ordered(columns: list[str], added: list[str]) -> list[str]:
    return columns + [c for c in added if c not in columns]
