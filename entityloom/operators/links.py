"""Listing operators: links, page numbers, page addresses, next-page chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.session import discard, staged

HREF_PATTERN = r'<a[^>]*\shref="([^"]*)"'


def hrefs(html: Column) -> Column:
    """All link targets of a page, in order, without building its elements."""
    return F.regexp_extract_all(html, F.lit(HREF_PATTERN), F.lit(1))


def distinct_links(links: DataFrame, *by: str) -> DataFrame:
    return links.dropDuplicates(list(by or ("source", "url")))


def capped(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` items under ``order``; -1 means all."""
    return df if n == -1 else df.orderBy(*order).limit(n)


def keep_known(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def union_sources(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def total_of(text: Column) -> Column:
    """``1 - 24 of 530`` -> 530."""
    return F.regexp_extract(text, r"of\s*([0-9]+)", 1).try_cast("int")


def largest_suffix(links: Column) -> Column:
    """Highest number after the last dot of any link, 0 where none has one."""
    numbers = F.transform(links, lambda u: F.regexp_extract(u, r"\.([0-9]+)$", 1).try_cast("int"))
    return F.coalesce(F.array_max(numbers), F.lit(0))


def numbers_exploded(df: DataFrame, name: str, start: int, last: str, step: int = 1, block: int = 4096) -> DataFrame:
    """One row for each of ``start, start + step .. last`` (a column of ``df``) in the new column ``name``.

    ``last`` may come from a page, and may be absurd: numbers are made in blocks, so that no row
    ever holds a list longer than a block, and the blocks of one row may go to many tasks.
    """
    span = block * step
    n_blocks = F.floor((F.col(last) - start) / span) + 1
    outer = F.when(F.col(last) >= start, F.sequence(F.lit(0).cast("bigint"), F.floor((n_blocks - 1) / block)))
    return (
        df.withColumn("_outer", F.explode(outer))
        .withColumn(
            "_block",
            F.explode(F.sequence(F.col("_outer") * block, F.least((F.col("_outer") + 1) * block, n_blocks) - 1)),
        )
        .withColumn(
            name,
            F.explode(
                F.sequence(
                    F.lit(start) + F.col("_block") * span,
                    F.least(F.lit(start) + (F.col("_block") + 1) * span - step, F.col(last).cast("bigint")),
                    F.lit(step).cast("bigint"),
                )
            ),
        )
        .drop("_outer", "_block")
    )


def pages_needed(items: Column, per_page: int) -> Column:
    return F.ceil(items / per_page).cast("int")


def _ranked(plain: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(url, chain, place)``: the first page of each node's chain, and the links from there.

    ``plain`` links ``(at, to)`` have one end each.  Every node points back, and in each round twice as far,
    until it points at the first page of its chain; a chain of n pages needs log2(n) rounds.  Cycles
    have no first page: when a round finishes none, all that is left is cycles, and
    each is cut before its smallest address.
    """
    heads = nodes.join(plain, nodes["url"] == plain["to"], "left_anti").select("url", F.col("url").alias("back"), F.lit(0).cast("bigint").alias("place"))
    done, _ = staged(heads, "ranked")
    active, seen = staged(plain.select(F.col("to").alias("url"), F.col("at").alias("back"), F.lit(1).cast("bigint").alias("place")), "active")
    finished = [done]
    while seen["n_rows"]:
        before = seen["n_rows"]
        # Those that point at a finished node become finished; the others jump over one that is not.
        far = lambda df: df.select(F.col("url").alias("_at"), F.col("back").alias("_back"), F.col("place").alias("_place"))
        jumped = lambda df: active.join(far(df), F.col("back") == F.col("_at")).select(
            "url", F.col("_back").alias("back"), (F.col("place") + F.col("_place")).alias("place")
        )
        ended, _ = staged(jumped(reduce(DataFrame.unionByName, finished)), "ranked")
        onward, seen = staged(jumped(active), "active")
        if seen["n_rows"] == before:
            finished.append(_cut_cycles(plain.join(onward, plain["to"] == onward["url"], "left_semi"), int(before)))
            break
        finished.append(ended)
        discard(active)
        active = onward
    return reduce(DataFrame.unionByName, finished).withColumnRenamed("back", "chain")


def _cut_cycles(plain: DataFrame, n: int) -> DataFrame:
    """``(url, back, place)`` of nodes on cycles: ``back`` is the smallest address, where the cycle begins."""
    least = plain.select(F.col("to").alias("url"), F.col("at").alias("back"), F.least("at", "to").alias("least"))
    least, _ = staged(least, "cycles")
    for _ in range(max(n - 1, 1).bit_length()):
        far = least.select(F.col("url").alias("_at"), F.col("back").alias("_back"), F.col("least").alias("_least"))
        wider = least.join(far, F.col("back") == F.col("_at")).select("url", F.col("_back").alias("back"), F.least("least", "_least").alias("least"))
        previous = least
        least, _ = staged(wider, "cycles")
        discard(previous)
    first = least.where("url = least").select("url")
    return _ranked(plain.join(first, plain["to"] == first["url"], "left_anti"), least.select("url")).withColumnRenamed("chain", "back")


def chains(pages: DataFrame, url: str, next_url: str) -> tuple[DataFrame, DataFrame]:
    """Pages as places in chains, and how chains lead on: ``(url, chain, place)`` and ``(chain, onto, n)``.

    A chain is named by its first page.  Where pages have several next pages, or are the next page of several,
    chains end and begin; the second frame says that the n pages of a chain lead on to another one.
    Both have at most a row for each page and link.
    """
    nodes, _ = staged(pages.select(F.col(url).alias("url")).distinct(), "nodes")
    # Links are distinct: a page that was crawled twice is one page.
    given = pages.select(F.col(url).alias("at"), F.col(next_url).alias("to")).where("to is not null and at <> to").distinct()
    known, _ = staged(given.join(nodes, given["to"] == nodes["url"], "left_semi"), "links")
    only = lambda by, other: known.groupBy(by).agg(F.min(other).alias(other), F.count(F.lit(1)).alias("n")).where("n = 1").select("at", "to")
    plain, _ = staged(only("at", "to").join(only("to", "at"), ["at", "to"], "left_semi"), "plain-links")
    places, _ = staged(_ranked(plain, nodes), "chains")
    # A link that is not within a chain leads from the last page of one to the first page of another or the same.
    inner = places.where("place > 0").select(F.col("url").alias("to"))
    entries = known.join(plain, ["at", "to"], "left_anti").unionByName(plain.join(inner, "to", "left_anti").select("at", "to"))
    tails = places.select(F.col("url").alias("at"), "chain", (F.col("place") + 1).alias("n"))
    onward, _ = staged(entries.join(tails, "at").select("chain", F.col("to").alias("onto"), "n"), "chain-links")
    return places, onward


def follow_next(pages: DataFrame, url: str, next_url: str, starts: DataFrame) -> DataFrame:
    """``(start, url, hop)`` for every page reached from the given start pages.

    Pages are ranked once in their chains (``chains``); a start then needs its own place, and the chains
    that its chain leads on to.  What is written has a row for each page, and for each start and chain it
    reaches, but not for each start and page: those pairs are only joined for whoever reads them.
    """
    places, onward = chains(pages, url, next_url)
    begin = starts.select(F.col(url).alias("url")).distinct().join(places, "url").select(F.col("url").alias("start"), "chain", "place")
    begin, _ = staged(begin, "starts")
    first = begin.join(onward, "chain").select("start", F.col("onto").alias("chain"), (F.col("n") - F.col("place")).alias("hop"))
    nearest = lambda df: df.groupBy("start", "chain").agg(F.min("hop").alias("hop"))
    sums = {"total": F.coalesce(F.sum("hop"), F.lit(0))}
    (reached, have), (jump, seen) = staged(nearest(first), "reached", sums), staged(onward, "chain-jump")
    # By doubling, until a round neither reaches a chain nor shortens a way.
    while have["n_rows"] and seen["n_rows"]:
        size = (have["n_rows"], have["total"])
        further = reached.join(jump, "chain").select("start", F.col("onto").alias("chain"), (F.col("hop") + F.col("n")).alias("hop"))
        wider, have = staged(nearest(reached.unionByName(further)), "reached", sums)
        discard(reached)
        reached = wider
        if (have["n_rows"], have["total"]) == size:
            break
        second = jump.select(F.col("chain").alias("onto"), F.col("onto").alias("last"), F.col("n").alias("m"))
        twice = jump.join(second, "onto").groupBy("chain", F.col("last").alias("onto")).agg(F.min(F.col("n") + F.col("m")).alias("n"))
        longer, seen = staged(twice, "chain-jump")
        discard(jump)
        jump = longer
    # Of its own chain a start has the pages behind it; if ways lead back, also those before it.
    own = begin.select("start", "chain", F.col("place").alias("low"), F.lit(None).cast("bigint").alias("high"), (-F.col("place")).alias("hop"))
    back = begin.select("start", "chain", F.col("place").alias("high"))
    others = reached.join(back, ["start", "chain"], "left").select("start", "chain", F.lit(0).cast("bigint").alias("low"), "high", "hop")
    inside = (F.col("place") >= F.col("low")) & (F.col("high").isNull() | (F.col("place") < F.col("high")))
    found = places.join(own.unionByName(others), "chain").where(inside)
    return found.select("start", "url", (F.col("hop") + F.col("place")).alias("hop"))
