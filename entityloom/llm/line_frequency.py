"""Quality rules from the frequency of lines across the documents of a host.

Normalised lines are hashed; for each host and hash the documents that hold the line are
counted.  A line in more than ``max_docs`` documents of its host is removed, however large the host
is; a document of which too little is left is rejected.  DataFrame functions only: no Python runs
on executors.  (A caller may ask for ``max_share`` of the host's documents besides; the bar then grows with
the host, and boilerplate of large hosts stays.)

Defined results: a NULL text has no words; a NULL source is a host of its own; each row is a
document of its own, also when rows or doc_ids repeat; an empty table gives an empty result;
columns beside doc_id, text and source are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import BLANK, WORD, addressed, columns_named, staged_rows, with_uid, words_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """Lines above the first limit (and the second, if given) go; documents below either of the last two are rejected."""

    max_docs: int = 10
    max_share: float = 0.0
    min_left_words: int = 10
    min_left_share: float = 0.5


def _window_hashes(words: Column) -> Column:
    at = [lambda i, k=k: F.get(words, i + k) for k in range(WINDOW)]
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.xxhash64(*[get(i) for get in at]))


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more: repeated starts, each adding what it covers anew."""
    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(sorted_rows: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(sorted_rows, k)["h"] == x["h"], F.lit(False))
        kept = F.filter(
            sorted_rows,
            lambda x, k: same(x, k + 1) | F.when(k > 0, same(x, k - 1)).otherwise(False),
        )
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))),
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    one = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    return one(order, lambda o: one(repeated(o), covered))


def base_counts(docs: DataFrame) -> DataFrame:
    """Counts of each document, and its lines as hashes with their words; one narrow row each."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.col("source").alias("host"), text.alias("text")).select(
        "doc_id", "host", "text", words_of(F.col("text")).alias("words")
    )
    # The windows are hashed in a projection of their own, so that nothing is computed twice.
    counted = split.select(
        "doc_id",
        "host",
        "text",
        F.size("words").cast("long").alias("n_words"),
        _window_hashes(F.col("words")).alias("hashes"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    plain = lambda x: F.trim(F.regexp_replace(F.lower(x), BLANK, " "))
    return counted.select(
        "doc_id",
        "host",
        "n_words",
        F.length(F.regexp_replace("text", BLANK, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("hashes") == F.size(F.array_distinct("hashes")), F.lit(0).cast("long"))
        .otherwise(_repeat_words(F.col("hashes")))
        .alias("n_repeat_words"),
        F.transform(
            "lines",
            lambda x: F.struct(
                F.xxhash64(plain(x)).alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n")
            ),
        ).alias("lines"),
    )


def frequent_lines(counts: DataFrame, limits: Limits) -> DataFrame:
    """(host, line) of the lines above the limits; counted with partial sums before the shuffle."""
    seen = (
        counts.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") > limits.max_docs)
    )
    if not limits.max_share:
        return seen.select("host", "line")
    sizes = counts.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    return (
        seen.alias("s")
        .join(sizes.alias("h"), F.col("s.host").eqNullSafe(F.col("h.host")))
        .filter(F.col("n_docs") > limits.max_share * F.col("host_docs"))
        .select("s.host", "s.line")
    )


def line_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row for each document: the counts, ``base_failed``, ``kept`` and what is left of it."""
    counts = staged_rows(with_uid(base_counts(docs)), "line-counts")
    frequent = staged_rows(frequent_lines(counts, limits), "frequent-lines")
    lines = counts.select("uid", "host", F.explode("lines").alias("x")).select("uid", "host", "x.line", "x.n")
    removed = (
        lines.alias("l")
        .join(
            frequent.alias("f"),
            F.col("l.host").eqNullSafe(F.col("f.host")) & (F.col("l.line") == F.col("f.line")),
        )
        .groupBy("uid")
        .agg(F.sum("n").cast("long").alias("n_removed_words"))
    )
    left = F.col("n_words") - F.col("n_removed_words")
    judged = counts.drop("lines").join(removed, "uid", "left").fillna(0, ["n_removed_words"])
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        "n_removed_words",
        (left < limits.min_left_words).alias("too_short"),
        (left < limits.min_left_share * F.col("n_words")).alias("depleted"),
    ).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.col("too_short") & ~F.col("depleted")).alias("kept"),
        "n_removed_words",
    )


def without_frequent_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the lines above the limits taken out of ``text``; other columns as they are.

    Lines meet as hashes; what comes back to a document is the list of its own frequent lines.
    """
    rows, file, at = addressed(docs)
    own = columns_named(rows, "line_", "gone", "file", "at")
    plain = lambda x: F.xxhash64(F.trim(F.regexp_replace(F.lower(x), BLANK, " ")))
    held = F.array_distinct(F.transform(F.split("text", "\n"), plain))
    lines = rows.select(F.col(file).alias("f"), F.col(at).alias("a"), F.col("source").alias("host"), F.explode(held).alias("line"))
    frequent = staged_rows(frequent_lines(base_counts(docs), limits), "frequent-lines")
    gone = (
        lines.alias("l")
        .join(frequent.alias("q"), F.col("l.host").eqNullSafe(F.col("q.host")) & (F.col("l.line") == F.col("q.line")))
        .groupBy(F.col("f").alias(own["file"]), F.col("a").alias(own["at"]))
        .agg(F.collect_set("l.line").alias(own["gone"]))
    )
    joined = rows.join(gone, (F.col(file) == F.col(own["file"])) & (F.col(at) == F.col(own["at"])), "left")
    kept = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col(own["gone"]), plain(x)))
    text = F.when(F.col(own["gone"]).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)


def sql(limits: Limits = Limits()) -> str:
    """The same result in DuckDB, with the lines and windows themselves in place of their hashes."""
    return rf"""
with d as (
  select row_number() over () as uid, doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), win as (
  select uid, i, array_to_string(words[i:i + 4], ' ') as w
  from (select uid, words, unnest(range(1, len(words) - 3)) as i from d)
), rep as (
  select uid, count(distinct p) as n
  from (select uid, unnest(range(i, i + 5)) as p
        from (select uid, i, count(*) over (partition by uid, w) as c from win) where c >= 2)
  group by uid
), l as (
  select uid, source, line,
         trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) as plain,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n
  from (select uid, source, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]')
), dup as (
  select uid, count(*) - count(distinct line) as n from l group by uid
), host as (
  select source, count(*) as host_docs from d group by source
), freq as (
  select f.source, f.plain
  from (select source, plain, count(distinct uid) as n_docs from l group by source, plain) f
  join host h on f.source is not distinct from h.source
  where n_docs > {limits.max_docs} and n_docs > {limits.max_share} * host_docs
), removed as (
  select l.uid, sum(l.n) as n
  from l join freq f on l.source is not distinct from f.source and l.plain = f.plain
  group by l.uid
), counts as (
  select d.doc_id, len(words)::bigint as n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(dup.n, 0)::bigint as n_dup_lines,
         coalesce(rep.n, 0)::bigint as n_repeat_words,
         coalesce(removed.n, 0)::bigint as n_removed_words
  from d left join rep using (uid) left join dup using (uid) left join removed using (uid)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words)
         and n_words - n_removed_words >= {limits.min_left_words}
         and n_words - n_removed_words >= {limits.min_left_share} * n_words as kept,
       n_removed_words
from counts
"""
