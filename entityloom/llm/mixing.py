"""Mixing sources to target weights by a min-cost flow over membership patterns.

Documents are summed by the set of sources that they belong to.  A small network routes each
set's tokens to the quotas of its sources: the first use of a set costs nothing, each further
one costs more than the one before (convex costs), so documents repeat only where a quota
cannot be met otherwise.  Within a set, documents lie on a line in a seeded order; each stretch
of the flow takes the documents that lie wholly inside it.  What is lacking then is routed over the
idle documents that still fit, in the same order, and the largest of each size class close the
gap, again and again until no idle document fits.  Documents are taken whole.

The driver holds one row for each set of sources (and for each of its size classes), a number
that the configuration of the mix bounds, not the number of documents.

Defined results: documents of size 0 are never taken; a NULL source is a source of its own;
rows that repeat are taken as rows of their own, in an order that their values fix, so reruns
agree; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.llm.common import addressed, bitmaps_of, by_bitmap, place_of, sender_of, small_frame, staged_rows, with_uid

#: Stretches of the seeded order whose sums are accumulated first; a window then orders one of them.
BUCKET_BITS = 12


def water_filling(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess is shared anew."""
    out, free, left = dict.fromkeys(sizes, 0.0), list(sizes), float(total)
    while free:
        weight = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / weight > most * sizes[s]]
        if not over:
            out.update({s: left * weights[s] / weight for s in free})
            break
        out.update({s: float(most * sizes[s]) for s in over})
        left -= sum(most * sizes[s] for s in over)
        free = [s for s in free if s not in over]
    return out


@dataclass
class _Arc:
    to: int
    room: int
    cost: int
    back: int


def min_cost_flow(n_nodes: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """The flow on each arc (from, to, capacity, cost) of a maximal flow of least cost.

    Shortest augmenting paths; costs are not negative, so a queue over relaxed nodes suffices.
    """
    graph: list[list[_Arc]] = [[] for _ in range(n_nodes)]
    places = []
    for a, b, capacity, cost in arcs:
        places.append((a, len(graph[a])))
        graph[a].append(_Arc(b, capacity, cost, len(graph[b])))
        graph[b].append(_Arc(a, 0, -cost, len(graph[a]) - 1))
    while True:
        far: list[float] = [float("inf")] * n_nodes
        via: list[tuple[int, int] | None] = [None] * n_nodes
        far[source] = 0
        queue, waiting = deque([source]), {source}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for k, arc in enumerate(graph[a]):
                if arc.room and far[a] + arc.cost < far[arc.to]:
                    far[arc.to], via[arc.to] = far[a] + arc.cost, (a, k)
                    if arc.to not in waiting:
                        queue.append(arc.to)
                        waiting.add(arc.to)
        if via[sink] is None:
            break
        path, at = [], sink
        while at != source:
            a, k = via[at]
            path.append(graph[a][k])
            at = a
        amount = min(arc.room for arc in path)
        for arc in path:
            arc.room -= amount
            graph[arc.to][arc.back].room += amount
    return [arcs[i][2] - graph[a][k].room for i, (a, k) in enumerate(places)]


def route(
    patterns: dict[str, int], quotas: dict, repeats: int, idle: dict[tuple[str, int], int] | None = None
) -> list[tuple[str, int, object, int, int]]:
    """(pattern, use, source, start, end) stretches of each pattern's line; uses count from 1.

    ``idle`` has what is left of each use, where that is not the whole pattern.
    """
    names, sources = list(patterns), list(quotas)
    members = {p: json.loads(p) for p in names}
    first_source = 1 + len(names) * (repeats + 1)
    sink = first_source + len(sources)
    arcs, meaning = [], []
    for i, p in enumerate(names):
        entry = 1 + i * (repeats + 1)
        for use in range(1, repeats + 1):
            room = patterns[p] if idle is None else idle.get((p, use), 0)
            arcs.append((0, entry + use, room, use * (use - 1) // 2))
            meaning.append(None)
            for k, s in enumerate(sources):
                if s in members[p]:
                    arcs.append((entry + use, first_source + k, room, 0))
                    meaning.append((p, use, s))
    for k, s in enumerate(sources):
        arcs.append((first_source + k, sink, quotas[s], 0))
        meaning.append(None)
    flow = min_cost_flow(sink + 1, arcs, 0, sink)
    at: dict[tuple[str, int], int] = {}
    out = []
    for what, amount in zip(meaning, flow, strict=True):
        if what and amount:
            start = at.get(what[:2], 0)
            out.append((*what, start, start + amount))
            at[what[:2]] = start + amount
    return out


def _seeded(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size")).bitwiseAND(F.lit(2**63 - 1))


def on_a_line(rows: DataFrame, seed: int, line: tuple[str, ...] = ("pattern",)) -> DataFrame:
    """Adds ``at``: the tokens of the same ``line`` that lie before the row in the seeded order.

    The order is cut into buckets; their sums are accumulated in one short window for each
    pattern, and the rows of a bucket in another, so no pattern is ever sorted as a whole.
    """
    keyed = rows.withColumn("place", _seeded(seed)).withColumn("bucket", F.shiftright("place", 63 - BUCKET_BITS))
    sums = keyed.groupBy(*line, "bucket").agg(F.sum("size").alias("bucket_size"))
    up_to = Window.partitionBy(*line).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*line, "bucket", F.coalesce(F.sum("bucket_size").over(up_to), F.lit(0)).alias("base"))
    within = (
        Window.partitionBy(*line, "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        keyed.join(starts, [*line, "bucket"])
        .withColumn("at", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .drop("base", "bucket")
    )


def _fill(candidates: list, lacks: dict) -> set[tuple]:
    """Largest first, each candidate goes to the source of its pattern that lacks most, if it fits."""
    chosen = set()
    for row in sorted(candidates, key=lambda r: (-r["size"], r["pattern"], r["use"], r["place"])):
        best = max(json.loads(row["pattern"]), key=lambda s: lacks.get(s, 0))
        if lacks.get(best, 0) >= row["size"]:
            lacks[best] -= row["size"]
            chosen.add((row["pattern"], row["use"], row["uid"], best))
    return chosen


def draw(rows: DataFrame, quotas: dict, repeats: int = 2, seed: int = 7, totals: dict | None = None) -> DataFrame:
    """``rows`` with ``draws``, an array of the sources that the row is taken for.

    ``rows`` is staged and has uid, doc_id, size and pattern (a JSON list of source names).  No
    row is drawn more than ``repeats`` times.
    """
    spark = rows.sparkSession
    totals = totals if totals is not None else pattern_totals(rows)
    stretches = route(totals, {s: int(q) for s, q in quotas.items()}, repeats)
    per_pattern: dict[str, list] = {p: [] for p in totals}
    for p, use, source, start, end in stretches:
        per_pattern[p].append((use, source, start, end))
    table = small_frame(
        spark,
        list(per_pattern.items()),
        "pattern string, stretches array<struct<use: int, source: string, start: long, end: long>>",
    )
    inside = lambda x: (F.col("at") >= x["start"]) & (F.col("at") + F.col("size") <= x["end"])
    placed = staged_rows(
        on_a_line(rows, seed)
        .join(table, "pattern")
        .select(
            "uid",
            "doc_id",
            "size",
            "pattern",
            "place",
            F.when(
                F.col("size") > 0,
                F.transform(F.filter("stretches", inside), lambda x: F.struct(x["use"].alias("use"), x["source"].alias("source"))),
            ).otherwise(F.array().cast("array<struct<use: int, source: string>>")).alias("drawn"),
        ),
        "mix-draws",
    )
    lacks = {s: int(q) for s, q in quotas.items()}
    _take(lacks, placed.select("size", F.explode("drawn").alias("d")).select("size", "d.source"))
    uses = F.array(*[F.lit(u) for u in range(1, repeats + 1)])
    idle = placed.filter("size > 0").select(
        "uid", "doc_id", "size", "pattern", F.explode(F.array_except(uses, F.transform("drawn", lambda x: x["use"]))).alias("use")
    )
    more = _closed(idle, lacks, list(totals), repeats, seed).groupBy("uid").agg(F.collect_list("source").alias("more"))
    drawn = F.transform("drawn", lambda x: x["source"])
    return placed.join(more, "uid", "left").select(
        "uid", "doc_id", "size", "pattern", F.concat(drawn, F.coalesce("more", F.array().cast("array<string>"))).alias("draws")
    )


def _take(lacks: dict, drawn: DataFrame) -> None:
    """Takes the sums of ``drawn`` (size, source) off ``lacks``."""
    for r in drawn.groupBy("source").agg(F.sum("size").alias("n")).collect():
        lacks[r["source"]] -= r["n"]


def _fitting(idle: DataFrame, lacks: dict, patterns: list[str]) -> DataFrame:
    """The rows that one of their sources lacks room for."""
    most = [(p, max((lacks.get(s, 0) for s in json.loads(p)), default=0)) for p in patterns]
    limits = small_frame(idle.sparkSession, most, "pattern string, most long")
    return idle.join(limits, "pattern").filter("size <= most").select(*idle.columns)


def _closed(idle: DataFrame, lacks: dict, patterns: list[str], repeats: int, seed: int) -> DataFrame:
    """(uid, use, source) of the ``idle`` uses that are taken until none of them fits what is lacking.

    What fits only shrinks, so each round goes on from the rows of the one before.
    """
    spark = idle.sparkSession
    taken = small_frame(spark, [], "uid long, use int, source string")
    while True:
        idle = staged_rows(_fitting(idle, lacks, patterns), "mix-idle")
        sums = {(r["pattern"], r["use"]): int(r["n"]) for r in idle.groupBy("pattern", "use").agg(F.sum("size").alias("n")).collect()}
        if not sums:
            return taken
        stretches = route({p: 0 for p in sorted({p for p, _ in sums})}, {s: max(0, n) for s, n in lacks.items()}, repeats, sums)
        table = small_frame(spark, stretches, "pattern string, use int, source string, start long, end long")
        inside = (F.col("at") >= F.col("start")) & (F.col("at") + F.col("size") <= F.col("end"))
        placed = on_a_line(idle, seed, ("pattern", "use")).join(table, ["pattern", "use"]).filter(inside)
        placed = staged_rows(placed.select("uid", "use", "source", "size"), "mix-more")
        _take(lacks, placed)
        taken = taken.unionByName(placed.drop("size"))
        idle = idle.join(placed.select("uid", "use"), ["uid", "use"], "left_anti")
        candidates = (
            _fitting(idle, lacks, patterns).withColumn("place", _seeded(seed))
            .groupBy("pattern", "use", F.floor(F.log2("size")).alias("class"))
            .agg(F.min(F.struct("place", "uid", "size")).alias("x"))
            .select("pattern", "use", "x.*")
            .collect()
        )
        chosen = [(u, use, s) for _, use, u, s in sorted(_fill(candidates, lacks), key=str)]
        filled = small_frame(spark, chosen, taken.schema)
        taken = taken.unionByName(filled)
        idle = idle.join(filled.select("uid", "use"), ["uid", "use"], "left_anti")


def pattern_totals(rows: DataFrame) -> dict[str, int]:
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("n")).collect()
    return {r["pattern"]: int(r["n"]) for r in sorted(sums, key=lambda r: r["pattern"])}


def pattern_of(*sources: Column) -> Column:
    """The set of sources as sorted JSON text; NULL is a name like any other."""
    return F.to_json(F.sort_array(F.array_distinct(F.array(*sources))), {"ignoreNullFields": "false"})


def source_sizes(totals: dict[str, int]) -> dict:
    """Tokens of each source, by code point with NULL last; a document counts for each of its sources."""
    sizes: dict = {}
    for p, n in totals.items():
        for s in json.loads(p):
            sizes[s] = sizes.get(s, 0) + n
    return dict(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")))


def standard_targets(sizes: dict, share: float = 1.5, cycle: tuple[int, ...] = (5, 2, 1), most: float = 2.0) -> dict:
    """Weights repeat ``cycle`` in the order of ``sizes``; targets share ``share`` of all tokens."""
    weights = {s: cycle[i % len(cycle)] for i, s in enumerate(sizes)}
    return water_filling(sizes, weights, share * sum(sizes.values()), most)


def standard_mix(rows: DataFrame, repeats: int = 2) -> tuple[DataFrame, DataFrame]:
    """The draws of the standard targets, and (source, source_size, target)."""
    totals = pattern_totals(rows)
    sizes = source_sizes(totals)
    targets = standard_targets(sizes, most=float(repeats))
    quotas = {s: round(t) for s, t in targets.items()}
    facts = small_frame(
        rows.sparkSession, [(s, sizes[s], float(targets[s])) for s in sizes], "source string, source_size long, target double"
    )
    return draw(rows, quotas, repeats, totals=totals), facts


def mixed_documents(docs: DataFrame, size: Column, source: Column, repeats: int = 2) -> DataFrame:
    """The rows of ``docs`` that the standard mix takes, each as often as it is drawn."""
    placed, file, at = addressed(docs)
    rows = placed.select(
        "doc_id", sender_of(file, at).alias("sender"), place_of(at).alias("place"), size.alias("size"), pattern_of(source).alias("pattern")
    )
    staged = staged_rows(with_uid(rows), "mix-sizes")
    drawn, _ = standard_mix(staged.drop("sender", "place"), repeats)
    times = drawn.select("uid", F.size("draws").alias("times"))
    taken = staged_rows(staged.select("uid", "sender", "place").join(times, "uid"), "mix-taken")
    n, out = taken.count(), None
    for k in range(1, repeats + 1):
        bits = bitmaps_of(taken.filter(F.col("times") >= k))
        part = by_bitmap(placed, sender_of(file, at), place_of(at), bits, n, wanted=True).select(*docs.columns)
        out = part if out is None else out.unionByName(part)
    return out
