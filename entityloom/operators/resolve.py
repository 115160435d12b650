"""Finding the records that denote the same entity.

Two records match when any of their keys (name, ticker, web site) agree ignoring case.
Records that share a key value form a *block*.  Nothing here lists the pairs of a block:
a block is represented by its lowest rank, so the work is rows x keys however large a
block gets, and every aggregation combines on the map side before it shuffles.

Where block facts must come back to the members, ``join_facts`` treats hot blocks apart:
only keys that hold more than a fixed share of all rows are broadcast, which bounds their
number, and the others are joined by shuffle.

The rounds write their state to the shared folder (``session.staged``), which cuts the
lineage and survives the loss of executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.functions.text import strip
from entityloom.session import discard, staged

# A key with more than 1/HOT_SHARE of all rows is hot; so there are fewer than HOT_SHARE of
# them, at some 100 bytes each.  Below MIN_HOT_ROWS rows no key is hot.
HOT_SHARE = 200_000
MIN_HOT_ROWS = 200_000
# Up to so many rows a join is left to Spark, which may broadcast a side; beyond that it is a shuffle join.
# Spark judges staged tables by the size of their files, a small part of what their rows take once they
# are sent, and the rounds send one after another: together that would grow with the input.
MIN_SHUFFLED_ROWS = 20_000

# Rounds of seeds before what is still open is divided into components for the first time, and the
# most (record, block) pairs of a component that one task solves in rank order.
FIRST_ROUNDS = 3
SMALL_COMPONENT = 100_000
# Nodes that a task joins locally before components are formed over all tasks.
LOCAL_EDGES = 200_000

Keys = dict[str, Column]


def _key_text(value: Column, null_matches: bool = False) -> Column:
    text = F.upper(strip(value.cast("string")))
    return F.coalesce(text, F.lit("")) if null_matches else F.nullif(text, F.lit(""))


def _block_name(tagged: Column) -> Column:
    return F.struct(F.xxhash64(tagged).alias("a"), F.xxhash64(F.lit(1), tagged).alias("b"))


def key_blocks(keys: Keys, null_matches: bool = False) -> Column:
    """The blocks of a record, ``array<struct<a:bigint,b:bigint>>``.

    A block is named by a 128-bit hash of key name and upper-cased value, so that wide
    values are not shuffled.  A missing value matches nothing, unless ``null_matches``
    asks for the literal rule under which missing equals missing.
    """

    def block(name: str, value: Column) -> Column:
        tagged = F.concat(F.lit(f"{name}="), _key_text(value, null_matches))
        return F.when(tagged.isNotNull(), _block_name(tagged))

    return F.filter(F.array(*[block(n, v) for n, v in keys.items()]), F.isnotnull)


def by_shuffle(df: DataFrame, total: int | None = None) -> DataFrame:
    """``df`` as a side of a join of ``total`` rows: neither side goes through the driver."""
    return df.hint("merge") if total is None or total >= MIN_SHUFFLED_ROWS else df


def join_facts(members: DataFrame, facts: DataFrame, on: list[str], total: int | None = None) -> DataFrame:
    """Inner join of members with one fact row per key; a hot key never meets in one task.

    ``facts`` carries ``n_rows``, an upper bound of its members.  With the ``total`` number
    of members known, keys above ``total / HOT_SHARE`` rows are broadcast (there are fewer
    than ``HOT_SHARE`` of them) and the members of all other keys go through a shuffle join.  Without it, or for inputs too small to have a hot key, the
    join is one with Spark's run-time skew handling.
    """
    facts_only = facts.drop("n_rows")
    if total is None or total < MIN_HOT_ROWS:
        return members.join(by_shuffle(facts_only, total), on)
    limit = max(MIN_HOT_ROWS, total // HOT_SHARE)
    hot = F.broadcast(facts.where(F.col("n_rows") > limit).drop("n_rows"))
    cold = by_shuffle(facts.where(F.col("n_rows") <= limit).drop("n_rows"), total)
    rest = members.join(hot.select(*on), on, "left_anti")
    return members.join(hot, on).unionByName(rest.join(cold, on))


def block_links(df: DataFrame, rank: str, keys: Keys) -> DataFrame:
    """Matches in linear form: every record of a block with the first record of that block.

    ``(key_name, key_value, head, rank)`` for blocks of two or more records; ``rank`` must
    be unique.  Two records match if and only if they share a (key_name, key_value).
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("key_name"), _key_text(v).alias("key_value")) for n, v in keys.items()])
    members = df.select(F.col(rank).alias("rank"), F.explode(pairs).alias("k")).select("rank", "k.key_name", "k.key_value")
    members = members.where(F.col("key_value").isNotNull())
    members, seen = staged(members.withColumn("block", _block_name(F.concat_ws("=", "key_name", "key_value"))), "members")
    heads = members.groupBy("block").agg(F.min("rank").alias("head"), F.count(F.lit(1)).alias("n_rows"))
    linked = join_facts(members, heads.where("n_rows > 1"), ["block"], int(seen["n_rows"]))
    return linked.where("rank <> head").select("key_name", "key_value", "head", "rank")


def matches_of(df: DataFrame, rank: str, keys: Keys, is_seed: Column) -> DataFrame:
    """For each record the first of the seed records that it matches: ``(rank, seed)``."""
    seed = F.when(is_seed, F.col(rank))
    members = df.select(F.col(rank).alias("rank"), seed.alias("seed"), F.explode(key_blocks(keys)).alias("block"))
    members, seen = staged(members, "members")
    facts = members.groupBy("block").agg(F.min("seed").alias("first"), F.count(F.lit(1)).alias("n_rows"))
    found = join_facts(members.select("rank", "block"), facts.where("first is not null"), ["block"], int(seen["n_rows"]))
    return found.groupBy("rank").agg(F.min("first").alias("seed"))


class _Nodes:
    """Records staged by rank, with exact copies (same value in every key) made one node.

    The node takes the rank of its first record.  A copy matches just what that record
    matches, and that record itself, so both cluster forms may run over nodes.
    """

    def __init__(self, df: DataFrame, rank: str, keys: Keys, null_matches: bool) -> None:
        wanted = df.select(F.col(rank).alias("rank"), key_blocks(keys, null_matches).alias("blocks"))
        self.records, seen = staged(wanted, "records")
        self.n_records = int(seen["n_rows"])
        keyed = self.records.where(F.size("blocks") > 0)
        nodes = keyed.groupBy("blocks").agg(F.min("rank").alias("node"), F.count(F.lit(1)).alias("n_rows"))
        self.nodes, seen = staged(nodes, "nodes", {"n_members": F.coalesce(F.sum(F.size("blocks")), F.lit(0))})
        self.n_members = int(seen["n_members"])

    def members(self, nodes: DataFrame | None = None) -> DataFrame:
        source = self.nodes if nodes is None else nodes
        return source.select("node", F.size("blocks").alias("n_blocks"), F.explode("blocks").alias("block"))

    def spread(self, entity_of: DataFrame) -> DataFrame:
        """``(rank, entity)`` for every record, given ``(node, entity)`` for every node."""
        facts = self.nodes.join(by_shuffle(entity_of, self.n_records), "node").select("blocks", "entity", "n_rows")
        keyed = join_facts(self.records, facts, ["blocks"], self.n_records).select("rank", "entity")
        alone = self.records.where(F.size("blocks") == 0).select("rank", F.col("rank").alias("entity"))
        return keyed.unionByName(alone)


def greedy_clusters(df: DataFrame, rank: str, keys: Keys, null_matches: bool = False) -> DataFrame:
    """``(rank, entity)`` where the entity is named by the rank of its seed.

    Same result as: take the remaining record of lowest rank as a seed, give it all
    remaining records that match it directly, repeat.  The seeds are the first maximal
    independent set in rank order, found in rounds (Blelloch, Fineman and Shun 2012):
    a record that is first in all its blocks is a seed, and what shares a block with a
    seed is decided.  Every other record then goes to the first seed among its blocks.

    A chain of records that each wait for the one before would need a round for each of them.  So after
    a few rounds what is open is divided into components, which do not touch each other, and each small one
    is walked in rank order by one task; only components beyond that size go on in rounds.
    """
    store = _Nodes(df, rank, keys, null_matches)
    open_nodes, n_members = store.nodes.drop("n_rows"), store.n_members
    sizes: DataFrame | None = None
    taken: list[DataFrame] = []
    rounds, divide_at = 0, FIRST_ROUNDS
    while n_members > 0:
        if rounds == divide_at:
            previous = open_nodes
            seeds, open_nodes, n_members = _walked_components(open_nodes, n_members)
            discard(previous)
            taken.append(seeds)
            divide_at *= 2
            continue
        members = store.members(open_nodes)
        heads = members.groupBy("block").agg(F.min(F.struct("node", "n_blocks")).alias("head"), F.count(F.lit(1)).alias("n_rows"))
        # A node heads at most its own few blocks, so these windows are tiny.
        headed = F.count(F.lit(1)).over(Window.partitionBy("seed"))
        named = heads.select("block", "n_rows", F.col("head.node").alias("seed"), F.col("head.n_blocks").alias("n_blocks"))
        facts = named.select("block", "n_rows", "seed", (headed == F.col("n_blocks")).alias("is_taken"))
        facts, _ = staged(facts, "blocks")
        sizes = sizes if sizes is not None else facts.select("block", "n_rows")
        taken.append(facts.where("is_taken").select("block", "seed"))
        met = join_facts(members.select("node", "block"), facts.select("block", "n_rows", "is_taken"), ["block"], n_members)
        rest = met.groupBy("node").agg(F.bool_or("is_taken").alias("done"), F.collect_list("block").alias("blocks"))
        rest = rest.where(~F.col("done")).select("node", "blocks")
        previous = open_nodes
        open_nodes, seen = staged(rest, "open", {"n_members": F.coalesce(F.sum(F.size("blocks")), F.lit(0))})
        discard(previous)
        n_members = int(seen["n_members"])
        rounds += 1
    if not taken:
        return store.records.select("rank", F.col("rank").alias("entity"))
    seeds = reduce(DataFrame.unionByName, taken).join(by_shuffle(sizes, store.n_members), "block")
    near = join_facts(store.members().select("node", "block"), seeds, ["block"], store.n_members)
    # A seed is its own first seed: a lower one in its blocks would have taken it.
    return store.spread(near.groupBy("node").agg(F.min("seed").alias("entity")))


def _walked_components(nodes: DataFrame, n_members: int) -> tuple[DataFrame, DataFrame, int]:
    """Seeds ``(block, seed)`` of the small components of open nodes, and the nodes of the others."""
    members = nodes.select("node", F.explode("blocks").alias("block"))
    root_of = component_roots(members, n_members)
    rooted = nodes.join(by_shuffle(root_of, n_members), "node", "left").select("node", "blocks", F.coalesce("root", "node").alias("root"))
    rooted, seen = staged(rooted, "rooted")
    sizes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("blocks")).alias("n_members"))
    sized = join_facts(rooted, sizes, ["root"], int(seen["n_rows"]))
    kind = dict(nodes.dtypes)
    small = sized.where(F.col("n_members") <= SMALL_COMPONENT).select("root", "node", "blocks")
    key, block = kind["node"], kind["blocks"].removeprefix("array<").removesuffix(">")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, held = None, set()
        for batch in batches:
            blocks, seeds = [], []
            for at, node, own in zip(*(batch.column(c).to_pylist() for c in ("root", "node", "blocks")), strict=True):
                if at != root:
                    root, held = at, set()
                names = [(b["a"], b["b"]) for b in own]
                if held.isdisjoint(names):
                    held.update(names)
                    blocks += own
                    seeds += [node] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, batch.column("blocks").type.value_type), pa.array(seeds, batch.column("node").type)], ["block", "seed"]
            )

    in_order = small.repartition("root").sortWithinPartitions("root", "node")
    seeds, _ = staged(in_order.mapInArrow(walk, f"block {block}, seed {key}"), "walked")
    large = sized.where(F.col("n_members") > SMALL_COMPONENT).select("node", "blocks")
    large, seen = staged(large, "open", {"n_members": F.coalesce(F.sum(F.size("blocks")), F.lit(0))})
    return seeds, large, int(seen["n_members"])


def transitive_clusters(df: DataFrame, rank: str, keys: Keys, null_matches: bool = False) -> DataFrame:
    """``(rank, entity)`` for the transitive closure of matching, named by its lowest rank.

    Connected components by alternating large-star and small-star steps (Kiveris et al.
    2014) over a graph that links each record to the heads of its blocks.
    """
    store = _Nodes(df, rank, keys, null_matches)
    roots = component_roots(store.members().select("node", "block"), store.n_members)
    every = store.nodes.select("node").join(by_shuffle(roots, store.n_members), "node", "left").select("node", F.coalesce("root", "node").alias("entity"))
    return store.spread(every)


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges ``(up, low)`` that connect the same nodes, each run of neighbours made a star.

    Neighbouring ranks are often linked (records of one crawl, chains): a task joins the ends of up to
    ``LOCAL_EDGES`` edges of a range at a time, which saves rounds and never adds an edge.
    """
    key = dict(edges.dtypes)["up"]

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        def out(kind: pa.DataType) -> pa.RecordBatch:
            pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], kind) for i in (0, 1)], ["up", "low"])

        for batch in batches:
            kind = batch.column("up").type
            for up, low in zip(batch.column("up").to_pylist(), batch.column("low").to_pylist(), strict=True):
                parent.setdefault(up, up)
                parent.setdefault(low, low)
                a, b = root(up), root(low)
                parent[max(a, b)] = min(a, b)
            if len(parent) > LOCAL_EDGES:
                yield out(kind)
        if parent:
            yield out(kind)

    return edges.repartitionByRange("low").mapInArrow(stars, f"up {key}, low {key}").distinct()


def component_roots(members: DataFrame, n_members: int) -> DataFrame:
    """``(node, root)``: the lowest node that each node of ``(node, block)`` is connected with by blocks.

    Nodes that share no block with another one are left out.
    """
    heads = members.groupBy("block").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n_rows"))
    linked = join_facts(members, heads, ["block"], n_members)
    start = linked.where("node <> head").select(F.col("node").alias("up"), F.col("head").alias("low")).distinct()
    edges, seen = staged(_contracted(start), "edges")
    n_edges = int(seen["n_rows"])
    while n_edges:
        both = edges.unionByName(edges.select(F.col("low").alias("up"), F.col("up").alias("low")))
        lower = F.col("low") < F.col("up")
        facts = both.groupBy("up").agg(
            F.least(F.min("low"), F.col("up")).alias("lead"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(lower).alias("n_lower"),
        )
        # Finished when every vertex is either a root or has one neighbour, its root.
        loose = (F.col("n_lower") > 1) | ((F.col("n_lower") == 1) & (F.col("n_rows") > 1))
        facts, seen = staged(facts, "large", {"n_loose": F.count_if(loose)})
        if not seen["n_loose"]:
            break
        large = join_facts(both, facts.drop("n_lower"), ["up"], 2 * n_edges).where("low > up and low <> lead")
        large, seen = staged(large.select(F.col("low").alias("up"), F.col("lead").alias("low")).distinct(), "edges")
        n_large = int(seen["n_rows"])
        facts = large.groupBy("up").agg(F.min("low").alias("lead"), F.count(F.lit(1)).alias("n_rows"))
        moved = join_facts(large, facts, ["up"], n_large).where("low <> lead").select(F.col("low").alias("up"), F.col("lead").alias("low"))
        kept = facts.select("up", F.col("lead").alias("low"))
        previous = edges
        edges, seen = staged(moved.unionByName(kept).distinct(), "edges")
        discard(previous, large)
        n_edges = int(seen["n_rows"])
    return edges.select(F.col("up").alias("node"), F.col("low").alias("root"))
