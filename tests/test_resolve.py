"""Clusters against plain models of both forms, with and without hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from entityloom.operators import resolve
from entityloom.operators.links import follow_next
from entityloom.sinks.tables import number_rows

KEYS = ("a", "b", "c")


def frame(spark, rows):
    return spark.createDataFrame(rows, "rank long, a string, b string, c string"), {k: F.col(k) for k in KEYS}


def norm(v):
    return v.strip().upper() if v and v.strip() else None


def greedy_model(rows, null_matches=False):
    left, out = sorted(rows), {}
    same = lambda s, r: any(x == y and (x is not None or null_matches) for x, y in zip(map(norm, s[1:]), map(norm, r[1:])))
    while left:
        seed, rest = left[0], []
        out[seed[0]] = seed[0]
        for r in left[1:]:
            if same(seed, r):
                out[r[0]] = seed[0]
            else:
                rest.append(r)
        left = rest
    return out


def transitive_model(rows):
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owner = {}
    for r in rows:
        for i, v in enumerate(map(norm, r[1:])):
            if v is None:
                continue
            if (i, v) in owner:
                a, b = root(owner[i, v]), root(r[0])
                parent[max(a, b)] = min(a, b)
            else:
                owner[i, v] = r[0]
    return {r[0]: root(r[0]) for r in rows}


def sample(seed, n, values):
    rnd = random.Random(seed)
    word = lambda: rnd.choice([None, f"V{rnd.randrange(values)}", f" v{rnd.randrange(values)} "])
    out = [(i, word(), word(), word()) for i in rnd.sample(range(10 * n), n)]
    return out + [(10 * n + i, *rnd.choice(out)[1:]) for i in range(n // 5)]


def result(df):
    rows = df.collect()
    out = {r["rank"]: r["entity"] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("seed, values", [(1, 400), (2, 90), (3, 30)])
def test_random(spark, seed, values):
    rows = sample(seed, 200, values)
    df, keys = frame(spark, rows)
    assert result(resolve.greedy_clusters(df, "rank", keys)) == greedy_model(rows)
    assert result(resolve.transitive_clusters(df, "rank", keys)) == transitive_model(rows)


def test_hot_key(spark, monkeypatch):
    """A third of all rows share one value: the broadcast way for hot keys gives the same."""
    monkeypatch.setattr(resolve, "MIN_HOT_ROWS", 25)
    rows = [(r[0], "hot" if i % 3 == 0 else r[1], r[2], r[3]) for i, r in enumerate(sample(5, 200, 150))]
    df, keys = frame(spark, rows)
    assert result(resolve.greedy_clusters(df, "rank", keys)) == greedy_model(rows)
    assert result(resolve.transitive_clusters(df, "rank", keys)) == transitive_model(rows)


def test_missing_matches_missing(spark):
    rows = sample(7, 40, 40)
    df, keys = frame(spark, rows)
    assert result(resolve.greedy_clusters(df, "rank", keys, null_matches=True)) == greedy_model(rows, True)


def test_chain(spark):
    rows = [(1, "x", None, None), (2, "x", "y", None), (3, None, "y", None)]
    df, keys = frame(spark, rows)
    assert result(resolve.greedy_clusters(df, "rank", keys)) == {1: 1, 2: 1, 3: 3}
    assert result(resolve.transitive_clusters(df, "rank", keys)) == {1: 1, 2: 1, 3: 1}
    long_chain = [(i, f"a{i // 2}", f"b{(i + 1) // 2}", None) for i in range(60)]
    df, keys = frame(spark, long_chain)
    assert set(result(resolve.transitive_clusters(df, "rank", keys)).values()) == {0}


def counted_stages(monkeypatch):
    """Labels of the tables that resolve stages from here on."""
    labels, plain = [], resolve.staged

    def counting(df, label, *more):
        labels.append(label)
        return plain(df, label, *more)

    monkeypatch.setattr(resolve, "staged", counting)
    return labels


def test_long_chain_in_few_rounds(spark, monkeypatch):
    """Each record waits for the one before: what is open after some rounds is walked by component."""
    labels = counted_stages(monkeypatch)
    rows = [(i, f"a{i // 2}", f"b{(i + 1) // 2}", None) for i in range(1000)]
    df, keys = frame(spark, rows)
    assert result(resolve.greedy_clusters(df, "rank", keys)) == greedy_model(rows)
    assert labels.count("blocks") + labels.count("large") < 12 and labels.count("walked") == 1


def test_large_components_go_on_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(resolve, "SMALL_COMPONENT", 30)
    monkeypatch.setattr(resolve, "FIRST_ROUNDS", 1)
    labels = counted_stages(monkeypatch)
    rows = [(i, f"a{i // 2}", f"b{(i + 1) // 2}", None) for i in range(24)]
    rows += [(100 + i, f"c{i // 2}", f"d{(i + 1) // 2}", None) for i in range(10)]
    rows += [(r[0] + 1000, *r[1:]) for r in sample(9, 60, 40)]
    df, keys = frame(spark, rows)
    assert result(resolve.greedy_clusters(df, "rank", keys)) == greedy_model(rows)
    assert labels.count("walked") > 1 and labels.count("blocks") > 2


def test_no_keys_and_no_rows(spark):
    df, keys = frame(spark, [(1, None, None, None), (2, " ", None, None)])
    assert result(resolve.greedy_clusters(df, "rank", keys)) == {1: 1, 2: 2}
    assert result(resolve.transitive_clusters(df, "rank", keys)) == {1: 1, 2: 2}
    assert result(resolve.greedy_clusters(df.where("rank < 0"), "rank", keys)) == {}


def test_links_and_seeds(spark):
    rows = [(1, "x", "p", None), (2, "X", "q", None), (3, "z", "q", None), (4, None, None, None)]
    df, keys = frame(spark, rows)
    links = {(r.key_name, r.key_value, r.head, r["rank"]) for r in resolve.block_links(df, "rank", keys).collect()}
    assert links == {("a", "X", 1, 2), ("b", "Q", 2, 3)}
    seeds = {r["rank"]: r.seed for r in resolve.matches_of(df, "rank", keys, F.col("rank").isin(2, 3)).collect()}
    assert seeds == {1: 2, 2: 2, 3: 2}


def test_number_rows(spark):
    df = spark.range(5000).selectExpr("cast((id * 7919) % 5000 as int) as x")
    assert all(r.token_id == r.x + 1 for r in number_rows(df, "x").collect())


def test_follow_next(spark):
    chain = [(f"p{i}", f"p{i + 1}" if i % 7 != 6 else None) for i in range(30)] + [("z1", "z2"), ("z2", "z1"), ("s", "gone")]
    pages = spark.createDataFrame(chain, "url string, next string")
    got = {(r.start, r.url, r.hop) for r in follow_next(pages, "url", "next", pages.where("url in ('p0', 'z1', 's')")).collect()}
    assert got == {("p0", f"p{i}", i) for i in range(7)} | {("z1", "z1", 0), ("z1", "z2", 1), ("s", "s", 0)}


def test_chain_crawled_twice_keeps_its_rows(spark, monkeypatch):
    from entityloom.operators import links

    sizes = []
    plain = links.staged

    def counting(df, label, *more):
        out, seen = plain(df, label, *more)
        sizes.append((label, seen["n_rows"]))
        return out, seen

    monkeypatch.setattr(links, "staged", counting)
    chain = [(f"p{i}", f"p{i + 1}") for i in range(9)] + [("p9", None)]
    pages = spark.createDataFrame(chain + chain, "url string, next_url string")
    got = follow_next(pages, "url", "next_url", pages.where("url = 'p0'")).collect()
    assert sorted((r.url, r.hop) for r in got) == [(f"p{i}", i) for i in range(10)]
    # Every table has at most a row for each page: in each round fewer pages are left to rank.
    assert max(n for _, n in sizes) == 10
    left = [n for label, n in sizes if label == "active"]
    assert left[0] == 9 and left == sorted(set(left), reverse=True) and left[-1] == 0


def test_chains_with_many_starts_stay_linear(spark, monkeypatch):
    from entityloom.operators import links

    sizes, plain = [], links.staged

    def counting(df, label, *more):
        out, seen = plain(df, label, *more)
        sizes.append(seen["n_rows"])
        return out, seen

    monkeypatch.setattr(links, "staged", counting)
    n = 200
    pages = spark.createDataFrame([(f"p{i:03}", f"p{i + 1:03}" if i + 1 < n else None) for i in range(n)], "url string, next string")
    got = follow_next(pages, "url", "next", pages.where("url in ('p000', 'p050', 'p120')"))
    want = {(f"p{s:03}", f"p{i:03}", i - s) for s in (0, 50, 120) for i in range(s, n)}
    assert {tuple(r) for r in got.collect()} == want
    assert max(sizes) <= n and len(sizes) < 30


@pytest.mark.parametrize("seed", range(4))
def test_follow_next_equals_a_walk(spark, seed):
    """Branches, merges, cycles, pages crawled twice with different links, links to unknown pages."""
    rnd = random.Random(seed)
    n = 40
    rows = [(f"p{i:02}", rnd.choice([f"p{i + 1:02}", f"p{i + 1:02}", f"p{rnd.randrange(n):02}", None, "gone", f"p{i:02}"])) for i in range(n)]
    rows += [(f"p{i:02}", f"p{rnd.randrange(n):02}") for i in rnd.sample(range(n), 5 * (seed % 2))]
    rows += [(f"c{i}", f"c{(i + 1) % 7}") for i in range(7)] + [("d1", "d0"), ("d0", "d1")]
    starts = {r[0] for r in rnd.sample(rows, 8)} | {"c3", "d1", "nowhere"}
    nexts = {}
    for at, to in rows:
        nexts.setdefault(at, set()).add(to)
    want = set()
    for start in starts & set(nexts):
        seen, front, hop = {}, {start}, 0
        while front:
            seen |= {u: hop for u in front}
            front = {t for u in front for t in nexts[u] if t in nexts and t not in seen}
            hop += 1
        want |= {(start, u, h) for u, h in seen.items()}
    pages = spark.createDataFrame(rows, "url string, next string")
    begin = spark.createDataFrame([(s,) for s in starts], "url string")
    assert {tuple(r) for r in follow_next(pages, "url", "next", begin).collect()} == want


def test_numbers_in_blocks(spark):
    from entityloom.operators.links import numbers_exploded

    df = spark.createDataFrame([(1, 45), (2, 4), (3, None), (4, 3), (5, 100)], "k int, last int")
    for block in (1, 2, 3, 4096):
        got = sorted((r.k, r.n) for r in numbers_exploded(df, "n", 4, "last", 7, block).collect())
        assert got == sorted((k, n) for k, last in ((1, 45), (2, 4), (5, 100)) for n in range(4, last + 1, 7))
    big = spark.createDataFrame([(1, 30_000_000)], "k int, last int")
    assert numbers_exploded(big, "n", 0, "last", 20).count() == 1_500_001


def test_large_joins_send_nothing_through_the_driver(spark):
    """Beyond a few rows facts meet their members by shuffle, however small their files are; the rows are the same."""
    members = spark.range(50).select("id", (F.col("id") % 7).alias("k"))
    facts = members.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first"))
    wanted = sorted((i % 7, i, i % 7) for i in range(50))
    for total in (None, 50, resolve.MIN_SHUFFLED_ROWS, resolve.MIN_HOT_ROWS):
        joined = resolve.join_facts(members, facts, ["k"], total)
        assert sorted(map(tuple, joined.select("k", "id", "first").collect())) == wanted
    plan = lambda total: resolve.join_facts(members, facts, ["k"], total)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan(resolve.MIN_SHUFFLED_ROWS)
    assert "SortMergeJoin" in plan(resolve.MIN_SHUFFLED_ROWS)
