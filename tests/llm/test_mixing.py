import json
import random
from collections import defaultdict

from entityloom.llm import mixing, queries
from entityloom.llm.common import staged_rows, with_uid
from pyspark.sql import functions as F


def test_water_filling_caps_and_reshares():
    got = mixing.water_filling({"a": 100, "b": 1000, "c": 10}, {"a": 5, "b": 2, "c": 1}, 1665, 2)
    assert got == {"a": 200.0, "b": 1445.0, "c": 20.0}
    assert mixing.water_filling({"a": 0, "b": 4}, {"a": 5, "b": 1}, 6, 2) == {"a": 0.0, "b": 6.0}
    assert mixing.water_filling({}, {}, 0, 2) == {}


def test_flow_prefers_first_uses():
    stretches = mixing.route({'["a"]': 10, '["a", "b"]': 10, '["b"]': 4}, {"a": 16, "b": 10}, 2)
    by_source, by_use = defaultdict(int), defaultdict(int)
    for p, use, source, start, end in stretches:
        assert source in json.loads(p) and 0 <= start < end
        by_source[source] += end - start
        by_use[use] += end - start
    assert dict(by_source) == {"a": 16, "b": 10}
    assert dict(by_use) == {1: 24, 2: 2}


def test_flow_equals_exhaustive_minimum():
    rng = random.Random(2)
    for _ in range(40):
        sizes = [rng.randint(0, 3) for _ in range(3)]
        quotas = [rng.randint(0, 4) for _ in range(2)]
        arcs = [(0, 1 + i, sizes[i], c) for i in range(3) for c in (0, 1)]
        arcs += [(1, 4, 9, 0), (2, 4, 9, 0), (2, 5, 9, 0), (3, 5, 9, 0)]
        arcs += [(4, 6, quotas[0], 0), (5, 6, quotas[1], 0)]
        flow = mixing.min_cost_flow(7, arcs, 0, 6)
        best = (0, 0)
        for a in range(2 * sizes[0] + 1):
            for b0 in range(2 * sizes[1] + 1):
                for b1 in range(2 * sizes[1] + 1 - b0):
                    for c in range(2 * sizes[2] + 1):
                        if a + b0 <= quotas[0] and b1 + c <= quotas[1]:
                            cost = sum(max(0, x - s) for x, s in zip((a, b0 + b1, c), sizes, strict=True))
                            best = max(best, (a + b0 + b1 + c, -cost))
        assert (flow[-1] + flow[-2], -sum(f * a[3] for f, a in zip(flow, arcs, strict=True))) == best


def test_overlapping_sources(spark):
    rng = random.Random(9)
    names = [["a"], ["a", "b"], ["b", None], [None]]
    rows = [(i, rng.choice([0, 1, 5, 40, 300]), json.dumps(names[min(i % 9, 3)])) for i in range(900)]
    df = staged_rows(with_uid(spark.createDataFrame(rows, "doc_id long, size long, pattern string")), "t")
    quotas = {"a": 15_000, "b": 9_000, None: 50_000}
    first, again = (sorted(map(tuple, mixing.draw(df, quotas).drop("uid").collect()), key=str) for _ in range(2))
    assert first == again
    got = defaultdict(int)
    for _, size, pattern, draws in first:
        assert len(draws) <= 2 and set(draws) <= set(json.loads(pattern)) and (size or not draws)
        for s in draws:
            got[s] += size
    capacity = 2 * sum(r[1] for r in rows)
    assert sum(got.values()) <= min(capacity, sum(quotas.values()))
    for s, q in quotas.items():
        assert 0 <= q - got[s] <= 0.01 * q


def test_query_on_small_tables(spark, docs, tmp_path):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([0, 3, 20, 200, 900]), f"s{min(i % 7, 4)}", "en") for i in range(400)]
    rows += [(500, None, None, None), (501, "a b c", None, "x"), (3, rows[3][1], "s3", "en"), (None, "q", "s1", "en")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = [r.asDict() for r in queries.op4_mix_sources(spark, str(tmp_path)).collect()]
    assert len(out) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    source = {(r[0], len((r[1] or "").split())): r[2] for r in rows}
    for r in out:
        s = source[(r["doc_id"], r["size"])]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6 * sum(sizes.values())
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(3, 0.02 * target[s])
    assert sorted(map(str, out)) == sorted(str(r.asDict()) for r in queries.op4_mix_sources(spark, str(tmp_path)).collect())


def test_empty(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op4_mix_sources(spark, str(tmp_path)).collect() == []
    assert mixing.pattern_totals(spark.createDataFrame([], "pattern string, size long").withColumn("n", F.lit(1))) == {}


def test_gap_beside_a_very_long_document_is_filled(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(300, 500), '["a"]') for i in range(2000)] + [(9000 + i, 200_000, '["a"]') for i in range(30)]
    df = staged_rows(with_uid(spark.createDataFrame(rows, "doc_id long, size long, pattern string")), "t")
    quota = int(1.5 * sum(r[1] for r in rows))
    out = mixing.draw(df, {"a": quota}).collect()
    assert len(out) == len(rows) and all(len(r.draws) <= 2 for r in out)
    lacking = quota - sum(r["size"] * len(r.draws) for r in out)
    idle = [r["size"] for r in out if len(r.draws) < 2]
    assert 0 <= lacking < min(idle)
