import hashlib
import random
import re

import numpy as np
import pytest
from entityloom.llm import common, exact_dedup, queries
from entityloom.llm.common import addressed


@pytest.mark.parametrize("n,bits", [(0, 44), (1, 44), (5, 3), (1000, 12), (1000, 44), (3000, 8)])
def test_golomb_round_trip(n, bits):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, 1 << bits, n))
    k, unary, rests = exact_dedup.golomb_encode(values, bits)
    assert np.array_equal(exact_dedup.golomb_decode(n, k, unary, rests), values)
    if n == 1000 and bits == 44:
        assert len(unary) + len(rests) < 0.62 * 8 * n


def test_third_and_later_are_not_sent():
    assert exact_dedup.at_most_twice(np.array([1, 1, 1, 1, 2, 3, 3, 3])).tolist() == [1, 1, 2, 3, 3]
    assert exact_dedup.at_most_twice(np.array([4])).tolist() == [4]


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for i, n in enumerate(norm):
        groups.setdefault(n, []).append(i)
    out = []
    for n, members in groups.items():
        first = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        sha = hashlib.sha256(n.encode()).hexdigest()
        out += [(rows[i][0], rows[first][0], len(members), i == first, sha) for i in members]
    return out


def key(r):
    return tuple(map(str, r))


def test_equal_to_brute_force(spark, docs, tmp_path):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdé") * rng.randrange(1, 5) for _ in range(rng.randrange(12))) for _ in range(300)]
    rows = list(enumerate(texts))
    rows += [(1000 + i, rng.choice([" ", "\n", "\t "]).join(texts[i].split(" "))) for i in range(0, 300, 3)]
    rows += [(2000 + i, "hot text") for i in range(500)] + [(5000, "hot  text"), (5001, "hot  text")]
    rows += [(3, None), (3, ""), (4000, " \x0b"), (None, "hot text"), (None, "only"), (7, "twin"), (7, "twin")]
    rows += [(6000, "x" * 200_000), (6001, "x" * 200_000)]
    docs(rows).repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op7_exact_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    small = rows[:40] + rows[-8:]
    unscanned = exact_dedup.duplicates(*addressed(docs(small)))  # no file scan: staged first
    got = [tuple(r)[2:] for r in unscanned.collect()]
    assert sorted(got, key=key) == sorted(brute(small), key=key)


def test_join_beyond_the_broadcast_bound(docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rows = [(i, f"t {i % 7}") for i in range(30)]
    got = [tuple(r)[2:] for r in exact_dedup.duplicates(*addressed(docs(rows))).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_empty(docs):
    assert exact_dedup.duplicates(*addressed(docs([]))).collect() == []
