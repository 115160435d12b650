import random

import numpy as np
import xxhash
from entityloom.llm import simhash
from entityloom.llm.common import addressed


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    ids = {}
    for i, x in enumerate(label):
        if rows[i][0] is not None:
            ids[x] = min(ids.get(x, rows[i][0]), rows[i][0])
    return [(rows[i][0], f"{fps[i]:016x}", ids.get(label[i])) for i in range(len(rows))]


def test_trie_walk_finds_all_components():
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(120)]
    near = [b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(6)]
    x = np.unique(np.array(base + near + [0, 1, 2**64 - 1], dtype=np.uint64))
    root = simhash.trie_links(x, None, 0)
    want = np.arange(len(x))
    while True:
        close = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
        fresh = np.array([want[c].min() for c in close])
        if np.array_equal(fresh, want):
            break
        want = fresh
    assert np.array_equal(root, want)


def test_majority_of_long_runs():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 2000).astype(np.uint64) * np.uint64(2)
    sizes = np.array([700, 0, 1, 255, 256, 788])
    got = simhash.majority_bits(hashes, sizes)
    start = 0
    for size, fp in zip(sizes, got, strict=True):
        part = [int(h) for h in hashes[start : start + size]]
        assert int(fp) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > len(part))
        start += size


def test_near_duplicates_equal_brute_force(docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(300)]
        rows.append((10 * i, " ".join(text)))
        if i % 3 == 0:
            text[150] = "other"
            rows.append((10 * i + 1, " ".join(text)))
        if i % 5 == 0:
            rows.append((10 * i - 1, " ".join(text).upper()))
    rows += [(7000, None), (7001, ""), (7002, " \n"), (None, "a b"), (7003, "a b"), (7003, "a b"), (7004, "é À x y")]
    rows.append((7005, "long " * 60_000))
    got = [tuple(r) for r in simhash.near_duplicates(*addressed(docs(rows))).select("doc_id", "fingerprint", "component_id").collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)


def test_empty_table(docs):
    assert simhash.near_duplicates(*addressed(docs([]))).collect() == []
