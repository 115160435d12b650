import hashlib
import random

import numpy as np
from entityloom.llm import common, queries, repeats


def brute(rows):
    """Every 100-byte string in a dictionary, in order of doc_id and place."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            s = raw[i : i + 100]
            if s in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(s)
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def prose(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "é", "an", "ß", "re"]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def sample(seed=2):
    rng = random.Random(seed)
    rows = [(3 * i, prose(rng, rng.choice([0, 3, 40, 120]))) for i in range(60)]
    passages = [prose(rng, 30) for _ in range(3)]
    rows += [(3 * i + 1, prose(rng, 20) + rng.choice(passages) + prose(rng, rng.choice([0, 25]))) for i in range(60)]
    rows += [(1000 + i, rows[i % 25][1]) for i in range(80)]
    for i in range(30):
        text = list(rows[60 + i][1])
        text[rng.randrange(len(text))] = "X"
        rows.append((3 * i + 2, "".join(text)))
    rows += [(5000, None), (5001, ""), (5002, "Orre " * 400), (5003, "a" * 700), (5004, "x" + "a" * 150), (5005, "ab" * 60 + "c" + "ab" * 70)]
    rows += [(None, rows[70][1]), (5006, "y" * 99), (5007, "y" * 100), (5008, "y" * 101), (5009, "\x00\x01" * 80)]
    rng.shuffle(rows)
    return rows


def check(spark, docs, tmp_path, rows):
    docs(rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op3_suffix_dedup(spark, str(tmp_path)).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_equal_to_brute_force(spark, docs, tmp_path):
    check(spark, docs, tmp_path, sample())


def test_spread_anchors_and_shuffled_bitmaps(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_SEGMENTS", 3)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    check(spark, docs, tmp_path, sample(7))


def test_repeated_rows(spark, docs, tmp_path):
    rows = sample(5)[:120]
    rows += [(2, "twin " + prose(random.Random(1), 60))] * 2
    docs(rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_suffix_dedup(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sum(r.n_removed for r in got) == sum(r[2] for r in brute(rows))


def test_meeting_rows_in_any_batches():
    rng = random.Random(3)
    rows = sorted((rng.choice([5, 6, 7, 8, 9]), rng.choice([0, 1, 2]), d, 0, 0, 1, False) for d in range(14))
    rows += [(99, 0, 50, 0, 0, 1, True), (99, 0, 51, 0, 0, 1, True)]
    want = set()
    for h in {r[0] for r in rows[:-2]}:
        segs = {}
        for r in rows[:-2]:
            if r[0] == h:
                segs.setdefault(r[1], []).append(r[2])
        for docs in segs.values():
            want |= {(docs[0], True)} if len(segs) > 1 else set()
            want |= {(d, False) for d in docs[1:]}
    want |= {(50, False), (51, False)}
    schema = repeats._schema(repeats._SEGMENT)
    for size in (1, 2, 3, 5, 40):
        batches = [repeats._table(list(zip(*rows[i : i + size], strict=True)), schema) for i in range(0, len(rows), size)]
        got = [(r["doc_id"], r["open"]) for b in repeats._meet(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == sorted(want)


def test_merge_by_binary_search():
    rng = random.Random(4)
    words = [bytes([rng.randrange(97, 101) for _ in range(3)]) for _ in range(30)]
    blocks = [np.array(sorted({rng.choice(words) for _ in range(12)}), dtype="S3") for _ in range(4)]
    order = list(range(sum(map(len, blocks))))
    rng.shuffle(order)
    places, at = [], 0
    for b in blocks:
        places.append(np.array(order[at : at + len(b)]))
        at += len(b)
    best = {}
    for b, p in zip(blocks, places, strict=True):
        for w, x in zip(b, p, strict=True):
            best[w] = min(best.get(w, 999), x)
    losers = repeats.merge_sorted(blocks, [p.copy() for p in places])
    assert [x.tolist() for x in losers] == [[bool(p > best[w]) for w, p in zip(b, q, strict=True)] for b, q in zip(blocks, places, strict=True)]


def test_empty(docs):
    assert repeats.without_repeats(docs([])).collect() == []


def test_rows_without_doc_id_in_two_files_keep_their_own_texts(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    n, names = 200_000, [f"{x}.parquet" for x in "abcdefgh"]
    pq.write_table(pa.table({"x": [1]}), f"{tmp_path}/a.parquet")
    folder = spark.read.parquet(f"{tmp_path}/a.parquet").select("_metadata.file_path").first()[0].removesuffix("a.parquet")
    rows = spark.range(n).select(F.explode(F.array(*map(F.lit, names))).alias("name"), "id")
    met = rows.groupBy(F.hash(F.concat(F.lit(folder), "name"), "id")).agg(F.sort_array(F.collect_list(F.struct("name", "id"))).alias("x"))
    (one, a), (two, b) = met.filter("size(x) > 1").orderBy("x").first()["x"][:2]  # equal under 32 bits
    paths = [f"{tmp_path}/{x}" for x in (one, two)]
    rng = random.Random(8)
    passage, clean = ("".join(rng.choice("abcdefgh ") for _ in range(400)) for _ in range(2))
    texts = {(0, a): "left " + passage, (1, b): clean + " right", (0, (a + 1) % n): passage}
    for k, path in enumerate(paths):
        filler = lambda i: "".join(rng.choices("jklmnopq ", k=150)) if i % 1000 == 0 else ""
        column = [texts.get((k, i)) or filler(i) for i in range(n)]
        pq.write_table(pa.table({"doc_id": pa.array([None] * n, pa.int64()), "text": column}), path)
    out = repeats.without_repeats(spark.read.parquet(*paths), with_bytes=True).filter("n_bytes > 150").collect()
    removed = {bytes(r.kept).decode() if r.n_removed == 0 else "": r.n_removed for r in out}
    assert len(out) == 3 and removed[clean + " right"] == 0 and removed[""] in (400, 401)
    assert sum(r.n_removed > 0 for r in out) == 1


def test_blocks_get_different_keys(spark):
    from pyspark.sql import functions as F

    blocks = spark.createDataFrame([("f", 0, 3), ("f", 1, 4), ("g", 0, 5)], "file string, block long, count long")
    meeting = lambda file, block, salt: F.col("block") if salt < 2 else F.xxhash64(F.lit(salt), file, block)
    assert repeats._blocks(blocks, meeting) == (12, 2)
    assert repeats._blocks(blocks.limit(0)) == (0, 0)


def test_very_long_text_in_pieces(spark, docs):
    """A text of several pieces; copies of what lies across their ends are found, and nothing else."""
    rng = np.random.default_rng(2)
    text = rng.integers(97, 123, 2 * repeats.PIECE_BYTES + 300_000).astype(np.uint8).tobytes().decode()
    end = repeats.PIECE_BYTES
    rows = [(1, text)] + [(10 + k, text[end - 500 + k : end + 500 + k]) for k in (0, 450, 499, 550)]
    rows += [(30, "x" * 40 + text[2 * end - 1000 : 2 * end + 30] + "y" * 40), (40, text[end - 99 : end])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.without_repeats(docs(rows)).collect()}
    assert got[1] == (0, 0) and got[30] == (1030, 1) and got[40] == (0, 0)
    assert {got[10 + k] for k in (0, 450, 499, 550)} == {(1000, 1)}
