import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from entityloom.llm import dac, packing, queries, tokens
from tokenizers import Tokenizer

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a\nb", "a \nb", "a\n b", "a\n\nb", "a\tb", "x\x1cy", "x y", "　x", "it's we'll",
    "<|endoftext|> x", "a <|startoftext|>b", "É́ é z", "␞ a", "1234 5,6", "Ω ΣΑΣ Σ", "😀 a😀\nb", "…\nA\nB c", "﻿a b", "ﬁ ǅ İ",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_the_library_on_whole_texts(path):
    rng = random.Random(3)
    words = ["the", "The", "naïve", "it's", "x1", "été,", "###", "don't", "␟", "a.b", "ß"]
    texts = ODD + ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  "]) for _ in range(60)) for _ in range(200)]
    texts += [" ".join(rng.choice(words) + str(rng.randrange(999)) for _ in range(40)) for _ in range(200)]
    whole = Tokenizer.from_file(path)
    for row, ids in tokens.encoded(pa.array([*texts, None]), path):
        want = whole.encode([*texts, ""][row], add_special_tokens=False).ids
        assert ids.tolist() == want, texts[row]


def test_levels_round_trip_and_random_access(tmp_path):
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, m, 900) for m in (3, 256, 257, 60_000, 2**24, 2**32 - 1)]).astype(np.uint32)
    rng.shuffle(ids)
    path = f"{tmp_path}/a.dac"
    with open(path, "wb") as out:
        out.write(dac.file_bytes([5, None, 7], [400, 0, len(ids) - 400], ids))
    file = dac.DacFile(path)
    assert np.array_equal(file.all_ids(), ids)
    assert [file.token(i) for i in range(0, len(ids), 7)] == ids[::7].tolist()
    assert file.document(0) == ids[:400].tolist() and file.document(1) == []
    docs, starts = file.directory()
    assert docs == [5, None, 7] and starts.tolist() == [0, 400, 400, len(ids)]
    with pytest.raises(IndexError):
        file.token(len(ids))


def test_word_memory_forgets_and_stays_right(monkeypatch):
    rng, asked = random.Random(6), []

    def encode(words):
        asked.extend(words)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.uint32)
        return flat, np.array([len(w) for w in words], np.int64)

    doubled = lambda words: tuple(np.repeat(x, 2) if i == 0 else 2 * x for i, x in enumerate(encode(words)))
    memory = tokens.WordMemory([encode, doubled], 40)
    words = [bytes(rng.randrange(97, 100) for _ in range(rng.randrange(5))) for _ in range(200)]
    for turn in range(60):
        if turn == 30:  # all words share one of two hashes
            monkeypatch.setattr(tokens.xxhash, "xxh64_intdigest", lambda w: len(w) % 2)
            memory = tokens.WordMemory([encode, doubled], 40)
        some = sorted(set(rng.sample(words, 25)))
        (flat, start, length), (flat2, start2, length2) = memory.look_up(some)
        for w, a, n, b, m in zip(some, start, length, start2, length2, strict=True):
            assert flat[a : a + n].tolist() == list(w)
            assert flat2[b : b + m].tolist() == [c for c in w for _ in range(2)]
    assert memory.look_up([])[0][1].tolist() == []
    assert len(asked) < 2 * 60 * 25


def test_names_of_object_stores():
    assert dac.arrow_uri("s3a://bucket/x y") == "s3://bucket/x y"
    assert [dac.arrow_uri(u) for u in ("file:///tmp/a", "hdfs://n/x", "/tmp/s3a://x")] == ["file:///tmp/a", "hdfs://n/x", "/tmp/s3a://x"]


def some_docs(docs):
    rng = random.Random(8)
    rows = [(1000 - i, " ".join(rng.choice(["alpha", "beta", "Γ", "x"]) for _ in range(rng.choice([0, 1, 7, 300])))) for i in range(150)]
    rows += [(7000, None), (7001, ""), (3, "twice"), (3, "twice"), (None, "nameless text"), (7002, "long words " * 30_000)]
    return rows, docs(rows)


def test_token_files_equal_brute_force(spark, docs, tmp_path, monkeypatch):
    rows, df = some_docs(docs)
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op5_token_codes(spark, str(tmp_path)).collect()]
    whole, start, want = Tokenizer.from_file(BYTE), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def test_packing_equals_the_pieces_and_leaves_no_gap(spark, docs, tmp_path):
    rows, df = some_docs(docs)
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op9_packing(spark, str(tmp_path)).collect()
    whole, want = Tokenizer.from_file(WORD), []
    for doc_id, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(doc_id, k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    check_sequences([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert len({r.sequence_id for r in got}) <= -(-sum(w[3] for w in want) // 2048) + 1


def check_sequences(rows, length):
    ends = {}
    for sequence, offset, size in sorted(rows):
        assert ends.get(sequence, 0) == offset
        ends[sequence] = offset + size
    assert all(e <= length for e in ends.values())
    return ends


def best_fit_decreasing(counts, length):
    room, used = [0] * (length + 1), 0
    for n in range(length, 0, -1):
        for _ in range(counts[n]):
            gap = next((g for g in range(n, length) if room[g]), length)
            if gap == length:
                used += 1
            else:
                room[gap] -= 1
            room[gap - n] += 1
    return used


def test_plans_use_every_piece_once():
    rng = np.random.default_rng(4)
    for length, most in ((16, 9), (64, 40), (64, 3), (2048, 5), (2048, 300)):
        counts = rng.integers(0, most, length + 1)
        counts[0] = 0
        counts[rng.integers(1, length + 1, length // 2)] = 0
        plan = packing.plan_sequences(counts, length)
        rows = []
        for n in range(1, length + 1):
            at = np.flatnonzero(plan["size"] == n)
            edges = [*plan["rank"][at], counts[n]]
            assert edges[0] == 0 or not counts[n]
            for k, row in enumerate(at):
                rows += [(int(plan["sequence"][row] + i), int(plan["offset"][row]), n) for i in range(edges[k + 1] - edges[k])]
        assert len(rows) == counts.sum()
        ends = check_sequences(rows, length)
        need = -(-int((counts * np.arange(length + 1)).sum()) // length)
        assert need <= len(ends) == plan["n"][0] <= best_fit_decreasing(counts, length) * 1.005 + 1


def test_empty_tables(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    for query in (queries.op5_token_codes, queries.op9_packing):
        assert query(spark, str(tmp_path)).collect() == []
