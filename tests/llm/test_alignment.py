import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from entityloom.llm import alignment as A
from entityloom.llm import queries

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
BOTH = A.Tokenizers(*PATHS)
SIZES = tuple(np.array([len(t) for t in table], np.int64) for table in (BOTH.bytes_a, BOTH.bytes_b))


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(table[i])))
        at += len(table[i])
    return out


def tokens(text):
    """Ids of a whole text by the libraries, none where their bytes differ."""
    if not text:
        return [], []
    raw = b" " + text.encode()
    a, b = BOTH.a.encode(" " + text, add_special_tokens=False).ids, BOTH.b.encode(text)
    if any(b"".join(t[i] for i in ids) != raw for t, ids in ((BOTH.bytes_a, a), (BOTH.bytes_b, b))):
        return [], []
    return a, b


def links(a, b):
    """All overlapping pairs, by their byte ranges alone."""
    x, y = spans(a, BOTH.bytes_a), spans(b, BOTH.bytes_b)
    out, j = [], 0
    for i, (s, e) in enumerate(x):
        while y[j][1] <= s:
            j += 1
        k = j
        while k < len(y) and y[k][0] < e:
            out.append((a[i], b[k]))
            k += 1
    return out


def groups(a, b):
    x, y = spans(a, BOTH.bytes_a), spans(b, BOTH.bytes_b)
    ends = sorted({e for _, e in x} & {e for _, e in y})
    out, start = [], 0
    for end in ends:
        out.append("|".join(",".join(str(i) for i, (s, e) in zip(t, z, strict=True) if start <= s and e <= end) for t, z in ((a, x), (b, y))))
        start = end
    return out


def brute(rows):
    coded = [(d, *tokens(t)) for d, t in rows]
    linked = [links(a, b) for _, a, b in coded]
    total = Counter(p for pairs in linked for p in pairs)
    best = Counter()
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    out = []
    for (d, a, b), pairs in zip(coded, linked, strict=True):
        g = groups(a, b)
        sha = hashlib.sha256(";".join(g).encode()).hexdigest() if a else ""
        out.append((d, len(a), len(b), len(g), len(pairs), sum(total[p] == best[p[1]] for p in pairs), sum(total[p] for p in pairs), sha))
    return out


def key(r):
    return tuple(map(str, r))


def some_rows():
    rng = random.Random(12)
    alphabet = ["the", "Straße", "naïve", "don't", "12345", "été,", "x=1;", "hello-world", "日本語", "<|endoftext|>", "<s>", "zzzzqqqq", "😀😀"]
    text = lambda n: rng.choice([" ", " ", "  ", "\n"]).join(rng.choice(alphabet) for _ in range(n))
    rows = [(i, text(rng.randrange(30))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " "), (103, "a▁b"), (104, "\x00\x07 x"), (105, " lead"), (106, "trail "), (107, "a  　b \t c")]
    rows += [(7, "twin twin"), (7, "twin twin"), (None, "no id")]
    rows += [(200 + i, "a hot text of many copies.") for i in range(40)]
    rows += [(300, " ".join(rng.choice(alphabet) for _ in range(3000))), (301, "q" * 3000 + " tail " + "日" * 2000), (302, text(2000) + " ▁ " + text(500))]
    return rows


@pytest.mark.parametrize("chunk,fan,pairs", [(1 << 15, 64, 10**6), (700, 2, 10**6), (257, 3, 0)])
def test_equal_to_brute_force(docs, chunk, fan, pairs):
    rows = some_rows()
    got = A.aligned(docs(rows), *PATHS, chunk=chunk, fan=fan, broadcast_pairs=pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_chunks_cover_and_are_safe():
    rng = random.Random(1)
    for _ in range(300):
        data = b" " + "".join(rng.choice(["a", "é", " ", " b", "　", "▁", "日本", "x" * 50]) for _ in range(200)).encode()
        ranges = list(A._ranges(data, 40))
        assert [r[0] for r in ranges[1:]] == [r[1] for r in ranges[:-1]] and ranges[0][0] == 0 and ranges[-1][1] == len(data)
        for low, high, start, stop in ranges:
            assert start <= low < high <= stop
            assert all(at in (0, len(data)) or A._is_cut(data, at) for at in (start, stop))
        assert sum(stop - start for *_, start, stop in ranges) < 4 * len(data) + 400


def test_fragments_are_a_monoid():
    """Any cuts into chunks, composed in any order, give the groups of the whole."""
    rng = random.Random(3)
    text = " ".join(rng.choice(["naïve", "don't", "日本語", "12345", "zzzzqqqq", "the"]) for _ in range(60))
    a, b = (np.array(x, np.uint32) for x in tokens(text))
    ends = [np.cumsum(s[t]) for s, t in zip(SIZES, (a, b), strict=True)]
    size = int(ends[0][-1])
    for _ in range(200):
        cuts = sorted({0, size, *(rng.randrange(size) for _ in range(rng.randrange(12)))})
        parts, found = [], {}
        for k, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
            first, last = zip(*(np.searchsorted(e, [low, high], side="right") for e in ends), strict=True)
            ids = [t[i:j] for t, i, j in zip((a, b), first, last, strict=True)]
            froms = [int(e[i - 1]) if i else 0 for e, i in zip(ends, first, strict=True)]
            cut = A.split(*ids, *froms, SIZES)
            if cut is None:
                parts.append(A.Fragment(-1, tuple(ids), A._NONE))
            else:
                parts.append(A.Fragment(k, tuple(t[: c.start] for t, c in zip(ids, cut, strict=True)), tuple(t[c.stop :] for t, c in zip(ids, cut, strict=True))))
                found[2 * k + 1] = [t[c].tolist() for t, c in zip(ids, cut, strict=True)]

        def closed(at, group, found=found):
            assert 2 * at not in found
            found[2 * at] = [x.tolist() for x in group]

        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [A.compose(A.compose(parts[i], A.EMPTY, closed), parts[i + 1], closed)]
        closed(parts[0].at, parts[0].prefix)
        assert not len(parts[0].suffix[0]) and not len(parts[0].suffix[1])
        for side, whole in ((0, a), (1, b)):
            assert [i for at in sorted(found) for i in found[at][side]] == whole.tolist()
        assert all(BOTH.bytes_a and b"".join(BOTH.bytes_a[i] for i in x) == b"".join(BOTH.bytes_b[i] for i in y) for x, y in found.values())


def test_empty_table(docs):
    assert A.aligned(docs([(1, "x")]).limit(0), *PATHS).collect() == []


def test_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_tokenizer_alignment(spark, folder).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)
