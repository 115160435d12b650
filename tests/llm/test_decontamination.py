import hashlib
import os
import random
import re
import sys

import pytest
from entityloom.llm import decontamination, queries

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import parity  # noqa: E402

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, window=10):
    windows = {}
    for item, text in items:
        ws = split(text)
        n = min(window, len(ws))
        for s in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[s : s + n]), set()).add(item)
    out = []
    for doc_id, text in rows:
        ws, hit, found = split(text), set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(ws) - n + 1):
                if (key := tuple(ws[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[key]
        names = sorted({str(i) for i in found if i is not None})
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(ws), len(hit), len(names), sha, bool(hit)))
    return out


def result(df):
    return [tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()]


def key(r):
    return tuple(map(str, r))


def table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "item_id as WINDOW", "item_id as uid")


@pytest.fixture
def case():
    rng = random.Random(11)
    vocabulary = ["a", "bé", "Cd", "x1", "ü", "qq", "w"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([4, 9, 10, 11, 25, 60]))) for i in range(30)]
    items += [(3, text(12)), (100, items[5][1]), (None, text(14)), (101, None), (102, ""), (103, "-- ."), (104, "zebra"), (105, "zebra, Zebra")]
    rows = []
    for i in range(120):
        parts = [text(rng.randrange(0, 30))]
        if i % 3 == 0:
            ws = split(rng.choice(items[:30])[1])
            s = rng.randrange(len(ws))
            parts.append("\n".join(ws[s : s + rng.randrange(1, 20)]).upper())
            parts.append(text(rng.randrange(0, 12)))
        rows.append((i, rng.choice([" ", "--", ". "]).join(parts)))
    rows += [(200, None), (201, ""), (202, " .;\x00"), (203, "ZEBRA zebra\x7fzebra"), (7, "twin"), (7, "twin"), (None, items[0][1])]
    rows += [(300 + i, items[12][1] + " zebra") for i in range(60)]
    return rows, items


def test_equal_to_brute_force(spark, docs, case):
    rows, items = case
    got = result(decontamination.contamination(docs(rows), table(spark, items)))
    assert sorted(got, key=key) == sorted(brute(rows, items), key=key)
    assert 60 < sum(r[5] for r in got) < len(got)


def test_long_text_in_pieces_and_shuffled_windows(spark, docs, case, monkeypatch):
    """Workers see the module's own piece, so a text of several pieces is used; windows lie across their ends."""
    rng = random.Random(4)
    filler = " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(400_000)).split(" ")
    items = [(1, " ".join(filler[100:125])), (2, " ".join(filler[-3:])), (3, "short one")]
    text = " ".join(filler)
    per_piece = decontamination.PIECE * len(filler) // len(text)
    items += [(10 + k, " ".join(filler[k * per_piece - 300 : k * per_piece + 300])) for k in (1, 2)]
    rows = [(1, text), (2, "b" * (decontamination.PIECE + 50) + " short ONE " + text[:2000]), (3, "clean")]
    got = result(decontamination.contamination(docs(rows), table(spark, items), broadcast_bytes=0))
    assert sorted(got, key=key) == sorted(brute(rows, items), key=key)


def test_spans(spark, docs):
    items = table(spark, [(1, "a b c d e f g h i j k l"), (2, "x y")])
    found = decontamination.contamination(docs([(1, "z a b c d e f g h i j k x y x y")]), items).head()
    assert [tuple(s) for s in found["spans"]] == [(1, 16)]
    assert (found["n_hit"], found["n_items"]) == (15, 2)


def test_empty_tables(spark, docs):
    items = table(spark, [(1, "a b")])
    none = decontamination.contamination(docs([(1, "a b")]).limit(0), items)
    assert none.collect() == [] and none.columns[0] == "doc_id"
    got = result(decontamination.contamination(docs([(1, "a b"), (2, None)]), items.limit(0)))
    assert sorted(r[:4] for r in got) == [(1, 2, 0, 0), (2, 0, 0, 0)]


def test_equal_to_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = parity.connect(folder)
    got = queries.op11_decontamination(spark, folder)
    sql = con.execute(f"select {', '.join(got.columns)} from ({queries.SQL['op11_decontamination']})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(sql)
