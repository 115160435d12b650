import random

import duckdb
from entityloom.llm import line_frequency as lf


def compare(df, limits=lf.Limits()):
    con = duckdb.connect()
    plain = df.select("doc_id", "text", "source").toPandas()
    con.register("documents", plain)
    cur = con.execute(lf.sql(limits))
    names = [d[0] for d in cur.description]
    got = lf.line_rules(df, limits)
    assert got.columns == names
    mine = sorted((tuple(r) for r in got.collect()), key=str)
    assert mine == sorted(cur.fetchall(), key=str)
    return mine


def sample():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)] + ["é", "#x", "A|b"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for i in range(120):
        text = [line(rng.randrange(1, 20)) for _ in range(rng.randrange(1, 6))]
        if i % 2:
            text.insert(0, rng.choice(["Read  More about this Site", " read more ABOUT this site\t"]))
        if i % 7 == 0:
            text = ["cookie notice one two three four five six seven", "read more about this site", line(2)]
        if i % 11 == 0:
            text += [text[-1]] * 2
        if i % 13 == 0:
            text.append(" ".join(["again and again we say"] * 6))
        rows.append((i, "\n".join(text), f"h{i % 3}", "en"))
    rows += [(500, None, "h0", "en"), (501, "", None, "en"), (502, " \n \n", "h1", "en"), (503, "one two", None, "en")]
    rows += [(504, "x y z " * 600, "h2", "en"), (3, rows[3][1], rows[3][2], "en"), (3, rows[3][1], rows[3][2], "en"), (None, rows[4][1], None, "en")]
    return rows


def test_equal_to_sql(docs):
    rows = compare(docs(sample()))
    assert any(r[8] for r in rows) and any(not r[6] and not r[7] for r in rows)
    compare(docs(sample()), lf.Limits(max_docs=1, max_share=0.0, min_left_words=3, min_left_share=0.9))


def test_the_limit_does_not_grow_with_the_host(docs):
    """A line on 15 of 2,500 documents of a host goes; one on 10 of them stays."""
    rows = [(i, f"body {i} of its own\n" + ("fifteen times the same" if i < 15 else "ten times the same" if i < 25 else "x y"), "h", "en") for i in range(2500)]
    rows = [(*r[:1], r[1] if r[0] < 25 else f"body {r[0]} a b c d e f g h i j", *r[2:]) for r in rows]
    got = {r[0]: r[8] for r in compare(docs(rows))}
    assert [got[i] for i in (0, 14, 15, 24, 25)] == [4, 4, 0, 0, 0]
    compare(docs(rows[:300]), lf.Limits(max_share=0.05))


def test_repeated_windows(docs):
    text = "a b c d e f a b c d e g a b c d e"
    (row,) = compare(docs([(1, text, "h", "en")]))
    assert row[5] == 15
    (row,) = compare(docs([(1, "x x x x x x x", "h", "en")]))
    assert row[5] == 7


def test_text_without_frequent_lines(docs):
    rows = [(i, f"menu home about\nbody {i} text", "h", "en") for i in range(30)] + [(99, None, "h", "en")]
    out = {r.doc_id: r.text for r in lf.without_frequent_lines(docs(rows)).collect()}
    assert out[4] == "body 4 text" and out[99] is None


def test_empty(docs):
    assert lf.line_rules(docs([])).collect() == []


def test_very_long_text(docs):
    row = lf.line_rules(docs([(1, "x y z " * 30_000, "h", "en")])).first()
    assert (row.n_words, row.n_repeat_words, row.base_failed, row.kept) == (90_000, 90_000, True, False)
