"""Pseudonyms against a plain Python version of the same permutations."""

import datetime
import hashlib
import re

from entityloom.llm import pseudonyms as ps

KEY = "k"


def noise(kind, i, x, salt=None):
    parts = [KEY, kind, str(i), str(x)] + ([str(salt)] if salt is not None else [])
    return int(hashlib.sha256("|".join(parts).encode()).hexdigest()[:15], 16)


def feistel(kind, a, b, size_a, size_b, salt=None):
    for i in range(ps.ROUNDS):
        a, b = b, (a + noise(kind, i, b, salt)) % (size_a if i % 2 == 0 else size_b)
    return a, b


def permuted(kind, d):
    n, low = len(d), len(d) // 2
    a, b = feistel(kind, int(d[:low]), int(d[low:]), 10**low, 10 ** (n - low), n)
    return f"{a:0{low}d}{b:0{n - low}d}"


def luhn(payload):
    total = 0
    for i, c in enumerate(reversed(payload)):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return str((10 - total % 10) % 10)


def laid_out(m, digits):
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in m)


def as_date(m, layout):
    try:
        return datetime.datetime.strptime(m, layout).date()
    except ValueError:
        return None


def moved(day, layout):
    first = datetime.date(1800, 1, 1)
    offset = (day - first).days
    if not 0 <= offset < 146097:
        return None
    a, b = feistel("date", offset // 773, offset % 773, 189, 773)
    return (first + datetime.timedelta(a * 773 + b)).strftime(layout)


def pseudonym(m):
    whole = lambda p: re.fullmatch(p, m)
    digits = re.sub("[^0-9]", "", m)
    if "@" in m:
        return "u" + hashlib.sha256(f"{KEY}|email|{m.lower()}".encode()).hexdigest()[:12] + "@example.org"
    if whole(ps.IPV4):
        o = [int(x) for x in m.split(".")]
        a, b = feistel("ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if whole(ps.DATE):
        for layout in ["%Y-%m-%d"] if m[4] == "-" else ["%d.%m.%Y"] if "." in m else ["%d/%m/%Y", "%m/%d/%Y"]:
            if as_date(m, layout):
                return moved(as_date(m, layout), layout)
        return None
    if whole(ps.SSN):
        area, group, serial = (int(x) for x in m.split("-"))
        if not (1 <= area <= 899 and area != 666 and group and serial):
            return None
        a, b = feistel("ssn", area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
        return f"{a + 1 + (a >= 665):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"
    if whole(ps.PHONE):
        return laid_out(m, digits[:-10] + permuted("phone", digits[-10:]))
    if whole(ps.CARD):
        if luhn(digits[:-1]) != digits[-1]:
            return None
        payload = digits[0] + permuted("card", digits[1:-1])
        return laid_out(m, payload + luhn(payload))
    if not (re.search("[0-9]", m) and re.search("[A-Fa-f]", m)):
        return None
    fresh = hashlib.sha256(f"{KEY}|secret|{m.lower()}".encode()).hexdigest()[: len(m)]
    return fresh.upper() if m == m.upper() else fresh


def brute(text):
    n = 0

    def swap(match):
        nonlocal n
        fresh = pseudonym(match[0])
        n += fresh is not None
        return match[0] if fresh is None else fresh

    return (None, 0) if text is None else (re.sub(ps.ANY, swap, text), n)


TEXTS = [
    None, "", "no numbers", "year 2020, 4.0. 12,5", "a 4068516892505468 b", "4068 5168 9250 5468, 4068-5168-9250-5468",
    "4465758382889437 4465758382889437", "4068516892505469", "call +1 (555) 555-5657. or 555-123-4567 x", "+1&&& (743) 555-3824",
    "24.243.215.198 256.1.1.1 1.2.3.4.5 v1.2.3.4", "born 1999-02-28, 1999-02-30, 31/12/2001, 12/31/2001, 05.06.1980, 1066-10-14",
    "123-45-6789 666-45-6789 000-12-3456 899-99-9999", "Ab.78@mail3.example.com ab.78@MAIL3.example.com x@y",
    'token = "5aad00685accefdd91653537b82ad0dab34e35e3" 5AAD00685ACCEFDD91653537B82AD0DAB34E35E3', "0" * 40 + " " + "a" * 40,
    "é 24.243.215.198 ß 4068516892505468\n\n24.243.215.198", "7 " * 90_000 + "4068516892505468", "4068516892505468" * 3, "$1 \\1 24.243.215.198",
]


def test_equal_to_plain_python(docs):
    df = docs(list(enumerate(TEXTS)) + [(3, TEXTS[4]), (3, TEXTS[4]), (None, TEXTS[4])])
    out = ps.pseudonymised(df, KEY)
    assert out.columns == [*df.columns, "n_pseudonyms"]
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        want = TEXTS[r.doc_id] if r.doc_id is not None and r.doc_id < len(TEXTS) else TEXTS[4]
        if r.doc_id == 3 and r.text != brute(TEXTS[3])[0]:
            want = TEXTS[4]
        assert (r.text, r.n_pseudonyms) == brute(want), (r.doc_id, want and want[:80])


def test_equal_values_stay_linked_and_formats_valid(docs):
    texts = ["x 4068516892505468 y", "4068-5168-9250-5468", "4068516892505469"]
    one, two, invalid = (r.text for r in ps.pseudonymised(docs(list(enumerate(texts))), KEY).orderBy("doc_id").collect())
    digits = re.sub("[^0-9]", "", one)
    assert digits == re.sub("[^0-9]", "", two) != "4068516892505468" and digits[-1] == luhn(digits[:-1])
    assert re.fullmatch(r"\d{4}-\d{4}-\d{4}-\d{4}", two) and invalid == texts[2]
    other = ps.pseudonymised(docs([(1, texts[0])]), "another key").first().text
    assert other != one


def test_small_domains_are_permuted(spark):
    from pyspark.sql import functions as F

    pairs = spark.range(189 * 773).select(
        ps.feistel(KEY, "date", F.floor(F.col("id") / 773), F.col("id") % 773, F.lit(189).cast("long"), F.lit(773).cast("long")).alias("p")
    )
    assert pairs.distinct().count() == 189 * 773
    threes = spark.range(1000).select(ps.permuted_digits(KEY, "t", F.lpad(F.col("id").cast("string"), 3, "0")).alias("d"))
    assert threes.distinct().count() == 1000 and threes.filter("length(d) = 3").count() == 1000


def test_empty_and_clashes(docs):
    assert ps.pseudonymised(docs([]), KEY).collect() == []
    df = docs([(1, "a")]).withColumnRenamed("uid", "n_pseudonyms")
    try:
        ps.pseudonymised(df, KEY)
    except ValueError:
        assert ps.pseudonymised(df, KEY, count_as="n").first()["n"] == 0
    else:
        raise AssertionError


CARDS = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "3782 822463 10005", "41111 11111 11111 1"]
NEIGHBOURS = ["97.51.17.173", "123-45-6789", "555-123-4567", "2001-02-03"]


def test_cards_beside_other_digits(docs):
    cases = [(f"{a}{c}{b}", c, None) for c in CARDS for a, b in (("", " 12/25"), ("", " 737"), ("No 12 ", ""), ("", " 12 25 7"), ("1234 ", " 1234"))]
    cases += [(text, c, n) for c in CARDS for n in NEIGHBOURS for text in (f"{c} {n}", f"{n} {c}", f"{c} {c} {n} 12")]
    out = {r.doc_id: r for r in ps.pseudonymised(docs([(i, c[0]) for i, c in enumerate(cases)]), KEY).collect()}
    for i, (text, card, neighbour) in enumerate(cases):
        want = text.replace(card, pseudonym(card))
        n = text.count(card)
        if neighbour:
            want, n = want.replace(neighbour, pseudonym(neighbour)), n + 1
        assert (out[i].text, out[i].n_pseudonyms) == (want, n), text


def test_cards_after_groups_like_a_phone_number(docs):
    texts = ["123 456 4111 1111 1111 1111", "4111 111 111 1111 11", "555-123-4567 4111 1111 1111 1111"]
    out = {r.doc_id: r.text for r in ps.pseudonymised(docs(list(enumerate(texts))), KEY).collect()}
    card = pseudonym(CARDS[0])
    assert out == {0: f"123 456 {card}", 1: laid_out(texts[1], re.sub("[^0-9]", "", card)), 2: f"{pseudonym('555-123-4567')} {card}"}


def test_runs_without_a_card_leave_their_neighbours(docs):
    texts = ["4111111111111112 97.51.17.173", "1 2 3 4 5 6 7 8 9 0 1 2 123-45-6789", "4111 1111 1111 1112 555-123-4567"]
    for r in ps.pseudonymised(docs(list(enumerate(texts))), KEY).collect():
        head, last = texts[r.doc_id].rsplit(" ", 1)
        assert r.text == f"{head} {pseudonym(last)}" and r.n_pseudonyms == 1
