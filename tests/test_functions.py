import datetime as dt

from pyspark.sql import functions as F

from entityloom.functions import dates, scores, urls
from entityloom.functions import text as tx

X = F.col("x")
D = dt.date


def day(s):
    return F.lit(s).cast("date")


def test_parse_date(rows):
    cases = {
        "02.08.1993": D(1993, 8, 2),
        "Dec. 27, 2015": D(2015, 12, 27),
        "December 27, 2015": D(2015, 12, 27),
        "02 August 1993": D(1993, 8, 2),
        " 2  AUG 1993 ": D(1993, 8, 2),
        "5 sept 2018": D(2018, 9, 5),
        "September 5, 2018": D(2018, 9, 5),
        "May 5, 2018": D(2018, 5, 5),
        "2018-1-31": D(2018, 1, 31),
        "2018.01.31": D(2018, 1, 31),
        "31 February 2018": None,
        "Dec 27, 2015": None,
        "soon": None,
        "-": None,
        None: None,
    }
    assert rows(list(cases), dates.parse_date(X)) == list(cases.values())


def test_day_month(rows):
    now = day("2019-03-01")
    assert rows(["2 Aug", "29 Feb", "31 Jun", "Aug", None], dates.parse_day_month(X, now)) == [D(2019, 8, 2), None, None, None, None]
    assert rows(["29 Feb"], dates.parse_day_month(X, day("2020-03-01"))) == [D(2020, 2, 29)]


def test_repair_years(spark):
    now = day("2018-06-15")
    given = [
        (1, "ended", "2018-08-01", "2018-09-01", "2017-08-01", "2017-09-01"),
        (2, "ended", "2018-02-01", "2018-03-01", "2018-02-01", "2018-03-01"),
        (3, "active", "2018-12-01", "2018-01-10", "2017-12-01", "2019-01-10"),
        (4, "upcoming", "2018-01-10", "2018-02-10", "2019-01-10", "2019-02-10"),
        (5, "upcoming", "2018-01-10", None, "2018-01-10", None),
        (6, None, "2018-01-10", "2018-02-01", "2018-01-10", "2018-02-01"),
    ]
    df = spark.createDataFrame(given, "i int, status string, s string, e string, s2 string, e2 string")
    start, end = dates.repair_years(F.col("s").cast("date"), F.col("e").cast("date"), F.col("status"), now)
    for r in df.select("s2", "e2", start.cast("string").alias("a"), end.cast("string").alias("b")).collect():
        assert (r.a, r.b) == (r.s2, r.e2)


def test_repair_clamps_leap_day(spark):
    df = spark.range(1).select(day("2020-02-29").alias("s"), day("2020-02-29").alias("e"))
    start, _ = dates.repair_years(F.col("s"), F.col("e"), F.lit("upcoming"), day("2020-06-01"))
    assert df.select(start.alias("a")).first().a == D(2021, 2, 28)


def test_period_status(rows):
    status = dates.period_status(X.cast("date"), F.date_add(X.cast("date"), 10), day("2018-06-15"))
    assert rows(["2018-06-15", "2018-06-05", "2018-06-04", "2018-06-16", None], status) == ["active", "active", "ended", "upcoming", None]


def test_ranges(rows):
    assert rows(["2 Aug – 5 Sep", "2 Aug", "a – b – c"], dates.range_side(X, 1, "–", exactly_two=True)) == ["5 Sep", None, None]
    assert rows(["from 01.02.2018 - to 03.04.2018"], dates.range_side(X, 0, last_word=True)) == ["01.02.2018"]
    assert rows(["1 May 2018", " "], dates.range_side(X, 0), dates.range_side(X, 1)) == [("1 May 2018", None), (None, None)]
    assert rows(["x 2018-01-02 y 2018.03.04", "2018-1-2"], dates.iso_date_text(X, 0), dates.iso_date_text(X, 1)) == [
        ("2018-01-02", "2018.03.04"),
        (None, None),
    ]


def test_rounding_is_by_binary_value(rows):
    values = ["0.35", "0.25", "0.75", "3.3499999999999996", "-0.04", "2.5", "1e2"]
    assert rows(values, scores.rounded(X.cast("double"))) == [float(f"{float(v):.1f}") + 0.0 for v in values]
    assert rows(["2.5", "3.5"], scores.rounded(X.cast("double"), 0)) == [2.0, 4.0]


def test_rescale(rows):
    assert rows(["4.5", " 2 ", "x", "4.5d", "nan", None], scores.rescale(X, 0, 5)) == [9.0, 4.0, None, None, None, None]
    words = list(scores.RISK_WORDS)
    assert rows(words, scores.rescale(scores.word_value(X, scores.RISK_WORDS), 1, 5)) == [0.0, 2.5, 5.0, 7.5, 10.0]
    assert rows(["NEGATIVE-", "NA"], scores.rescale(scores.word_value(X, scores.RATING_GRADES), 0, 8)) == [0.0, None]


def test_rescale_is_monotone(rows):
    values = [f"{i / 7:.4f}" for i in range(36)]
    got = rows(values, scores.rescale(X, 0, 5))
    assert got == sorted(got)


def test_numeric(rows):
    assert rows(["1", "-1.5", ".5", "5.", "1e3", "inf", "", "1_0", None], scores.is_number(X)) == [True] * 5 + [False] * 4


def test_text(rows):
    assert rows(["NAME (SYM)", "NAME"], tx.before(X)) == ["NAME", "NAME"]
    assert rows(["Ticker: A : b", "none"], tx.between_colons(X)) == ["A", None]
    assert rows(["3.1 / 5", "3", "1/2/3", "x / 5"], tx.fraction_numerator(X)) == [3.1, None, None, None]
    assert rows(["width:85%", "w"], tx.style_percent(X)) == [85, None]
    assert rows(["1st August 2018", "August 22nd", "third"], tx.drop_ordinals(X)) == ["1 August 2018", "August 22", "third"]
    assert rows(["Yes, now", "NO", "unknown", "-"], tx.yes_no(X)) == [True, False, False, None]
    assert rows(["  a \n", " - ", " "], tx.known_text(X)) == ["a", None, None]
    assert rows(['say "hi" '], tx.drop_quotes(X)) == ["say hi"]
    assert rows(["  two   WORDS "], tx.title_case(X)) == ["Two Words"]


def test_links(rows):
    base = F.lit("https://x.org/a/b?q=1#f")
    cases = {
        "/c": "https://x.org/c",
        "c": "https://x.org/a/c",
        "../c": "https://x.org/c",
        "./c/../d?x=..": "https://x.org/a/d?x=..",
        "?r": "https://x.org/a/b?r",
        "#g": "https://x.org/a/b?q=1#g",
        "": "https://x.org/a/b?q=1#f",
        "//y.org/z": "https://y.org/z",
        "mailto:a@b": "mailto:a@b",
        "http://y.org": "http://y.org",
    }
    assert rows(list(cases), urls.resolve(base, X)) == list(cases.values())
    assert rows(["img.png", "/img.png"], urls.resolve(F.lit("https://x.org"), X)) == ["https://x.org/img.png"] * 2
    assert rows(["HTTP://Www.X.org:80/a", "x"], urls.origin(X)) == ["http://Www.X.org:80/", None]
    assert rows(["https://www.t.me/a", "t.me/x", "https://not-t.me/x"], urls.social_host(X)) == ["t.me", "t.me", "not-t.me"]
    assert rows(["http://f/index.php?topic=12.40;x", "http://f/x"], urls.thread_base(X)) == ["http://f/index.php?topic=12", None]
    assert rows([" http://a  b", " "], urls.clean_link(X)) == ["http://a", None]
