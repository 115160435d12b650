"""Shredder, rule packs of all sources, and the full run."""

import random
import time
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from entityloom.operators import enrich
from entityloom.operators.extract import Part, Rule, Sel, SourceRules, extract, find, listing_links, take, unmapped_labels
from entityloom.operators.packs import PACKS
from entityloom.operators import shred as shredder
from entityloom.operators.rules import _known as known_value
from entityloom.operators.shred import element_table, own_text_of, shred, text_of
from entityloom.plans.profiles import Community, build_profiles, full_run
from entityloom.plans.refresh import refresh_run
from entityloom.schema import CSV_FIELDS, FIELDS
from entityloom.sinks.files import EmptyOutput, write_stage
from entityloom.sources.pages import PAGE_BYTES_SCHEMA

AS_OF = F.lit("2018-06-15").cast("date")

DROPS = """<div><img data-src="/logo.png"><div class="ico-main-info"><h3> Foo Coin </h3></div></div>
<a href="https://foo.io/wp.pdf"><div class="button">WHITEPAPER</div></a><a href="https://foo.io"><div class="button">WEBSITE</div></a>
<div class="ico-description">All about <b>foo</b>.</div>
<div class="soc_links"><a href="http://t.me/foo chat"><span><i class="fab fa-telegram"></i></span></a><a><i class="fa-github"></i></a></div>
<div class="rating-field"><div class="rating-box"><p>Hype rate\nmore</p><p> High </p></div><div class="rating-box"><p>Risk rate</p></div>
<div class="rating-box"><p>ICO Drps score</p><p>Very High Interest</p></div></div>
<div class="token-sale"><strong>Token sale ended</strong></div><h4>Token Sale: 2 Aug – 5 Sep</h4>
<li><span class="grey">Ticker: </span>FOO</li><li><span class="grey">Whitelist: </span>Yes (ends 1 May)</li>
<li><span class="grey">Сan't participate: </span>US, China</li><li><span class="grey">Odd: </span>x</li>"""
BENCH = """<div class="box"><div class="name"><h1>Foo Coin</h1><h2>sub</h2></div></div><p>A description.</p>
<div class="rating"><div itemprop="ratingValue" content="4.1"></div><div class="distribution"><div>4.5<label>ICO profile</label></div>
<div>3.0<label>Team</label></div></div></div><div class="image"><img src="/l.png"></div>
<div class="financial_data"><label>Time</label><div class="number">7 days</div><small>2018-06-01 - 2018-07-01</small>
<div class="data_row"><div>Token</div><div>FOO</div></div><div class="data_row"><div>preICO start</div><div>1st August 2017</div></div>
<div class="data_row"><div>preICO end</div><div>22nd August 2017</div></div>
<div class="data_row"><div>Whitelist/KYC</div><div>KYC</div></div><div class="data_row"><div>Country</div><div>UK</div></div></div>
<div class="socials"><a title="x" href="https://foo.io">www</a><a href="https://none">Twitter</a></div>"""
MARKS = """<h1 itemprop="name">Foo Coin</h1><img itemprop="url" src="i.png"><div class="ico-rating-overall"> 7.2 </div>
<div><div class="ico-rating__item"><div class="ico-rating__title">Team &amp; Advisors</div></div><div class="ico-rating__circle">8.1</div></div>
<div class="icoinfo"><div class="icoinfo-block__item"><span>Ticker:</span> FOO</div>
<div class="icoinfo-block__item"><span>ICO Time:</span> 1 jun 2018 - 1 jul 2018</div>
<div class="icoinfo-block__item"><span>Country:</span> Germany</div><div class="icoinfo-block__item"><span>Whitelist/KYC:</span> Whitelist</div>
<span>Website:</span><a href="https://foo.io">x</a><a class="icoinfo-block__view" href="https://www.reddit.com/r/foo">r</a>
<a class="icoinfo-block__view" href="t.me/foo">t</a></div><div class="company-description">Text</div>"""
RATING = """<img src="/pic.png"><div class="share"></div><div class="h1"><h1>Foo Coin (FOO)</h1></div>
<div><span class="title">Risk score</span><span class="score">2 / 5</span></div><div><span class="title">Hype score</span><span class="score">2</span></div>
<div><span class="title">Investment rating</span><span class="name">Stable+</span></div><a target="_blank" href="https://bitcointalk.org/index.php?topic=7.0">BTCtalk</a>
<table><tr><td>Description:</td><td> Words </td></tr></table>"""
RATING_DETAILS = """<table><tr><td>Ticker:</td><td>FOO</td></tr><tr><td>ICO start date:</td><td>01.08.2018</td></tr>
<tr><td>ICO end date:</td><td>01.09.2018</td></tr><tr><td>Country Limitations:</td><td>Korea, Republic of, Unspecified</td></tr></table>"""
TOPS = """<h1 class="page-details__title">Foo Coin</h1><img class="page-details__logo" src="/x.png"><div class="rating_block"><span class="rating-text">0</span></div>
<div class="page-details__main"><a title="Twitter" href="https://twitter.com/foo">t</a><a title="Twitter" href="https://twitter.com/second">t</a></div>
<div class="page-details__info-row"><h3 class="page-details__info-title">Token symbol</h3><div class="page-details__info-descr"> FOO </div></div>
<div class="page-details__info-row"><h3 class="page-details__info-title">Amount raised</h3><p>x</p><div class="page-details__info-descr">$5</div></div>
<div class="show-more-wrap show-more--big2"><h2>About</h2></div>
<div id="section-review-block"><div class="rat-stars"><span style="width:80%"></span></div><div class="rat-stars"><span style="width:0%"></span></div></div>
<div id="section-review-block"><div class="rat-stars"><span style="width:75%"></span></div></div>"""
TRACK = """<h1 class="h2 x">Foo Coin</h1><div class="img-thumbnail align-self-center m-2"><img src="data:image/png;base64,AA"></div><div class="fs-14">d</div>
<table><tr><th>Token Sale</th><td>from 1.2.2018 - to 3.4.2018</td></tr><tr><th>Country</th><td><a>Peru</a></td></tr><tr><th>Token</th><td>FOO</td></tr></table>
<div class="fs-60 fw-400 text-primary">3.5</div><div class="flexbox flex-wrap"><a onclick="go('link-Homepage')" href=" https://foo.io ">h</a>
<a onclick="go('button-Slack')" href="https://s">s</a><a onclick="other()" href="https://o">o</a></div>"""
BAZAAR = """<div class="com-header__info"><h1>Foo Coin</h1><p>d</p></div><div class="com-header__logo"><img src=" https://cdn/x.png "></div>
<div class="ico-rating" rating="4.5"></div><div class="com-sidebar"><a href="https://foo.io">w</a>
<div class="com-sidebar__info-line"><span>Start:</span><span class="com-sidebar__info-value">1 June 2018</span></div>
<div class="com-sidebar__info-line"><span>End:</span><span class="com-sidebar__info-value">1 July 2018</span></div>
<div class="com-sidebar__info-line"><span>Odd:</span><span class="com-sidebar__info-value">?</span></div></div>"""
BAZAAR_COMMUNITY = """<div class="com-rating__list"><div class="com-rating__list-element"><span>Team</span><div class="progress-bar"><span style="width:85%"></span></div></div></div>
<div class="com-social"><a href="https://t.me/foo"><i class="fab fa-telegram"></i></a><a href="x"><i class="fab fa-zzz"></i></a></div>"""

PAGES = [
    ("icodrops", "https://d/foo", DROPS),
    ("icobench", "https://b/foo", BENCH),
    ("icomarks", "https://m/foo", MARKS),
    ("icoratings", "https://r/foo", RATING),
    ("icoratings", "https://r/foo/details", RATING_DETAILS),
    ("tokentops", "https://t/foo", TOPS),
    ("trackico", "https://k/foo", TRACK),
    ("icobazaar", "https://z/foo", BAZAAR),
    ("icobazaar", "https://z/foo/community", BAZAAR_COMMUNITY),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "source string, url string, html string")


@pytest.fixture(scope="module")
def profiles(pages):
    return {r.source: r for r in build_profiles(pages, AS_OF).collect()}


def fields(row, *names):
    return tuple(str(row[n]) if row[n] is not None else None for n in names)


def test_one_profile_per_source(profiles):
    assert len(profiles) == 7
    assert {r.name for r in profiles.values()} == {"Foo Coin"}
    assert {s for s, r in profiles.items() if r.ticker != "FOO"} == {"icobazaar"}


def test_drops(profiles):
    r = profiles["icodrops"]
    assert fields(r, "ico_url", "whitepaper", "web_page", "description", "logo") == (
        "https://d/foo", "https://foo.io/wp.pdf", "https://foo.io", "All about foo.", "https://icodrops.com/logo.png",
    )
    assert fields(r, "telegram_page", "github_page") == ("https://t.me/foo", None)
    assert (r.hype_score, r.risk_score, r.website_overall_rating) == (7.5, None, 10.0)
    assert fields(r, "status", "ico_start", "ico_end") == ("ended", "2017-08-02", "2017-09-05")
    assert (r.whitelist, r.kyc, r.countries_restricted) == (True, None, "USA, CHN")


def test_bench(profiles):
    r = profiles["icobench"]
    assert fields(r, "description", "logo", "web_page", "twitter_page") == ("A description.", "https://icobench.com/l.png", "https://foo.io", None)
    assert (r.website_overall_rating, r.ico_profile_score, r.team_score) == (8.2, 4.5, 6.0)
    assert fields(r, "ico_start", "ico_end", "pre_ico_start", "pre_ico_end") == ("2018-06-01", "2018-07-01", "2017-08-01", "2017-08-22")
    assert (r.status, r.kyc, r.whitelist, r.country) == ("active", True, False, "GBR")


def test_marks(profiles):
    r = profiles["icomarks"]
    assert (r.website_overall_rating, r.team_score, r.status, r.country) == (7.2, 8.1, "active", "DEU")
    assert fields(r, "web_page", "reddit_page", "telegram_page", "logo") == (
        "https://foo.io", "https://www.reddit.com/r/foo", "t.me/foo", "https://icomarks.com/i.png",
    )
    assert (r.kyc, r.whitelist, r.description) == (False, True, "Text")


def test_rating_on_two_pages(profiles):
    r = profiles["icoratings"]
    assert (r.ico_url, r.risk_score, r.hype_score, r.roi_score) == ("https://r/foo", 4.0, None, 7.5)
    assert fields(r, "ico_start", "ico_end", "status") == ("2018-08-01", "2018-09-01", "upcoming")
    assert (r.countries_restricted, r.description, r.logo) == ("KOR", "Words", "https://icorating.com/pic.png")
    assert r.btc_page == "https://bitcointalk.org/index.php?topic=7.0"


def test_tops(profiles):
    r = profiles["tokentops"]
    assert (r.website_overall_rating, r.user_review_score, r.raised, r.description) == (None, 7.7, "$5", "About")
    assert r.twitter_page == "https://twitter.com/foo"


def test_track(profiles):
    r = profiles["trackico"]
    assert fields(r, "ico_start", "ico_end", "status", "country") == ("2018-02-01", "2018-04-03", "ended", "PER")
    assert fields(r, "web_page", "slack_page", "logo") == ("https://foo.io", "https://s", "data:image/png;base64,AA")
    assert r.website_overall_rating == 7.0


def test_bazaar_on_two_pages(profiles):
    r = profiles["icobazaar"]
    assert (r.website_overall_rating, r.team_score, r.telegram_page) == (9.0, 8.5, "https://t.me/foo")
    assert fields(r, "ico_start", "status", "logo") == ("2018-06-01", "active", "https://cdn/x.png")


def test_unmapped_labels(pages):
    found = extract(shred(pages.where("source in ('icodrops', 'icobazaar')"), index=True), PACKS)
    assert {r.label for r in unmapped_labels(found, "source").collect()} == {"ODD:", "odd", "zzz"}


def test_listing_links(spark):
    html = [
        ("icobench", '<a class="image" href="/ico/a">x</a><a class="image">y</a><a href="/z">z</a>'),
        ("icoratings", '<table><tr data-href="/ico/b"><td>x</td></tr><tr><td>y</td></tr></table>'),
        ("tokentops", '<a target="_blank" href="/no">n</a><div class="upcoming-sec__main"><a target="_blank" href="https://t/c">x</a></div>'),
    ]
    df = spark.createDataFrame(html, "source string, html string")
    got = {(r.source, r.url) for r in listing_links(shred(df), PACKS).collect()}
    assert got == {("icobench", "https://icobench.com/ico/a"), ("icoratings", "https://icorating.com/ico/b"), ("tokentops", "https://t/c")}


def test_shredder_forgives(spark):
    html = '<html><p>one<b>two<p>three</i><ul><li>a<li>b &amp; c</ul><script>var t="</p><p>x";</script><!-- <p>no</p> --><br>end'
    df = spark.createDataFrame([(1, html), (2, None), (3, "plain")], "id int, html string")
    rows = {(r.id, r.pos): r for r in element_table(shred(df), "id").collect()}
    tags = [rows[1, i].tag for i in range(9)]
    assert tags == ["html", "p", "b", "p", "ul", "li", "li", "script", "br"]
    assert [rows[1, i].parent_pos for i in range(9)] == [None, 0, 1, 0, 0, 4, 4, 0, 0]
    assert rows[1, 6].own_text == "b & c" and rows[1, 7].own_text == "" and rows[1, 0].own_text == "end"
    assert rows[1, 1].next_pos == 3 and rows[1, 5].next_pos == 6
    texts = shred(df).select("id", F.transform("elements", lambda e: text_of(F.col("texts"), e)).alias("t"), F.transform("elements", lambda e: own_text_of(F.col("texts"), e)).alias("o"))
    first = {r.id: r for r in texts.collect()}
    assert first[1].t[1] == "onetwo" and first[1].o[1] == "one" and first[2].t == [] and first[3].t == []


def test_shredder_survives_anything(spark):
    odd = [
        "<![if mso]><p>a</p><![endif]><![x",
        "<p>x<![CDATA[ y ]]>z",
        "<!DOCTYPE [<!ELEMENT a>]><p>q",
        "<a href=x href=y disabled>&#xD800;&#9999999;&bogus;</a></a></p>",
        "<" * 2000 + "p" + ">" * 2000,
        "<b>" * 3000 + "deep" + "</i>" * 3000,
        "<p><b>" * 2000,
        "\u0000<p>\u0000</p>",
        "<script>never closed <p>",
        "<td>" * 50 + "</table>",
    ]
    df = spark.createDataFrame(list(enumerate(odd)), "id int, html string")
    rows = shred(df).select("id", F.size("elements").alias("n"), F.array_max(F.transform("elements", lambda e: e["depth"])).alias("d")).collect()
    got = {r.id: r for r in rows}
    assert len(got) == len(odd)
    assert got[5].n == 3000 and got[5].d == 2999
    assert got[3].n == 1 and got[8].n == 1


def test_unreadable_page_does_not_stop_the_rest():
    class Broken(shredder._PageReader):
        def feed(self, data):
            raise AssertionError("no")

    page = shredder._PageReader().read("<p class=x>a<b>c")
    assert Broken().read("<p>") is None
    elements, texts = shredder._arrow_columns([page, None, page, ([], [])])
    assert [len(x) if x is not None else None for x in elements.to_pylist()] == [2, None, 2, 0]
    assert [x and [p["piece"] for p in x] for x in texts.to_pylist()] == [["a", "c"], None, ["a", "c"], []]


def test_native_text_equals_shredded(spark):
    from entityloom.sources.tables import read_table

    pages = read_table(spark, "/root/testdata/sf0.001", "pages")
    e, x = F.col("elements"), F.col("texts")
    got = shred(pages, drop_html=False).select("html", take(e, x, find(e, x, Sel("h1")), "text").alias("h1")).collect()
    for r in got:
        raw = r.html.split("<h1>")[1].split("</h1>")[0]
        assert r.h1 == unescape(raw).strip()


def test_community_parts(spark):
    post = '<div class="top-matter"><p class="tagline">by <a>{}</a></p><ul><li class="first"><a>{}</a></li></ul></div>'
    html = "".join(post.format(*p) for p in [("ann", "12 comments"), ("bob", "comment"), ("ann", "3 comments")])
    df = spark.createDataFrame([("https://x/r/foo", html)], "url string, html string")
    posts = enrich.community_posts(shred(df))
    karma = spark.createDataFrame([("ann", 10), ("bob", 0)], "author string, karma long")
    assert enrich.community_figures(posts, karma).first().asDict() == {
        "url": "https://x/r/foo", "rdt_post_count": 3, "rdt_comment_count": 15, "rdt_usr_avg_karma": 10,
    }
    nav = '<a class="navPages" href="https://f/index.php?topic=7.20">2</a><a class="navPages" href="https://f/index.php?topic=7.40">3</a>'
    first = spark.createDataFrame([("https://f/index.php?topic=7.0", nav), ("https://f/x", nav)], "url string, html string")
    assert [r.page_url[-4:] for r in enrich.thread_offsets(shred(first)).orderBy("page_offset").collect()] == ["=7.0", "7.20", "7.40"]


def test_means(spark):
    authors = spark.createDataFrame([("u", a) for a in "abcd"], "url string, author string")
    karma = spark.createDataFrame([("a", 10), ("b", 0), ("d", 5)], "author string, karma long")
    assert enrich.mean_reputation(authors, karma).first().rdt_usr_avg_karma == 7
    negative = karma.selectExpr("author", "-karma as karma")
    assert enrich.mean_reputation(authors, negative).first().rdt_usr_avg_karma == -8
    pages = spark.createDataFrame([("t", 3, 2), ("t", 4, 1), ("t", None, 9), ("z", 0, 4)], "thread string, page_mean long, n_comments long")
    assert [tuple(r) for r in enrich.thread_figures(pages).collect()] == [("t", 3, 3)]


def test_full_run(spark, pages, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "url string, html string")
    post = '<div class="top-matter"><p class="tagline"><a>ann</a></p><ul><li class="first"><a>4 comments</a></li></ul></div>'
    community = Community(
        member_pages=frame([("t.me/foo", '<div class="tgme_page_extra"> 12 345 members</div>')]),
        post_pages=frame(
            [
                ("https://www.reddit.com/r/foo", post + '<span class="next-button"><a href="https://www.reddit.com/r/foo?after=1">n</a></span>'),
                ("https://www.reddit.com/r/foo?after=1", post),
                ("https://www.reddit.com/r/other", post),
                ("https://www.reddit.com/user/x", post),
            ]
        ),
        author_pages=frame([("https://www.reddit.com/user/ann", "<span>1,234 Karma</span>")]),
        thread_pages=frame([("https://bitcointalk.org/index.php?topic=7.0", "Activity: 10 Activity: 3"), ("https://bitcointalk.org/index.php?topic=7.20", "Activity: 1")]),
    )
    crawled = pages.select(
        "source", "url", F.lit("text/html; charset=utf-8").alias("content_type"), F.encode("html", "utf-8").alias("body")
    )
    broken = spark.createDataFrame([("icomarks", "https://m/bad", "text/html", bytearray(b"\xff\xfe\x80")), ("nobody", "https://n/x", None, bytearray(b"<p>"))], PAGE_BYTES_SCHEMA)
    crawled = crawled.unionByName(broken)
    orphan = spark.createDataFrame([("icoratings", "https://i/lost/details", "text/html", bytearray(b"<p>x"))], PAGE_BYTES_SCHEMA)
    crawled = crawled.unionByName(orphan)
    paths = full_run(crawled, community, AS_OF, str(tmp_path), "r1")
    read = {name: spark.read.parquet(path).collect() for name, path in paths.items()}
    assert [len(v) for v in read.values()] == [1] * 6
    assert read["tokens"][0].source == "icomarks" and read["tokens"][0].id == 1
    assert read["social_pages"][0].teleg_subs_count == 12345
    assert read["subreddits"][0].rdt_usr_avg_karma == 1234 and read["subreddits"][0].rdt_comment_count == 8
    assert (read["bitcointalk"][0].btc_avg_activ, read["bitcointalk"][0].btc_num_comments) == (3, 3)
    n_profiles = spark.read.parquet(str(tmp_path / "by_source")).count()
    assert n_profiles == 7
    refused = spark.read.parquet(str(tmp_path / "rejects")).collect()
    rejected = {(r.source, r.field): r.reason for r in refused}
    assert {
        ("icomarks", "body"), ("nobody", "page"), ("icoratings", "page"), ("icodrops", "ODD:"), ("icobazaar", "odd"), ("icobazaar", "zzz"),
    } <= set(rejected)
    counts = {r.stage: r.n_rows for r in spark.read.parquet(str(tmp_path / "counts")).collect()}
    assert counts["pages"] == crawled.count() and counts["profiles"] == n_profiles
    n_records = sum(r.field == "record" for r in refused)
    assert counts["profiles"] == counts["profiles_valid"] + n_records
    # Every page is in a profile, or the second page of one, or rejected.
    n_pages = sum(r.field in ("body", "page") for r in refused)
    n_second = crawled.where("endswith(url, '/details') or endswith(url, '/community')").count() - 1
    assert counts["pages"] == n_profiles + n_second + n_pages
    # The same crawl twice, as batches of a stream, gives the same tables.
    times = crawled.withColumn("fetched_at", F.lit("2018-06-01").cast("timestamp"))
    old = times.withColumn("body", F.encode(F.lit("<p>old"), "utf-8")).withColumn("fetched_at", F.lit("2018-05-01").cast("timestamp"))
    files, state = str(tmp_path / "files"), str(tmp_path / "state")
    twice = Community(*(p.unionByName(p) for p in vars(community).values()))
    for k, batch in enumerate((old.unionByName(times), times)):
        batch.write.mode("append").parquet(files)
        stream = spark.readStream.schema(times.schema).parquet(files)
        again = refresh_run(stream, state, str(tmp_path / "check"), twice, AS_OF, str(tmp_path / f"again{k}"), "r1")
    assert {n: spark.read.parquet(p).collect() for n, p in again.items()} == read
    snapshot = tmp_path / "stage=threads" / "run_ts=r1"
    row = spark.read.option("header", True).csv(str(snapshot)).first()
    assert row.__fields__ == list(CSV_FIELDS)
    assert (row.rdt_post_count, row.kyc, row.slack_page, row.team_score) == ("2", "no", "https://s", "8.1")


def test_empty_stage_is_an_error(spark, tmp_path):
    with pytest.raises(EmptyOutput):
        write_stage(spark.range(0), str(tmp_path), "members", "r1")


def test_csv_order_covers_all_fields():
    assert sorted(CSV_FIELDS) == sorted(FIELDS)


@pytest.mark.parametrize("n", [600, 5_000, 50_000])
def test_any_depth(n):
    """Text stays with its element, and the time is linear: 50,000 levels take well under a second of a minute."""
    start = time.perf_counter()
    elements, texts = shredder._PageReader().read("lead" + "<div>" * n + "<b>hello</b>" + "<p>x" * 50 + "</div>" * n + "tail")
    assert time.perf_counter() - start < 20
    b = next(e for e in elements if e[5] == "b")
    assert b[4] == n and [t for t in texts if t[0] == b[0]] == [(b[0], "hello")]
    assert [t for o, t in texts if o is None] == ["lead", "tail"]
    assert elements[0][3] == len(elements) - 1 and all(e[4] == i for i, e in enumerate(elements[:n]))


def test_implied_ends_stop_at_their_stops():
    elements, _ = shredder._PageReader().read("<p>a<table><td><p>b<p>c</td></table><p>d<ul><li>e<ul><li>f</ul><li>g</ul>")
    assert [(e[5], e[1]) for e in elements] == [
        ("p", None), ("table", None), ("td", 1), ("p", 2), ("p", 2), ("p", None), ("ul", None), ("li", 6), ("ul", 7), ("li", 8), ("li", 6),
    ]


class _ByBase(shredder._PageReader):
    """Every tag read by the base class."""

    def _plain_tags(self, i):
        return i


ODD_PIECES = (
    "<div>", "</div>", "<P>", "<p class=x>", "<p class='a b' id=\"q\">", "<li>", "</ul>", "<br/>", "<script>", "</script>", "x<y", "a &amp; b", "\n",
    "<title>", "</title>", "<!-- c -->", "<![if x]>", "<a href=x/>", "<a href='x>y'>", '<a href="a&amp;b">', "<a href>", '<a href="">', "<a x=1 x=2>",
    '<a x="1"y=2>', "<a\tb=c\n>", "<a\x0bb=c>", "<a\xa0b=c>", "</div x>", "</ div>", "</>", "<", '<a b="c', "&#", "<a:b>", "<a b=c'd>", "<a b=c/ d=e>",
)


def test_plain_tags_are_read_as_the_base_class_reads_them():
    pick = random.Random(3)
    for _ in range(3000):
        page = "".join(pick.choice(ODD_PIECES) for _ in range(pick.randint(1, 20)))
        elements, texts = shredder._PageReader().read(page)
        assert (elements, texts) == _ByBase().read(page), page
        assert [list(e[6]) for e in elements] == [list(e[6]) for e in _ByBase().read(page)[0]], page


def test_plain_tags_skip_the_steps_of_the_base_class(monkeypatch):
    calls = []
    for name in ("parse_starttag", "parse_endtag"):
        base = getattr(HTMLParser, name)
        monkeypatch.setattr(HTMLParser, name, lambda self, i, base=base: calls.append(i) or base(self, i))
    shredder._PageReader().read("<div class=a>" * 600 + "<b id='x'>w</b>p" + "</div>" * 600 + "tail")
    assert not calls


def test_a_value_is_read_once(spark):
    """Inside a lambda an expression that names a text twice makes Spark read it twice."""
    page = spark.createDataFrame([("<h1>a</h1>", "s")], "html string, source string")
    rules = SourceRules("s", "http://x", (Rule(Sel("h1"), Part(steps=("upper",)), to="name"),), (Sel("a"), "href", ()))
    values = spark.createDataFrame([(" a ",), ("  ",), (None,)], "x string")
    once = values.select(F.transform(F.array("x"), lambda t: known_value(F.concat(t, F.lit("")))).alias("v"))
    assert [r.v[0] for r in once.collect()] == ["a", None, None]
    assert once._jdf.queryExecution().optimizedPlan().toString().count("concat(") == 1
    assert extract(shred(page, index=True), (rules,)).first()["raw"] == {"name": "A"}
