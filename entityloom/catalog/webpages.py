"""Queries on crawled pages: scans, links, elements and labelled fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.catalog.registry import Tables, greedy_sql, query
from entityloom.functions import urls
from entityloom.functions import text as tx
from entityloom.operators import links
from entityloom.operators.extract import (
    STEPS,
    Move,
    Part,
    Rule,
    Sel,
    SourceRules,
    classify,
    extract,
    find,
    find_all,
    listing_links,
    read_part,
    take,
    unmapped_labels,
)
from entityloom.operators.packs import BAZAAR_ICONS, BENCH, MARKS, PACKS, RATING, TRACK_TOKENS
from entityloom.operators.shred import element_table, own_text_of, register_page_elements, shred
from entityloom.plans.consolidate import consolidate
from entityloom.plans.profiles import OUTCOME_SCHEMA, build_profiles, extract_sources, merge_order
from entityloom.session import staged
from entityloom.sources.pages import decode_pages
from entityloom.streaming.refresh import latest_pages

TOPICS = {"THE": "topic_the", "AND": "topic_and", "LE": "topic_le", "DE": "topic_de", "LA": "topic_la", "EN": "topic_en", "OF": "topic_of"}
NAV = Sel("nav")
PAGE_RULES = SourceRules(
    "page",
    "http://pages.example.com",
    (
        Rule(Sel("title"), to="title", first_only=True),
        Rule(Sel("a"), Part(take="@href"), Part(steps=("upper",)), TOPICS, within=(NAV,)),
        Rule(Sel("a"), Part(take="@href"), to="first_link", within=(NAV,), first_only=True),
        Rule(Sel("html"), Part(take="@lang"), to="lang", first_only=True),
        Rule(NAV, Part((Move("following", Sel("div", ("ad",))),)), to="ad", first_only=True),
    ),
    listing=(Sel("a", attrs={"href": None}), "href", (NAV,)),
)
_DECODED = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), "
    "'&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"
)
_TITLE = _DECODED.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")
_H1 = _DECODED.format("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")
_BLANKS = "E' \\t\\n\\r\\f\\x0b' || chr(160)"
_NAV = "regexp_extract(html, '<nav>(.*?)</nav>', 1, 's')"
_NAV_HREFS = f"""regexp_extract_all({_NAV}, '<a href="([^"]*)">([^<]*)</a>', 1)"""
_NAV_TEXTS = f"""regexp_extract_all({_NAV}, '<a href="([^"]*)">([^<]*)</a>', 2)"""
_AD = _DECODED.format("""regexp_extract(html, '<div class="ad">([^<]*)</div>', 1)""")
_HREFS = """regexp_extract_all(html, '<a[^>]*\\shref="([^"]*)"', 1)"""


# --- scans ----------------------------------------------------------------


@query("""select page_id, url, length(html) as n_chars from pages""")
def scan_pages(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@query(
    """select page_id, url, case page_id % 5 when 1 then regexp_replace(html, '[^\\x00-\\x7F]', 'é', 'g')
         when 4 then null else html end as html from pages"""
)
def decode_bodies(t: Tables) -> DataFrame:
    """Bodies as UTF-8 (declared, undeclared, unknown name), Latin-1, and one that is not valid UTF-8."""
    kind = F.col("page_id") % 5
    latin = F.encode(F.regexp_replace("html", r"[^\x00-\x7F]", "é"), "ISO-8859-1")
    utf8 = F.encode("html", "UTF-8")
    crawled = t.pages.select(
        "page_id",
        "url",
        F.when(kind == 0, "text/html; charset=UTF-8")
        .when(kind == 1, "text/html; charset=ISO-8859-1")
        .when(kind == 2, "text/html")
        .when(kind == 3, "text/html; charset=x-none")
        .otherwise("text/html; charset=utf-8")
        .alias("content_type"),
        F.when(kind == 1, latin).when(kind == 4, F.concat(F.unhex(F.lit("FFFE80")), utf8)).otherwise(utf8).alias("body"),
    )
    return decode_pages(crawled).drop("content_type")


# --- links ----------------------------------------------------------------


@query(f"""select page_id, unnest(range(len(hs))) as pos, unnest(hs) as href from (select page_id, {_HREFS} as hs from pages)""")
def page_links(t: Tables) -> DataFrame:
    found = t.pages.select("page_id", F.posexplode(links.hrefs(F.col("html"))).alias("pos", "href"))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@query(f"""select page_id, 'page' as source, 'http://pages.example.com' || unnest(hs) as url from (select page_id, {_NAV_HREFS} as hs from pages)""")
def listing_profiles(t: Tables) -> DataFrame:
    """Profile links of listing pages by the source's own rule, made absolute."""
    shredded = shred(t.pages.select("page_id", F.lit("page").alias("source"), "html"))
    return listing_links(shredded, (PAGE_RULES,), keep=("page_id",))


@query(
    f"""with l as (select page_id, url, unnest({_HREFS}) as h from pages),
         f as (select page_id, url, unnest([h, h[2:], '?q=1', '#top', '//cdn.example.com' || h, 'https://x.example.com' || h, '/a/.././b' || h]) as link,
                 regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as root,
                 regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as path from l)
       select page_id, link, case
         when regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') then link
         when starts_with(link, '//') then regexp_extract(url, '^([a-z]+:)', 1) || link
         when starts_with(link, '?') then root || path || link
         when starts_with(link, '#') then split_part(url, '#', 1) || link
         when starts_with(link, '/a/.././b') then root || '/b' || link[10:]
         when starts_with(link, '/') then root || link
         else root || coalesce(nullif(regexp_extract(path, '^(.*/)', 1), ''), '/') || link end as url
       from f where link <> ''"""
)
def links_resolved(t: Tables) -> DataFrame:
    found = t.pages.select("page_id", F.col("url").alias("base"), F.explode(links.hrefs(F.col("html"))).alias("h"))
    forms = F.array(
        F.col("h"),
        F.substring("h", 2, 1 << 30),
        F.lit("?q=1"),
        F.lit("#top"),
        F.concat(F.lit("//cdn.example.com"), "h"),
        F.concat(F.lit("https://x.example.com"), "h"),
        F.concat(F.lit("/a/.././b"), "h"),
    )
    each = found.select("page_id", "base", F.explode(forms).alias("link")).where("link <> ''")
    return each.select("page_id", "link", urls.resolve(F.col("base"), F.col("link")).alias("url"))


@query("""select page_id, length(html)::int as total, (page_id % 7 * 20)::int as last_offset from pages""")
def page_count(t: Tables) -> DataFrame:
    total = links.total_of(F.concat(F.lit("1 - 24 of "), F.length("html").cast("string"), F.lit(" items")))
    ids = F.col("page_id")
    thread = lambda n: F.concat(F.lit("index.php?topic="), ids.cast("string"), F.lit("."), n.cast("string"))
    offsets = F.array(thread(F.lit(0)), thread(ids % 7 * 20), F.lit("index.php?topic=x.new"))
    return t.pages.select("page_id", total.alias("total"), links.largest_suffix(offsets).alias("last_offset"))


@query(
    """select page_id, unnest(list_concat([url], list_transform(range(2, ceil(length(html) / 24)::int + 1), lambda i: url || '/' || i || '/'))) as page_url
       from pages"""
)
def page_urls(t: Tables) -> DataFrame:
    """The root page and pages 2..ceil(n / 24)."""
    roots = t.pages.select("page_id", "url", links.pages_needed(F.length("html"), 24).alias("last"))
    more = links.numbers_exploded(roots, "i", 2, "last", block=16)
    numbered = more.select("page_id", F.concat("url", F.lit("/"), F.col("i").cast("string"), F.lit("/")).alias("page_url"))
    return roots.select("page_id", F.col("url").alias("page_url")).unionByName(numbered)


@query(f"""select regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host, unnest({_HREFS}) as href from pages""")
def links_flat(t: Tables) -> DataFrame:
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    return t.pages.select(host.alias("host"), F.explode(links.hrefs(F.col("html"))).alias("href"))


@query(f"""select distinct regexp_extract(url, '([a-z]+)(\\?|#|/|$)', 1) as source, unnest({_HREFS}) as url from pages""")
def links_distinct(t: Tables) -> DataFrame:
    source = F.regexp_extract("url", r"([a-z]+)(\?|#|/|$)", 1)
    found = t.pages.select(source.alias("source"), F.explode(links.hrefs(F.col("html"))).alias("url"))
    return links.distinct_links(found)


@query(f"""select page_id, href from (select page_id, unnest({_HREFS}) as href from pages) order by href, page_id limit 40""")
def links_capped(t: Tables) -> DataFrame:
    found = t.pages.select("page_id", F.explode(links.hrefs(F.col("html"))).alias("href"))
    return links.capped(found, 40, "href", "page_id")


@query("""select doc_id, quality, lang from documents join labels using (doc_id) where nullif(quality, 0) is not null""")
def failures_dropped(t: Tables) -> DataFrame:
    graded = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", tx.zero_to_null(F.col("quality")).alias("quality")), "doc_id", "left")
    return links.keep_known(graded, "quality").select("doc_id", "quality", "lang")


@query(
    """with recursive walk as (
         select conv_id, turn, 0::bigint as hop from conversations where turn = 0
         union all select c.conv_id, c.turn, hop + 1 from walk w join conversations c on c.conv_id = w.conv_id and c.turn = w.turn + 1)
       select 'c' || conv_id || '?t=0' as start, 'c' || conv_id || '?t=' || turn as url, hop from walk"""
)
def next_chain(t: Tables) -> DataFrame:
    address = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("?t="), turn.cast("string"))
    pages = t.conversations.select(address(F.col("turn")).alias("url"), address(F.col("turn") + 1).alias("next_url"), "turn")
    twice = pages.unionByName(pages)  # a table of crawls holds pages more than once
    return links.follow_next(twice, "url", "next_url", twice.where("turn = 0"))


# --- elements -------------------------------------------------------------


def shredded_pages(t: Tables) -> DataFrame:
    return shred(t.pages)


@query(
    """select page_id, tag, count(*) as n from (select page_id, unnest(regexp_extract_all(
         regexp_replace(regexp_replace(html, '<script>.*?</script>', '<script>', 'gs'), '<style>.*?</style>', '<style>', 'gs'),
         '<([a-z0-9]+)[^>]*>', 1)) as tag from pages) group by all"""
)
def shred_elements(t: Tables) -> DataFrame:
    """Element rows, counted by page and tag."""
    rows = element_table(shredded_pages(t), "page_id")
    return rows.groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(
    """select page_id, (600 + page_id % 300)::int as depth, 'w' || regexp_replace(url, '[^a-z0-9]', '', 'g') as word,
         'p' || page_id as outer_text, 'tail' || page_id as top_text from pages"""
)
def deep_nesting(t: Tables) -> DataFrame:
    """Text at the bottom of 600 to 899 open elements, beside them, and outside any element."""
    n = (F.lit(600) + F.col("page_id") % 300).cast("int")
    word = F.concat(F.lit("w"), F.regexp_replace("url", "[^a-z0-9]", ""))
    number = F.col("page_id").cast("string")
    html = F.concat(
        F.repeat(F.lit("<div>"), n), F.lit("<b>"), word, F.lit("</b>p"), number, F.repeat(F.lit("</div>"), n), F.lit("tail"), number
    )
    e, x = F.col("elements"), F.col("texts")
    top = F.array_join(F.transform(F.filter(x, lambda p: p["owner"].isNull()), lambda p: p["piece"]), "")
    b = find(e, x, Sel("b"))
    return shred(t.pages.select("page_id", html.alias("html"))).select(
        "page_id",
        b["depth"].alias("depth"),
        own_text_of(x, b).alias("word"),
        own_text_of(x, F.get(e, b["parent"])).alias("outer_text"),
        top.alias("top_text"),
    )


@query(
    """select page_id, unnest(range(len(hs))) as link_no, unnest(hs) as href, unnest(ws) as word from (
         select page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) as hs,
           regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) as ws from pages)"""
)
def elements_in_sql(t: Tables) -> DataFrame:
    """The shredder as a table function in SQL."""
    register_page_elements(t.spark)
    links_ = t.spark.sql(
        """select key as page_id, pos, attrs['href'] as href, own_text as word
           from page_elements(table(select page_id, html from {pages})) where tag = 'a'""",
        pages=t.pages,
    )
    number = F.row_number().over(Window.partitionBy("page_id").orderBy("pos")) - 1
    return links_.select("page_id", number.cast("bigint").alias("link_no"), "href", "word")


@query(f"""select page_id, trim({_TITLE}, {_BLANKS}) as title, trim({_H1}, {_BLANKS}) as heading from pages""")
def element_text(t: Tables) -> DataFrame:
    e, x = F.col("elements"), F.col("texts")
    text = lambda sel: take(e, x, find(e, x, sel), "text")
    return shredded_pages(t).select("page_id", text(Sel("title")).alias("title"), text(Sel("h1")).alias("heading"))


@query(
    """select page_id, regexp_extract(html, '<html lang="([a-z]*)"', 1) as lang, regexp_extract(html, '<meta charset="([^"]*)"', 1) as charset,
         regexp_extract(html, '<nav>.*?<a href="([^"]*)"', 1, 's') as first_link from pages"""
)
def element_attr(t: Tables) -> DataFrame:
    e, x = F.col("elements"), F.col("texts")
    attr = lambda sel, name, *within: take(e, x, find(e, x, sel, within), f"@{name}")
    return shredded_pages(t).select(
        "page_id",
        attr(Sel("html"), "lang").alias("lang"),
        attr(Sel("meta"), "charset").alias("charset"),
        attr(Sel("a"), "href", NAV).alias("first_link"),
    )


@query(f"""select page_id, trim({_AD}, {_BLANKS}) as ad, 'article' as after_ad, 'body' as above_nav from pages""")
def sibling_value(t: Tables) -> DataFrame:
    """Sibling and parent of a matched element."""
    e, x = F.col("elements"), F.col("texts")
    nav = find(e, x, NAV)
    ad = Sel("div", ("ad",))
    return shredded_pages(t).select(
        "page_id",
        read_part(e, x, nav, Part((Move("following", ad),))).alias("ad"),
        F.get(e, find(e, x, ad)["next"])["tag"].alias("after_ad"),
        F.get(e, nav["parent"])["tag"].alias("above_nav"),
    )


@query(f"""select page_id, len({_NAV_HREFS}) as n_links from pages""")
def elements_with_attribute(t: Tables) -> DataFrame:
    e, x = F.col("elements"), F.col("texts")
    found = find_all(e, x, Sel("a", attrs={"href": None}), (NAV,))
    return shredded_pages(t).select("page_id", F.size(found).cast("bigint").alias("n_links"))


_TOPIC_SQL = ", ".join(
    f"list_filter(list_zip(hs, ts), lambda p: upper(trim(p[2])) = '{word}')[-1][1] as {field}" for word, field in TOPICS.items()
)


@query(
    f"""select page_id, nullif(trim({_TITLE}, {_BLANKS}), '') as title, hs[1] as first_link, nullif(trim({_AD}, {_BLANKS}), '') as ad,
          regexp_extract(html, '<html lang="([a-z]*)"', 1) as lang, {_TOPIC_SQL}
        from (select *, {_NAV_HREFS} as hs, {_NAV_TEXTS} as ts from pages)"""
)
def labelled_fields(t: Tables) -> DataFrame:
    """Rules as data over whole pages: labels, first matches, attributes and siblings."""
    pages = t.pages.select("page_id", F.lit("page").alias("source"), "html")
    raw = extract(shred(pages, index=True), (PAGE_RULES,))
    names = ["title", "first_link", "ad", "lang", *TOPICS.values()]
    return raw.select("page_id", *[F.try_element_at("raw", F.lit(n)).alias(n) for n in names])


@query(
    f"""select page_id, upper(replace(trim(t[2]), 'ß', 'ss')) as label, t[1] as value from
          (select page_id, unnest(list_zip({_NAV_HREFS}, {_NAV_TEXTS})) as t from pages)
        where upper(trim(t[2])) not in ({", ".join(f"'{w}'" for w in TOPICS)})"""
)
def unknown_labels(t: Tables) -> DataFrame:
    """Labelled values that feed no field: the rejects of an extraction."""
    pages = t.pages.select("page_id", F.lit("page").alias("source"), "html")
    return unmapped_labels(extract(shred(pages, index=True), (PAGE_RULES,)), "page_id")


@query(
    f"""select page_id, coalesce({", ".join(f"list_filter(list_zip(hs, ts), lambda p: upper(trim(p[2])) = '{w}')[-1][1]" for w in ("THE", "LE", "DE"))}, hs[1], '-') as link
        from (select page_id, {_NAV_HREFS} as hs, {_NAV_TEXTS} as ts from pages)"""
)
def fallback(t: Tables) -> DataFrame:
    """Candidate labels in order, then the first link."""
    pages = t.pages.select("page_id", F.lit("page").alias("source"), "html")
    raw = extract(shred(pages, index=True), (PAGE_RULES,))
    candidates = [F.try_element_at("raw", F.lit(n)) for n in ("topic_the", "topic_le", "topic_de", "first_link")]
    return raw.select("page_id", F.coalesce(*candidates, F.lit("-")).alias("link"))


# --- link classes ---------------------------------------------------------


def _case(expr: str, targets: dict[str, str]) -> str:
    return f"case {expr} " + " ".join(f"when '{k}' then '{v}'" for k, v in targets.items()) + " end"


@query(
    f"""select page_id, href, {_case("upper(trim(word))", TOPICS)} as field from
          (select page_id, unnest({_NAV_HREFS}) as href, unnest({_NAV_TEXTS}) as word from pages)"""
)
def classify_text(t: Tables) -> DataFrame:
    pattern = r'<a href="([^"]*)">([^<]*)</a>'
    nav = F.regexp_extract("html", r"(?s)<nav>(.*?)</nav>", 1)
    pairs = F.arrays_zip(
        F.regexp_extract_all(nav, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(nav, F.lit(pattern), F.lit(2)).alias("word")
    )
    found = t.pages.select("page_id", F.explode(pairs).alias("p")).select("page_id", "p.*").toDF("page_id", "href", "word")
    return found.select("page_id", "href", classify(F.upper(tx.strip(F.col("word"))), TOPICS).alias("field"))


HOSTS = {"example.com": "web_page", "example.org": "facebook_page", "example.net": "twitter_page"}


@query(
    f"""select page_id, regexp_extract(url, '([a-z]+\\.[a-z]+)([/?#:]|$)', 1) as host,
          {_case("regexp_extract(url, '([a-z]+[.][a-z]+)([/?#:]|$)', 1)", HOSTS)} as field from pages"""
)
def classify_host(t: Tables) -> DataFrame:
    host = F.substring_index(STEPS["host"](F.col("url")), ".", -2)
    return t.pages.select("page_id", host.alias("host"), classify(host, HOSTS).alias("field"))


_ICON_SQL = "['telegram', 'github', 'none', 'reddit', 'slack'][page_id % 5 + 1]"


@query(f"""select page_id, {_ICON_SQL} as token, {_case(_ICON_SQL, BAZAAR_ICONS)} as field from pages""")
def classify_class(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(n) for n in ("telegram", "github", "none", "reddit", "slack")])
    css = F.concat(F.lit("fab fa-"), F.get(names, (F.col("page_id") % 5).cast("int")), F.lit(" fa-2x"))
    token = STEPS["icon_token"](css)
    return t.pages.select("page_id", token.alias("token"), classify(token, BAZAAR_ICONS).alias("field"))


_TOKEN_SQL = "['twitter', 'blog', null, 'homepage', 'whitepaper'][page_id % 5 + 1]"


@query(f"""select page_id, {_TOKEN_SQL} as token, {_case(_TOKEN_SQL, TRACK_TOKENS)} as field from pages""")
def classify_token(t: Tables) -> DataFrame:
    calls = ("go('link-Twitter');", "go('button-Blog')", "go('twitter')", "go('x-link-Home.Page')", "go('button-White-paper')")
    onclick: Column = F.get(F.array(*[F.lit(c) for c in calls]), (F.col("page_id") % 5).cast("int"))
    token = STEPS["social_token"](onclick)
    return t.pages.select("page_id", token.alias("token"), classify(token, TRACK_TOKENS).alias("field"))


# --- whole profiles -------------------------------------------------------


def part_profile_pages(t: Tables, sources: int = 3) -> DataFrame:
    """Profile pages in the layouts of three or all seven sources, written from the part table."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    day = F.date_add(F.lit("1998-06-01").cast("date"), size)
    score = (size / 10).cast("string")
    shown = lambda d, layout: F.date_format(d, layout)
    end = F.date_add(day, 30)
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    row = lambda label, value: text("<tr><td>", label, "</td><td> ", value, " </td></tr>")
    name = F.col("p_name")
    rating_main = text(
        "<div class=h1><h1>", name, " (", F.col("p_brand"), ")</h1></div><p><span class=title>Risk score</span>",
        "<span class=score>", score, " / 5</span></p><a target=_blank href='http://t.me/p", key, "'>Telegram</a>",
    )
    rating_details = text(
        "<table>", row("Ticker:", text("T", key)), row("ICO start date:", shown(day, "dd.MM.yyyy")),
        row("ICO end date:", shown(end, "dd.MM.yyyy")), row("Odd row:", key), "</table>",
    )
    marks = text(
        "<h1 itemprop=name>", name, "</h1><div class=ico-rating-overall> ", score, " </div><div class=icoinfo>",
        "<div class=icoinfo-block__item><span>Ticker:</span> T", key, "</div><div class=icoinfo-block__item><span>ICO Time:</span> ",
        shown(day, "d MMM yyyy"), " - ", shown(end, "d MMM yyyy"), "</div>",
        "<div class=icoinfo-block__item><span>Country:</span> Germany</div>",
        "<a class=icoinfo-block__view href='http://www.t.me/p", key, "'>x</a></div>",
    )
    bench = text(
        "<div class=name><h1>", name, "</h1><h2>", F.col("p_type"), "</h2></div><div class=rating><div class=distribution>",
        "<div>", score, "<label>Team</label></div></div></div><div itemprop=ratingValue content='", score, "'></div>",
        "<div class=financial_data><label>Time</label><div class=number>5 days</div><small>", shown(day, "yyyy-MM-dd"),
        " - ", shown(end, "yyyy-MM-dd"), "</small><div class=data_row><div>Token</div><div>T", key,
        "</div></div><div class=data_row><div>Country</div><div>UK</div></div></div>",
        "<div class=socials><a title=t href='http://t.me/p", key, " '>Telegram</a></div>",
    )
    drops = text(
        "<div class=ico-main-info><h3> ", name, "</h3></div><div class=token-sale><strong>Token sale ended</strong></div>",
        "<li><span class=grey>Ticker: </span>T", key, "</li><li><span class=grey>Odd: </span>x</li><div class=rating-field>",
        "<div class=rating-box><p>Risk rate\nmore</p><p> Low </p></div><div class=rating-box><p>Hype rate</p></div></div>",
        "<div class=soc_links><a href='http://t.me/p", key, "'><span><i class='fab fa-telegram'></i></span></a></div>",
    )
    tops_row = lambda label, value: text(
        "<div class=page-details__info-row><h3 class=page-details__info-title>", label, "</h3><div class=page-details__info-descr> ", value, "</div></div>"
    )
    tops = text(
        "<h1 class=page-details__title>", name, "</h1><div class=rating_block><span class=rating-text>", score, "</span></div>",
        "<div class=page-details__main><a title=Telegram href='http://t.me/p", key, "'>t</a><a title=Telegram href=x>u</a></div>",
        tops_row("Token symbol", text("T", key)), tops_row("Start date", shown(day, "d MMMM yyyy")), tops_row("Close date", shown(end, "MMMM d, yyyy")),
    )
    track = text(
        "<h1 class=h2>", name, "</h1><div class='fs-60 fw-400 text-primary'>", score, "</div><table><tr><th>Token</th><td>T", key,
        "</td></tr><tr><th>Token Sale</th><td>from ", shown(day, "d.M.yyyy"), " - to ", shown(end, "d.M.yyyy"),
        "</td></tr><tr><th>Country</th><td><a>Peru</a></td></tr></table><div class='flexbox flex-wrap'>",
        "<a href='http://t.me/p", key, "' onclick=\"f('link-Telegram')\">t</a></div>",
    )
    line = lambda label, value: text(
        "<div class=com-sidebar__info-line><span>", label, ":</span><span class=com-sidebar__info-value>", value, "</span></div>"
    )
    bazaar = text(
        "<div class=com-header__info><h1>", name, "</h1><p>", F.col("p_type"), "</p></div><div class=ico-rating rating='", score, "'></div>",
        "<div class=com-sidebar>", line("Start", shown(day, "MMM. d, yyyy")), line("End", shown(end, "yyyy.MM.dd")), "</div>",
        "<div class=com-rating__list><div class=com-rating__list-element><span>Team</span><div class=progress-bar><span style='width: ",
        size.cast("string"), "%'></span></div></div></div>",
    )
    social = text("<div class=com-social><a href=' http://t.me/p", key, "'><i class='fab fa-telegram'></i></a></div>")
    kind = F.col("p_partkey") % sources
    page = lambda source, tail, html: F.struct(F.lit(source).alias("source"), F.concat(F.lit("https://x/p"), key, F.lit(tail)).alias("url"), html.alias("html"))
    layouts = (
        (page("icoratings", "", rating_main), page("icoratings", "/details", rating_details)),
        (page("icomarks", "", marks),),
        (page("icobench", "", bench),),
        (page("icodrops", "", drops),),
        (page("tokentops", "", tops),),
        (page("trackico", "", track),),
        (page("icobazaar", "", bazaar), page("icobazaar", "/community", social)),
    )
    pages = F.when(kind == 0, F.array(*layouts[0]))
    for k in range(1, sources):
        pages = pages.when(kind == k, F.array(*layouts[k]))
    # The scan is small and the work per page is not: spread the keys before the pages are
    # made.  A given number of tasks is not merged again by the size of the rows.
    tasks = max(4 * t.spark.sparkContext.defaultParallelism, 8)
    return t.part.repartition(tasks, "p_partkey").select(F.explode(pages).alias("p")).select("p.*")


def _profiles_sql(sources: int) -> str:
    """The profiles of those pages; in the order of the layouts above."""
    return f"""select * from (with p as (select *, p_partkey % {sources} as k, date '1998-06-01' + p_size as d, p_size / 10.0::double as s from part)
       select ['icoratings', 'icomarks', 'icobench', 'icodrops', 'tokentops', 'trackico', 'icobazaar'][k + 1] as source,
         'https://x/p' || p_partkey as ico_url, p_name as name, case when k <> 6 then 'T' || p_partkey end as ticker,
         case when k <> 3 then d end as ico_start, case when k <> 3 then d + 30 end as ico_end,
         case when k = 3 then 'ended' when date '1998-08-01' < d then 'upcoming' when date '1998-08-01' > d + 30 then 'ended' else 'active' end as status,
         case k when 1 then 'DEU' when 2 then 'GBR' when 5 then 'PER' end as country,
         case when k in (0, 3) then null when k = 1 then s else show1(s * 10 / 5) end as website_overall_rating,
         case k when 0 then show1(s * 10 / 5) when 3 then 2.5 end as risk_score,
         case k when 2 then show1(s * 10 / 5) when 6 then show1(p_size * 10 / 100.0::double) end as team_score,
         case when k = 1 then 'https://www.t.me/p' else 'https://t.me/p' end || p_partkey as telegram_page
       from p)"""


_PROFILES = _profiles_sql(3)
_PROFILE_COLUMNS = (
    "source", "ico_url", "name", "ticker", "ico_start", "ico_end", "status", "country",
    "website_overall_rating", "risk_score", "team_score", "telegram_page",
)


@query(_PROFILES)
def profiles_from_pages(t: Tables) -> DataFrame:
    """Pages of several sources, one of them on two pages each, to typed profiles."""
    packs = (RATING, MARKS, BENCH)
    profiles = build_profiles(part_profile_pages(t), F.lit("1998-08-01").cast("date"), packs)
    return profiles.select(*_PROFILE_COLUMNS)


@query(_profiles_sql(7))
def profiles_of_all_sources(t: Tables) -> DataFrame:
    """Pages of all seven sources, two of them on two pages each, to typed profiles: one plan for all rules."""
    return build_profiles(part_profile_pages(t, 7), F.lit("1998-08-01").cast("date"), PACKS).select(*_PROFILE_COLUMNS)


@query(
    f"""select source, case when source = 'icomarks' then 'failed' else 'done' end as state, count(*) filter (where source <> 'icomarks') as n_profiles,
         count(*) filter (where source = 'icomarks') as n_failed_pages from ({_profiles_sql(7)}) group by all"""
)
def failing_source(t: Tables) -> DataFrame:
    """A source whose rules cannot be evaluated costs its own pages; the six others come through."""
    broken = SourceRules(MARKS.source, MARKS.domain, (Rule(Sel("h1"), Part(steps=("no such step",)), to="name"),), MARKS.listing)
    packs = tuple(broken if p.source == MARKS.source else p for p in PACKS)
    pages, _ = staged(part_profile_pages(t, 7), "pages", partition_by=("source",))
    found = extract_sources(pages, packs)
    outcomes = t.spark.createDataFrame(found.outcomes, OUTCOME_SCHEMA).select("source", "state")
    got = found.profiles.where("raw is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n_profiles"))
    lost = found.failed_pages.groupBy("source").agg(F.count(F.lit(1)).alias("n_failed_pages"))
    zero = F.lit(0).cast("bigint")
    counted = outcomes.join(got, "source", "left").join(lost, "source", "left")
    # A table may be too small to have pages of each source.
    shown = counted.select("source", "state", F.coalesce("n_profiles", zero).alias("n_profiles"), F.coalesce("n_failed_pages", zero).alias("n_failed_pages"))
    return shown.where("n_profiles + n_failed_pages > 0")


@query(_profiles_sql(7))
def late_pages(t: Tables) -> DataFrame:
    """A store that holds each page three times, newest in the middle: the latest fetch is chosen on narrow
    rows, and pages are read where they lie; then as above."""
    pages = part_profile_pages(t, 7)
    day = lambda n: F.lit(f"1998-07-0{n}").cast("timestamp")
    old = lambda n: pages.withColumn("html", F.lit(f"<p>{n}")).withColumn("fetched_at", day(n))
    store, _ = staged(old(1).unionByName(pages.withColumn("fetched_at", day(3))).unionByName(old(2)), "page-store")
    latest = latest_pages(store).drop("fetched_at")
    return build_profiles(latest, F.lit("1998-08-01").cast("date"), PACKS).select(*_PROFILE_COLUMNS)


_ENTITY_FIELDS = ("source", "name", "ticker", "status", "country", "website_overall_rating", "risk_score", "telegram_page")
_ENTITY_BEST = ", ".join(f"arg_min({f}, (prio, rank)) filter (where {f} is not null) as {f}" for f in _ENTITY_FIELDS)


@query(
    f"""with recursive p as ({_PROFILES}),
         r as (select *, row_number() over (order by case source when 'icoratings' then 1 when 'icomarks' then 2 else 3 end, ico_url) as rank,
             case source when 'icomarks' then 0 when 'icoratings' then 3 else 5 end as prio,
             ['n=' || upper(name), 't=' || upper(ticker)] as ks from p),
         {greedy_sql("r")}
       select entity, {_ENTITY_BEST} from r join e using (rank) group by entity"""
)
def entities_from_pages(t: Tables) -> DataFrame:
    """Pages of several sources to merged entities; names are few, so blocks are large.

    Records are taken in reverse order of the sources' turn, then by address.
    """
    profiles = build_profiles(part_profile_pages(t), F.lit("1998-08-01").cast("date"), (RATING, MARKS, BENCH))
    merged = consolidate(merge_order(profiles))
    return merged.select("entity", *_ENTITY_FIELDS)
