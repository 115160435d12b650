"""Queries on single values: text, dates, links, scores, countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.catalog.registry import Tables, query
from entityloom.functions import dates, scores, urls
from entityloom.functions import text as tx
from entityloom.operators import countries
from entityloom.operators.normalize import normalize, score_of
from entityloom.schema import RAW_SCHEMA, SOURCES, conform

def as_of() -> Column:
    return F.lit("1998-08-01").cast("date")



def pick(number: Column, *choices: Column | str) -> Column:
    """The choice at position ``number`` modulo their count."""
    parts = F.array(*[c if isinstance(c, Column) else F.lit(c) for c in choices])
    return F.get(parts, F.pmod(number, F.lit(len(choices))).cast("int"))


def day(name: str) -> Column:
    return F.col(name).cast("date")


def shown(date: Column, layout: str) -> Column:
    return F.date_format(date, layout)


# --- text -----------------------------------------------------------------


@query(
    """select p_partkey, trim(split_part(p_name || ' (' || p_brand || ')', '(', 1)) as label from part"""
)
def before_delim(t: Tables) -> DataFrame:
    shown_name = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    return t.part.select("p_partkey", tx.before(shown_name).alias("label"))


@query(
    """select p_partkey, case when p_size % 3 = 0 then null else p_type end as label
       from part"""
)
def after_colon(t: Tables) -> DataFrame:
    text = F.when(F.col("p_size") % 3 == 0, F.col("p_type")).when(
        F.col("p_size") % 3 == 1, F.concat(F.lit("Type:  "), "p_type")
    ).otherwise(F.concat(F.lit("Type: "), "p_type", F.lit(" : "), "p_brand"))
    return t.part.select("p_partkey", tx.between_colons(text).alias("label"))


@query(
    """select p_partkey, case when p_size % 3 = 2 then null else p_size::double end as score from part"""
)
def fraction(t: Tables) -> DataFrame:
    tail = pick(F.col("p_size"), " / 50", "/50", " / 50 / 2")
    return t.part.select("p_partkey", tx.fraction_numerator(F.concat(F.col("p_size").cast("string"), tail)).alias("score"))


@query(
    """select p_partkey, p_size as width, p_size as stars from part"""
)
def percent(t: Tables) -> DataFrame:
    style = F.concat(F.lit("width: "), F.col("p_size").cast("string"), F.lit("%; height: 7px"))
    return t.part.select("p_partkey", tx.style_percent(style).alias("width"), tx.style_number(style).alias("stars"))


@query(
    """select event_id, case event_type when 'error' then 'ended' when 'click' then 'upcoming'
         when 'view' then 'active' end as status,
         case when event_type = 'error' then 'ended' end as label_status
       from events"""
)
def status_phrase(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    phrase = (
        F.when(kind == "error", "Token sale ended")
        .when(kind == "click", "Sale starts in 3 days")
        .when(kind == "view", "Sale ends in 2 days")
        .otherwise(F.concat(F.lit("nothing about "), kind))
    )
    label = F.when(kind == "error", " Ended ").otherwise("UNKNOWN")
    return t.events.select("event_id", tx.status_phrase(phrase).alias("status"), tx.status_label(label).alias("label_status"))


@query(
    """select o_orderkey, o_orderpriority in ('1-URGENT', '2-HIGH') as kyc, o_orderpriority in ('1-URGENT', '3-MEDIUM') as whitelist
       from orders"""
)
def two_flags(t: Tables) -> DataFrame:
    word = F.col("o_orderpriority")
    text = F.when(word == "1-URGENT", "Whitelist + Kyc").when(word == "2-HIGH", "kyc").when(word == "3-MEDIUM", "WhiteList").otherwise("None")
    return t.orders.select("o_orderkey", tx.flag_in(text, "KYC").alias("kyc"), tx.flag_in(text, "WHITELIST").alias("whitelist"))


@query(
    """select doc_id, case when contains(lower(text), 'yes') then true when contains(lower(text), 'no') then false end as flag
       from documents"""
)
def yes_no(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.yes_no(F.col("text")).alias("flag"))


@query(
    """select o_orderkey, strftime(o_orderdate, '%-d %B %Y') as plain, o_orderdate::date as parsed from orders"""
)
def ordinals(t: Tables) -> DataFrame:
    date = day("o_orderdate")
    n = F.dayofmonth(date)
    ending = F.when(n.isin(1, 21, 31), "st").when(n.isin(2, 22), "nd").when(n.isin(3, 23), "rd").otherwise("th")
    text = F.concat(n.cast("string"), ending, F.lit(" "), shown(date, "MMMM yyyy"))
    plain = tx.drop_ordinals(text)
    return t.orders.select("o_orderkey", plain.alias("plain"), dates.parse_date(plain).alias("parsed"))


@query("""select l_orderkey, l_partkey, l_linenumber, nullif(l_discount, 0) as discount from lineitem""")
def zero_null(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", tx.zero_to_null(F.col("l_discount")).alias("discount"))


@query(
    """select o_orderkey, nullif(trim(o_orderpriority), '4-NOT SPECIFIED') as word,
         coalesce(nullif(trim(o_orderpriority), '4-NOT SPECIFIED'), '-') as shown
       from orders"""
)
def sentinel_null(t: Tables) -> DataFrame:
    word = tx.missing_to_null(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("\n")), "4-NOT SPECIFIED")
    return t.orders.select("o_orderkey", word.alias("word"), tx.null_to_missing(word).alias("shown"))


@query(
    """select doc_id, trim(replace(text, '"', ''), E' \\t\\n\\r\\f\\x0b' || chr(160)) as clean from documents"""
)
def quote_strip(t: Tables) -> DataFrame:
    quoted = F.concat(F.lit(' "'), "text", F.lit('" \n'))
    return t.documents.select("doc_id", tx.drop_quotes(quoted).alias("clean"))


@query(
    """select p_partkey, array_to_string(list_transform(string_split(p_name || ' ' || p_type, ' '),
           lambda w: upper(w[1]) || lower(w[2:])), ' ') as title from part"""
)
def titlecase(t: Tables) -> DataFrame:
    text = F.concat(F.lit("  "), "p_name", F.lit(" \t "), "p_type", F.lit("\n"))
    return t.part.select("p_partkey", tx.title_case(text).alias("title"))


# --- dates ----------------------------------------------------------------


@query(
    """with shown as (select o_orderkey, case o_orderkey % 8
           when 0 then strftime(o_orderdate, '%B %-d, %Y') when 1 then strftime(o_orderdate, '%b. %-d, %Y')
           when 2 then strftime(o_orderdate, '%-d %B %Y') when 3 then strftime(o_orderdate, '%d.%m.%Y')
           when 4 then strftime(o_orderdate, '%-d %b %Y') when 5 then strftime(o_orderdate, '%Y-%m-%d')
           when 6 then strftime(o_orderdate, '%Y.%m.%d') else 'in ' || strftime(o_orderdate, '%Y') end as text from orders)
       select o_orderkey, try_strptime(text, ['%B %d, %Y', '%b. %d, %Y', '%d %B %Y', '%d.%m.%Y', '%d %b %Y',
           '%Y-%m-%d', '%Y.%m.%d'])::date as parsed from shown"""
)
def dates_multi(t: Tables) -> DataFrame:
    date = day("o_orderdate")
    text = pick(
        F.col("o_orderkey"),
        F.upper(shown(date, "MMMM d, yyyy")),
        F.concat(F.lit(" "), shown(date, "MMM. d, yyyy")),
        F.lower(shown(date, "d  MMMM yyyy")),
        shown(date, "dd.MM.yyyy"),
        F.regexp_replace(shown(date, "d MMM yyyy"), "Sep ", "Sept "),
        shown(date, "yyyy-MM-dd"),
        shown(date, "yyyy.MM.dd"),
        F.concat(F.lit("in "), shown(date, "yyyy")),
    )
    return t.orders.select("o_orderkey", dates.parse_date(text).alias("parsed"))


@query(
    """select l_orderkey, l_partkey, l_linenumber,
         try_strptime(strftime(l_shipdate, '%-d %b') || ' 1998', '%d %b %Y')::date as parsed from lineitem"""
)
def dates_noyear(t: Tables) -> DataFrame:
    text = shown(day("l_shipdate"), "dd MMM")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", dates.parse_day_month(text, as_of()).alias("parsed"))


@query(
    """with d as (select o_orderkey, try_strptime(strftime(o_orderdate, '%-d %b') || ' 1998', '%d %b %Y')::date as s,
           try_strptime(strftime(o_orderdate + interval 40 day, '%-d %b') || ' 1998', '%d %b %Y')::date as e,
           case o_orderstatus when 'F' then 'ended' when 'O' then 'active' else 'upcoming' end as status,
           date '1998-08-01' as now from orders)
       select o_orderkey, status,
         (case when s is null or e is null then s when status in ('ended', 'active') and s > now then s - interval 1 year
               when status = 'upcoming' and s < now then s + interval 1 year else s end)::date as ico_start,
         (case when s is null or e is null then e when status = 'ended' and e > now then e - interval 1 year
               when status in ('active', 'upcoming') and e < now then e + interval 1 year else e end)::date as ico_end
       from d"""
)
def year_repair(t: Tables) -> DataFrame:
    date = day("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "F", "ended").when(F.col("o_orderstatus") == "O", "active").otherwise("upcoming")
    parsed = t.orders.select(
        "o_orderkey",
        status.alias("status"),
        dates.parse_day_month(shown(date, "d MMM"), as_of()).alias("s"),
        dates.parse_day_month(shown(F.date_add(date, 40), "d MMM"), as_of()).alias("e"),
    )
    start, end = dates.repair_years(F.col("s"), F.col("e"), F.col("status"), as_of())
    return parsed.select("o_orderkey", "status", start.alias("ico_start"), end.alias("ico_end"))


@query(
    """select l_orderkey, l_partkey, l_linenumber,
         case when date '1998-08-01' between l_shipdate::date and l_shipdate::date + 45 then 'active'
              when date '1998-08-01' < l_shipdate::date then 'upcoming' else 'ended' end as status
       from lineitem"""
)
def status_by_date(t: Tables) -> DataFrame:
    start = day("l_shipdate")
    status = dates.period_status(start, F.date_add(start, 45), as_of())
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", status.alias("status"))


@query(
    """select o_orderkey, strftime(o_orderdate, '%d %b') as dash_start, strftime(o_orderdate + interval 9 day, '%d %b') as dash_end,
         strftime(o_orderdate, '%d.%m.%Y') as word_start, strftime(o_orderdate + interval 9 day, '%d.%m.%Y') as word_end,
         null::varchar as broken
       from orders"""
)
def range_split(t: Tables) -> DataFrame:
    a, b = day("o_orderdate"), F.date_add(day("o_orderdate"), 9)
    dashed = F.concat(shown(a, "dd MMM"), F.lit(" – "), shown(b, "dd MMM"))
    words = F.concat(F.lit("from "), shown(a, "dd.MM.yyyy"), F.lit(" - to "), shown(b, "dd.MM.yyyy"))
    side = dates.range_side
    return t.orders.select(
        "o_orderkey",
        side(dashed, 0, "–", exactly_two=True).alias("dash_start"),
        side(dashed, 1, "–", exactly_two=True).alias("dash_end"),
        side(words, 0, last_word=True).alias("word_start"),
        side(words, 1, last_word=True).alias("word_end"),
        side(F.concat(dashed, F.lit("–")), 0, "–", exactly_two=True).alias("broken"),
    )


@query(
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as first_date,
         strftime(o_orderdate + interval 9 day, '%Y.%m.%d') as second_date, null::varchar as third_date from orders"""
)
def iso_dates(t: Tables) -> DataFrame:
    a, b = day("o_orderdate"), F.date_add(day("o_orderdate"), 9)
    text = F.concat(F.lit("from "), shown(a, "yyyy-MM-dd"), F.lit(" to "), shown(b, "yyyy.MM.dd"), F.lit(" 1999-1-1"))
    cols = [dates.iso_date_text(text, i).alias(f"{n}_date") for i, n in enumerate(("first", "second", "third"))]
    return t.orders.select("o_orderkey", *cols)


# --- links ----------------------------------------------------------------


@query("""select page_id, case when page_id % 5 = 0 then null else url end as web_page from pages""")
def url_clean(t: Tables) -> DataFrame:
    text = F.when(F.col("page_id") % 5 == 0, " \n ").otherwise(F.concat(F.lit(" "), "url", F.lit("\t(official) "), "url"))
    return t.pages.select("page_id", urls.clean_link(text).alias("web_page"))


@query("""select page_id, replace(url, 'http:', 'https:') as telegram_page from pages""")
def url_https(t: Tables) -> DataFrame:
    return t.pages.select("page_id", urls.https(F.col("url")).alias("telegram_page"))


@query("""select page_id, lower(regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1)) || '/' as origin from pages""")
def link_origin(t: Tables) -> DataFrame:
    return t.pages.select("page_id", urls.origin(F.col("url")).alias("origin"))


@query("""select page_id, split_part(url, '&', 1) as url from pages""")
def link_trim(t: Tables) -> DataFrame:
    return t.pages.select("page_id", urls.before_ampersand(F.col("url")).alias("url"))


@query(
    """select conv_id, turn, case when role = 'user' then 'https://forum.example.org/index.php?topic=' || conv_id end as thread
       from conversations"""
)
def thread_base(t: Tables) -> DataFrame:
    link = F.concat(
        F.lit("https://forum.example.org/index.php?"),
        F.when(F.col("role") == "user", "topic=").otherwise("board="),
        F.col("conv_id").cast("string"),
        F.lit("."),
        (F.col("turn") * 20).cast("string"),
    )
    return t.conversations.select("conv_id", "turn", urls.thread_base(link).alias("thread"))


@query(
    """select page_id, contains(replace(url, '/en/', '/r/'), '/r/') and not contains(replace(url, '/en/', '/r/'), '/user/') as eligible
       from pages"""
)
def eligible(t: Tables) -> DataFrame:
    from entityloom.operators.enrich import eligible_community

    link = F.replace(F.col("url"), F.lit("/en/"), F.lit("/r/"))
    return t.pages.select("page_id", eligible_community(link).alias("eligible"))


# --- scores ---------------------------------------------------------------


@query(
    """select event_id, show1(value * 10 / 100) as ten, show0(value * 100 / 50) as whole,
         show1(10 + value * -10 / 100) as turned from events"""
)
def rescale(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events.select(
        "event_id",
        scores.rescale(v, 0, 100).alias("ten"),
        scores.rescale(v, 0, 50, 0, 100, decimals=0).alias("whole"),
        scores.rescale(v, 0, 100, 10, 0).alias("turned"),
    )


_NUMERIC = """case p_partkey % 5 when 0 then p_size::varchar when 1 then p_retailprice::varchar
    when 2 then p_brand when 3 then p_size || 'd' else '-' || p_size || 'e1' end"""


@query(
    f"""select p_partkey, try_cast({_NUMERIC} as double) is not null as numeric, try_cast({_NUMERIC} as double) as number from part"""
)
def numeric_test(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    text = pick(
        F.col("p_partkey"), size, F.col("p_retailprice").cast("string"), F.col("p_brand"), F.concat(size, F.lit("d")), F.concat(F.lit("-"), size, F.lit("e1"))
    )
    return t.part.select("p_partkey", scores.is_number(text).alias("numeric"), scores.to_number(text).alias("number"))


@query(
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 5 when '2-HIGH' then 4 when '3-MEDIUM' then 3
           when '5-LOW' then 2 end as risk,
         case o_orderstatus when 'F' then 1 when 'O' then 8 when 'P' then 0 end as grade from orders"""
)
def ordinal_words(t: Tables) -> DataFrame:
    word = F.col("o_orderpriority")
    risk = F.when(word == "1-URGENT", "Very High").when(word == "2-HIGH", "High").when(word == "3-MEDIUM", "Normal").when(word == "5-LOW", "Low").otherwise("Not rated")
    state = F.col("o_orderstatus")
    grade = F.when(state == "F", "NEGATIVE").when(state == "O", "POSITIVE+").when(state == "P", "NEGATIVE-")
    return t.orders.select(
        "o_orderkey",
        scores.word_value(risk, scores.RISK_WORDS).alias("risk"),
        scores.word_value(grade, scores.RATING_GRADES).alias("grade"),
    )


@query(
    """with s as (select p_partkey, ['icodrops','icobazaar','icobench','trackico','tokentops','icomarks','icoratings'][p_partkey % 7 + 1] as source,
           p_size / 10.0::double as v, p_size % 5 + 1 as w from part)
       select p_partkey, source,
         case when source = 'icodrops' then null when source in ('icomarks', 'icoratings') then v else show1(v * 10 / 5) end as website_overall_rating,
         case when source = 'icobazaar' then show1(v * 10 / 100) when source = 'icobench' then show1(v * 10 / 5)
              else v end as team_score,
         case when source = 'tokentops' then show1(v * 10 / 100) else v end as user_review_score,
         case when source = 'icodrops' then show1((w - 1) * 10 / 4.0::double) when source = 'icoratings' then show1(v * 10 / 5)
              else v end as risk_score
       from s"""
)
def source_scales(t: Tables) -> DataFrame:
    number = (F.col("p_size") / 10).cast("string")
    word = pick(F.col("p_size"), *scores.RISK_WORDS)
    base = t.part.select("p_partkey", pick(F.col("p_partkey"), *SOURCES).alias("source"), number.alias("v"), word.alias("w"))
    risk = F.when(F.col("source") == "icodrops", F.col("w")).otherwise(F.col("v"))
    names = ("website_overall_rating", "team_score", "user_review_score")
    return base.select(
        "p_partkey",
        "source",
        *[score_of(F.col("source"), n, F.col("v")).alias(n) for n in names],
        score_of(F.col("source"), "risk_score", risk).alias("risk_score"),
    )


# --- countries ------------------------------------------------------------


@query(
    """select c.c_custkey, case c_custkey % 4 when 1 then null when 2 then a.code || ', X' || b.code || ', ' || d.code
           else a.code || ', ' || b.code || ', Atlantis, ' || d.code end as codes
       from customer c
       join (select n_nationkey k, 'N' || lpad(n_nationkey::varchar, 2, '0') as code from nation) a on a.k = c_nationkey
       join (select n_nationkey k, 'N' || lpad(n_nationkey::varchar, 2, '0') as code from nation) b on b.k = (c_nationkey + 7) % 25
       join (select n_nationkey k, 'N' || lpad(n_nationkey::varchar, 2, '0') as code from nation) d on d.k = (c_nationkey + 11) % 25"""
)
def country_list(t: Tables) -> DataFrame:
    """List conversion through a join with a dimension table: NULL lists, names that hold a comma,
    unspecified and unknown words."""
    named = lambda shift: F.concat(F.lit("Nation_"), F.pmod(F.col("c_nationkey") + shift, F.lit(25)).cast("string"))
    plain = F.concat_ws(",", named(0), F.concat(F.lit(" "), named(7)), F.lit(" Atlantis "), named(11))
    comma = F.concat_ws(",", named(0), named(7), F.lit(" Kingdom of"), F.lit(" unspecified"), named(11))
    text = F.when(F.col("c_custkey") % 4 == 1, F.lit(None)).when(F.col("c_custkey") % 4 == 2, comma).otherwise(plain)
    lists = t.customer.select("c_custkey", text.alias("codes"))
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    key = countries.country_key(F.col("n_name"))
    dim = t.nation.select(key.alias("key"), code.alias("code"))
    dim = dim.unionByName(t.nation.select(F.concat(key, F.lit(", KINGDOM OF")).alias("key"), F.concat(F.lit("X"), code).alias("code")))
    return countries.convert_lists_by_join(lists, "c_custkey", "codes", dim)


@query(
    """select c_custkey, case c_custkey % 8 when 0 then 'RUS' when 1 then null when 2 then 'GBR, KOR, USA' when 3 then 'usa, Atlantis'
           when 4 then 'DEU' when 5 then 'LCA, BIH' when 6 then 'XYZ' else null end as countries_restricted,
         case c_custkey % 8 when 0 then 'RUS' when 4 then 'DEU' when 6 then 'XYZ' when 5 then 'St. Lucia, Bosnia and Herzegovina'
           when 2 then 'UK, Korea, Republic of, US' when 3 then 'usa, Atlantis' else null end as country
       from customer"""
)
def unspecified(t: Tables) -> DataFrame:
    """Real country names, codes, comma names, unknown and unspecified words."""
    codes = countries.dim_map(countries.country_table(t.spark))
    text = pick(
        F.col("c_custkey"),
        "Russia",
        "Unspecified",
        "UK, Korea, Republic of, US",
        "usa, Atlantis",
        "DE.",
        "St. Lucia, Bosnia and Herzegovina",
        "XYZ",
        "",
    )
    lists = t.customer.select("c_custkey", text.alias("country"), text.alias("countries_restricted"))
    return countries.convert_countries(lists, codes)


# --- whole records --------------------------------------------------------


@query(
    """select s_suppkey, s_name as name, null::varchar as ticker, null::date as ico_start,
         s_acctbal as team_score, floor(abs(s_acctbal))::bigint as btc_num_comments
       from supplier"""
)
def conform_record(t: Tables) -> DataFrame:
    small = T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("ticker", T.StringType()),
            T.StructField("ico_start", T.DateType()),
            T.StructField("team_score", T.DoubleType()),
            T.StructField("btc_num_comments", T.LongType()),
        ]
    )
    given = t.supplier.select(
        "s_suppkey",
        F.col("s_name").alias("name"),
        F.lit("no date").alias("ico_start"),
        F.col("s_acctbal").cast("string").alias("team_score"),
        F.floor(F.abs("s_acctbal")).cast("string").alias("btc_num_comments"),
    )
    return conform(given, small, keep=("s_suppkey",))


@query(
    """with r as (select o_orderkey, ['icodrops','icobazaar','icobench','trackico','tokentops','icomarks','icoratings'][o_orderkey % 7 + 1] as source,
           o_orderdate::date as d, o_orderstatus st, o_orderpriority w, o_totalprice p from orders),
       n as (select *, case when source = 'icodrops' then try_strptime(strftime(d, '%-d %b') || ' 1998', '%d %b %Y')::date else d end as s,
           case when source = 'icodrops' then try_strptime(strftime(d + 30, '%-d %b') || ' 1998', '%d %b %Y')::date else d + 30 end as e from r)
       select o_orderkey, source, 'Name ' || o_orderkey as name, nullif(w, '4-NOT SPECIFIED') as ticker,
         (case when source <> 'icodrops' or s is null or e is null then s when st = 'F' and s > date '1998-08-01' then s - interval 1 year else s end)::date as ico_start,
         (case when source <> 'icodrops' or s is null or e is null then e when st = 'F' and e > date '1998-08-01' then e - interval 1 year else e end)::date as ico_end,
         case when source = 'icodrops' then (case when st = 'F' then 'ended' end)
              when date '1998-08-01' between s and e then 'active' when date '1998-08-01' < s then 'upcoming' else 'ended' end as status,
         'https://t.me/x' || o_orderkey as telegram_page,
         case when source = 'icodrops' then null when source in ('icomarks', 'icoratings') then floor(p / 1000) / 100
              else show1(floor(p / 1000) / 100 * 10 / 5) end as website_overall_rating,
         st = 'O' as kyc
       from n"""
)
def normalize_all(t: Tables) -> DataFrame:
    d = day("o_orderdate")
    key = F.col("o_orderkey").cast("string")
    source = pick(F.col("o_orderkey"), *SOURCES)
    yearless = source == "icodrops"
    written = lambda x: F.when(yearless, shown(x, "d MMM")).otherwise(shown(x, "d MMMM yyyy"))
    given = t.orders.select(
        "o_orderkey",
        source.alias("source"),
        F.concat(F.lit(" Name "), key).alias("name"),
        tx.missing_to_null(F.col("o_orderpriority"), "4-NOT SPECIFIED").alias("ticker"),
        written(d).alias("ico_start"),
        written(F.date_add(d, 30)).alias("ico_end"),
        F.when(F.col("o_orderstatus") == "F", "ended").otherwise("-").alias("status"),
        F.concat(F.lit("http://t.me/x"), key, F.lit(" (chat)")).alias("telegram_page"),
        (F.floor(F.col("o_totalprice") / 1000) / 100).cast("string").alias("website_overall_rating"),
        F.when(F.col("o_orderstatus") == "O", "Yes").otherwise("No").alias("kyc"),
    )
    typed = normalize(conform(given, RAW_SCHEMA, keep=("o_orderkey",)), as_of(), "o_orderkey")
    return typed.select(
        "o_orderkey", "source", "name", "ticker", "ico_start", "ico_end", "status", "telegram_page", "website_overall_rating", "kyc"
    )


