"""Queries on community figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.catalog.registry import Tables, query
from entityloom.functions import text as tx
from entityloom.operators import enrich


@query(
    """select user_id, floor(sum(least(value, 100)::int) filter (where least(value, 100)::int <> 0)
         / count(*) filter (where least(value, 100)::int <> 0))::bigint as stars
       from events group by user_id"""
)
def star_mean(t: Tables) -> DataFrame:
    """Floor-mean of the non-zero star widths per user."""
    width = F.bround(F.least("value", F.lit(100.0)), 0).cast("int")
    styles = t.events.select("user_id", F.concat(F.lit("width: "), width.cast("string"), F.lit("%")).alias("style"))
    rated = styles.select("user_id", tx.zero_to_null(tx.style_number(F.col("style"))).alias("n"))
    sums = rated.groupBy("user_id").agg(F.sum("n").alias("total"), F.count("n").alias("n"))
    return sums.select("user_id", enrich.floor_mean(F.col("total"), F.col("n")).alias("stars"))


@query("""select c_custkey, case when c_custkey % 4 = 3 then null else c_custkey * 1237 + 12 end as members from customer""")
def members_text(t: Tables) -> DataFrame:
    spaced = F.replace(F.format_number(F.col("c_custkey") * 1237 + 12, 0), F.lit(","), F.lit(" "))
    html = F.concat(
        F.lit('<div class="tgme_page_extra">\n '),
        F.when(F.col("c_custkey") % 4 == 3, "no").otherwise(spaced),
        F.lit(" members, 12 online</div>"),
    )
    return t.customer.select("c_custkey", enrich.member_count(html).alias("members"))


def event_posts(t: Tables) -> DataFrame:
    """Events as posts of a community per event type and day."""
    k = F.get_json_object("props", "$.k")
    url = F.concat_ws("/", F.lit("/r"), "event_type", F.date_format("ts", "yyyyMMdd"))
    label = F.when(F.col("event_id") % 6 == 0, "comment").otherwise(F.concat(k, F.lit(" comments of 12")))
    return t.events.select(url.alias("url"), label.alias("comment_label"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"))


_POSTS = """select '/r/' || event_type || '/' || strftime(ts, '%Y%m%d') as url,
      case when event_id % 6 = 0 then 0 else (props->>'k')::bigint end as comments, 'user' || user_id as author from events"""


@query(f"""select url, count(*) as rdt_post_count, sum(comments)::bigint as rdt_comment_count from ({_POSTS}) group by url""")
def posts_and_comments(t: Tables) -> DataFrame:
    return enrich.community_totals(event_posts(t))


@query(f"""select url, count(distinct author) as n_authors from ({_POSTS}) group by url""")
def authors(t: Tables) -> DataFrame:
    return enrich.community_authors(event_posts(t)).groupBy("url").agg(F.count(F.lit(1)).alias("n_authors"))


def user_pages(t: Tables) -> DataFrame:
    """Author pages in both layouts; some authors have no figure, some have zero."""
    users = t.events.select("user_id").distinct()
    n = F.col("user_id")
    shown = lambda c: F.format_number(c, 0)
    html = (
        F.when(n % 5 == 0, F.lit("<p>suspended</p>"))
        .when(n % 5 == 1, F.concat(F.lit("<span> "), shown(n * 1009), F.lit(" Karma</span>")))
        .when(n % 5 == 2, F.lit("<span>0 Karma</span>"))
        .otherwise(
            F.concat(
                F.lit('<span class="karma">'), shown(n * 31), F.lit('</span> <span class="karma comment-karma">'),
                shown(-n * 7), F.lit("</span>"),
            )
        )
    )
    return users.select(F.concat(F.lit("user"), n.cast("string")).alias("author"), html.alias("html"))


_KARMA = """select distinct 'user' || user_id as author, case user_id % 5 when 0 then null when 1 then user_id * 1009 when 2 then 0
      else user_id * 24 end as karma from events"""


@query(_KARMA)
def reputation(t: Tables) -> DataFrame:
    return user_pages(t).select("author", enrich.reputation(F.col("html")).alias("karma"))


@query(
    f"""with p as ({_POSTS}), k as ({_KARMA}), a as (select distinct url, author from p)
       select url, floor(sum(karma) / count(*))::bigint as rdt_usr_avg_karma from a join k using (author) where karma <> 0 group by url"""
)
def mean_reputation(t: Tables) -> DataFrame:
    karma = user_pages(t).select("author", enrich.reputation(F.col("html")).alias("karma"))
    return enrich.mean_reputation(enrich.community_authors(event_posts(t)), karma)


@query(
    f"""with p as ({_POSTS}), k as ({_KARMA}), a as (select distinct url, author from p),
         c as (select url, count(*) as rdt_post_count, sum(comments)::bigint as rdt_comment_count from p group by url),
         m as (select url, floor(sum(karma) / count(*))::bigint as rdt_usr_avg_karma from a join k using (author) where karma <> 0 group by url)
       select * from c join m using (url)"""
)
def community_figures(t: Tables) -> DataFrame:
    """Posts, comments and mean reputation; communities without a rated author are skipped."""
    karma = user_pages(t).select("author", enrich.reputation(F.col("html")).alias("karma"))
    return enrich.community_figures(event_posts(t), karma)


@query(
    """select page_id, case when page_id % 4 = 3 then null else floor((page_id + page_id % 9 + 3) / 3)::bigint end as page_mean,
         case when page_id % 4 = 3 then 0 else 3 end::bigint as n_comments from pages"""
)
def page_activity(t: Tables) -> DataFrame:
    n = F.col("page_id")
    figure = lambda c: F.concat(F.lit("<td>Activity: "), c.cast("string"), F.lit("</td>"))
    figures = F.when(n % 4 == 3, "<td>none</td>").otherwise(F.concat(figure(n), "html", figure(n % 9), figure(F.lit(3))))
    mean, count = enrich.page_activity(figures)
    return t.pages.select("page_id", mean.alias("page_mean"), count.alias("n_comments"))


@query(
    """with p as (select user_id as thread, ts::date as d, floor(sum((props->>'k')::bigint) / count(*))::bigint as page_mean, count(*) as n
         from events group by all)
       select thread, floor(sum(page_mean) / count(*))::bigint as btc_avg_activ, sum(n)::bigint as btc_num_comments
       from p group by thread having sum(page_mean) <> 0"""
)
def thread_rollup(t: Tables) -> DataFrame:
    """Users as threads and days as pages: mean of page means, not weighted by page size."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    per_page = t.events.groupBy(F.col("user_id").alias("thread"), F.col("ts").cast("date").alias("page")).agg(
        F.sum(k).alias("total"), F.count(F.lit(1)).alias("n_comments")
    )
    pages = per_page.select("thread", enrich.floor_mean(F.col("total"), F.col("n_comments")).alias("page_mean"), "n_comments")
    return enrich.thread_figures(pages)


@query("""select c_custkey, c_name from customer order by c_name limit 100""")
def first_n(t: Tables) -> DataFrame:
    """The first 100 entities: a top-k report, one candidate list per partition."""
    return enrich.first_entities(t.customer.select("c_custkey", "c_name"), 100, "c_name")
