"""Queries on what a run writes and counts: snapshots, tables, stage counts, rejects, refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.catalog.entities import ORDER_FIELDS, order_records
from entityloom.catalog.registry import Tables, query
from entityloom.functions import dates, scores
from entityloom.functions import text as tx
from entityloom.operators.quality import is_valid, rejects, unparsed_counts
from entityloom.schema import RAW_SCHEMA, conform
from entityloom.session import scratch_path
from entityloom.sinks.files import read_csv, write_by_source, write_csv, write_json, write_stage
from entityloom.sinks.tables import TARGET_TABLES, fan_out, number_rows, reload_folder
from entityloom.sinks.versions import table_paths
from entityloom.sources.tables import TABLE_SCHEMAS
from entityloom.streaming.refresh import current, refresh


@query("""select doc_id, md5(text) as text_md5, lang, nullif(source, 'src7') as source from documents""")
def csv_roundtrip(t: Tables) -> DataFrame:
    """Whole texts, with quotes and line ends, through CSV and back; ``-`` stands for unknown."""
    path = scratch_path(t.spark, "csv")
    docs = t.documents.select("doc_id", "text", "lang", F.nullif(F.col("source"), F.lit("src7")).alias("source"))
    write_csv(docs, path, "-")
    back = read_csv(t.spark, path, "doc_id bigint, text string, lang string, source string")
    return back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", tx.missing_to_null(F.col("source")).alias("source"))


@query("""select o_orderpriority as source, o_orderkey, o_totalprice from orders""")
def by_source(t: Tables) -> DataFrame:
    path = write_by_source(
        t.orders.select(F.col("o_orderpriority").alias("source"), "o_orderkey", "o_totalprice"), scratch_path(t.spark, "by_source"), "r1"
    )
    back = t.spark.read.schema("o_orderkey bigint, o_totalprice double, source string").parquet(path)
    return back.select("source", "o_orderkey", "o_totalprice")


@query("""select 'members' as stage, n_nationkey, n_name from nation union all select 'posts', c_nationkey, c_name from customer""")
def staged_snapshots(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "stages")
    write_stage(t.nation.select("n_nationkey", "n_name"), folder, "members", "r1")
    write_stage(t.customer.select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_name").alias("n_name")), folder, "posts", "r1")
    return t.spark.read.schema("n_nationkey int, n_name string, stage string, run_ts string").parquet(folder).drop("run_ts").select("stage", "n_nationkey", "n_name")


@query("""select event_id, event_type, value, props from events""")
def json_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    write_json(t.events.select("event_id", "event_type", "value", "props"), path)
    return t.spark.read.schema("event_id bigint, event_type string, value double, props string").json(path)


@query("""select s_suppkey, s_name from supplier""")
def reload_tables(t: Tables) -> DataFrame:
    """A second load replaces the first; readers ask for the version that was committed last."""
    folder = scratch_path(t.spark, "reload")
    reload_folder({"suppliers": t.customer.select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"))}, folder)
    reload_folder({"suppliers": t.supplier.select("s_suppkey", "s_name")}, folder)
    return t.spark.read.schema("s_suppkey bigint, s_name string").parquet(table_paths(t.spark, folder)["suppliers"])


@query("""select row_number() over (order by c_name) as token_id, c_custkey, c_name from customer""")
def surrogate_keys(t: Tables) -> DataFrame:
    return number_rows(t.customer.select("c_custkey", "c_name"), "c_name")


@query(
    """with n as (select row_number() over (order by c_custkey) as id, * from customer)
       select id, c_name as name, c_mktsegment as platform, show1(c_acctbal * 10 / 10000) as team_score,
         'https://t.me/' || c_custkey as telegram_page, null::bigint as btc_num_comments, null::varchar as reddit_page,
         '2024-01-01' as created_at
       from n"""
)
def fan_out_tables(t: Tables) -> DataFrame:
    """One wide record into six tables, written and joined again on the surrogate key."""
    given = t.customer.select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("platform"),
        scores.rescale(F.col("c_acctbal"), 0, 10000).alias("team_score"),
        F.concat(F.lit("https://t.me/"), F.col("c_custkey").cast("string")).alias("telegram_page"),
    )
    numbered = number_rows(conform(given, keep=("c_custkey",)), "c_custkey")
    frames = fan_out(numbered, F.lit("2024-01-01"))
    paths = reload_folder(frames, scratch_path(t.spark, "tables"))
    back = {name: t.spark.read.schema(frames[name].schema).parquet(paths[name]) for name in TARGET_TABLES}
    out = back["tokens"].select("id", "name", "created_at")
    wanted = {
        "token_details": "platform",
        "scores": "team_score",
        "social_pages": "telegram_page",
        "bitcointalk": "btc_num_comments",
        "subreddits": "reddit_page",
    }
    for name, column in wanted.items():
        out = out.join(back[name].select(F.col("token_id").alias("id"), column), "id")
    return out


@query(
    """select count(*) as extracted, count(*) filter (where k >= 4) as kept, count(*) filter (where k < 4) as dropped from (
         select (o_orderpriority <> '4-NOT SPECIFIED')::int * 2 + (o_orderstatus <> 'P')::int + (o_totalprice >= 20000)::int + 1 as k from orders)"""
)
def stage_counts(t: Tables) -> DataFrame:
    """Extracted, kept and dropped records of a stage, in one pass."""
    valid = is_valid(ORDER_FIELDS, ("day",), 4)
    sums = order_records(t).agg(F.count(F.lit(1)).alias("extracted"), F.count_if(valid).alias("kept"))
    return sums.select("extracted", "kept", (F.col("extracted") - F.col("kept")).alias("dropped"))


def _written_date():
    """Order dates as texts, some in a layout no source uses."""
    d = F.col("o_orderdate").cast("date")
    return F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "yyyy/MM/dd")).when(F.col("o_orderkey") % 3 == 1, "soon").otherwise(
        F.date_format(d, "d MMMM yyyy")
    )


@query(
    """select o_orderpriority as source, count(*) filter (where o_orderkey % 3 = 0) as bad_dates,
         count(*) filter (where o_orderstatus = 'F') as bad_days from orders group by 1"""
)
def unparsed_dates(t: Tables) -> DataFrame:
    text = _written_date()
    day = F.when(F.col("o_orderstatus") == "F", "31 Feb").otherwise("1 Feb")
    df = t.orders.select(F.col("o_orderpriority").alias("source"), text.alias("text"), day.alias("day"))
    now = F.lit("1998-08-01").cast("date")
    return unparsed_counts(
        df,
        "source",
        bad_dates=(F.col("text"), dates.parse_date(F.col("text"))),
        bad_days=(F.col("day"), dates.parse_day_month(F.col("day"), now)),
    )


@query(
    """select o_orderkey, 'ico_start' as field, strftime(o_orderdate, '%Y/%m/%d') as raw, 'no date layout fits' as reason
       from orders where o_orderkey % 3 = 0
       union all select o_orderkey, 'roi_score', o_orderpriority, 'not a number' from orders where o_orderstatus = 'P'"""
)
def reject_rows(t: Tables) -> DataFrame:
    """Failed fields of all records, with their reason; the records themselves go on."""
    text = _written_date()
    score = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise("4.5")
    return rejects(
        t.orders,
        "o_orderkey",
        ico_start=(text, text.rlike("[0-9]") & dates.parse_date(text).isNull(), "no date layout fits"),
        roi_score=(score, ~scores.is_number(score), "not a number"),
    )


@query(
    """select * from (select user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') as seen from events
         qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)"""
)
def refresh_latest(t: Tables) -> DataFrame:
    """Events as a stream of files: the latest event of every user after all micro-batches."""
    target, checkpoint = scratch_path(t.spark, "refresh"), scratch_path(t.spark, "refresh-checkpoint")
    stream = t.spark.readStream.schema(TABLE_SCHEMAS["events"]).parquet(f"{t.folder}/events.parque[t]")  # a pattern fits a file and a folder
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    refresh(stream.drop("props"), "user_id", ("ts", "event_id"), target, checkpoint)
    latest = current(t.spark, target, schema, "user_id", ("ts", "event_id"))
    return latest.select("user_id", "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"))


@query("""select s_suppkey, s_name as name, '-' as ticker from supplier""")
def csv_sentinel(t: Tables) -> DataFrame:
    """A conformed raw record shows ``-`` for every unknown field."""
    path = scratch_path(t.spark, "csv")
    raw = conform(t.supplier.select("s_suppkey", F.col("s_name").alias("name")), RAW_SCHEMA, keep=("s_suppkey",))
    write_csv(raw, path, "-")
    schema = "s_suppkey bigint, " + ", ".join(f"{f} string" for f in RAW_SCHEMA.names)
    return read_csv(t.spark, path, schema).select("s_suppkey", "name", "ticker")
