"""Queries on whole records: validity, matching, clusters, merge and dimension look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.catalog.registry import Tables, greedy_sql, query
from entityloom.functions import scores
from entityloom.functions import text as tx
from entityloom.operators import resolve
from entityloom.operators.enrich import attach
from entityloom.operators.links import union_sources as union_frames
from entityloom.operators.merge import merge_by_priority
from entityloom.operators.quality import completeness, keep_valid
from entityloom.plans.consolidate import consolidate
from entityloom.plans.incremental import EntityState, apply_changes, current_entities
from entityloom.session import scratch_path, staged
from entityloom.sources.tables import project_to_target, read_row

URGENCY = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5}
ORDER_FIELDS = ("word", "urgency", "state", "price", "day")


def order_records(t: Tables) -> DataFrame:
    """Orders as records of several sources: the priority word names the source."""
    word = tx.missing_to_null(F.col("o_orderpriority"), "4-NOT SPECIFIED")
    price = F.when(F.col("o_totalprice") >= 20000, F.col("o_totalprice"))
    number = scores.word_value(word, URGENCY)
    return t.orders.select(
        F.col("o_custkey").alias("entity"),
        F.col("o_orderkey").alias("rank"),
        F.coalesce(number, F.lit(9)).alias("priority"),
        word.alias("word"),
        scores.rescale(number, 1, 5).alias("urgency"),
        tx.missing_to_null(F.col("o_orderstatus"), "P").alias("state"),
        scores.rescale(price, 0, 500000).alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )


_ORDER_RECORDS = """select o_custkey as entity, o_orderkey as rank,
      coalesce(case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3 when '5-LOW' then 5 end, 9) as prio,
      nullif(o_orderpriority, '4-NOT SPECIFIED') as word,
      show1((case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3 when '5-LOW' then 5 end - 1) * 10 / 4.0::double) as urgency,
      nullif(o_orderstatus, 'P') as state,
      case when o_totalprice >= 20000 then show1(o_totalprice * 10 / 500000) end as price,
      strftime(o_orderdate, '%Y-%m-%d') as day from orders"""
_KNOWN = "((word is not null)::int + (urgency is not null)::int + (state is not null)::int + (price is not null)::int + (day is not null)::int)"
_BEST = ", ".join(f"arg_min({f}, (prio, rank)) filter (where {f} is not null) as {f}" for f in ORDER_FIELDS)


@query(
    f"""with r as ({_ORDER_RECORDS}), v as (select * from r where day is not null and {_KNOWN} >= 3),
         m as (select entity, count(*) as n_records, {_BEST} from v group by entity)
       select c_custkey, n_name, n_records, word, urgency, state, price, day
       from m join customer on c_custkey = entity left join nation on n_nationkey = c_nationkey"""
)
def consolidate_orders(t: Tables) -> DataFrame:
    """Flagship: sentinel, ordinal scale, validity, priority merge per customer, dimension look-up."""
    valid = keep_valid(order_records(t), ("day",), ORDER_FIELDS, 3)
    merged = merge_by_priority(valid, "entity", ORDER_FIELDS, "priority", "rank", counts="n_records")
    # The merge and this join share their partitioning; nation is left to Spark's size check.
    named = merged.join(t.customer.select("c_custkey", "c_nationkey"), F.col("entity") == F.col("c_custkey"))
    out = named.join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.select("c_custkey", "n_name", "n_records", *ORDER_FIELDS)


@query(f"""select rank as o_orderkey, {_KNOWN} as known from ({_ORDER_RECORDS})""")
def completeness_count(t: Tables) -> DataFrame:
    return order_records(t).select(F.col("rank").alias("o_orderkey"), completeness(*ORDER_FIELDS).alias("known"))


@query(f"""select rank as o_orderkey from ({_ORDER_RECORDS}) where state is not null""")
def required_present(t: Tables) -> DataFrame:
    return keep_valid(order_records(t), ("state",), ORDER_FIELDS, 0).select(F.col("rank").alias("o_orderkey"))


@query(f"""select rank as o_orderkey, word, state from ({_ORDER_RECORDS}) where day is not null and {_KNOWN} >= 4""")
def complete_enough(t: Tables) -> DataFrame:
    return keep_valid(order_records(t), ("day",), ORDER_FIELDS, 4).select(F.col("rank").alias("o_orderkey"), "word", "state")


@query(f"""select entity, {_BEST} from ({_ORDER_RECORDS}) group by entity""")
def priority_merge(t: Tables) -> DataFrame:
    return merge_by_priority(order_records(t), "entity", ORDER_FIELDS, "priority", "rank")


# --- matching -------------------------------------------------------------


def part_keys(t: Tables) -> tuple[DataFrame, dict[str, Column]]:
    keys = {
        "label": F.concat_ws("|", "p_name", "p_brand"),
        "make": F.concat_ws("|", "p_type", "p_brand", F.col("p_size").cast("string")),
    }
    return t.part, keys


_PART_KEYS = """select p_partkey as rank, 'label' as key_name, upper(p_name || '|' || p_brand) as key_value from part
      union all select p_partkey, 'make', upper(p_type || '|' || p_brand || '|' || p_size) from part"""


@query(
    f"""with k as ({_PART_KEYS}), h as (select key_name, key_value, min(rank) as head from k group by all)
       select key_name, key_value, head, rank from k join h using (key_name, key_value) where rank <> head"""
)
def match_links(t: Tables) -> DataFrame:
    """Matches on any of two keys, in linear form: each record with the first of its block."""
    df, keys = part_keys(t)
    return resolve.block_links(df, "p_partkey", keys)


@query(
    f"""with k as ({_PART_KEYS}), s as (select key_name, key_value, min(rank) as seed from k join part on p_partkey = rank
           where p_size >= 40 group by all)
       select rank, min(seed) as seed from k join s using (key_name, key_value) group by rank"""
)
def match_seeds(t: Tables) -> DataFrame:
    """For every part the first large part that it matches on any key."""
    df, keys = part_keys(t)
    return resolve.matches_of(df, "p_partkey", keys, F.col("p_size") >= 40)


@query(
    f"""with recursive k as ({_PART_KEYS}), h as (select key_name, key_value, min(rank) as head from k group by all),
         e as (select distinct rank as a, head as b from k join h using (key_name, key_value)),
         b as (select a, b from e union select b, a from e),
         reach as (select p_partkey as id, p_partkey as root from part union select b.b, r.root from reach r join b on b.a = r.id)
       select id as rank, min(root) as entity from reach group by id"""
)
def clusters_transitive(t: Tables) -> DataFrame:
    df, keys = part_keys(t)
    return resolve.transitive_clusters(df, "p_partkey", keys)


@query(
    f"""with recursive p as (select rank, list(key_name || '=' || key_value) as ks from ({_PART_KEYS}) group by rank),
         {greedy_sql("p")} select rank, entity from e"""
)
def clusters_greedy(t: Tables) -> DataFrame:
    """Seeds in rank order absorb their direct matches."""
    df, keys = part_keys(t)
    return resolve.greedy_clusters(df, "p_partkey", keys)


_DOC_PRIORITY = {f"src{i}": i * 7 % 20 for i in range(20)}
_DOC_FIELDS = ("source", "name", "ticker", "n_chars", "quality", "toxic")
_DOC_CASE = "case source " + " ".join(f"when '{s}' then {p}" for s, p in _DOC_PRIORITY.items()) + " end"
_TEXT_BLANKS = "E' \\t\\n\\r\\f\\x0b' || chr(160)"


_MERGE_SQL = (
    f"""with recursive r as (select 1000000000 - doc_id as rank, {_DOC_CASE} as prio, source, text as name, lang as ticker, n_chars,
            nullif(quality, 0) as quality, nullif(toxic, 0) as toxic from documents left join labels using (doc_id)),
         v as (select *, ['n=' || md5(upper(trim(name, {_TEXT_BLANKS}))),
             's=' || n_chars || '/' || source] as ks from r where 4 + (quality is not null)::int + (toxic is not null)::int >= 4),
         {greedy_sql("v")}
       select entity,
         {", ".join(f"arg_min({f}, (prio, rank)) filter (where {f} is not null) as {f}" for f in ("source", "ticker", "n_chars", "quality", "toxic"))},
         md5(arg_min(trim(replace(name, '"', ''), {_TEXT_BLANKS}), (prio, rank))) as name_md5
       from v join e using (rank) group by entity"""
)


def document_records(t: Tables) -> DataFrame:
    """Documents with their labels as records that match by their text or by source and length."""
    grades = t.labels.select("doc_id", tx.zero_to_null(F.col("quality")).alias("quality"), tx.zero_to_null(F.col("toxic")).alias("toxic"))
    return (
        t.documents.join(grades, "doc_id", "left")
        .withColumn("rank", F.lit(1000000000).cast("bigint") - F.col("doc_id"))
        .withColumnRenamed("text", "name")
        .withColumnRenamed("lang", "ticker")
        .withColumn("shape", F.concat_ws("/", F.col("n_chars").cast("string"), "source"))
    )


def _shown(merged: DataFrame) -> DataFrame:
    return merged.withColumn("name_md5", F.md5(F.col("name").cast("binary"))).drop("name", "shape")


# The shape is a key and no field of its own: the minimum counts it.
_RECORD_FIELDS = (*_DOC_FIELDS, "shape")


@query(_MERGE_SQL)
def merge_full(t: Tables) -> DataFrame:
    """Whole consolidation of documents that match by their text or by source and length."""
    return _shown(consolidate(document_records(t), "rank", _RECORD_FIELDS, ("name", "ticker"), 5, ("name", "shape"), priority=_DOC_PRIORITY))


@query(_MERGE_SQL)
def merge_in_batches(t: Tables) -> DataFrame:
    """The same in three batches: half of the sources in a first state, then their changes, then the rest.

    A batch recomputes the entities it touches; after the last one all are as in one run.
    """
    state = EntityState(
        scratch_path(t.spark, "entity-state"), ("doc_id",), ("rank", "doc_id"), _RECORD_FIELDS, ("name", "ticker"), 5, ("name", "shape"),
        tuple(_DOC_PRIORITY.items()),
    )
    records, _ = staged(document_records(t), "records")
    early = F.pmod(F.crc32("source"), F.lit(2)) == 0
    changes = F.col("quality").isNotNull()
    # At first, records that change later have another text, and some of them are not valid.
    stale = records.where(early).withColumn("name", F.when(changes, F.concat("name", F.lit(" (draft)"))).otherwise(F.col("name")))
    apply_changes(state, stale.withColumn("ticker", F.when(F.col("toxic").isNull(), F.col("ticker"))))
    apply_changes(state, records.where(early & (changes | F.col("toxic").isNotNull())))
    apply_changes(state, records.where(~early))
    merged = current_entities(t.spark, state)
    return _shown(merged.select(F.col("seed.rank").alias("entity"), *_RECORD_FIELDS))


# --- joins with dimensions and figures ------------------------------------


@query("""select c_custkey, n_name, r_name from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey""")
def dimension_lookup(t: Tables) -> DataFrame:
    """Look-ups by code; which side is broadcast is left to Spark's own size check."""
    named = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return named.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"), "left").select("c_custkey", "n_name", "r_name")


@query("""select d.doc_id, d.source, l.quality from documents d left join labels l on l.doc_id = d.doc_id""")
def attach_figures(t: Tables) -> DataFrame:
    """Figures of pages that were crawled twice do not double a profile."""
    profiles = t.documents.select("doc_id", "source")
    figures = t.labels.select("doc_id", "quality")
    return attach(profiles, figures.unionByName(figures), "doc_id", url="doc_id")


@query(
    """select d.doc_id, case when l.doc_id is not null then d.source || '/' || d.doc_id end as telegram_page, l.quality
       from documents d left join labels l on l.doc_id = d.doc_id"""
)
def clear_unmatched(t: Tables) -> DataFrame:
    """A record without figures loses its link as well."""
    link = lambda df: df.withColumn("telegram_page", F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    profiles = link(t.documents.select("doc_id", "source")).select("doc_id", "telegram_page")
    labelled = t.labels.join(t.documents.select("doc_id", "source"), "doc_id")
    figures = link(labelled).select(F.col("telegram_page").alias("url"), "quality")
    return attach(profiles, figures, "telegram_page", clear_unmatched=True)


@query(
    """select 'customer' as kind, c_custkey as id, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
       union all by name select 'supplier' as kind, s_suppkey as id, s_name as name, s_acctbal as balance from supplier"""
)
def union_sources(t: Tables) -> DataFrame:
    c = t.customer.select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    s = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind")
    )
    return union_frames(c, s)


@query("""select c_custkey, c_name, c_acctbal from customer order by c_acctbal, c_custkey limit 1""")
def read_one_row(t: Tables) -> DataFrame:
    return read_row(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c_acctbal", "c_custkey")


@query("""select c_name, c_mktsegment from customer""")
def target_projection(t: Tables) -> DataFrame:
    """Columns of a load come from the target's own schema, less the columns it fills itself."""
    target = t.spark.createDataFrame([], "id bigint, c_name string, c_mktsegment string, created_at timestamp, updated_at timestamp")
    return project_to_target(t.customer, target)
