"""Registered queries: name -> (Spark query, SQL that gives the same result)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from entityloom.sources.tables import read_table

QueryFn = Callable[["Tables"], DataFrame]


@dataclass(frozen=True)
class Tables:
    """The given tables of one folder, as attributes: ``t.orders``."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        return read_table(self.spark, self.folder, name)


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Entry] = {}


def printed(sql: str) -> str:
    """Expand ``show1(x)`` and ``show0(x)``: x as printed with one or no decimal, as a number."""
    for name, layout in (("show1(", "{:.1f}"), ("show0(", "{:.0f}")):
        while name in sql:
            start = sql.index(name)
            end, depth = start + len(name), 1
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[end], 0)
                end += 1
            inner = sql[start + len(name) : end - 1]
            sql = f"{sql[:start]}(format('{layout}', ({inner})::double)::double + 0){sql[end:]}"
    return sql


def greedy_sql(records: str) -> str:
    """Common table expressions that give ``e`` (rank, entity) for ``records`` with rank and a list ``ks`` of keys.

    The walk takes the records one by one and carries the keys that seeds hold: a record none of
    whose keys is held is a seed.  Each record then goes to the first seed among its keys.
    """
    return f"""o as (select row_number() over (order by rank) as i, rank, ks from {records}),
         walk as (select 0::bigint as i, []::varchar[] as held, null::bigint as seed
           union all select o.i, case when list_has_any(held, o.ks) then held else list_concat(held, o.ks) end,
             case when list_has_any(held, o.ks) then null else o.rank end from walk join o on o.i = walk.i + 1),
         k as (select rank, unnest(ks) as key from {records}),
         s as (select key, min(seed) as seed from k join walk on walk.seed = k.rank group by key),
         e as (select rank, min(seed) as entity from k join s using (key) group by rank)"""


def query(sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a function of ``Tables`` under its own name."""

    def add(fn: QueryFn) -> QueryFn:
        if fn.__name__ in CATALOG:
            raise ValueError(f"two queries named {fn.__name__}")
        CATALOG[fn.__name__] = Entry(lambda spark, folder: fn(Tables(spark, folder)), printed(sql) if sql else None)
        return fn

    return add
