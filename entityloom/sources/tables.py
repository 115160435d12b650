"""Table scans with fixed schemas, read-back helpers and JDBC."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Schemas are given, so that no scan starts with a job that reads file footers.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Columns a target table fills by itself.
SYSTEM_COLUMNS = ("id", "token_id", "created_at", "updated_at")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(os.path.join(folder, f"{name}.parquet"))


def read_row(df: DataFrame, *order: str) -> DataFrame:
    """The first row under ``order``; Spark keeps one candidate per partition."""
    return df.orderBy(*order).limit(1)


def jdbc_options(url: str, table: str, **options: object) -> dict[str, str]:
    """Options for a JDBC scan or load; credentials are always the caller's."""
    return {"url": url, "dbtable": table, **{k: str(v) for k, v in options.items()}}


def read_jdbc(spark: SparkSession, url: str, table: str, **options: object) -> DataFrame:
    """A table or a ``(select …) alias``; give partitionColumn and bounds to read it in parallel."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def target_columns(target: DataFrame, system: tuple[str, ...] = SYSTEM_COLUMNS) -> list[str]:
    """Columns of a target table that a load must supply."""
    return [c for c in target.columns if c.lower() not in system]


def project_to_target(df: DataFrame, target: DataFrame, system: tuple[str, ...] = SYSTEM_COLUMNS) -> DataFrame:
    return df.select(*target_columns(target, system))
