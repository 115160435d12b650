"""Crawled-page tables: snapshot scan and body decoding."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package installed: the task code travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAGE_BYTES_SCHEMA = "source string, url string, content_type string, body binary"


def read_pages(spark: SparkSession, path: str, schema: str = PAGE_BYTES_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def charset_of(content_type: Column) -> Column:
    """Charset named by a content type; ``utf-8`` where none is named."""
    named = F.lower(F.btrim(F.regexp_extract(content_type, r"(?i)charset=\s*\"?([^\";\s]+)", 1)))
    return F.coalesce(F.nullif(named, F.lit("")), F.lit("utf-8"))


@F.pandas_udf(T.StringType())
def _decode_other(body: pd.Series, charset: pd.Series) -> pd.Series:
    """Charsets the JVM functions do not know; an unknown name means utf-8, bad bytes mean NULL."""

    def one(raw, name):
        if raw is None:
            return None
        try:
            return bytes(raw).decode(name)
        except LookupError:
            pass
        except UnicodeDecodeError:
            return None
        try:
            return bytes(raw).decode("utf-8")
        except UnicodeDecodeError:
            return None

    return pd.Series([one(r, n) for r, n in zip(body, charset)], dtype=object)


def _native(charset: Column) -> tuple[Column, Column]:
    """Whether a charset is UTF-8, and whether it is Latin-1."""
    return charset.isin("utf-8", "utf8"), charset.isin("iso-8859-1", "latin-1", "latin1")


def decode_native(body: Column, content_type: Column) -> Column:
    """Text of a UTF-8 or Latin-1 body by the JVM's functions; other names read as UTF-8.

    NULL marks a body that its charset cannot read (a reject).
    """
    _, latin1 = _native(charset_of(content_type))
    as_utf8 = F.when(F.is_valid_utf8(body.cast("string")), F.decode(body, "UTF-8"))
    return F.when(latin1, F.decode(body, "ISO-8859-1")).otherwise(as_utf8)


def decode_pages(pages: DataFrame, other_charsets: bool = True) -> DataFrame:
    """Add ``html``; a page whose body cannot be read keeps a NULL there.

    Rows are divided by charset: UTF-8 and Latin-1 never reach Python, and the plan has a Python step, for
    the rest alone, only where there is a rest.  Whether there is one is looked up in the content types.
    """
    native = pages.withColumn("html", decode_native(F.col("body"), F.col("content_type"))).drop("body")
    charset = charset_of(F.col("content_type"))
    utf8, latin1 = _native(charset)
    is_rare = ~(utf8 | latin1)
    if not other_charsets or pages.select("content_type").where(is_rare).isEmpty():
        return native
    rare = pages.where(is_rare).withColumn("html", _decode_other(F.col("body"), charset)).drop("body")
    return native.where(~is_rare).unionByName(rare)
