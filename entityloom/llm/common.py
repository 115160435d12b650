"""Helpers shared by the corpus operators: reading, staging, words."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from entityloom.session import scratch_path

#: A word is a run of characters other than space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged_rows(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, executors may be lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Driver-made rows as a frame, handed over as Arrow: rows handed over as Python objects would be
    converted by Python workers on executors, a pool of their own that then stays."""
    fields = to_arrow_schema(T.DataType.fromDDL(schema) if isinstance(schema, str) else schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), schema)


def give_back() -> None:
    """Memory that a task has freed goes back to the system, since its worker process stays for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Bytes of rows handed to a Python worker at a time where whole texts are.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers and back in smaller batches, unless the session names a size of its own.

    At Spark's 64 MB a task holds several such blocks at once, in the worker and outside the JVM's heap, and
    an executor that runs stage after stage keeps what they have left behind.
    """
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


def with_uid(df: DataFrame) -> DataFrame:
    """A unique number for each row, in ``uid``; it is fixed once the result is staged."""
    return df.withColumn("uid", F.monotonically_increasing_id())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def columns_named(df: DataFrame, prefix: str, *names: str) -> dict[str, str]:
    """Names for helper columns that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in names:
        new = f"{prefix}{name}"
        while new.lower() in taken:
            new += "_"
        out[name] = new
    return out


def addressed(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the file and the place in it of each row: a key that every later scan repeats.

    A plain scan of Parquet files has both already; anything else is staged first.
    """
    own = columns_named(docs, "row_", "file", "at")
    for df in (docs, None):
        try:
            df = staged_rows(docs, "documents") if df is None else df
            out = df.withColumns(
                {own["file"]: F.col("_metadata.file_path"), own["at"]: F.col("_metadata.row_index")}
            )
            return out, own["file"], own["at"]
        except AnalysisException:
            continue
    raise ValueError("rows of this input have no address")


#: Rows of a file in one sender; its bitmap has a bit for each.
SENDER_ROWS = 65_536
#: The bitmaps of up to this many rows are broadcast (one bit a row: 32 MB); those of more are joined by shuffle.
BROADCAST_ROWS = 2**28


def sender_of(file: str, at: str) -> Column:
    """The block of a file that an addressed row lies in."""
    return F.xxhash64(F.col(file), F.floor(F.col(at) / SENDER_ROWS))


def place_of(at: str) -> Column:
    return (F.col(at) % SENDER_ROWS).cast("int")


def bitmaps_of(rows: DataFrame) -> DataFrame:
    """(sender, words): a bit for each of ``rows`` (sender, place)."""
    bit = F.expr("shiftleft(1L, place & 63)")
    words = rows.groupBy("sender", F.shiftright("place", 6).alias("w")).agg(F.bit_or(bit).alias("bits"))
    full = lambda m: F.transform(
        F.sequence(F.lit(0), F.lit(SENDER_ROWS // 64 - 1)), lambda i: F.coalesce(F.element_at(m, i), F.lit(0).cast("long"))
    )
    by_sender = words.groupBy("sender").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))
    return by_sender.select("sender", full(F.col("m")).alias("words"))


def by_bitmap(df: DataFrame, sender: Column, place: Column, bitmaps: DataFrame, n_rows: int, wanted: bool) -> DataFrame:
    """The rows of ``df`` whose bit is set, or with ``wanted`` false those whose bit is not.

    Texts stay where they are read: only bitmaps move.
    """
    own = columns_named(df, "bit_", "sender", "words")
    side = bitmaps.select(F.col("sender").alias(own["sender"]), F.col("words").alias(own["words"]))
    side = F.broadcast(side) if n_rows <= BROADCAST_ROWS else side
    bit = F.getbit(F.get(own["words"], F.shiftright(place, 6)), place.bitwiseAND(63))
    joined = df.join(side, sender == F.col(own["sender"]), "left")
    return joined.filter(F.coalesce(bit, F.lit(0)) == int(wanted)).select(*df.columns)
