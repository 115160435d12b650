"""The latest row of each key, with wide columns read only where they lie.

A page store holds every fetch of a page, and a page body is a thousand times as wide as what
decides between fetches.  So the winners are chosen on narrow rows: key, order, a hash of the
content, and the address of the row (its file and place in it).  The address of a winner
becomes one bit in a bitmap of its file, and the scan that reads the bodies keeps the rows whose bit is
set.  Bitmaps, a bit for each row, are all that is sent; no body enters a shuffle.

Bitmaps are broadcast.  Files are dealt into as many groups as keep the bitmaps of each
below ``GROUP_BYTES``; each group is scanned apart (the scan skips the files of others), so every
file is read once, and what is broadcast at a time is bounded whatever the size of the store.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from entityloom.session import staged

#: Rows of a file that one bitmap stands for.
BLOCK_ROWS = 1 << 14
#: Most bytes of bitmaps that one scan is sent.
GROUP_BYTES = 32 << 20
#: Columns that hold page contents.
WIDE = ("html", "body")
_FILE, _AT = "_row_file", "_row_at"


def placed(df: DataFrame) -> DataFrame:
    """``df`` with the file of each row and its place there.

    Rows of a Parquet scan have an address that every later scan repeats; others are written first.
    """
    address = {_FILE: F.col("_metadata.file_path"), _AT: F.col("_metadata.row_index")}
    try:
        return df.withColumns(address)
    except AnalysisException:
        return staged(df, "rows")[0].withColumns(address)


def content_hash(df: DataFrame, wide: tuple[str, ...] = WIDE) -> Column:
    """A number that tells contents apart, so that reruns choose alike."""
    held = [F.col(c) for c in df.columns if c in wide]
    return F.xxhash64(*held) if held else F.lit(0).cast("long")


def winners(rows: DataFrame, keys: tuple[str, ...], order: tuple[Column, ...]) -> DataFrame:
    """(keys, _row_file, _row_at) of the last row of each key; a maximum, combined on the map side."""
    places = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(_FILE), F.col(_AT))
    best = rows.groupBy(*keys).agg(F.max(places).alias("m"))
    return best.select(*keys, F.col(f"m.{_FILE}").alias(_FILE), F.col(f"m.{_AT}").alias(_AT))


def _bitmaps(places: DataFrame) -> DataFrame:
    """(file, block, words): for each block of a file a bit for each of ``places``, as 64-bit words up to the last."""
    place = F.col(_AT) % BLOCK_ROWS
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = (
        places.select(F.col(_FILE).alias("file"), F.floor(F.col(_AT) / BLOCK_ROWS).alias("block"), place.alias("place"))
        .groupBy("file", "block", F.shiftright("place", 6).cast("int").alias("w"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    held = words.groupBy("file", "block").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"), F.max("w").alias("last"))
    full = F.transform(F.sequence(F.lit(0), F.col("last")), lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long")))
    return held.select("file", "block", full.alias("words"))


def rows_at(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Those of the ``placed`` rows whose address is in ``places`` (_row_file, _row_at), without the address.

    The bitmaps are staged; ``rows`` are scanned where they lie, once.
    """
    size = F.octet_length("file") + 8 * F.size("words") + 64
    maps, seen = staged(_bitmaps(places), "row-bitmaps", {"n_bytes": F.coalesce(F.sum(size), F.lit(0))})
    n_groups = max(1, -(-int(seen["n_bytes"]) // GROUP_BYTES))
    columns = [c for c in rows.columns if c not in (_FILE, _AT)]

    def read(group: int) -> DataFrame:
        mine = lambda file: F.pmod(F.xxhash64(file), F.lit(n_groups)) == group
        part, bits = (rows, maps) if n_groups == 1 else (rows.where(mine(F.col(_FILE))), maps.where(mine(F.col("file"))))
        place = (F.col(_AT) % BLOCK_ROWS).cast("int")
        word = F.get("words", F.shiftright(place, 6))
        at = (F.col(_FILE) == F.col("file")) & (F.floor(F.col(_AT) / BLOCK_ROWS) == F.col("block"))
        joined = part.join(F.broadcast(bits), at)
        return joined.where(F.getbit(F.coalesce(word, F.lit(0).cast("long")), place.bitwiseAND(63)) == 1).select(*columns)

    return reduce(DataFrame.unionByName, [read(g) for g in range(n_groups)])


def latest_rows(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], wide: tuple[str, ...] = WIDE) -> tuple[DataFrame, int]:
    """The last row of each key under ``order``, and the number of rows given.

    Rows that agree in the order are told apart by their content, and equal rows by their place.  Columns in
    ``wide`` may not be part of the order: their hash stands in for them.
    """
    rows = placed(df)
    seen = Observation()
    narrow = rows.select(*keys, *[c for c in order if c not in keys], content_hash(df, wide).alias("_content"), _FILE, _AT)
    narrow = narrow.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    best = winners(narrow, keys, (*[F.col(c) for c in order], F.col("_content")))
    chosen = rows_at(rows, best)
    try:
        return chosen, int(seen.get["n_rows"])
    except Py4JJavaError:  # an input known to be empty is dropped from the plan, and its count with it
        return chosen, 0
