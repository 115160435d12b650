"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Rows are dealt into senders, blocks of a file.  A sender sorts the fingerprints of its rows and
sends each owner (a range of fingerprints) its share as a Golomb code of the gaps, far fewer
bytes than the hashes.  The owner merges what it gets and answers each sender with a bitmap of
the fingerprints that occur again anywhere.  Only rows that the bitmaps mark are suspects: their
texts are read a second time, shuffled, and compared byte by byte.

A fingerprint that occurs more than twice in a sender is sent twice, and equal texts are summed
in each task before the shuffle, so a text that fills a third of the table costs each task one row.

Defined results: a NULL text counts as empty; empty texts are equal to each other; of rows equal
in text, length and doc_id one stays; a NULL doc_id comes after all others; an empty table gives
an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import (
    BLANK,
    SENDER_ROWS,
    addressed,
    bitmaps_of,
    by_bitmap,
    place_of,
    sender_of,
    staged_rows,
)

FINGERPRINT_BITS = 48
#: Fingerprints for one owner, about, and the most bits of a fingerprint that choose the owner.
OWNER_ROWS, OWNER_BITS = 100_000, 16


def golomb_encode(values: np.ndarray, bits: int) -> tuple[int, bytes, bytes]:
    """(k, unary parts, remainders of k bits) of the gaps between sorted values below 2**bits.

    The divisor is the power of two near the mean gap.  Quotients and remainders are kept apart,
    so that both are coded and decoded as whole arrays.
    """
    n = len(values)
    k = max(0, bits - 1 - (max(n, 1) - 1).bit_length())
    gaps = np.diff(values.astype(np.int64), prepend=0)
    quotients, rests = gaps >> k, gaps & ((1 << k) - 1)
    stops = np.cumsum(quotients + 1) - 1
    unary = np.ones(int(stops[-1]) + 1 if n else 0, dtype=np.uint8)
    unary[stops] = 0
    columns = (rests[:, None] >> np.arange(k)[::-1]) & 1
    return k, np.packbits(unary).tobytes(), np.packbits(columns.astype(np.uint8).ravel()).tobytes()


def golomb_decode(n: int, k: int, unary: bytes, rests: bytes) -> np.ndarray:
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    columns = np.unpackbits(np.frombuffer(rests, np.uint8), count=n * k).reshape(n, k).astype(np.int64)
    low = columns @ (1 << np.arange(k)[::-1].astype(np.int64)) if k else np.zeros(n, np.int64)
    return np.cumsum((quotients << k) + low)


def at_most_twice(fps: np.ndarray) -> np.ndarray:
    """Sorted fingerprints without the third and later of equal ones."""
    return fps[np.concatenate((np.ones(min(2, len(fps)), bool), fps[2:] != fps[:-2]))]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def _encode_senders(owner_bits: int):
    rest_bits = FINGERPRINT_BITS - owner_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sender, fps in zip(batch.column("sender").to_pylist(), batch.column("fps"), strict=True):
                sent = at_most_twice(fps.values.to_numpy())
                owners = sent >> rest_bits
                edges = np.flatnonzero(np.diff(owners, prepend=-1))
                for a, b in zip(edges, [*edges[1:], len(sent)], strict=True):
                    k, unary, rests = golomb_encode(sent[a:b] & ((1 << rest_bits) - 1), rest_bits)
                    out.append((int(owners[a]), sender, int(b - a), k, unary, rests))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _CODE_TYPES, strict=True)],
                ["owner", "sender", "n", "k", "unary", "rests"],
            )

    return run


_CODE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())


def _answer(codes: pa.Table) -> pa.Table:
    """What an owner does: mark the fingerprints that it was sent more than once, for each sender."""
    rows = codes.to_pylist()
    parts = [golomb_decode(r["n"], r["k"], r["unary"], r["rests"]) for r in rows]
    merged = np.sort(np.concatenate(parts))
    repeated = np.unique(merged[1:][merged[1:] == merged[:-1]])
    marks = [np.packbits(np.isin(p, repeated, assume_unique=False)).tobytes() for p in parts]
    return pa.table(
        {
            "sender": pa.array([r["sender"] for r in rows], pa.int64()),
            "owner": pa.array([r["owner"] for r in rows], pa.int64()),
            "marks": pa.array(marks, pa.binary()),
        }
    )


def _row_bitmaps(owner_bits: int):
    """What a sender does with the answers: one bit for each of its rows, as 64-bit words."""
    rest_bits = FINGERPRINT_BITS - owner_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            senders, words = [], []
            for row in range(batch.num_rows):
                fps = batch.column("fps")[row].values.to_numpy()
                places = batch.column("places")[row].values.to_numpy()
                sent = at_most_twice(fps)
                edges = np.flatnonzero(np.diff(sent >> rest_bits, prepend=-1))
                sizes = dict(zip((sent[edges] >> rest_bits).tolist(), np.diff([*edges, len(sent)]).tolist(), strict=True))
                answers = {a["owner"].as_py(): a["marks"].as_py() for a in batch.column("answers")[row].values}
                marks = [np.unpackbits(np.frombuffer(answers[o], np.uint8), count=n) for o, n in sizes.items()]
                again = np.unique(sent[np.concatenate(marks) == 1])
                bits = np.zeros(SENDER_ROWS, np.uint8)
                bits[places[np.isin(fps, again)]] = 1
                senders.append(batch.column("sender")[row].as_py())
                words.append(np.packbits(bits, bitorder="little").view("<i8").tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(senders, pa.int64()), pa.array(words, pa.list_(pa.int64()))], ["sender", "words"]
            )

    return run


def suspects(rows: DataFrame) -> DataFrame:
    """(sender, words): for each sender the bitmap of its rows whose fingerprint occurs again.

    ``rows`` is staged and has sender, place (below ``SENDER_ROWS``) and fp.
    """
    n = rows.count()
    owner_bits = min(OWNER_BITS, max(4, (n // OWNER_ROWS).bit_length()))
    sorted_rows = F.sort_array(F.collect_list(F.struct("fp", "place")))
    senders = staged_rows(
        rows.groupBy("sender")
        .agg(sorted_rows.alias("x"))
        .select("sender", F.col("x.fp").alias("fps"), F.col("x.place").alias("places")),
        "dedup-senders",
    )
    codes = senders.select("sender", "fps").mapInArrow(
        _encode_senders(owner_bits), "owner long, sender long, n long, k int, unary binary, rests binary"
    )
    answers = codes.groupBy("owner").applyInArrow(_answer, "sender long, owner long, marks binary")
    per_sender = answers.groupBy("sender").agg(F.collect_list(F.struct("owner", "marks")).alias("answers"))
    return senders.join(per_sender, "sender").mapInArrow(_row_bitmaps(owner_bits), "sender long, words array<long>")


def duplicates(placed: DataFrame, file: str, at: str) -> DataFrame:
    """For each row of addressed documents: sender, place, doc_id, keep_id, group_size, kept, text_sha256."""
    narrow = placed.select(file, at, "doc_id", "text")
    rows = staged_rows(
        narrow.select(file, at, "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), normalised(F.col("text")).alias("t"))
        .select(
            file,
            at,
            "doc_id",
            "n_chars",
            F.unhex(F.sha2("t", 256)).alias("sha"),
            F.shiftrightunsigned(F.xxhash64("t"), 64 - FINGERPRINT_BITS).alias("fp"),
            sender_of(file, at).alias("sender"),
            place_of(at).alias("place"),
        ),
        "dedup-rows",
    )
    n_rows = rows.count()
    bitmaps = staged_rows(suspects(rows.select("sender", "place", "fp")), "dedup-bitmaps")
    suspect = by_bitmap(narrow, sender_of(file, at), place_of(at), bitmaps, n_rows, wanted=True)
    texts = suspect.select(
        file, at, "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), normalised(F.col("text")).alias("t")
    )
    best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("order_id"), F.col(file).alias("file"), (-F.col(at)).alias("at")))
    groups = (
        texts.groupBy("t")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select(
            F.unhex(F.sha2("t", 256)).alias("sha"),
            (-F.col("best.order_id")).alias("keep_id"),
            F.col("best.file").alias("keep_file"),
            (-F.col("best.at")).alias("keep_at"),
            "group_size",
        )
    )
    alone = F.col("group_size").isNull()
    return rows.join(groups, "sha", "left").select(
        "sender",
        "place",
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | ((F.col(file) == F.col("keep_file")) & (F.col(at) == F.col("keep_at")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns as they are."""
    placed, file, at = addressed(docs)
    found = staged_rows(duplicates(placed, file, at).select("sender", "place", "kept"), "dedup-kept")
    gone = bitmaps_of(found.filter("not kept"))
    return by_bitmap(placed, sender_of(file, at), place_of(at), gone, found.count(), wanted=False).select(*docs.columns)


SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as n
  from documents
)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by n) as group_size,
       row_number() over w = 1 as kept,
       sha256(n) as text_sha256
from d
window w as (partition by n order by length(t) desc, doc_id nulls last)
"""
