"""Passages of test items inside documents, by winnowing.

A window is ``window`` consecutive words of an item; an item of fewer words is one window.  Runs of
``gram`` words are hashed, and the least hash of the runs inside a window is its fingerprint.
A document that holds a window holds the same runs there and so has the same fingerprint: sliding
over all windows, every shared span as long as a window is met, although only about two of
``window - gram + 2`` runs are ever looked up.  (A shorter item of n words has windows of n words
and runs of ``min(gram, n)``.)

Documents are read once.  Fingerprints are held against a bitmap of the items' fingerprints
whose size is fixed; a hit is extended to the windows that it is the fingerprint of, and those
that pass a second bitmap are joined with the items' windows word by word.  So bitmaps only
spare rows, they never decide.  A window that many documents or many items share is one row on the
side of the items, and documents with the same set of windows look their items up once.

Defined results: a NULL or empty text has no words; a NULL item_id is an item without a name: its
words count as hit, and it is left out of the list; equal item_ids are one item; rows that repeat
a doc_id are rows of their own; an empty table on either side gives documents without hits; a very
long text is taken in pieces that overlap by a window; columns other than those named are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import staged_rows, with_uid

WINDOW = 10
GRAM = 5
#: Bits of a bitmap for each value in it, and the most bits: 8 MB, whatever the number of items.
BITS_EACH, MOST_BITS = 32, 2**26
#: Windows of items up to so many bytes may be broadcast; beyond that both sides are shuffled.
BROADCAST_BYTES = 32 * 2**20
#: Text is taken in pieces of about so many bytes.
PIECE = 2**20
_FACTOR, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _folded() -> bytes:
    """A table for ``bytes.translate``: A-Z lower-cased, all that is no word byte a space."""
    out = bytearray(b" " * 256)
    for b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        out[b] = b
    for b in range(0x41, 0x5B):
        out[b] = b + 32
    return bytes(out)


_FOLD = _folded()


def words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: runs of digits, letters and all beyond ASCII, lower-cased."""
    return text.translate(_FOLD).split()


def _hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, ws), np.uint64, len(ws))


def _runs_at(h: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """A hash of the run of k words from each start."""
    out = np.zeros(len(starts), np.uint64)
    for j in range(k):
        out = out * _FACTOR + h[starts + j]
    out ^= out >> np.uint64(32)
    out *= _SPREAD
    return out ^ (out >> np.uint64(29))


def _runs(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words."""
    n = max(len(h) - k + 1, 0)
    return _runs_at(h, np.arange(n), k)


def _fingerprints(h: np.ndarray, n: int, gram: int) -> np.ndarray:
    """For each window of n words the least hash of its runs."""
    k = min(gram, n)
    runs = _runs(h, k)
    size = max(len(h) - n + 1, 0)
    out = runs[:size]
    for j in range(1, n - k + 1):
        out = np.minimum(out, runs[j : j + size])
    return out


def _item_windows(window: int, gram: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).cast(pa.binary())
            rows, sizes, found, prints, wholes = [], [], [], [], []
            for row in range(batch.num_rows):
                ws = words(texts[row].as_py() or b"")
                n = min(window, len(ws))
                if n:
                    h = _hashes(ws)
                    count = len(ws) - n + 1
                    rows += [row] * count
                    sizes += [n] * count
                    found += [b" ".join(ws[s : s + n]) for s in range(count)]
                    prints.append(_fingerprints(h, n, gram))
                    wholes.append(_runs(h, n))
            flat = lambda parts: np.concatenate([np.empty(0, np.uint64), *parts]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    names.take(pa.array(rows, pa.int64())),
                    pa.array(sizes, pa.int32()),
                    pa.array(found, pa.binary()),
                    pa.array(flat(prints)),
                    pa.array(flat(wholes)),
                ],
                ["item", "n", "window", "print", "whole"],
            )

    return cut


def item_windows(items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item, n, window, print, whole): the windows of each item with fingerprint and whole hash."""
    narrow = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string"))
    return narrow.mapInArrow(
        _item_windows(window, gram), "item string, n int, window binary, print long, whole long"
    )


def _bitmap(values: DataFrame, column: str) -> np.ndarray:
    """A bit for each value, modulo the size of the bitmap."""
    n = values.select(F.approx_count_distinct(column)).head()[0]
    bits = max(2**12, min(MOST_BITS, 1 << (BITS_EACH * n).bit_length()))
    word = F.shiftright(F.col(column).bitwiseAND(F.lit(bits - 1)), 6).alias("w")
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")
    set_bits = values.groupBy(word).agg(F.bit_or(bit).alias("bits"))
    table = set_bits.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[table.column("w").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def _present(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _segments(text: bytes, overlap: int) -> Iterator[tuple[list[bytes], int]]:
    """(words, number of them that the segment before had too), pieces of one text in order."""
    start, carried = 0, []
    while start < len(text):
        stop = start + PIECE
        piece = text[start:stop]
        while stop < len(text):  # not inside a word
            cut = piece.translate(_FOLD).rfind(b" ")
            if cut >= 0:
                piece, stop = piece[: cut + 1], start + cut + 1
                break
            piece, stop = piece + text[stop : stop + PIECE], stop + PIECE
        ws = carried + words(piece)
        yield ws, len(carried)
        carried = ws[-overlap:] if overlap else []
        start = stop


class _Found:
    """Rows found so far: for each document its number of words, and windows with their places."""

    def __init__(self, schema: pa.Schema):
        self.rows: list[tuple] = []
        self.schema = schema
        self.bytes = 0

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema
        )
        self.rows, self.bytes = [], 0
        return out


def _matched(segments: list, lengths: list[int], gram: int, prints: np.ndarray, wholes: np.ndarray):
    """(segment, first word in its text, n, window) of each window that both bitmaps let through."""
    ws = [w for _, _, part, _ in segments for w in part]
    h = _hashes(ws)
    sizes = np.array([len(part) for _, _, part, _ in segments], np.int64)
    fresh = np.array([f for _, _, _, f in segments], np.int64)
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(segments)), sizes)
    place = np.arange(len(ws)) - (ends - sizes)[of]
    for n in lengths:
        least = _fingerprints(h, n, gram)
        if not len(least):
            continue
        # Winnowing: one look-up for each stretch of windows with the same least hash.
        first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        hit = np.repeat(_present(prints, least[first]), np.diff(np.append(first, len(least))))
        s = np.flatnonzero(hit)
        s = s[(place[s] + n <= sizes[of[s]]) & (place[s] + n > fresh[of[s]])]
        s = s[_present(wholes, _runs_at(h, s, n))]
        for at in s.tolist():
            k = int(of[at])
            yield k, segments[k][1] + int(place[at]), n, b" ".join(ws[at : at + n])


def _search(lengths: list[int], gram: int, prints: np.ndarray, wholes: np.ndarray):
    overlap = max(lengths, default=1) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            uids, names = batch.column(0), batch.column(1)
            texts = batch.column(2).cast(pa.binary())
            if found is None:
                found = _Found(
                    pa.schema(
                        [
                            ("uid", pa.int64()),
                            ("doc", names.type),
                            ("n_words", pa.int64()),
                            ("n_found", pa.int64()),
                            ("window", pa.binary()),
                            ("n", pa.int32()),
                            ("at", pa.list_(pa.int64())),
                        ]
                    )
                )
            open_segments: list[tuple[int, int, list[bytes], int]] = []
            open_words = 0
            n_found = [0] * batch.num_rows

            def look(open_segments=open_segments, uids=uids, n_found=n_found, found=found) -> None:
                places: dict[tuple[int, int, bytes], list[int]] = {}
                for k, at, n, window in _matched(open_segments, lengths, gram, prints, wholes):
                    places.setdefault((open_segments[k][0], n, window), []).append(at)
                for (row, n, window), at in places.items():
                    n_found[row] += 1
                    found.rows.append((uids[row].as_py(), None, None, None, window, n, at))
                    found.bytes += len(window) + 8 * len(at) + 32
                open_segments.clear()

            done, counts = 0, [0] * batch.num_rows
            for row in range(batch.num_rows):
                base = 0
                for ws, fresh in _segments(texts[row].as_py() or b"", overlap):
                    open_segments.append((row, base - fresh, ws, fresh))
                    base += len(ws) - fresh
                    open_words += len(ws)
                    if open_words > PIECE // 6:
                        look()
                        open_words = 0
                counts[row] = base
                if not open_segments:
                    for r in range(done, row + 1):
                        found.rows.append((uids[r].as_py(), names[r].as_py(), counts[r], n_found[r], None, None, None))
                    done = row + 1
                if found.bytes > PIECE or len(found.rows) > 10_000:
                    yield found.batch()
            look()
            for r in range(done, batch.num_rows):
                found.rows.append((uids[r].as_py(), names[r].as_py(), counts[r], n_found[r], None, None, None))
            yield found.batch()

    return run


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): its words, those inside a window of an item, and the items.

    Returns doc_id, n_words, n_hit, spans (stretches of hit words: first, one past the last),
    n_items, items_sha256, contaminated.
    """
    tests = staged_rows(item_windows(items, window, gram), "item-windows")
    facts = tests.select("window", "n", "print", "whole").groupBy("window").agg(
        F.first("n").alias("n"), F.first("print").alias("print"), F.first("whole").alias("whole")
    )
    known = staged_rows(with_uid(facts).withColumnRenamed("uid", "wid"), "windows")
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())
    size = known.select(F.sum(F.octet_length("window") + 32)).head()[0] or 0
    search = _search(lengths, gram, _bitmap(known, "print"), _bitmap(known, "whole"))
    narrow = with_uid(docs.select("doc_id", F.col("text").cast("string"))).select("uid", "doc_id", "text")
    kind = dict(narrow.dtypes)["doc_id"]
    found = staged_rows(
        narrow.mapInArrow(
            search, f"uid long, doc {kind}, n_words long, n_found long, window binary, n int, at array<long>"
        ),
        "decontamination",
    )
    base = found.filter(F.col("window").isNull()).select("uid", F.col("doc").alias("doc_id"), "n_words", "n_found")
    side = known.select("window", "wid")
    side = F.broadcast(side) if size <= broadcast_bytes else side
    spans = F.transform("at", lambda s: F.struct(s.alias("first"), (s + F.col("n")).alias("last")))
    matched = found.filter(F.col("window").isNotNull()).join(side, "window").select("uid", "wid", spans.alias("spans"))
    hit = matched.groupBy("uid").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.collect_set("wid")).alias("wids"),
    )
    windows = _digest(F.col("wids").cast("array<string>")).alias("windows")
    merged = hit.select("uid", "wids", windows, F.col("spans.first").alias("first"), F.col("spans.last").alias("last")).mapInArrow(
        _merged, f"uid long, wids array<long>, windows string, spans {_SPANS}"
    )
    per_doc = staged_rows(merged, "contaminated")
    # Documents with the same windows hold the same items.
    sets = per_doc.groupBy("windows").agg(F.first("wids").alias("wids"))
    named = known.join(tests.select("window", "item").distinct(), "window").select("wid", "item")
    listed = (
        sets.select("windows", F.explode("wids").alias("wid"))
        .join(named, "wid")
        .groupBy("windows")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select("windows", F.size("items").cast("long").alias("n_items"), _digest(F.col("items")).alias("items_sha256"))
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    some = (
        base.filter("n_found > 0")
        .join(per_doc.join(listed, "windows"), "uid", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"),
            F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        )
    )
    none = base.filter("n_found = 0").select(
        "doc_id",
        "n_words",
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast(_SPANS).alias("spans"),
        F.lit(0).cast("long").alias("n_items"),
        F.sha2(F.lit(""), 256).alias("items_sha256"),
    )
    return some.unionByName(none).withColumn("contaminated", F.col("n_hit") > 0)


_SPANS = "array<struct<first:bigint,last:bigint>>"


def _digest(names: Column) -> Column:
    return F.sha2(F.array_join(names, ","), 256)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches in order, those that touch or overlap made one."""
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    for batch in batches:
        spans = []
        for row in range(batch.num_rows):
            first, last = (batch.column(c)[row].values.to_numpy() for c in ("first", "last"))
            reach = np.maximum.accumulate(last)
            opens = np.concatenate(([True], first[1:] > reach[:-1]))
            closes = np.append(opens[1:], True)
            spans.append([{"first": a, "last": b} for a, b in zip(first[opens].tolist(), reach[closes].tolist(), strict=True)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, kind)], ["uid", "wids", "windows", "spans"])


#: DuckDB SQL of the digest columns: every window of every document in full.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
), dw AS (
  SELECT uid, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT uid, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM d, (SELECT DISTINCT n FROM iw) AS lengths WHERE len(w) >= n)
), hits AS (
  SELECT dw.uid, dw.s, dw.n, dw.win FROM dw WHERE dw.win IN (SELECT win FROM iw)
), covered AS (
  SELECT uid, count(*) AS n_hit FROM (SELECT DISTINCT uid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY uid
), found AS (
  SELECT h.uid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT uid, win FROM hits) AS h JOIN iw ON iw.win = h.win GROUP BY h.uid
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered AS c ON c.uid = d.uid LEFT JOIN found AS f ON f.uid = d.uid
"""
