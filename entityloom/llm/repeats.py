"""Removing repeated byte strings across documents with suffix arrays.

Every string of ``LENGTH`` bytes that also starts earlier (in a smaller doc_id, or before in the
same document) is repeated, and all bytes under repeated strings go.  The job finds them so:

1. Each string is assigned to its anchor, the leftmost of the 32-byte runs in it with the
   smallest hash.  Equal strings have equal anchors at the same place, so strings of different
   anchors need never meet.  The strings of one anchor form a segment of some 135 bytes.
2. Segments are dealt by anchor.  A segment whose anchor occurs once is done; of equal segments
   the first stays and the others are repeated as a whole (equal ones are already folded where
   they are read).  What remains are different segments around one anchor, the edges of copies.
3. Those are dealt into shards.  A shard builds the suffix array of its segments
   (Larsson-Sadakane) and the common prefixes (Kasai); a run of suffixes that share ``LENGTH``
   bytes is one string, and all but its first place are repeated.
4. An anchor with very many segments is spread over several shards.  Each of them sends its
   sorted distinct strings on, and these are merged by binary search in one list.
5. Only documents with repeated strings are read again, to cut and hash them.

Hashes only decide what is compared, except that segments are held equal on 96 bits of two
independent hashes and their anchor's place.

Defined results: a NULL text is empty; texts below ``LENGTH`` bytes stay whole; rows that repeat
a doc_id are documents of their own, in the order of their address; a NULL doc_id comes after
all others; no two rows share a key, however often a doc_id repeats; an empty table gives an empty result; a
very long text is searched in overlapping pieces (``PIECE_BYTES``), so its length costs time and no more than
a few times its own size in memory; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import SENDER_ROWS, addressed, bitmaps_of, by_bitmap, place_of, sender_of, staged_rows
from entityloom.llm.suffix_array import Segments, kasai, larsson_sadakane

LENGTH = 100
ANCHOR = 32
#: Bytes of text taken together in a task.
PIECE_BYTES = 2_000_000
#: Segments in a shard, about; an anchor with more of them is spread over several shards.
SHARD_SEGMENTS = 12_000
_WINDOW = LENGTH - ANCHOR + 1  # anchors that lie in one string
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_LAST = 2**63 - 1  # stands for a NULL doc_id: after all others
_PLACE = 2**28 - 1  # places in a piece; the other bits of the order of anchors are their hash


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Hashes:
    """Hashes of any byte runs of an array, by sums of prefixes modulo 2**64."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), dtype=np.uint64, out=self.sums[1:])
        self.back = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def runs(self, size: int) -> np.ndarray:
        return _mixed((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])


def segments_of(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first string, strings, anchor hash, segment hash) of each segment of joined texts.

    Places are relative to the document.
    """
    n, ends = len(raw) - LENGTH + 1, np.cumsum(sizes)
    if n < 1:
        return (np.empty(0, np.int64),) * 5
    hashes = _Hashes(raw)
    runs = hashes.runs(ANCHOR)
    # Hash and place in one number: its minimum is the leftmost of the smallest hashes.
    least = (runs & ~np.uint64(_PLACE)) | np.arange(len(runs), dtype=np.uint64)
    width = 1
    while 2 * width <= _WINDOW:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:n], least[_WINDOW - width :][:n])
    doc_of = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.flatnonzero(np.arange(n) + LENGTH <= ends[doc_of[:n]])
    if not len(begin):
        return (np.empty(0, np.int64),) * 5
    place = (least[begin] & np.uint64(_PLACE)).astype(np.int64)
    at = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.append(at, len(begin)))
    first, doc = begin[at], doc_of[begin[at]]
    whole = hashes.of(first, first + count - 1 + LENGTH)
    starts = ends - sizes
    return doc, first - starts[doc], count, runs[place[at]].view(np.int64), (whole >> np.uint64(32)).astype(np.int64)


def _table(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in text.split(", ")])


_SEGMENT = "h long, g long, doc_id long, uid long, first int, count int, again boolean"
_FOUND = "h long, doc_id long, uid long, first int, count int, open boolean"


def _runs(doc: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adjacent stretches of a document in one row; input sorted by (document, first)."""
    if not len(doc):
        return doc, first, count
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (first[1:] != first[:-1] + count[:-1])))
    at = np.flatnonzero(new)
    return doc[at], first[at], np.add.reduceat(count, at)


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each text; of those that are equal in a piece only the first, the others as repeated."""
    schema = _schema(_SEGMENT)
    for batch in batches:
        ids, uids = batch.column("doc_id").to_numpy(), batch.column("uid").to_numpy()
        row_rank = np.empty(batch.num_rows, np.int64)
        row_rank[np.lexsort((uids, ids))] = np.arange(batch.num_rows)
        part, size = [], 0
        for piece in _text_pieces(batch.column("text")):
            part.append(piece)
            size += len(piece[2])
            if size >= PIECE_BYTES:
                yield from _part_segments(part, ids, uids, row_rank, schema)
                part, size = [], 0
        if part:
            yield from _part_segments(part, ids, uids, row_rank, schema)


def _text_pieces(texts: pa.Array) -> Iterator[tuple[int, int, memoryview]]:
    """(row, place, bytes): pieces of texts that overlap by what a string needs, so that each starts in one."""
    for row, text in enumerate(texts):
        raw = memoryview(text.as_buffer() or b"")
        for place in range(0, max(len(raw) - LENGTH + 1, 1), PIECE_BYTES):
            yield row, place, raw[place : place + PIECE_BYTES + LENGTH - 1]


def _part_segments(part: list, ids: np.ndarray, uids: np.ndarray, row_rank: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Segments of some pieces, repeated ones apart.  A segment cut by the end of a piece is two, which meet later."""
    row_of, place_of_piece = (np.array([p[i] for p in part], np.int64) for i in (0, 1))
    sizes = np.fromiter((len(p[2]) for p in part), np.int64, len(part))
    piece, first, count, h, g = segments_of(np.frombuffer(b"".join(p[2] for p in part), np.uint8), sizes)
    doc, first = row_of[piece], first + place_of_piece[piece]
    by_h = np.argsort(h, kind="stable")
    same = h[by_h][1:] == h[by_h][:-1]
    twice = by_h[np.concatenate(([False], same)) | np.concatenate((same, [False]))] if len(h) else by_h
    twice = twice[np.lexsort((first[twice], row_rank[doc[twice]], g[twice], h[twice]))]
    later = np.zeros(len(h), bool)
    later[twice[1:][(h[twice][1:] == h[twice][:-1]) & (g[twice][1:] == g[twice][:-1])]] = True
    rows = [h, g, doc, first, count]
    yield _table(_named(ids, uids, 0, *(x[~later] for x in rows)) + [np.zeros((~later).sum(), bool)], schema)
    rd, rf, rc = _runs(doc[later], first[later], count[later])
    spread = _mixed((ids[rd].view(np.uint64) + rf.astype(np.uint64)) * np.uint64(_BASE)).view(np.int64)
    yield _table(_named(ids, uids, 0, spread, np.zeros(len(rd)), rd, rf, rc) + [np.ones(len(rd), bool)], schema)


def _named(ids, uids, start, h, g, doc, first, count) -> list:
    return [h, g.astype(np.int64), ids[start + doc], uids[start + doc], first.astype(np.int32), count.astype(np.int32)]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, segment and order: later equal segments are repeated, and the first
    ones are open where their anchor has another segment too."""
    schema = _schema(_FOUND)
    last_h = last_g = None
    many = False  # the anchor of the row before has two different segments
    held: pa.RecordBatch | None = None  # its first segment, while it has only one
    for batch in batches:
        if not batch.num_rows:
            continue
        h, g = batch.column("h").to_numpy(), batch.column("g").to_numpy()
        again = batch.column("again").to_numpy(zero_copy_only=False)
        new_h = np.concatenate(([h[0] != last_h], h[1:] != h[:-1])) | again
        new_g = new_h | np.concatenate(([g[0] != last_g], g[1:] != g[:-1]))
        found = batch.select(["h", "doc_id", "uid", "first", "count"])
        repeated = found.take(pa.array(np.flatnonzero(~new_g | again)))
        yield pa.RecordBatch.from_arrays([*repeated.columns, pa.array(np.zeros(repeated.num_rows, bool))], schema=schema)
        group = np.cumsum(new_h)  # 0 goes on from the batch before
        firsts = np.flatnonzero(new_g & ~again)
        size = np.bincount(group[firsts], minlength=group[-1] + 1)
        is_open = size[group[firsts]] > 1
        if group[0] == 0 and size[0]:
            is_open[group[firsts] == 0] = True
            if held is not None and not many:
                yield held
            many, held = True, None
        tail = group[firsts] == group[-1]
        if group[-1] > 0:
            many, held = bool(size[-1] > 1), None
            if size[-1] == 1:
                row = found.slice(int(firsts[tail][0]), 1)
                held = pa.RecordBatch.from_arrays([*row.columns, pa.array([True])], schema=schema)
        opened = found.take(pa.array(firsts[is_open]))
        yield pa.RecordBatch.from_arrays([*opened.columns, pa.array(np.ones(opened.num_rows, bool))], schema=schema)
        last_h, last_g = h[-1], g[-1]


_SHARD = "h long, part int, salt int, doc_id long, uid long, first int, count int, string binary"


def _search_shard(table: pa.Table) -> pa.Table:
    """Suffix array of a shard; what is repeated in it, and the distinct strings of spread anchors."""
    s = Segments(table.column("bytes").to_pylist())
    order = larsson_sadakane(s)
    fresh = kasai(s, order) < LENGTH
    ids, uids = table.column("doc_id").to_numpy(), table.column("uid").to_numpy()
    h, salts = table.column("h").to_numpy(), table.column("salts").to_numpy()
    first = table.column("first").to_numpy().astype(np.int64)
    key = np.lexsort((uids, ids))
    rank = np.empty(len(key), np.int64)
    moved = np.concatenate(([False], (ids[key][1:] != ids[key][:-1]) | (uids[key][1:] != uids[key][:-1])))
    rank[key] = np.cumsum(moved)
    segment = s.segment[order]
    start = first[segment] + order - s.starts[segment]
    place = np.where(s.left[order] >= LENGTH, (rank[segment] << 32) + start, np.iinfo(np.int64).max)
    at = np.flatnonzero(fresh)
    earliest = np.repeat(np.minimum.reduceat(place, at), np.diff(np.append(at, len(order))))
    valid = s.left[order] >= LENGTH
    again = np.zeros(len(order), bool)
    again[order[valid & (place > earliest)]] = True
    where = np.flatnonzero(again)
    seg, f, c = _runs(s.segment[where], first[s.segment[where]] + where - s.starts[s.segment[where]], np.ones(len(where), np.int64))
    none = [None] * len(seg)
    rows = [h[seg], np.zeros(len(seg)), np.zeros(len(seg)), ids[seg], uids[seg], f, c, none]
    keep = order[valid & (place == earliest) & (salts[segment] > 1)]  # in the order of the strings
    seg = s.segment[keep]
    strings = [s.raw[i : i + LENGTH].tobytes() for i in keep]
    parts = [hash_part(x, int(salts[k])) for x, k in zip(strings, seg, strict=True)]
    salt = np.full(len(keep), table.column("salt")[0].as_py() if table.num_rows else 0)
    more = [h[seg], parts, salt, ids[seg], uids[seg], first[seg] + keep - s.starts[seg], np.ones(len(keep)), strings]
    kinds = _schema(_SHARD).types
    return pa.table(
        {
            name: pa.chunked_array([pa.array(np.asarray(x).astype(kind.to_pandas_dtype()) if kind != pa.binary() else x, kind) for x in (a, b)])
            for name, kind, a, b in zip(_schema(_SHARD).names, kinds, rows, more, strict=True)
        }
    )


def hash_part(string: bytes, salts: int) -> int:
    """The part of a spread anchor's strings that a string is merged in."""
    return int.from_bytes(hashlib.blake2b(string, digest_size=4).digest(), "little") % (64 * salts)


def merge_sorted(blocks: list[np.ndarray], places: list[np.ndarray]) -> list[np.ndarray]:
    """For sorted blocks of distinct strings: which of them also stand in another block at a smaller place.

    Each block is looked up in the merged list of those before it by binary search; equal strings
    keep the smaller place there, the others are put in.
    """
    losers = [np.zeros(len(b), bool) for b in blocks]
    known, place = blocks[0], places[0]
    owner, index = np.zeros(len(known), np.int64), np.arange(len(known))
    for k in range(1, len(blocks)):
        at = np.searchsorted(known, blocks[k])
        inside = np.minimum(at, len(known) - 1)
        equal = (at < len(known)) & (known[inside] == blocks[k])
        mine, theirs = np.flatnonzero(equal), inside[equal]
        wins = places[k][mine] < place[theirs]
        losers[k][mine[~wins]] = True
        for j, i in zip(owner[theirs[wins]], index[theirs[wins]], strict=True):
            losers[j][i] = True
        place[theirs[wins]], owner[theirs[wins]], index[theirs[wins]] = places[k][mine[wins]], k, mine[wins]
        new = np.flatnonzero(~equal)
        known = np.insert(known, at[new], blocks[k][new])
        place, owner, index = (
            np.insert(a, at[new], b) for a, b in ((place, places[k][new]), (owner, k), (index, new))
        )
    return losers


def _merge_strings(table: pa.Table) -> pa.Table:
    ids, uids, first = (table.column(c).to_numpy() for c in ("doc_id", "uid", "first"))
    salt = table.column("salt").to_numpy()
    strings = np.array(table.column("string").to_pylist(), dtype=f"S{LENGTH}")
    rank = np.empty(len(ids), np.int64)
    rank[np.lexsort((first, uids, ids))] = np.arange(len(ids))
    rows = [np.flatnonzero(salt == k) for k in np.unique(salt)]
    rows = [r[np.argsort(strings[r], kind="stable")] for r in rows]
    losers = merge_sorted([strings[r] for r in rows], [rank[r] for r in rows])
    lost = np.concatenate([r[x] for r, x in zip(rows, losers, strict=True)])
    out = table.select(["doc_id", "uid", "first", "count"]).take(pa.array(lost))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each segment that is asked for."""
    schema = _schema("shard long, salt int, salts int, h long, doc_id long, uid long, first int, bytes binary")
    for batch in batches:
        for row in range(batch.num_rows):
            raw, wanted = batch.column("text")[row].as_buffer().to_pybytes(), batch.column("wanted")[row].as_py()
            n = len(wanted)
            columns = [[w[c] for w in wanted] for c in ("shard", "salt", "salts", "h")]
            columns += [[batch.column(c)[row].as_py()] * n for c in ("doc_id", "uid")]
            columns += [[w["first"] for w in wanted], [raw[w["first"] : w["first"] + w["count"] - 1 + LENGTH] for w in wanted]]
            yield _table(columns, schema)


def remaining(raw: bytes, stretches: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left without the bytes of repeated strings, and the number of removed runs."""
    parts, end, spans = [], 0, 0
    for first, count in sorted(stretches):
        if first > end or (first == end and not spans):
            parts.append(raw[end:first])
            spans += 1
        end = max(end, first + count - 1 + LENGTH)
    parts.append(raw[end:])
    return b"".join(parts), spans


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            raw = batch.column("text")[row].as_buffer().to_pybytes()
            left, spans = remaining(raw, [(w["first"], w["count"]) for w in batch.column("stretches")[row].as_py()])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": [batch.column("doc_id")[row].as_py()],
                    "n_bytes": [len(raw)],
                    "n_removed": [len(raw) - len(left)],
                    "n_spans": [spans],
                    "kept_sha256": [hashlib.sha256(left).hexdigest()],
                    "kept": [left],
                },
                schema=pa.schema(
                    [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")), ("kept_sha256", pa.string()), ("kept", pa.binary())]
                ),
            )


def _block_bits(file: Column, block: Column, salt: int) -> Column:
    """The upper bits of a row's uid, by its block of a file; the place in the block has the lower 16."""
    return F.shiftleft(F.xxhash64(F.lit(salt), file, block), SENDER_ROWS.bit_length() - 1)


def _blocks(blocks: DataFrame, bits=_block_bits) -> tuple[int, int]:
    """The number of rows, and a salt under which no two of the ``blocks`` (file, block, count) share their bits."""
    salt = 0
    while True:
        upper = bits(F.col("file"), F.col("block"), salt)
        row = blocks.agg(
            F.sum("count").alias("rows"), F.count(F.lit(1)).alias("blocks"), F.count_distinct(upper).alias("different")
        ).first()
        if row["blocks"] == row["different"]:
            return row["rows"] or 0, salt
        salt += 1


class _Source:
    """Texts under the key (doc_id, uid), and the few of them that a table of keys names."""

    def __init__(self, docs: DataFrame):
        placed, file, at = addressed(docs)
        block = F.floor(F.col(at) / SENDER_ROWS)
        self.n, salt = _blocks(placed.groupBy(F.col(file).alias("file"), block.alias("block")).count())
        self.texts = placed.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"),
            (_block_bits(F.col(file), block, salt) + place_of(at)).alias("uid"),
            sender_of(file, at).alias("sender"),
            place_of(at).alias("place"),
            F.coalesce("text", F.lit("")).alias("text"),
        )

    def bitmaps(self, keys: DataFrame) -> DataFrame:
        """(sender, words): a bit for each row that ``keys`` (doc_id, uid) names."""
        rows = self.texts.select("sender", "place", "doc_id", "uid").join(keys, ["doc_id", "uid"], "left_semi")
        return bitmaps_of(rows)

    def named(self, bitmaps: DataFrame, wanted: bool) -> DataFrame:
        rows = by_bitmap(self.texts, F.col("sender"), F.col("place"), bitmaps, self.n, wanted)
        return rows.select("doc_id", "uid", "text")


def _shards(found: DataFrame) -> DataFrame:
    """The open segments with their shard; anchors with too many are spread."""
    segments = found.filter("open").select("h", "doc_id", "uid", "first", "count")
    n_shards = max(1, -(-segments.count() // SHARD_SEGMENTS))
    spread = (
        segments.groupBy("h").count().filter(F.col("count") > SHARD_SEGMENTS)
        .select("h", F.ceil(F.col("count") / SHARD_SEGMENTS).cast("int").alias("salts"))
    )
    salts = F.coalesce("salts", F.lit(1))
    return segments.join(spread, "h", "left").select(
        F.pmod("h", F.lit(n_shards)).alias("shard"),
        F.pmod(F.hash("doc_id", "uid", "first"), salts).alias("salt"),
        salts.alias("salts"),
        "h", "doc_id", "uid", "first", "count",
    )


def repeated_strings(docs: DataFrame) -> tuple[_Source, DataFrame]:
    """(doc_id, uid, first, count): stretches of starts of strings that also start earlier."""
    source = _Source(docs)
    met = (
        source.texts.select("doc_id", "uid", "text")
        .mapInArrow(_read_segments, _SEGMENT)
        .repartition("h")
        .sortWithinPartitions("again", "h", "g", "doc_id", "uid", "first")
        .mapInArrow(_meet, _FOUND)
    )
    found = staged_rows(met, "repeats-found")
    dealt = staged_rows(_shards(found), "repeats-open")
    keys = ["doc_id", "uid"]
    texts = source.named(source.bitmaps(dealt.select(*keys)), wanted=True)
    wanted = dealt.groupBy(*keys).agg(
        F.collect_list(F.struct("shard", "salt", "salts", "h", "first", "count")).alias("wanted")
    )
    cut = texts.join(wanted, keys).mapInArrow(
        _cut, "shard long, salt int, salts int, h long, doc_id long, uid long, first int, bytes binary"
    )
    searched = staged_rows(cut.groupBy("shard", "salt").applyInArrow(_search_shard, _SHARD), "repeats-searched")
    merged = (
        searched.filter("string is not null").groupBy("h", "part")
        .applyInArrow(_merge_strings, "doc_id long, uid long, first int, count int")
    )
    columns = ["doc_id", "uid", "first", "count"]
    stretches = (
        found.filter("not open").select(*columns)
        .unionByName(searched.filter("string is null").select(*columns))
        .unionByName(merged)
    )
    return source, staged_rows(stretches, "repeats")


def without_repeats(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row, and the bytes ``kept`` if asked for."""
    source, stretches = repeated_strings(docs)
    bitmaps = staged_rows(source.bitmaps(stretches.select("doc_id", "uid")), "repeats-bitmaps")
    per_doc = stretches.groupBy("doc_id", "uid").agg(F.collect_list(F.struct("first", "count")).alias("stretches"))
    changed = source.named(bitmaps, wanted=True).join(per_doc, ["doc_id", "uid"]).mapInArrow(_remove, _RESULT)
    size = F.octet_length("text").cast("long")
    zero = F.lit(0).cast("long")
    same = source.named(bitmaps, wanted=False).select(
        "doc_id",
        size.alias("n_bytes"),
        zero.alias("n_removed"),
        zero.alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        F.encode("text", "UTF-8").alias("kept"),
    )
    out = same.unionByName(changed).withColumn("doc_id", F.nullif("doc_id", F.lit(_LAST)))
    return out if with_bytes else out.drop("kept")
