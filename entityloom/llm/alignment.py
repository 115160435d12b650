"""Two tokenizers of the same text aligned: byte-range chunks are fragments, and fragments compose.

Byte offsets where tokens of both end cut the tokens into groups.  A chunk of a document's bytes
has the tokens that end in it; what it can say of groups is a fragment:

* without a common end, all its tokens are open (a bridge);
* else an open prefix up to its first common end, closed groups, and an open suffix after the last.

Fragments compose associatively: the suffix of the left and the prefix of the right make one more
closed group, bridges lengthen what they touch, and the empty bridge changes nothing.  So a
very long document is dealt out as chunks, tokenized by many tasks, and its open ends are reduced as a
tree; closed groups stay where they are.  Afterwards each chunk has the whole groups that end in it,
and long and short documents go on alike.

A chunk is tokenized within the nearest places where neither tokenizer lets a token cross: before
a space between two characters that are no white space.  (A text without any is one stretch for the
tokenizers.)  Token bytes come from the vocabularies, and every stretch is compared with them.

Counts of linked id pairs are summed over all documents; they go back to the documents as a sorted
table where it is small, and by a join on the pair beyond (``broadcast_pairs``).

Defined results: NULL and empty texts, and those that some token bytes differ from, have no tokens
and an empty column of groups; rows that repeat a doc_id are rows of their own; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityloom.llm.common import give_back, staged_rows, with_uid
from entityloom.llm.tokens import WordMemory, split_units, spread
from entityloom.session import scratch_path

#: Documents of more bytes are cut into chunks of so many.
CHUNK = 1 << 15
#: Fragments of a document composed by one step of the tree.
FAN = 64
#: Up to so many id pairs (17 bytes each) are sent to all tasks.
BROADCAST_PAIRS = 2_000_000
#: Texts are tokenized and aligned together up to so many bytes.
PIECE = 1 << 20
#: Words whose ids a worker remembers.
MEMORY_WORDS = 300_000
_SPACE = "▁"
_EMPTY = np.empty(0, np.uint32)


def byte_level() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: visible ones stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Tokenizers:
    """Both tokenizers of a worker, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        to_byte, vocabulary = byte_level(), self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in to_byte for c in token):
                self.bytes_a[i] = bytes(to_byte[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        #: No token of B may hold a blank behind something else, or a newline, or cuts there were not safe.
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in pieces)
        self.blank = self.b.piece_to_id(_SPACE)
        self.sizes = tuple(np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.memory = WordMemory([self._units_a, self._units_b], MEMORY_WORDS)

    def _a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _checked(self, raw: list[bytes], coded: list[list[int]], table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids in one array and their numbers; none for a unit that their bytes differ from."""
        good = [ids if b"".join(map(table.__getitem__, ids)) == unit else [] for unit, ids in zip(raw, coded, strict=True)]
        return np.fromiter((i for ids in good for i in ids), np.uint32), np.fromiter(map(len, good), np.int64, len(good))

    def _units_a(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self._checked(raw, self._a([u.decode() for u in raw]), self.bytes_a)

    def _units_b(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # The library puts a blank before each unit; a unit that starts with a newline has none of its own.
        own = self.b.encode([u.decode() if u[:1] == b"\n" else u[1:].decode() for u in raw], num_threads=1)
        coded = [ids[1:] if u[:1] == b"\n" and ids[:1] == [self.blank] else ids for u, ids in zip(raw, own, strict=True)]
        return self._checked(raw, coded, self.bytes_b)

    def encode(self, stretches: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """Ids of both for each stretch (a space, then text), and whether their bytes are the stretch.

        Where single blanks or newlines part all words, a word is encoded once and remembered.
        """
        out: list[tuple[np.ndarray, np.ndarray, bool]] = [(_EMPTY, _EMPTY, True)] * len(stretches)
        texts = [s[1:].decode() for s in stretches]
        sure = [i for i, t in enumerate(texts) if _has_single_blanks(t)]
        if sure:
            units, at, n = split_units([texts[i].replace("\n", " \n") for i in sure])
            found = self.memory.look_up([u if u[:1] == b"\n" else b" " + u for u in units.to_pylist()])
            spans = [spread(side, at, n) for side in found]
            for k, i in enumerate(sure):
                ids = [flat[ends[k - 1] if k else 0 : ends[k]] for flat, ends in spans]
                same = all(int(size[x].sum()) == len(stretches[i]) for size, x in zip(self.sizes, ids, strict=True))
                out[i] = (*ids, same)
        whole = [i for i, t in enumerate(texts) if t and not _has_single_blanks(t)]
        if whole:
            both = self._a([" " + texts[i] for i in whole]), self.b.encode([texts[i] for i in whole], num_threads=1)
            for i, a, b in zip(whole, *both, strict=True):
                same = all(b"".join(map(t.__getitem__, x)) == stretches[i] for t, x in ((self.bytes_a, a), (self.bytes_b, b)))
                out[i] = (np.array(a, np.uint32), np.array(b, np.uint32), same)
        return out


def _has_single_blanks(text: str) -> bool:
    """Words, each followed by one space or newline and another word; no other white space or control character."""
    if not text.replace("\n", " ").isprintable() or _SPACE in text or not text:
        return False
    return text[0] not in " \n" and text[-1] not in " \n" and not any(x in text for x in ("  ", "\n\n", " \n", "\n "))


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _is_cut(data: bytes, at: int) -> bool:
    """Whether no token of either can cross ``at``, which holds a space."""
    if not 0 < at < len(data) - 1:
        return False
    start = at - 1
    while data[start] & 0xC0 == 0x80:
        start -= 1
    stop = at + 2
    while stop < len(data) and data[stop] & 0xC0 == 0x80:
        stop += 1
    return not any(c.isspace() or c == _SPACE for c in (data[start:at] + data[at + 1 : stop]).decode())


def _cut_from(data: bytes, at: int) -> int:
    """The first safe cut at or after ``at``."""
    while (at := data.find(b" ", at)) >= 0:
        if _is_cut(data, at):
            return at
        at += 1
    return len(data)


def _cut_up_to(data: bytes, at: int) -> int:
    """The last safe cut at or before ``at``."""
    while (at := data.rfind(b" ", 0, at + 1)) > 0:
        if _is_cut(data, at):
            return at
        at -= 1
    return 0


def _ranges(data: bytes, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(low, high, start, stop): chunks, and the stretch between safe cuts that each lies in.

    Where no cut is near, a chunk goes on to the next cut, so that stretches hardly overlap.
    """
    low = start = 0
    while low < len(data):
        high = min(low + size, len(data))
        before = stop = len(data)
        if high < len(data):
            before, stop = _cut_up_to(data, high), _cut_from(data, high)
            if max(high - before, stop - high) > size:
                high = before = stop
        yield low, high, start, stop
        low, start = high, before


def _chunks(size: int):
    """Chunks of long documents: (uid, doc_id, k, n_chunks, low, high, stretch); ends count inside the stretch."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = b" " + batch.column("text")[row].as_py()
                ranges = list(_ranges(data, size))
                for k, (low, high, start, stop) in enumerate(ranges):
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).slice(row, 1) for c in ("uid", "doc_id")),
                            *(pa.array([v], pa.int64()) for v in (k, len(ranges), low - start, high - start)),
                            pa.array([data[start:stop]], pa.binary()),
                        ],
                        ["uid", "doc_id", "k", "n_chunks", "low", "high", "stretch"],
                    )

    return cut


_TOKENS = "uid long, doc_id {kind}, k long, n_chunks long, same boolean, a binary, b binary, a_from long, b_from long"


def _encode(path_a: str, path_b: str):
    """Tokens that end within (low, high] of each stretch; ``a_from``, ``b_from``: where the first of them starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        kinds = [_kind(size) for size in both.sizes]
        for batch in batches:
            stretches, lows, highs = (batch.column(c).to_pylist() for c in ("stretch", "low", "high"))
            start = 0
            while start < len(stretches):
                stop, size = start, 0
                while stop < len(stretches) and size < PIECE:
                    size += len(stretches[stop])
                    stop += 1
                same, ids, froms = [], ([], []), ([], [])
                coded = both.encode(stretches[start:stop])
                for low, high, (*tokens, ok) in zip(lows[start:stop], highs[start:stop], coded, strict=True):
                    same.append(ok)
                    for side in (0, 1):
                        ends = np.cumsum(both.sizes[side][tokens[side]])
                        first, last = np.searchsorted(ends, [low, high], side="right")
                        ids[side].append(tokens[side][first:last].astype(kinds[side]).tobytes() if ok else b"")
                        froms[side].append(int(ends[first - 1]) - low if first and ok else -low)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(start, stop - start) for c in ("uid", "doc_id", "k", "n_chunks")),
                        pa.array(same, pa.bool_()),
                        *(pa.array(x, pa.binary()) for x in ids),
                        *(pa.array(x, pa.int64()) for x in froms),
                    ],
                    ["uid", "doc_id", "k", "n_chunks", "same", "a", "b", "a_from", "b_from"],
                )
                start = stop
            give_back()

    return run


def _staged_small(df: DataFrame, label: str) -> DataFrame:
    """As ``staged_rows``, packed closer: ids repeat."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tokens_of(docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK) -> DataFrame:
    """Tokens of each chunk (uid, doc_id, k, n_chunks, same, a, b, a_from, b_from), ids as 16 or 32-bit integers.

    Short documents (even uid) are tokenized where they are read; the chunks of long ones (odd) are dealt out.
    """
    narrow = with_uid(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")))
    narrow = narrow.select("uid", "doc_id", "text")
    kind = dict(narrow.dtypes)["doc_id"]
    is_short = F.octet_length("text") < chunk
    long = lambda v: F.lit(v).cast("long")
    stretch = F.concat(F.lit(b" "), F.col("text"))
    short = narrow.filter(is_short).select(
        (2 * F.col("uid")).alias("uid"), "doc_id", long(0).alias("k"), long(1).alias("n_chunks"), long(0).alias("low"),
        F.octet_length(stretch).cast("long").alias("high"), stretch.alias("stretch"),
    )
    chunks = narrow.filter(~is_short).withColumn("uid", 2 * F.col("uid") + 1).mapInArrow(
        _chunks(chunk), f"uid long, doc_id {kind}, k long, n_chunks long, low long, high long, stretch binary"
    )
    dealt = chunks.repartition("uid", "k")
    coded = [df.mapInArrow(_encode(path_a, path_b), _TOKENS.format(kind=kind)) for df in (short, dealt)]
    return _staged_small(coded[0].unionByName(coded[1]), "token-chunks")


@dataclass
class Aligned:
    """Tokens of both over the same bytes, from a common start to a common end, and what links them."""

    a: np.ndarray
    b: np.ndarray
    sizes: tuple[np.ndarray, np.ndarray]
    ends_a: np.ndarray = field(init=False)
    ends_b: np.ndarray = field(init=False)

    def __post_init__(self):
        self.ends_a, self.ends_b = (np.cumsum(s[t]) for s, t in zip(self.sizes, (self.a, self.b), strict=True))
        n = int(self.ends_a[-1]) + 1 if len(self.a) else 1
        at_a, at_b = np.zeros(n, np.int8), np.zeros(n, np.int8)
        at_a[self.ends_a] = 1
        at_b[self.ends_b] = 1
        #: Ends of links: between two neighbouring ends exactly one token of each lies.
        self.links = np.flatnonzero(at_a | at_b)
        self.groups = np.flatnonzero(at_a & at_b)
        before_a = np.cumsum(at_a, dtype=np.int64)[self.links] - at_a[self.links]
        before_b = np.cumsum(at_b, dtype=np.int64)[self.links] - at_b[self.links]
        #: The id pair of each link.
        self.pairs = self.a[before_a].astype(np.int64) << 32 | self.b[before_b].astype(np.int64)

    def codes(self, n_a: int, n_b: int) -> np.ndarray:
        """Each token in the order of the groups' text, as its row in ``texts``."""
        upto_a, upto_b = (np.searchsorted(e, self.groups, side="right") for e in (self.ends_a, self.ends_b))
        many_a, many_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        out = np.empty(len(self.a) + len(self.b), np.int64)
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[upto_a - 1] = True
        last_b[upto_b - 1] = True
        out[np.arange(len(self.a)) + np.repeat(upto_b - many_b, many_a)] = self.a + n_a * last_a
        out[np.arange(len(self.b)) + np.repeat(upto_a, many_b)] = self.b + 2 * n_a + n_b * last_b
        return out


def texts(n_a: int, n_b: int) -> list[bytes]:
    """``codes`` as text: ids with a comma, or at the end of their part of a group with a bar or semicolon."""
    return [b"%d%s" % (i, mark) for n, marks in ((n_a, (b",", b"|")), (n_b, (b",", b";"))) for mark in marks for i in range(n)]


# Fragments


@dataclass
class Fragment:
    """Open tokens of a run of chunks: ids of both before the first and after the last common end.

    A bridge (``at`` negative) has all its tokens in ``prefix``.  ``at`` is the chunk of its first common end.
    """

    at: int
    prefix: tuple[np.ndarray, np.ndarray]
    suffix: tuple[np.ndarray, np.ndarray]


_NONE = (_EMPTY, _EMPTY)
EMPTY = Fragment(-1, _NONE, _NONE)


def _joined(x, y):
    return tuple(np.concatenate(p) for p in zip(x, y, strict=True))


def compose(x: Fragment, y: Fragment, closed: Callable[[int, tuple], None]) -> Fragment:
    """``x`` followed by ``y``; a group that closes between them goes to ``closed`` with the chunk it ends in."""
    if y.at < 0:
        if x.at < 0:
            return Fragment(-1, _joined(x.prefix, y.prefix), _NONE)
        return Fragment(x.at, x.prefix, _joined(x.suffix, y.prefix))
    if x.at < 0:
        return Fragment(y.at, _joined(x.prefix, y.prefix), y.suffix)
    closed(y.at, _joined(x.suffix, y.prefix))
    return Fragment(x.at, x.prefix, y.suffix)


def split(a: np.ndarray, b: np.ndarray, a_from: int, b_from: int, sizes) -> tuple[slice, slice] | None:
    """The tokens of a chunk's closed groups; those before are its prefix, those after its suffix."""
    ends_a, ends_b = a_from + np.cumsum(sizes[0][a]), b_from + np.cumsum(sizes[1][b])
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(common):
        return None
    return tuple(slice(*(int(i) + 1 for i in np.searchsorted(e, common[[0, -1]]))) for e in (ends_a, ends_b))


def _kind(size: np.ndarray) -> str:
    """How ids of a vocabulary are stored: in 16 bits where they fit."""
    return "<u2" if len(size) <= 1 << 16 else "<u4"


def _ids(cell, size: np.ndarray) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), _kind(size)) if cell.is_valid else _EMPTY


def _bytes(ids: np.ndarray, size: np.ndarray) -> bytes:
    return ids.astype(_kind(size)).tobytes()


_FRAGMENT = "uid long, k long, closed boolean, at long, prefix_a binary, prefix_b binary, suffix_a binary, suffix_b binary"
_FRAGMENT_NAMES = [f.split()[0] for f in _FRAGMENT.split(", ")]


def _fragment_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), *[pa.binary()] * 4]
    columns = list(zip(*rows, strict=True)) or [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _FRAGMENT_NAMES)


def _row(sizes, uid: int, k: int, closed: bool, at: int, prefix, suffix) -> tuple:
    return (uid, k, closed, at, *(_bytes(x, size) for part in (prefix, suffix) for x, size in zip(part, sizes, strict=True)))


def _fragments(sizes):
    """The fragment of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                uid, k, a_from, b_from = (batch.column(c)[row].as_py() for c in ("uid", "k", "a_from", "b_from"))
                a, b = (_ids(batch.column(c)[row], size) for c, size in zip(("a", "b"), sizes, strict=True))
                parts = split(a, b, a_from, b_from, sizes)
                if parts is None:
                    out.append(_row(sizes, uid, k, False, -1, (a, b), _NONE))
                else:
                    in_a, in_b = parts
                    out.append(_row(sizes, uid, k, False, k, (a[: in_a.start], b[: in_b.start]), (a[in_a.stop :], b[in_b.stop :])))
            yield _fragment_rows(out)

    return run


def _composed(sizes, fan: int):
    """Neighbouring fragments composed ``fan`` at a time; rows are sorted by uid and k.  Closed groups come as rows too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, EMPTY
        for batch in batches:
            out: list[tuple] = []
            for row in range(batch.num_rows):
                uid, k, at = (batch.column(c)[row].as_py() for c in ("uid", "k", "at"))
                ids = [_ids(batch.column(c)[row], size) for c, size in zip(_FRAGMENT_NAMES[4:], (*sizes, *sizes), strict=True)]
                if (uid, k // fan) != key:
                    if key:
                        out.append(_row(sizes, *key, False, held.at, held.prefix, held.suffix))
                    key, held = (uid, k // fan), EMPTY
                held = compose(
                    held,
                    Fragment(at, tuple(ids[:2]), tuple(ids[2:])),
                    lambda at, group, uid=uid, out=out: out.append(_row(sizes, uid, at, True, at, group, _NONE)),
                )
            yield _fragment_rows(out)
        if key:
            yield _fragment_rows([_row(sizes, *key, False, held.at, held.prefix, held.suffix)])

    return run


def crossing_groups(chunks: DataFrame, sizes, fan: int = FAN) -> DataFrame:
    """(uid, k, group_a, group_b): for each chunk the group that ends at its first common end."""
    level = chunks.select("uid", "k", "a", "b", "a_from", "b_from").mapInArrow(_fragments(sizes), _FRAGMENT)
    found = []
    most = chunks.agg(F.max("n_chunks")).head()[0] or 0
    while most:
        dealt = level.repartition("uid", F.floor(F.col("k") / fan)).sortWithinPartitions("uid", "k")
        done = staged_rows(dealt.mapInArrow(_composed(sizes, fan), _FRAGMENT), "fragments")
        found.append(done.filter("closed"))
        level = done.filter("not closed")
        most = 0 if most <= fan else -(-most // fan)
    # What is left of a document is its first group; its end is a common end, so nothing is open there.
    found.append(level.filter("at >= 0").withColumn("k", F.col("at")))
    every = reduce(DataFrame.unionByName, found)
    return every.select("uid", "k", F.col("prefix_a").alias("group_a"), F.col("prefix_b").alias("group_b"))


def _whole(sizes):
    """Each chunk with whole groups: the one that ends at its first common end, and its closed ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = ([], [])
            for row in range(batch.num_rows):
                held = zip(("a", "b", "group_a", "group_b"), (*sizes, *sizes), strict=True)
                a, b, crossing_a, crossing_b = (_ids(batch.column(c)[row], size) for c, size in held)
                parts = split(a, b, *(batch.column(c)[row].as_py() for c in ("a_from", "b_from")), sizes)
                in_a, in_b = parts or (slice(0, 0), slice(0, 0))
                for side, x, y in ((0, crossing_a, a[in_a]), (1, crossing_b, b[in_b])):
                    columns[side].append(_bytes(np.concatenate((x, y)), sizes[side]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("uid", "doc_id", "k")), *(pa.array(c, pa.binary()) for c in columns)],
                ["uid", "doc_id", "k", "a", "b"],
            )

    return run


def whole_chunks(tokens: DataFrame, sizes, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """(uid, doc_id, k, a, b) with whole groups only: of short documents, and of the chunks of long ones."""
    kind = dict(tokens.dtypes)["doc_id"]
    is_long = F.col("uid") % 2 == 1
    short = tokens.filter(~is_long).select("uid", "doc_id", "k", "a", "b")
    chunks = tokens.filter(is_long)
    # A document of which one chunk differs from its bytes has no tokens; only keys meet on the document.
    wrong = chunks.filter("not same").select("uid").distinct()
    keys = chunks.select("uid", "k").join(wrong, "uid", "left_semi").withColumn("wrong", F.lit(True))
    chunks = chunks.join(keys, ["uid", "k"], "left").withColumns(
        {c: F.when(F.col("wrong"), F.lit(b"")).otherwise(F.col(c)) for c in ("a", "b")}
    )
    chunks = _staged_small(chunks.drop("wrong", "same"), "long-documents")
    joined = chunks.join(crossing_groups(chunks, sizes, fan), ["uid", "k"], "left")
    long = joined.mapInArrow(_whole(sizes), f"uid long, doc_id {kind}, k long, a binary, b binary")
    return short, _staged_small(long, "whole-chunks")


def _parts(batch: pa.RecordBatch, sizes) -> Iterator[tuple[int, int, Aligned, np.ndarray, np.ndarray]]:
    """Rows taken together up to a bound: (first, one past the last, alignment, ids of each row in both)."""
    raw = [[_ids(x, size) for x in batch.column(c)] for c, size in zip(("a", "b"), sizes, strict=True)]
    start = 0
    while start < batch.num_rows:
        stop, size = start, 0
        while stop < batch.num_rows and size < PIECE // 4:
            size += len(raw[0][stop])
            stop += 1
        a, b = (np.concatenate(r[start:stop]).astype(np.uint32) for r in raw)
        counts = [np.array([len(x) for x in r[start:stop]], np.int64) for r in raw]
        yield start, stop, Aligned(a, b, sizes), *counts
        start = stop


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(at, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64)


def _pair_counts(sizes, hold: int = 1_000_000):
    """Counts of id pairs, summed inside the task up to ``hold`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(counts[0])], ["pair", "n"])

        for batch in batches:
            for _, _, aligned, _, _ in _parts(batch, sizes):
                k, n = np.unique(aligned.pairs, return_counts=True)
                keys.append(k)
                counts.append(n)
                held += len(k)
                if held > 2 * hold:
                    k, n = _summed(keys, counts)
                    keys, counts, held = [k], [n], len(k)
                    if held > hold:
                        yield out()
                        keys, counts, held = [], [], 0
        if keys:
            k, n = _summed(keys, counts)
            keys, counts = [k], [n]
            yield out()

    return run


def pair_counts(whole: list[DataFrame], sizes) -> DataFrame:
    """(pair, total, best): how many links hold each id pair, and whether none of its B id is linked oftener."""
    partial = reduce(DataFrame.unionByName, (w.mapInArrow(_pair_counts(sizes), "pair long, n long") for w in whole))
    totals = partial.groupBy("pair").agg(F.sum("n").alias("total"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return totals.withColumn("best", F.col("total") == F.max("total").over(of_b))


_STATS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _described(sizes, table: tuple[np.ndarray, np.ndarray, np.ndarray] | None, digest: bool):
    """Counts of each row; with ``digest`` the hash of its groups' text, else the text itself.

    Without a ``table`` of pairs the two sums over links are left to a join.
    """
    n_a, n_b = len(sizes[0]), len(sizes[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = texts(n_a, n_b).__getitem__
        for batch in batches:
            stats = {c: [np.empty(0, np.int64)] for c in _STATS}
            content: list = []
            for _, _, x, many_a, many_b in _parts(batch, sizes):
                stats["n_a"].append(many_a)
                stats["n_b"].append(many_b)
                byte_ends = np.concatenate(([0], x.ends_a))[np.cumsum(many_a)]
                per_row = lambda ends, byte_ends=byte_ends: np.searchsorted(ends, byte_ends, side="right")
                stats["n_groups"].append(np.diff(per_row(x.groups), prepend=0))
                links = per_row(x.links)
                stats["n_links"].append(np.diff(links, prepend=0))
                if table is None:
                    sums = [np.zeros(len(links), np.int64)] * 2
                else:
                    at = np.searchsorted(table[0], x.pairs)
                    sums = [np.diff(np.concatenate(([0], np.cumsum(v[at], dtype=np.int64)))[links], prepend=0) for v in table[:0:-1]]
                stats["n_best"].append(sums[0])
                stats["count_sum"].append(sums[1])
                codes = x.codes(n_a, n_b).tolist()
                start = 0
                for stop in np.cumsum(many_a + many_b).tolist():
                    text = b"".join(map(text_of, codes[start:stop]))[:-1]
                    content.append((hashlib.sha256(text).hexdigest() if text else "") if digest else text)
                    start = stop
            kept = ("uid", "doc_id") if digest else ("uid", "doc_id", "k")
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    *(pa.array(np.concatenate(stats[c]), pa.int64()) for c in _STATS),
                    pa.array(content, pa.string() if digest else pa.binary()),
                ],
                [*kept, *_STATS, "groups_sha256" if digest else "groups"],
            )

    return run


def _long_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of long documents, sorted by uid and k: their sums, and the hash of their texts as they pass."""
    key, name, sums, sha, any_text = None, None, None, None, False
    kind = None

    def out() -> pa.RecordBatch:
        values = [pa.array([key], pa.int64()), pa.array([name], kind), *(pa.array([s], pa.int64()) for s in sums)]
        return pa.RecordBatch.from_arrays(
            [*values, pa.array([sha.hexdigest() if any_text else ""])], ["uid", "doc_id", *_STATS, "groups_sha256"]
        )

    for batch in batches:
        kind = batch.column("doc_id").type
        for row in range(batch.num_rows):
            uid = batch.column("uid")[row].as_py()
            if uid != key:
                if key is not None:
                    yield out()
                key, name = uid, batch.column("doc_id")[row].as_py()
                sums, sha, any_text = [0] * len(_STATS), hashlib.sha256(), False
            sums = [s + batch.column(c)[row].as_py() for s, c in zip(sums, _STATS, strict=True)]
            text = batch.column("groups")[row].as_buffer()
            if len(text):
                sha.update(b";" if any_text else b"")
                sha.update(text)
                any_text = True
    if key is not None:
        yield out()


def _row_pairs(sizes):
    """(uid, pair, n): id pairs of each row with their number of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column("uid").to_numpy()
            for row in range(batch.num_rows):
                x = Aligned(*(_ids(batch.column(c)[row], size) for c, size in zip(("a", "b"), sizes, strict=True)), sizes)
                pairs, n = np.unique(x.pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), uids[row])), pa.array(pairs), pa.array(n)], ["uid", "pair", "n"]
                )

    return run


def aligned(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    chunk: int = CHUNK,
    fan: int = FAN,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): numbers of tokens, groups and links, and the hash of its groups.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    """
    both = Tokenizers(path_a, path_b)
    if not both.cuts:
        raise ValueError("tokens of the second tokenizer hold blanks behind other characters")
    sizes = both.sizes
    tokens = tokens_of(docs, path_a, path_b, chunk)
    kind = dict(tokens.dtypes)["doc_id"]
    short, long = whole_chunks(tokens, sizes, fan)
    pairs = staged_rows(pair_counts([short, long], sizes), "pair-counts")
    table = None
    if pairs.count() <= broadcast_pairs:
        known = pairs.sort("pair").toArrow()
        table = tuple(known.column(c).to_numpy() for c in ("pair", "total", "best"))
    counts = ", ".join(f"{c} long" for c in _STATS)
    result = f"uid long, doc_id {kind}, {counts}, groups_sha256 string"
    of_short = short.mapInArrow(_described(sizes, table, digest=True), result)
    of_long = (
        long.mapInArrow(_described(sizes, table, digest=False), f"uid long, doc_id {kind}, k long, {counts}, groups binary")
        .repartition("uid")
        .sortWithinPartitions("uid", "k")
        .mapInArrow(_long_digests, result)
    )
    out = of_short.unionByName(of_long)
    if table is None:
        each = reduce(DataFrame.unionByName, (w.mapInArrow(_row_pairs(sizes), "uid long, pair long, n long") for w in (short, long)))
        sums = (
            each.join(pairs, "pair")
            .groupBy("uid")
            .agg(
                F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
                F.sum(F.col("n") * F.col("total")).alias("count_sum"),
            )
        )
        zero = F.lit(0).cast("long")
        out = (
            out.drop("n_best", "count_sum")
            .join(sums, "uid", "left")
            .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})
        )
    return out.select("doc_id", *_STATS, "groups_sha256")
