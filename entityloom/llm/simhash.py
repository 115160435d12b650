"""Near-duplicates by SimHash, linked by a self-join of the binary trie of fingerprints.

A fingerprint is a path in a binary trie of 64 levels.  Pairs of trie nodes are walked down
together with the number of bits in which they differ so far; a pair beyond the budget is cut
off, with all that hangs below it.  The top levels deal the node pairs out to Spark tasks; each
task walks its pairs on one sorted array, and joins the few fingerprints of small nodes
directly.  A task emits the components of the links it finds, never the pairs, so output stays
below the number of fingerprints it was given.

Defined results: a NULL or empty text, or one without words, has fingerprint zero and is linked
like any other; equal fingerprints are one node, so copies cost nothing; rows that repeat a
doc_id are rows of their own; a NULL doc_id never names a component unless all of it is NULL;
an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import addressed, bitmaps_of, by_bitmap, give_back, place_of, sender_of, staged_rows
from entityloom.llm.components import components

SEED = 42
BUDGET = 3
WORDS = 3
#: Texts are hashed in pieces of about this many bytes, which bounds the memory of a task.
PIECE_BYTES = 1_000_000
#: Fingerprints in a node of the top level, about; more of them give a deeper top level.
NODE_SIZE = 12_000
#: Node pairs of at most this many pairs of fingerprints are compared directly.
DIRECT = 32
#: Node pairs held at once in a step of the walk.
FRONT = 200_000
_LOW = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None) -> list[int]:
    """XXH64 of each run of three words, repeats included; shorter texts are one run."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change
    if not words:
        return []
    if len(words) <= WORDS:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    digest = xxhash.xxh64_intdigest
    return [digest(b"%b %b %b" % three, SEED) for three in zip(words, words[1:], words[2:], strict=False)]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of ``sizes`` hashes, the bits set in over half of them; eight counters at a time."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full].astype(np.int64)
    blocks = -(-n // 255)  # a byte counts to 255
    starts = np.concatenate(([0], np.cumsum(n)[:-1]))
    inner = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    block_starts = np.repeat(starts, blocks) + 255 * inner
    first_block = np.cumsum(blocks) - blocks
    found = np.zeros(len(full), dtype=np.uint64)
    for k in range(8):
        bits = (hashes >> np.uint64(k)) & _LOW
        counts = np.add.reduceat(bits, block_starts).astype("<u8").view(np.uint8).reshape(-1, 8)
        total = np.add.reduceat(counts.astype(np.int64), first_block, axis=0)
        for byte in range(8):
            over = (2 * total[:, byte] > n).astype(np.uint64)
            found |= over << np.uint64(8 * byte + k)
    out[full] = found
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, start = batch.column("text"), 0
        fps = np.zeros(batch.num_rows, dtype=np.uint64)
        while start < batch.num_rows:
            hashes, sizes, size, at = [], [], 0, start
            while at < batch.num_rows and size < PIECE_BYTES:
                text = texts[at].as_py()
                found = shingle_hashes(text)
                hashes.append(np.array(found, dtype=np.uint64))
                sizes.append(len(found))
                size += len(text or "")
                at += 1
            fps[start:at] = majority_bits(np.concatenate(hashes), np.array(sizes))
            start = at
        kept = [batch.column(c) for c in ("doc_id", "sender", "place")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(fps.view(np.int64))], ["doc_id", "sender", "place", "fp"])
    give_back()


def fingerprints(placed: DataFrame, file: str, at: str) -> DataFrame:
    """(doc_id, sender, place, fp) for each addressed row; fp holds the 64 bits as a signed number."""
    narrow = placed.select("doc_id", sender_of(file, at).alias("sender"), place_of(at).alias("place"), "text")
    schema = f"doc_id {dict(narrow.dtypes)['doc_id']}, sender long, place int, fp long"
    return narrow.mapInArrow(_fingerprint_batches, schema)


class _Groups:
    """Components of links between the positions of an array; roots are the smallest members."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = self.root[self.root]
                if np.array_equal(above, self.root):
                    break
                self.root = above


def _direct(x: np.ndarray, pairs: np.ndarray, groups: _Groups, budget: int) -> None:
    """Compare all fingerprints of the node pairs (alo, ahi, blo, bhi)."""
    alo, ahi, blo, bhi = pairs
    for s in range(0, len(alo), 50_000):
        a0, b0 = alo[s : s + 50_000], blo[s : s + 50_000]
        na, nb = ahi[s : s + 50_000] - a0, bhi[s : s + 50_000] - b0
        n = na * nb
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(nb, n)
        i = np.repeat(a0, n) + at // width
        j = np.repeat(b0, n) + at % width
        near = np.bitwise_count(x[i] ^ x[j]) <= budget
        groups.link(i[near], j[near])


def trie_links(x: np.ndarray, split: int | None, depth: int, budget: int = BUDGET) -> np.ndarray:
    """The root position of each fingerprint of ``x``, linked by the walk over node pairs.

    ``x`` is sorted.  With ``split`` the walk starts at the pair of nodes x[:split], x[split:],
    which lie at ``depth``; without, at the pair of the one node with itself.
    """
    groups = _Groups(len(x))
    if split is None:
        start = np.array([[0], [len(x)], [0], [len(x)], [0]])
    else:
        differ = int(np.bitwise_count((x[0] ^ x[-1]) >> np.uint64(64 - depth))) if depth else 0
        start = np.array([[0], [split], [split], [len(x)], [differ]])
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, start)]
    while stack:
        level, front = stack.pop()
        alo, ahi, blo, bhi, dist = front
        small = ((ahi - alo) * (bhi - blo) <= DIRECT) | (level == 64)
        if small.any():
            _direct(x, front[:4, small], groups, budget)
            alo, ahi, blo, bhi, dist = front[:, ~small]
        if not len(alo):
            continue
        if level not in ones:
            bit = (x >> np.uint64(63 - level)) & np.uint64(1)
            ones[level] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        count = ones[level]
        amid, bmid = ahi - (count[ahi] - count[alo]), bhi - (count[bhi] - count[blo])
        same = alo == blo
        parts = [
            (alo, amid, blo, bmid, dist),
            (amid, ahi, bmid, bhi, dist),
            (alo, amid, bmid, bhi, dist + 1),
            (amid[~same], ahi[~same], blo[~same], bmid[~same], dist[~same] + 1),
        ]
        down = np.concatenate([np.stack(p) for p in parts], axis=1)
        down = down[:, (down[1] > down[0]) & (down[3] > down[2]) & (down[4] <= budget)]
        for s in range(0, down.shape[1], FRONT):
            stack.append((level + 1, down[:, s : s + FRONT]))
    return groups.root


_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _links_of_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    low, high, depth = (k.as_py() for k in key)
    x = np.sort(table.column("fp").to_numpy().view(np.uint64))
    split = None
    if low != high:
        split = int(np.searchsorted(x, np.uint64(high << (64 - depth))))
        if split in (0, len(x)):
            return _LINKS.empty_table()
    root = trie_links(x, split, depth)
    child = np.flatnonzero(root != np.arange(len(x)))
    return pa.Table.from_arrays([pa.array(x[child].view(np.int64)), pa.array(x[root[child]].view(np.int64))], schema=_LINKS)


def hamming_links(fps: DataFrame, budget_bits: int = BUDGET) -> DataFrame:
    """Links (u, v) whose components are those of all pairs at ``budget_bits`` or fewer; ``fps`` is distinct."""
    n = fps.count()
    depth = min(20, max(2, int(np.ceil(np.log2(max(n, 1) / NODE_SIZE))) if n else 2))
    masks = [sum(1 << b for b in bits) for k in range(budget_bits + 1) for bits in combinations(range(depth), k)]
    node = F.shiftrightunsigned("fp", 64 - depth)
    pairs = fps.select("fp", node.alias("node"), F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    other = F.col("node").bitwiseXOR(F.col("mask"))
    dealt = pairs.select(
        "fp",
        F.least("node", other).alias("low"),
        F.greatest("node", other).alias("high"),
        F.lit(depth).alias("depth"),
    )
    return dealt.groupBy("low", "high", "depth").applyInArrow(_links_of_group, "u long, v long")


def near_duplicates(placed: DataFrame, file: str, at: str) -> DataFrame:
    """For each addressed row: sender, place, doc_id, fingerprint, component_id, kept.

    The component's smallest doc_id stays; of rows that repeat it the one with the first address.
    """
    rows = staged_rows(fingerprints(placed, file, at), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "sender", "place")
    nodes = staged_rows(rows.groupBy("fp").agg(F.min(order).alias("first")), "simhash-nodes")
    roots = components(hamming_links(nodes.select("fp")))
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = nodes.join(linked.select("fp", "root").join(smallest, "root").select("fp", "least"), "fp", "left").select(
        "fp", F.coalesce("least", "first").alias("stays")
    )
    return rows.join(named, "fp").select(
        "sender",
        "place",
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("stays.doc_id").alias("component_id"),
        ((F.col("sender") == F.col("stays.sender")) & (F.col("place") == F.col("stays.place"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component; all columns as they are."""
    placed, file, at = addressed(docs)
    found = staged_rows(near_duplicates(placed, file, at).select("sender", "place", "kept"), "simhash-kept")
    gone = bitmaps_of(found.filter("not kept"))
    return by_bitmap(placed, sender_of(file, at), place_of(at), gone, found.count(), wanted=False).select(*docs.columns)
