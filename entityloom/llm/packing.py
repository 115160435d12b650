"""Packing documents into sequences by exact complements of lengths, then best fit.

Lengths are at most the size of a sequence, so all documents are described by one count for each
length.  The plan is made on these counts alone: a piece and one, two or three others whose
lengths sum to the rest of the sequence are used up together as often as all are available;
what has no exact complement is packed by best fit, again many equal sequences in one step.
The plan says for each length which ranks go to which sequences; Spark numbers the pieces of a
length (in buckets, so that a common length is not one task) and looks their place up.

The driver holds the counts, at most one for each length, and the plan, whose steps each use up
a length or a group of equal sequences.

Defined results: a NULL text is empty; an empty text is its end id alone; rows that repeat a
doc_id are packed as rows of their own; an empty table gives an empty result; only doc_id and
text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import staged_rows, with_uid
from entityloom.llm.mixing import on_a_line
from entityloom.llm.tokens import encoded, forget

LENGTH = 2048


class _Plan:
    """Groups of equal sequences; each slot is a length, in the order of the sequence."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.groups: list[tuple[list[int], int]] = []

    def use(self, lengths: list[int], times: int) -> None:
        for n in lengths:
            self.left[n] -= times
        self.groups.append((lengths, times))

    def most(self, lengths: list[int]) -> int:
        """How often these lengths are available together."""
        return min(int(self.left[n]) // lengths.count(n) for n in lengths)


def _single(plan: _Plan, gap: int) -> Iterator[list[int]]:
    if plan.left[gap]:
        yield [gap]


def _pairs(plan: _Plan, gap: int) -> Iterator[list[int]]:
    """All pairs that fill the gap, the most unequal first, as long as both lengths are left."""
    small = np.arange(1, gap // 2 + 1)
    for s in small[(plan.left[small] > 0) & (plan.left[gap - small] > 0)].tolist():
        if plan.left[s] and plan.left[gap - s]:
            yield [gap - s, s]


def _triples(plan: _Plan, gap: int) -> Iterator[list[int]]:
    """For each available first piece, large ones first, all pairs that its rest is a sum of."""
    have = (plan.left[: gap + 1] > 0).astype(np.float64)
    have[0] = 0
    size = 1 << (2 * gap + 1).bit_length()
    spectrum = np.fft.rfft(have, size)
    pair_sums = np.rint(np.fft.irfft(spectrum * spectrum, size)[: gap + 1])
    for a in np.flatnonzero((have > 0) & (pair_sums[gap - np.arange(gap + 1)] > 0))[::-1].tolist():
        if plan.left[a]:
            for pair in _pairs(plan, gap - a):
                yield [a, *pair]


def _complements(plan: _Plan, length: int, most: int) -> None:
    """Pieces below the full length, long ones first, with one to ``most`` exact complements.

    Single complements go first for all pieces, since combinations of short pieces could
    otherwise take the only partner of another piece.  Combinations are walked until the piece is
    used up or none is left; what can still be combined then needs a length more often than it is there.
    """
    for combos in (_single, _pairs, _triples)[:most]:
        for base in range(length - 1, 0, -1):
            if plan.left[base]:
                for combo in combos(plan, length - base):
                    times = plan.most([base, *combo])
                    if times:
                        plan.use([base, *combo], times)
                    if not plan.left[base]:
                        break


def _best_fit(plan: _Plan, length: int) -> None:
    """The rest, long pieces first, each into the fullest sequences that still have room."""
    open_groups: dict[int, list[tuple[list[int], int]]] = {}
    for n in range(length - 1, 0, -1):
        count = int(plan.left[n])
        while count:
            gap = next((g for g in range(n, length) if open_groups.get(g)), None)
            if gap is None:
                fit = length // n
                whole, rest = divmod(count, fit)
                if whole:
                    open_groups.setdefault(length - n * fit, []).append(([n] * fit, whole))
                if rest:
                    open_groups.setdefault(length - n * rest, []).append(([n] * rest, 1))
                count = 0
                continue
            slots, size = open_groups[gap].pop()
            each = min(gap // n, max(1, count // size))
            times = min(size, count // each)
            if times < size:
                open_groups[gap].append((slots, size - times))
            open_groups.setdefault(gap - n * each, []).append((slots + [n] * each, times))
            count -= times * each
        plan.left[n] = 0
    plan.groups += [g for groups in open_groups.values() for g in groups]


def plan_sequences(counts: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Where pieces go: for each length and range of ranks, the first sequence and the offset.

    ``counts[n]`` is the number of pieces of length n.  The arrays are sorted by (size, rank).
    Of the plans with up to three, two and one complements the one with fewest sequences is used.
    """
    plans = []
    for most in (3, 2, 1):
        plan = _Plan(counts)
        if plan.left[length]:
            plan.use([length], int(plan.left[length]))
        _complements(plan, length, most)
        _best_fit(plan, length)
        plans.append(plan)
    plan = min(plans, key=lambda p: sum(times for _, times in p.groups))
    used = np.zeros(length + 1, np.int64)
    rows, sequence = [], 0
    for slots, times in plan.groups:
        offset = 0
        for n in slots:
            rows.append((n, used[n], sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {"size": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3], "n": np.array([sequence])}


def _pieces(tokenizer: str, end_id: int, length: int, keep: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("doc_id")
            rows, pieces, starts, sizes, crcs = [], [], [], [], []
            for row, ids in encoded(batch.column("text"), tokenizer):
                raw = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(raw), length)):
                    part = raw[start : start + length]
                    rows.append(row)
                    pieces.append(k)
                    starts.append(start)
                    sizes.append(len(part))
                    crcs.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    names.take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        if not keep:
            forget()

    return cut


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, keep: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents cut where they are longer than a sequence.

    Without ``keep`` a worker drops its encoder at the end of a task: tasks start slower, and the worker
    is small when other stages follow.
    """
    narrow = docs.select("doc_id", "text")
    kind = dict(narrow.dtypes)["doc_id"]
    return narrow.mapInArrow(
        _pieces(tokenizer, end_id, length, keep), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def _placer(plan: dict[str, np.ndarray], length: int):
    keys = plan["size"] * np.int64(2) ** 48 + plan["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("at").to_numpy()
            at = np.searchsorted(keys, size * np.int64(2) ** 48 + rank, side="right") - 1
            keep = [i for i, c in enumerate(batch.schema.names) if c != "at"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in keep),
                    pa.array(plan["sequence"][at] + rank - plan["rank"][at]),
                    pa.array(plan["offset"][at]),
                ],
                [*(batch.schema.names[i] for i in keep), "sequence_id", "offset"],
            )

    return place


def packed(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` with sequence_id and offset; the pieces of a sequence are gapless from 0."""
    rows = staged_rows(with_uid(pieces), "pieces")
    counts = np.zeros(length + 1, dtype=np.int64)
    for r in rows.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    plan = plan_sequences(counts, length)
    order = rows.select(
        "*", F.col("length").alias("pattern"), F.lit(1).cast("long").alias("size")
    )
    ranked = on_a_line(order, seed=1).drop("pattern", "size", "place", "uid")
    fields = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes if n != "at")
    return ranked.mapInArrow(_placer(plan, length), f"{fields}, sequence_id long, offset long")
