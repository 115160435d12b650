"""Token ids as directly addressable codes: binary files with random access to any token.

An id is cut into chunks of ``CHUNK_BITS`` bits.  Level k holds the k-th chunk of each id that
has one, a bitmap that says which of them go on, and a rank directory over the bitmap (ones
before each block), which turns a place in level k into the place in level k + 1.  A token is
read by one chunk, one bit and one rank for each level; nothing is decoded on the way.

Documents are written in ascending doc_id, each range of doc_ids by one task, as files in the
shared folder.  A file has a name of its own for each attempt and counts only once its row is in
the manifest, which Spark commits; files of lost attempts are never read.

Defined results: a NULL text is empty; an empty text is its end id alone; a NULL doc_id comes
first; rows that repeat a doc_id are written one after the other, shorter text first; an empty
table gives no files and an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityloom.llm.common import staged_rows
from entityloom.llm.tokens import encoded
from entityloom.session import scratch_path

MAGIC = b"DACF0001"
CHUNK_BITS = 8
BLOCK_BITS = 512
#: A task begins a new file beyond this many ids, which bounds its memory.
FILE_IDS = 4_000_000
#: Documents in a range, about; very large tables have longer ranges, of several files each.
RANGE_DOCS, MOST_RANGES = 4_000, 20_000


def dac_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, packed bitmap, ones before each block) for each level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunks = (rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        rest = rest >> np.uint32(CHUNK_BITS)
        more = rest > 0
        bitmap = np.packbits(more, bitorder="little")
        per_byte = np.bitwise_count(bitmap).astype(np.uint32)
        padded = np.pad(per_byte, (0, -len(per_byte) % (BLOCK_BITS // 8)))
        blocks = padded.reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate(([0], np.cumsum(blocks)[:-1])).astype("<u4") if len(blocks) else np.empty(0, "<u4")
        levels.append((chunks, bitmap, ranks))
        rest = rest[more]
        if not len(rest):
            return levels


def file_bytes(doc_ids: list, sizes: list[int], ids: np.ndarray) -> bytes:
    """A whole file: magic, header length, header, document directory, levels."""
    known = np.array([d is not None for d in doc_ids], dtype=bool)
    parts = [
        ("doc_known", np.packbits(known, bitorder="little").tobytes()),
        ("doc_ids", np.array([d if d is not None else 0 for d in doc_ids], dtype="<i8").tobytes()),
        ("doc_starts", np.concatenate(([0], np.cumsum(sizes))).astype("<u8").tobytes()),
    ]
    levels = dac_levels(ids)
    for k, (chunks, bitmap, ranks) in enumerate(levels):
        parts += [(f"chunks{k}", chunks.tobytes()), (f"bitmap{k}", bitmap.tobytes()), (f"ranks{k}", ranks.tobytes())]
    places, at = {}, 0
    for name, raw in parts:
        places[name] = [at, len(raw)]
        at += len(raw)
    header = json.dumps({"n_docs": len(doc_ids), "n_ids": len(ids), "levels": len(levels), "parts": places}).encode()
    return b"".join([MAGIC, len(header).to_bytes(8, "little"), header, *(raw for _, raw in parts)])


def arrow_uri(path: str) -> str:
    """A path as Arrow names it: Hadoop's connectors of the same object store have schemes of their own."""
    scheme, mark, rest = path.partition("://")
    return {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + mark + rest


class DacFile:
    """Reader of one file; ``token`` and ``document`` read only the bytes they need."""

    def __init__(self, path: str):
        system, plain = fs.FileSystem.from_uri(arrow_uri(path))
        self.file = system.open_input_file(plain)
        head = self.file.read_at(16, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is not a file of directly addressable codes")
        size = int.from_bytes(head[8:16], "little")
        self.header = json.loads(self.file.read_at(size, 16))
        self.base = 16 + size

    def close(self) -> None:
        self.file.close()

    def __len__(self) -> int:
        return self.header["n_ids"]

    def _read(self, name: str, start: int = 0, length: int | None = None) -> bytes:
        at, size = self.header["parts"][name]
        return self.file.read_at(size - start if length is None else min(length, size - start), self.base + at + start)

    def token(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, at = 0, i
        for k in range(self.header["levels"]):
            value |= self._read(f"chunks{k}", at, 1)[0] << (CHUNK_BITS * k)
            block = at // BLOCK_BITS
            bits = self._read(f"bitmap{k}", block * BLOCK_BITS // 8, BLOCK_BITS // 8)
            within = at - block * BLOCK_BITS
            if not bits[within // 8] >> (within % 8) & 1:
                break
            ones = int.from_bytes(bits, "little") & ((1 << within) - 1)
            at = int.from_bytes(self._read(f"ranks{k}", 4 * block, 4), "little") + ones.bit_count()
        return value

    def document(self, d: int) -> list[int]:
        """The ids of the file's d-th document, each by its own access."""
        start, end = np.frombuffer(self._read("doc_starts", 8 * d, 16), dtype="<u8").tolist()
        return [self.token(i) for i in range(start, end)]

    def all_ids(self) -> np.ndarray:
        """All ids, level by level from the last."""
        value = np.empty(0, np.uint32)
        for k in reversed(range(self.header["levels"])):
            chunks = np.frombuffer(self._read(f"chunks{k}"), dtype=np.uint8)
            bits = np.unpackbits(np.frombuffer(self._read(f"bitmap{k}"), np.uint8), count=len(chunks), bitorder="little")
            out = chunks.astype(np.uint32)
            out[bits.view(bool)] |= value << np.uint32(CHUNK_BITS)
            value = out
        return value

    def directory(self) -> tuple[list, np.ndarray]:
        """(doc_ids, starts with the end as last) of the file's documents."""
        n = self.header["n_docs"]
        known = np.unpackbits(np.frombuffer(self._read("doc_known"), np.uint8), count=n, bitorder="little")
        ids = np.frombuffer(self._read("doc_ids"), "<i8")
        starts = np.frombuffer(self._read("doc_starts"), "<u8").astype(np.int64)
        return [int(d) if k else None for d, k in zip(ids, known, strict=True)], starts


_MANIFEST = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        docs, sizes, parts, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, sizes, parts, total, seq
            path = f"{folder}/{part:06d}-{seq:04d}-{uuid.uuid4().hex}.dac"
            system, plain = fs.FileSystem.from_uri(arrow_uri(path))
            system.create_dir(plain.rpartition("/")[0], recursive=True)
            with system.open_output_stream(plain) as out:
                out.write(file_bytes(docs, sizes, np.concatenate(parts)))
            row = pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "path": path, "n_docs": len(docs), "n_ids": total}], schema=_MANIFEST
            )
            docs, sizes, parts, total, seq = [], [], [], 0, seq + 1
            return row

        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for row, ids in encoded(batch.column("text"), tokenizer):
                docs.append(names[row])
                sizes.append(len(ids) + 1)
                parts += [ids.astype(np.uint16) if not len(ids) or ids.max() < 65536 else ids, end]
                total += len(ids) + 1
                if total >= FILE_IDS:
                    yield flush()
        if docs:
            yield flush()

    return write


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the ids of ``docs``; the manifest: part, seq, path, n_docs, n_ids, first (ids before the file)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "dac")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n_ranges = max(1, min(MOST_RANGES, -(-rows.count() // RANGE_DOCS)))
    ordered = rows.repartitionByRange(n_ranges, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.length("text"), "text"
    )
    manifest = staged_rows(
        ordered.mapInArrow(_writer(folder, tokenizer, end_id), "part long, seq long, path string, n_docs long, n_ids long"),
        "dac-manifest",
    )
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            file = DacFile(row["path"])
            ids, (docs, starts) = file.all_ids().astype("<u4"), file.directory()
            file.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(docs, pa.int64()),
                    "start": pa.array(starts[:-1] + row["first"]),
                    "n_tokens": pa.array(np.diff(starts)),
                    "ids_crc32": pa.array(
                        [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.int64()
                    ),
                }
            )


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files; one file at a time in a task."""
    files = manifest.select("path", "first")
    spread = files.repartition(max(1, min(files.count(), 2_000)), "path")
    return spread.mapInArrow(_read_files, "doc_id long, start long, n_tokens long, ids_crc32 long")
