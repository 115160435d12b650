"""Language identification by compression with a dictionary of each language.

For each language a zstandard raw-content dictionary is filled from a bounded sample of labelled
documents.  A text is cut into short frames; each frame is compressed with every dictionary, and
the language with the smallest total wins.  Where the two best are close, the answer is rejected.

The sample is at most about 2 x ``SAMPLE_DOCS`` documents of each language, chosen by a hash of
the doc_id (one text of each), of which ``SAMPLE_CHARS`` characters are used, and ``DICT_BYTES`` in all.  The
number of languages must be one that a driver can hold dictionaries for.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0, and not accepted;
without any labelled text all answers are ``und``; equal sizes go to the language with more
labelled documents, then the one that sorts first; a NULL doc_id is never learned from and not held out; each row is judged on its own, so
repeated rows need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import give_back

SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 100, 1_200, 64_000
FRAME_BYTES = 4_096
LEVEL = 6
#: Short texts are compressed with more effort, since a few bytes decide.
SHORT_BYTES, SHORT_LEVEL = 1_024, 12
#: Relative distance of the second size from the best below which an answer is rejected.
MIN_MARGIN = 0.003
#: Relative distance that counts as one natural unit in the score.
SCALE = 0.02
UNKNOWN = "und"
_NO_LETTER = regex.compile(r"\P{L}+")


def plain_letters(text: str) -> bytes:
    """Lower-case letters with one space in place of anything else."""
    return _NO_LETTER.sub(" ", text.lower()).encode("utf-8", "replace")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def dictionaries(docs: DataFrame, usable: Column) -> dict[str, bytes]:
    """Dictionary content by language, from rows that are ``usable`` and labelled."""
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.xxhash64(F.lit("sample"), "doc_id").bitwiseAND(F.lit(2**31 - 1)) / float(2**31)
    limits = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, 2.0 * SAMPLE_DOCS / n))])
    picked = (
        rows.filter(share < F.element_at(limits, F.col("lang")))
        .select("lang", "doc_id", share.alias("share"), F.substring("text", 1, 8 * SAMPLE_CHARS).alias("text"))
        .filter("text is not null")
        # One text for each doc_id: a doc_id that many rows repeat is one document of the sample.
        .groupBy("lang", "doc_id", "share")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    out: dict[str, list[bytes]] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["share"], r["doc_id"], r["text"])):
        out.setdefault(r["lang"], []).append(plain_letters(r["text"])[:SAMPLE_CHARS])
    joined = {k: b" ".join(v)[:DICT_BYTES] for k, v in out.items()}
    common_first = sorted(joined, key=lambda k: (-counts[k], k))
    return {k: joined[k] for k in common_first if len(joined[k].strip()) >= 8}


@lru_cache(maxsize=4)
def _compressors(content: tuple[bytes, ...], level: int) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in content:
        data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=level)
        out.append(
            zstandard.ZstdCompressor(
                level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return out


def code_lengths(raw: bytes, content: tuple[bytes, ...]) -> np.ndarray:
    """Compressed bytes of ``raw`` under each dictionary, in frames that learn little of their own."""
    frames = [raw[i : i + FRAME_BYTES] for i in range(0, len(raw), FRAME_BYTES)]
    coders = _compressors(content, SHORT_LEVEL if len(raw) <= SHORT_BYTES else LEVEL)
    return np.array([sum(len(c.compress(f)) for f in frames) for c in coders])


def judge(text: str | None, names: list[str], content: tuple[bytes, ...]) -> tuple[str, float, float]:
    """(language, score, margin) of one text."""
    raw = plain_letters(text or "").strip()
    if not raw or not names:
        return UNKNOWN, 0.0, 0.0
    sizes = code_lengths(raw, content)
    best = int(np.argmin(sizes))
    unit = max(1.0, SCALE * sizes[best])
    score = 1.0 / float(np.exp((sizes[best] - sizes) / unit).sum())
    rest = np.delete(sizes, best)
    margin = float((rest.min() - sizes[best]) / sizes[best]) if len(rest) else 1.0
    return names[best], score, margin


def _judged(content: dict[str, bytes]):
    names = list(content)
    raws = tuple(content[n] for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            found = [judge(text[i].as_py(), names, raws) for i in range(batch.num_rows)]
            columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), _TYPES, strict=True)] if found else [pa.array([], t) for t in _TYPES]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *columns], [*batch.schema.names[:-1], "lang_pred", "score", "margin"])
        _release()

    return run


def _release() -> None:
    """A worker goes on to other work: it does not keep dictionaries."""
    _compressors.cache_clear()
    give_back()


_TYPES = (pa.string(), pa.float64(), pa.float64())


def identified(docs: DataFrame, content: dict[str, bytes], *keep: Column) -> DataFrame:
    """The columns ``keep`` of each row with lang_pred, score, margin and accepted."""
    narrow = docs.select(*keep, F.col("text"))
    fields = ", ".join(f"`{n}` {t}" for n, t in narrow.dtypes[:-1])
    out = narrow.mapInArrow(_judged(content), f"{fields}, lang_pred string, score double, margin double")
    return out.withColumn("accepted", (F.col("lang_pred") != UNKNOWN) & (F.col("margin") >= MIN_MARGIN))


def accepted_rows(docs: DataFrame, content: dict[str, bytes]) -> DataFrame:
    """The rows of ``docs`` whose language is accepted; all columns as they are."""
    names, raws, at = list(content), tuple(content.values()), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at)
            found = [judge(text[i].as_py(), names, raws) for i in range(batch.num_rows)]
            yield batch.filter(pa.array([x[0] != UNKNOWN and x[2] >= MIN_MARGIN for x in found], pa.bool_()))
        _release()

    return docs.mapInArrow(run, docs.schema)
