"""A quality classifier on learned subword embeddings.

The features of a text are its words, pairs of adjacent words and runs of three and four characters
(code points), hashed into buckets.  Each bucket has a learned vector; the mean of a document's vectors goes
through a softmax over the two labels.  Vectors and output are trained together by stochastic
gradient descent in numpy, on a bounded sample: about ``SAMPLE_DOCS`` labelled documents chosen by
a hash of the doc_id (one text of each), of each of which ``SAMPLE_CHARS`` characters are used.

Since the mean and the output are linear up to the softmax, a bucket enters a score by one
number; scoring whole texts is one table look-up for each feature.

Defined results: a NULL or empty text has no features and scores the learned bias; without
labels every score is 0.5; a NULL doc_id is never learned from and not held out; conflicting
labels of a doc_id count as the larger; each row is scored on its own, so repeated rows need no
rule; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 17
DIMENSION = 8
EPOCHS, RATE = 6, 0.5
SAMPLE_DOCS, SAMPLE_CHARS = 3_000, 2_000
#: Texts are scored in pieces of about this many characters.
PIECE_CHARS = 2_000_000
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: A word followed by itself is one feature, whatever the word.
_SELF_PAIR = np.uint64(0x5EED)
_INVERSE = pow(_BASE, -1, 2**64)


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * np.uint64(_MIX)) >> np.uint64(64 - BUCKET_BITS)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)  # modulo 2**64


def features(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of each feature; ``raw`` holds the texts' code points, each behind one blank.

    ``starts`` are the places of those blanks.  No feature spans two documents, since words and
    runs are cut at them.
    """
    n = len(raw)
    doc_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    wide = raw.astype(np.uint64) + np.uint64(1)
    buckets, docs = [], []
    for width in (3, 4):
        if n < width:
            continue
        h = np.zeros(n - width + 1, dtype=np.uint64)
        for k in range(width):
            h = h * np.uint64(_BASE) + wide[k : n - width + 1 + k]
        whole = doc_of[: n - width + 1] == doc_of[width - 1 :]
        buckets.append(_bucket(h[whole] + np.uint64(width)))
        docs.append(doc_of[: n - width + 1][whole])
    edge = np.flatnonzero(np.diff(np.concatenate(([1], blank.view(np.int8), [1]))))
    begin, end = edge[::2], edge[1::2]
    if len(begin):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(wide * _powers(_BASE, n), dtype=np.uint64, out=sums[1:])
        words = (sums[end] - sums[begin]) * _powers(_INVERSE, n)[begin]
        owner = doc_of[begin]
        same = owner[:-1] == owner[1:]
        pairs = words[:-1] * np.uint64(_BASE) + words[1:] * np.uint64(_MIX)
        pairs[words[:-1] == words[1:]] = _SELF_PAIR
        buckets += [_bucket(words), _bucket(pairs[same])]
        docs += [owner, owner[:-1][same]]
    if not buckets:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(buckets).astype(np.int64), np.concatenate(docs)


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts, each behind one blank, and where they start."""
    parts = [f" {t or ''}" for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32), np.cumsum(sizes) - sizes


@dataclass
class Model:
    """What scoring needs: one number for each bucket, and the bias."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        raw, starts = joined(texts)
        bucket, doc = features(raw, starts)
        total = np.bincount(doc, self.weight[bucket], minlength=len(texts))
        count = np.bincount(doc, minlength=len(texts))
        logit = total / np.maximum(count, 1) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))


def train(texts: list[str], labels: list[int], seed: int = 11) -> Model:
    """Vectors, output and bias by gradient descent, one document at a time."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1 / DIMENSION, (1 << BUCKET_BITS, DIMENSION)).astype(np.float32)
    output, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    bags = []
    for text in texts:
        raw, starts = joined([text])
        ids, counts = np.unique(features(raw, starts)[0], return_counts=True)
        bags.append((ids, (counts / max(1, counts.sum())).astype(np.float32)[:, None]))
    steps, done = EPOCHS * len(texts), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(texts)):
            ids, share = bags[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            mean = (vectors[ids] * share).sum(axis=0)
            logit = mean @ output + bias
            chance = np.exp(logit - logit.max())
            error = chance / chance.sum()
            error[labels[i]] -= 1
            back = output @ error
            output -= rate * np.outer(mean, error)
            bias -= rate * np.float32(0.1) * error
            # A step for each bucket in proportion to its share, scaled as for a sum of words.
            vectors[ids] -= rate * np.float32(20.0) * share * back
    difference = output[:, 1] - output[:, 0]
    return Model((vectors @ difference).astype(np.float32), float(bias[1] - bias[0]))


def learned(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """A model from the labels whose rows are ``usable`` (a condition on doc_id)."""
    known = (
        labels.filter(usable & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("quality"))
    )
    share = F.xxhash64(F.lit("quality"), "doc_id").bitwiseAND(F.lit(2**31 - 1)) / float(2**31)
    sample = known.filter(share < min(1.0, SAMPLE_DOCS / max(1, known.count())))
    rows = (
        docs.select("doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .join(sample, "doc_id")
        .filter("text is not null")
        # One text for each doc_id, however many rows repeat it.
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    if not rows:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0)
    return train([r["text"] for r in rows], [r["quality"] for r in rows])


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, start, found = batch.column(batch.num_columns - 1), 0, []
            while start < batch.num_rows:
                part, size, at = [], 0, start
                while at < batch.num_rows and size < PIECE_CHARS:
                    part.append(text[at].as_py())
                    size += len(part[-1] or "")
                    at += 1
                found.append(model.scores(part))
                start = at
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.concatenate(found) if found else np.empty(0))], [*batch.schema.names[:-1], "score"]
            )

    return run


def scored(docs: DataFrame, model: Model, *keep: Column) -> DataFrame:
    """The columns ``keep`` of each row with its score."""
    narrow = docs.select(*keep, F.col("text"))
    fields = ", ".join(f"`{n}` {t}" for n, t in narrow.dtypes[:-1])
    return narrow.mapInArrow(_scorer(model), f"{fields}, score double")
