import os
import random
import re
import zlib

import numpy as np
import pytest
from entityloom.llm import language, quality, queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


@needs_data
def test_language_accuracy_on_held_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op8_language_id(spark, SF).collect()
    assert len(out) == len(docs) and all(r.held_out == (fold(r.doc_id, 3) == 1) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert sum(r.accepted for r in out) >= 0.98 * len(out) and all(0 <= r.score <= 1 for r in out)


@needs_data
def test_quality_accuracy_on_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = queries.op10_quality(spark, SF).collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.score >= 0.3) for r in out)
    held = [r for r in out if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def brute_features(text):
    """Buckets by plain integers, character by character."""
    mask, base, mix = 2**64 - 1, quality._BASE, quality._MIX
    raw = [ord(c) for c in " " + text]
    bucket = lambda h: (((h ^ h >> 29) * mix) & mask) >> 64 - quality.BUCKET_BITS
    out = []
    for width in (3, 4):
        for i in range(len(raw) - width + 1):
            h = 0
            for c in raw[i : i + width]:
                h = (h * base + c + 1) & mask
            out.append(bucket((h + width) & mask))
    words = [sum((c + 1) * pow(base, k, 2**64) for k, c in enumerate(map(ord, w))) & mask for w in re.findall("[^ \t-\r]+", text)]
    out += map(bucket, words)
    for a, b in zip(words, words[1:], strict=False):
        out.append(bucket(int(quality._SELF_PAIR) if a == b else (a * base + b * mix) & mask))
    return sorted(out)


def test_features_equal_brute_force_and_stay_in_their_document():
    texts = ["", "a", "ab cd ab ab", "é  x\ny", "long word " * 50, "\x0b", "end"]
    raw, starts = quality.joined([*texts, None])
    bucket, doc = quality.features(raw, starts)
    for i, t in enumerate([*texts, ""]):
        assert sorted(bucket[doc == i].tolist()) == brute_features(t)


def test_training_separates_and_is_repeatable():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["good", "fine", "word"]) for _ in range(20)) for _ in range(60)]
    texts += [" ".join(rng.choice(["BAD!!", "JUNK##"]) for _ in range(20)) for _ in range(30)]
    labels = [1] * 60 + [0] * 30
    model, again = quality.train(texts, labels), quality.train(texts, labels)
    assert np.array_equal(model.weight, again.weight)
    scores = model.scores([*texts, None, "", "x " * 100_000])
    assert scores[:60].min() > 0.8 and scores[60:90].max() < 0.2 and np.isfinite(scores).all()


def test_odd_rows_and_empty_tables(spark, docs, tmp_path):
    rows = [(i, f"the cat and the dog went home {i} " * 5, "s", "en") for i in range(40)]
    rows += [(100 + i, f"der Hund und die Katze gingen heim {i} " * 5, "s", "de") for i in range(40)]
    rows += [(300, None, "s", "en"), (301, "", "s", "en"), (302, "123 !!", "s", None), (None, "the dog", "s", "de")]
    rows += [(303, "the dog " * 40_000, "s", None), (5, rows[5][1], "s", "en")]
    docs(rows).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (7, None)], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/a/labels.parquet"
    )
    got = queries.op8_language_id(spark, f"{tmp_path}/a").collect()
    assert len(got) == len(rows)
    pred = {r.doc_id: r.lang_pred for r in got}
    assert pred[300] == pred[301] == pred[302] == "und" and pred[303] == "en" and pred[110] == "de"
    assert not any(r.accepted for r in got if r.lang_pred == "und")
    scores = queries.op10_quality(spark, f"{tmp_path}/a").collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    docs([]).write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/b/labels.parquet")
    assert queries.op8_language_id(spark, f"{tmp_path}/b").collect() == []
    assert queries.op10_quality(spark, f"{tmp_path}/b").collect() == []


def test_numbers_are_no_letters_and_repeated_ids_one_document(spark, docs):
    content = {"en": b"the cat sat on the mat and the dog", "de": b"die Katze und der Hund gingen heim"}
    assert [language.judge(t, list(content), tuple(content.values()))[0] for t in ("²½ Ⅷ 3", "…", "x²")][:2] == ["und", "und"]
    rows = [(1, f"text {i} the dog", "s", "en") for i in range(300)] + [(2, "der Hund und die Katze", "s", "de")]
    got = language.dictionaries(docs(rows), F.lit(True))
    assert len(got["en"]) < 40
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality.learned(docs(rows), labels, F.lit(True)).weight.any()


def test_without_labels(spark, docs, tmp_path):
    docs([(1, "some text", "s", None)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [r.lang_pred for r in queries.op8_language_id(spark, str(tmp_path)).collect()] == ["und"]
    assert [r.score for r in queries.op10_quality(spark, str(tmp_path)).collect()] == [0.5]


def test_narrow_margin_is_rejected():
    same = {"a": b"one two three four five six", "b": b"one two three four five six"}
    name, score, margin = language.judge("one two three", list(same), tuple(same.values()))
    assert name == "a" and margin == 0 and score == 0.5
