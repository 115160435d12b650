"""The whole chain against plain Python on small tables."""

import os
import random
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from entityloom.llm import language
from pyspark.sql import functions as F
from test_exact_dedup import brute as brute_exact
from test_simhash import brute_components
from test_tokens import check_sequences
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def run_stages(spark, folder):
    docs, tables = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        tables.append(docs.collect())
    return tables


def check_chain(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    rows = [r.asDict() for r in docs.collect()]
    one, two, three, four, five = run_stages(spark, folder)
    key = lambda r: str([r[c] for c in names])
    content = language.dictionaries(docs, F.lit(True))
    judged = [(r, language.judge(r["text"], list(content), tuple(content.values()))) for r in rows]
    rows = [r for r, (name, _, margin) in judged if name != "und" and margin >= language.MIN_MARGIN]
    assert sorted(map(key, one)) == sorted(map(key, rows))

    def stays(rows, verdicts):
        """One row for each doc_id that a brute-force version keeps."""
        by_id = defaultdict(list)
        for r in rows:
            by_id[r["doc_id"]].append(r)
        return [by_id[v][0] for v in verdicts]

    rows = stays(rows, [v[0] for v in brute_exact([(r["doc_id"], r["text"]) for r in rows]) if v[3]])
    assert sorted(map(key, two)) == sorted(map(key, rows))
    rows = stays(rows, {c for _, _, c in brute_components([(r["doc_id"], r["text"]) for r in rows])})
    assert sorted(map(key, three)) == sorted(map(key, rows))
    size = lambda r: len((r["text"] or "").encode().split())
    times, sizes, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in four:
        times[key(r)] += 1
        taken[r["source"]] += size(r)
    for r in rows:
        sizes[r["source"]] += size(r)
    assert set(times) <= set(map(key, rows)) and max(times.values()) <= 2
    assert set(names) == set(four[0].asDict())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= max(0.05 * sum(sizes.values()), max(map(size, rows)))
    assert all(n <= 2 * sizes[s] for s, n in taken.items())
    whole, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for r in four:
        n = len(whole.encode(r["text"], add_special_tokens=False).ids) + 1
        want += [(r["doc_id"], k, s, min(2048, n - s)) for k, s in enumerate(range(0, n, 2048))]
    assert sorted(tuple(r)[:4] for r in five) == sorted(want)
    ends = check_sequences([(r.sequence_id, r.offset, r.length) for r in five], 2048)
    assert len(ends) <= np.ceil(sum(w[3] for w in want) / 2048) * 1.05 + 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_stages_equal_brute_force(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    check_chain(spark, str(tmp_path))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 100


def test_odd_rows_and_clashing_columns(spark, docs, tmp_path):
    rng = random.Random(1)
    words = {"en": ["the", "house", "and", "with", "river"], "de": ["der", "und", "nicht", "haus", "fluss"]}
    rows = []
    for i in range(80):
        lang = "de" if i % 3 else "en"
        text = " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "en", "ing"]) for _ in range(rng.choice([20, 60])))
        rows.append((i, text, f"s{i % 3}", lang))
    rows += [(100 + i, rows[i][1], "s0", "de") for i in range(10)] + [(5, rows[5][1], rows[5][2], rows[5][3])]
    rows += [(300, None, "s1", None), (301, "", None, "en"), (302, "12 34", "s1", "en"), (303, "the river and " * 20_000, None, "en")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    check_chain(spark, str(tmp_path))


def test_empty(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_texts_go_to_workers_in_small_batches(spark, docs):
    """Unless the session names a size of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    table = docs([(1, "a b")])
    for own, wanted in ((None, "8388608b"), ("3m", "3m")):
        try:
            spark.conf.unset(key) if own is None else spark.conf.set(key, own)
            corpus_pipeline.pack(spark, table, "")
            assert spark.conf.get(key) == wanted
        finally:
            spark.conf.unset(key)
