"""Decoding, refresh by files, targets and the shared folder."""

import os

import pytest
from pyspark.sql import functions as F

from entityloom import session
from entityloom.operators.quality import counted
from entityloom.sources.pages import decode_pages
from entityloom.sources.tables import jdbc_options, target_columns
from entityloom.streaming.refresh import compact, current, latest_per_key, refresh


def test_decode(spark):
    word = "Größe мир"
    cases = [
        ("utf-8", word.encode(), word),
        ("windows-1251", "мир".encode("cp1251"), "мир"),
        ("ISO-8859-1", "Größe".encode("latin-1"), "Größe"),
        ("no-such", word.encode(), word),
        ("utf-8", b"\xff\xfe\x80", None),
        ("utf-16", word.encode("utf-16"), word),
        ("us-ascii", b"\xe9", None),
    ]
    df = spark.createDataFrame([(f"text/html; charset={c}", bytearray(b), w) for c, b, w in cases] + [(None, bytearray(b"ok"), "ok")], "content_type string, body binary, want string")
    for r in decode_pages(df).collect():
        assert r.html == r.want, r.content_type


SCHEMA = "k long, seq long, v string"


def test_replay_equals_batch(spark, tmp_path):
    source, target, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    make = lambda lo, hi: spark.range(lo, hi).selectExpr("id % 17 as k", "id as seq", "concat('v', id) as v")
    for lo in (0, 100, 200):
        make(lo, lo + 100).write.mode("append").parquet(source)
        refresh(spark.readStream.schema(SCHEMA).parquet(source), "k", ("seq",), target, check)
    got = sorted(current(spark, target, SCHEMA, "k", ("seq",)).collect())
    assert got == sorted(latest_per_key(make(0, 300), "k", "seq").collect())
    assert len(os.listdir(target)) >= 3
    again = str(tmp_path / "compacted")
    compact(spark, target, again, SCHEMA, "k", ("seq",))
    assert sorted(current(spark, again, SCHEMA, "k", ("seq",)).collect()) == got


def test_counted(spark, tmp_path):
    df, seen = counted(spark.range(7), "stage-count")
    df.where("id > 3").write.parquet(str(tmp_path / "x"))
    assert seen.get == {"n_rows": 7}


def test_targets(spark):
    df = spark.createDataFrame([], "id int, name string, Created_At string, x int, token_id long")
    assert target_columns(df) == ["name", "x"]
    assert jdbc_options("jdbc:x", "t", batchsize=100)["batchsize"] == "100"


class FakeContext:
    applicationId = "fake"

    def __init__(self, master, given=None):
        self.master, self.given = master, given

    def getCheckpointDir(self):
        return self.given


class FakeSession:
    def __init__(self, master, configured=None, given=None):
        self.sparkContext = FakeContext(master, given)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_shared_dir():
    assert session.shared_dir(FakeSession("spark://x:7077", "/shared/dir/")) == "/shared/dir"
    assert session.shared_dir(FakeSession("spark://x:7077", None, "hdfs:/c")) == "hdfs:/c"
    own = session.shared_dir(FakeSession("local[2]"))
    assert os.path.isdir(own) and own == session.shared_dir(FakeSession("local[2]"))
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("spark://x:7077"))
    assert session.scratch_path(FakeSession("yarn", "/s"), "x").startswith("/s/entityloom/x-")


def test_staged_counts(spark):
    df, seen = session.staged(spark.range(10).withColumn("x", F.col("id") * 2), "t", {"total": F.sum("x")})
    assert (df.count(), seen["n_rows"], seen["total"]) == (10, 10, 90)
    with pytest.raises(Exception):
        session.staged(spark.range(1).select(F.raise_error(F.lit("x")).alias("e")), "t")
