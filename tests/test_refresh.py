"""Late reading of pages, versions of tables, entities kept up to date, and what a run leaves behind."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from entityloom import session
from entityloom.catalog import CATALOG
from entityloom.operators import latest
from entityloom.operators.extract import Move, Part, Rule, Sel
from entityloom.operators.normalize import normalize
from entityloom.operators.packs import PACKS
from entityloom.operators.rules import BadRule, compiled
from entityloom.plans import incremental
from entityloom.plans.consolidate import consolidate
from entityloom.plans.incremental import EntityState, apply_changes, compact, current_entities
from entityloom.plans.profiles import Community, build_profiles, full_run, merge_order
from entityloom.plans.refresh import refresh_entities
from entityloom.schema import FIELDS, RAW_SCHEMA, conform
from entityloom.sinks.versions import commits, drop_versions, table_paths, write_version
from entityloom.streaming.refresh import latest_pages

AS_OF = F.lit("1998-08-01").cast("date")


def exchanged(df):
    """Columns that enter any exchange of a plan."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    blocks = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert blocks
    return {c.split("#")[0].strip() for b in blocks for c in b.split(",")}


def store(spark, tmp_path, n=300):
    rnd = random.Random(1)
    rows = [("s" if i % 5 else None, f"u{rnd.randrange(n // 4)}", None if rnd.random() < 0.2 else rnd.randrange(4), f"page {rnd.randrange(60)}") for i in range(n)]
    df = spark.createDataFrame(rows, "source string, url string, seq int, html string")
    df = df.withColumn("fetched_at", F.timestamp_seconds("seq")).drop("seq")
    df.repartition(7).write.parquet(str(tmp_path / "pages"))
    return spark.read.parquet(str(tmp_path / "pages"))


def check_latest(pages, got):
    best = {}
    for r in pages.collect():
        best.setdefault((r.source, r.url), []).append(r)
    got = {(r.source, r.url): r for r in got.collect()}
    assert set(got) == set(best)
    for key, rows in best.items():
        times = [r.fetched_at for r in rows if r.fetched_at]
        assert got[key].fetched_at == (max(times) if times else None)
        assert got[key] in rows


def test_latest_pages_leave_bodies_where_they_lie(spark, tmp_path, monkeypatch):
    pages = store(spark, tmp_path)
    chosen = latest_pages(pages)
    assert chosen.columns == pages.columns
    assert not exchanged(chosen) & {"html", "body"}
    check_latest(pages, chosen)
    monkeypatch.setattr(latest, "GROUP_BYTES", 300)
    monkeypatch.setattr(latest, "BLOCK_ROWS", 128)
    check_latest(pages, latest_pages(pages))
    again, n_given = latest_pages(pages.unionByName(pages), counted=True)  # no plain scan: written first
    check_latest(pages, again)
    assert n_given == 600


def test_equal_pages_count_once(spark, tmp_path):
    pages = spark.createDataFrame([("s", "u", "x")] * 5 + [("s", "v", "y"), ("s", "v", None)], "source string, url string, html string")
    pages.repartition(3).write.parquet(str(tmp_path / "p"))
    assert latest_pages(spark.read.parquet(str(tmp_path / "p"))).groupBy("url").count().collect() and latest_pages(pages).count() == 2


def test_tables_change_together(spark, tmp_path):
    folder = str(tmp_path / "tables")
    frames = lambda n, broken=None: {
        t: spark.range(n).select(F.when(F.lit(t == broken), F.raise_error(F.lit("disk"))).otherwise(F.col("id")).cast("bigint").alias("id"))
        for t in "abcdef"
    }
    assert table_paths(spark, folder) == {}
    write_version(frames(3), folder, "first")
    read = lambda: {t: spark.read.parquet(p).count() for t, p in table_paths(spark, folder).items()}
    assert read() == dict.fromkeys("abcdef", 3)
    with pytest.raises(Exception, match="disk"):
        write_version(frames(5, "c"), folder)
    assert read() == dict.fromkeys("abcdef", 3)
    assert len(os.listdir(f"{folder}/_versions")) == 1
    for n in (7, 8, 9):
        write_version(frames(n), folder)
    assert read() == dict.fromkeys("abcdef", 9) and drop_versions(spark, folder) == 2
    assert read() == dict.fromkeys("abcdef", 9) and commits(spark, folder).count() == 4


FIELDS_OF_TEST = ("source", "a", "b", "v")


def state_at(path):
    return EntityState(str(path), ("id",), ("id",), FIELDS_OF_TEST, ("source",), 2, ("a", "b"), (("x", 0), ("y", 1)))


def whole(spark, rows):
    df = spark.createDataFrame(rows, "id long, source string, a string, b string, v string").withColumnRenamed("id", "rank")
    merged = consolidate(df, "rank", FIELDS_OF_TEST, ("source",), 2, ("a", "b"), priority={"x": 0, "y": 1})
    return {r.entity: tuple(r)[1:] for r in merged.collect()}


def taken(spark, state):
    return {r.seed.id: tuple(r)[1:] for r in current_entities(spark, state).collect()}


def test_batches_equal_a_full_run(spark, tmp_path):
    rnd = random.Random(8)
    word = lambda k: None if rnd.random() < 0.3 else f"{k}{rnd.randrange(60)}"
    make = lambda i: (i, rnd.choice(["x", "y", "y", None]), word("a"), word("b"), word("v"))
    schema = "id long, source string, a string, b string, v string"
    rows = {i: make(i) for i in range(120)}
    state = state_at(tmp_path / "state")
    apply_changes(state, spark.createDataFrame(list(rows.values()), schema))
    assert taken(spark, state) == whole(spark, list(rows.values()))
    for batch in range(3):
        changed = {i: make(i) for i in (*rnd.sample(range(120), 6), 200 + batch)}
        gone = rnd.sample(sorted(set(rows) - set(changed)), 3)
        rows = {i: r for i, r in (rows | changed).items() if i not in gone}
        removed = spark.createDataFrame([(i,) for i in gone], "id long")
        counts = apply_changes(state, spark.createDataFrame(list(changed.values()), schema), removed)
        assert counts["changed"] == 7
        assert taken(spark, state) == whole(spark, list(rows.values()))
    compact(spark, state)
    assert taken(spark, state) == whole(spark, list(rows.values()))
    changed = {i: make(i) for i in (5, 300)}
    apply_changes(state, spark.createDataFrame(list(changed.values()), schema))
    rows |= changed
    assert taken(spark, state) == whole(spark, list(rows.values()))


def test_a_batch_recomputes_what_it_touches(spark, tmp_path, monkeypatch):
    """Two hundred entities of two records each: a changed record costs its own entity, and the one it joins."""
    schema = "id long, source string, a string, b string, v string"
    rows = [(i, "xy"[i % 2], f"a{i // 2}", None, "v") for i in range(400)]
    state = state_at(tmp_path / "state")
    assert apply_changes(state, spark.createDataFrame(rows, schema))["entities_recomputed"] == 200
    joined = [(8, "x", "a7", None, "new")]
    counts = apply_changes(state, spark.createDataFrame(joined, schema))
    assert counts == {"changed": 1, "components_touched": 2, "records_recomputed": 4, "entities_recomputed": 2}
    written = spark.read.parquet(os.path.join(state.folder, "_versions", commits(spark, state.folder).orderBy(F.desc("number")).first().version, "records"))
    assert written.count() == 4
    rows[8] = joined[0]
    assert taken(spark, state) == whole(spark, rows)
    # A record that is not valid any more leaves; its partner stays alone.
    counts = apply_changes(state, spark.createDataFrame([(20, None, "a10", None, None)], schema))
    assert (counts["components_touched"], counts["records_recomputed"], counts["entities_recomputed"]) == (1, 1, 1)
    rows[20] = (20, None, "a10", None, None)
    assert taken(spark, state) == whole(spark, rows)
    assert incremental._present(spark, state)["records"].count() == 399


@pytest.fixture(scope="module")
def crawled(spark):
    from entityloom.catalog.registry import Tables
    from entityloom.catalog.webpages import part_profile_pages

    pages = part_profile_pages(Tables(spark, "/root/testdata/sf0.001"), 7).where("url < 'https://x/p15'")
    made = pages.select("source", "url", F.lit("text/html").alias("content_type"), F.encode("html", "utf-8").alias("body"), F.lit("1998-07-01").cast("timestamp").alias("fetched_at"))
    return session.staged(made, "crawled")[0]


def test_entities_follow_the_page_files(spark, crawled, tmp_path):
    files, store_at, check = (str(tmp_path / n) for n in ("files", "store", "check"))
    state = EntityState(str(tmp_path / "entities"))

    def take(batch):
        batch.write.mode("append").parquet(files)
        return refresh_entities(spark.readStream.schema(crawled.schema).parquet(files), store_at, check, state, AS_OF)

    (first,) = take(crawled)
    n = crawled.count()
    assert first["pages_read"] == n
    # One page of a profile on two pages is fetched again with a new ticker, and one page turns unreadable.
    two = crawled.where("source = 'icoratings' and endswith(url, '/details')").orderBy("url").limit(1)
    changed = two.withColumn("body", F.encode(F.regexp_replace(F.decode("body", "utf-8"), "T[0-9]+", "TNEW"), "utf-8"))
    lost = crawled.where("source = 'icomarks'").orderBy("url").limit(1).withColumn("body", F.encode(F.lit("<p>"), "utf-8"))
    later = changed.unionByName(lost).withColumn("fetched_at", F.lit("1998-07-02").cast("timestamp"))
    (second,) = take(later)
    assert second["pages_read"] == 3 and second["changed"] == 2
    assert second["records_recomputed"] < first["records_recomputed"] / 2
    now = crawled.unionByName(later).withColumn("html", F.decode("body", "utf-8")).drop("body")
    profiles = build_profiles(latest_pages(now).drop("fetched_at", "content_type"), AS_OF)
    want = consolidate(merge_order(profiles))
    show = lambda df: sorted(tuple(map(str, r)) for r in df.select(*FIELDS).collect())
    assert show(current_entities(spark, state)) == show(want)
    assert profiles.where("ticker = 'TNEW'").count() == 1 and profiles.where("name is null").count() == 1


def test_a_run_leaves_only_its_results(spark, crawled, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "scratch"))
    empty = spark.createDataFrame([], "url string, html string")
    paths = full_run(crawled, Community(empty, empty, empty, empty), AS_OF, str(tmp_path / "out"), "r1", snapshots="parquet")
    left = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / "scratch") for f in names]
    assert left == []
    assert table_paths(spark, str(tmp_path / "out" / "tables")) == paths
    outcomes = {r.source: r.state for r in spark.read.parquet(str(tmp_path / "out" / "outcomes")).collect()}
    assert outcomes == {p.source: "done" for p in PACKS}
    assert [c.label for c in commits(spark, str(tmp_path / "out" / "tables")).orderBy("number").collect()] == ["r1 members", "r1 posts", "r1 threads"]


def test_failing_source_is_a_reject(spark, crawled, tmp_path):
    broken = tuple(
        type(p)(p.source, p.domain, (Rule(Sel("h1"), Part((Move("sideways"),)), to="name"),), p.listing, p.sub_page) if p.source == "trackico" else p for p in PACKS
    )
    empty = spark.createDataFrame([], "url string, html string")
    full_run(crawled, Community(empty, empty, empty, empty), AS_OF, str(tmp_path / "out"), "r1", broken, snapshots="parquet")
    outcomes = {r.source: (r.state, r.reason) for r in spark.read.parquet(str(tmp_path / "out" / "outcomes")).collect()}
    assert outcomes.pop("trackico") == ("failed", "BadRule: no move is named sideways")
    assert {s for s, _ in outcomes.values()} == {"done"} and len(outcomes) == 6
    refused = spark.read.parquet(str(tmp_path / "out" / "rejects")).where("source = 'trackico'").collect()
    assert len(refused) == crawled.where("source = 'trackico'").count()
    assert {r.reason for r in refused} == {"source failed: BadRule: no move is named sideways"}
    assert spark.read.parquet(str(tmp_path / "out" / "by_source")).where("source <> 'trackico'").count() > 30


def test_rules_without_meaning():
    fine = Rule(Sel("h1"), to="name")
    steps = {"strip": F.trim}
    assert '"keys": ["h1"]' in compiled((fine,), steps)
    for rule in (
        Rule(Sel(), to="x"),
        Rule(Sel("a")),
        Rule(Sel("a"), Part(steps=("other",)), to="x"),
        Rule(Sel("a"), Part((Move("find"),)), to="x"),
        Rule(Sel("a"), to="x", within=(Sel("b"), Sel("c")), in_all=True),
    ):
        with pytest.raises(BadRule):
            compiled((rule,), steps)


def test_plans_compute_scores_once(spark):
    """Word and scale look-ups, and printed numbers, stand once for each score in the plan."""
    raw = conform(spark.createDataFrame([("icobench", "x")], "source string, name string"), RAW_SCHEMA)
    plan = normalize(raw, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_number") <= 9
    folder = "/root/testdata/sf0.001"
    plan = CATALOG["source_scales"].run(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_number") <= 4


def test_discarded_tables_are_gone(spark):
    df, _ = session.staged(spark.range(3), "gone")
    path = session._STAGED[df]
    assert os.path.isdir(path)
    session.discard(df, None)
    assert not os.path.exists(path)
    with session.scratch_scope(spark) as made:
        session.staged(spark.range(3), "kept")
        assert len(made) == 1 and os.path.isdir(made[0])
    assert not os.path.exists(made[0])
