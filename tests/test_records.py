"""Countries, validity, merge and consolidation."""

import random

from pyspark.sql import functions as F

from entityloom.operators import countries
from entityloom.operators.merge import merge_by_priority, source_priority
from entityloom.operators.quality import keep_valid
from entityloom.plans.consolidate import consolidate
from entityloom.schema import FIELDS, PROFILE_SCHEMA, SOURCES, conform


def test_schema_has_52_fields():
    assert len(FIELDS) == len(set(FIELDS)) == 52


def test_country_lists(spark):
    codes = countries.dim_map(countries.country_table(spark))
    cases = {
        "Russia": "RUS",
        "Korea, Republic of": "KOR",
        "Iran, Islamic Republic of, UK, US": "IRN, GBR, USA",
        "Côte d'Ivoire": "CIV",
        "Saint Barthélemy": "BLM",
        "Bosnia and Herzegovina, Åland Islands": "BIH, ALA",
        "Hong Kong SAR China,": "HKG",
        "abc": "abc",
        "Sudan.": "SDN",
        "Dubai": "ARE",
        "Viet Nam, Cabo Verde, Türkiye": "VNM, CPV, TUR",
        "Sint Maarten (Dutch part), Hong Kong SAR": "SXM, HKG",
        "Republic of Peru, Kingdom of Norway, the Kingdom of the Netherlands": "PER, NOR, NLD",
        "Republic of Korea, Democratic Republic of the Congo, Federal Republic of Germany": "KOR, COD, DEU",
        "Atlantis": "Atlantis",
        "Unspecified": None,
        None: None,
    }
    df = spark.createDataFrame(list(cases.items()), "x string, want string")
    for r in df.select("x", "want", countries.to_codes(F.col("x"), codes).alias("got")).collect():
        assert r.got == r.want, r.x
    dropped = df.select(countries.to_codes(F.col("x"), codes, keep_unknown=False).alias("got")).where(F.col("got") == "Atlantis")
    assert dropped.count() == 0


def test_country_join_equals_inline(spark):
    table = countries.country_table(spark)
    words = ["Russia", "UK", "Peru", "xyz", "Nowhere", "Korea, Republic of", "Unspecified", "Kingdom of Norway", "", "Sudan."]
    rows = [(i, ", ".join(random.Random(i).sample(words, 3))) for i in range(60)] + [(90, None), (91, ""), (92, "Unspecified")]
    df = spark.createDataFrame(rows, "k int, c string")
    for separator in (",", "|", "."):
        for keep in (True, False):
            joined = countries.convert_lists_by_join(df, "k", "c", countries.country_dim(spark, table), separator, keep)
            inline = df.select("k", countries.to_codes(F.col("c"), countries.dim_map(table), separator, keep).alias("c"))
            assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, inline.collect()), key=str)


def test_keys_of_constants_equal_those_of_columns(spark):
    names = [*countries.COUNTRY_ALIASES, " st. Lucia & x.", "Åland  Islands", "Côte d’Ivoire", "ÝŸ,"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.k for r in df.select(countries.country_key(F.col("n")).alias("k")).collect()] == list(map(countries.plain_key, names))


def test_valid_records(spark):
    df = spark.createDataFrame([(1, "n", "t", "a", "b", "c"), (2, "n", "t", "a", "b", None), (3, None, "t", "a", "b", "c")], "rank int, name string, ticker string, a string, b string, c string")
    assert [r.rank for r in keep_valid(df, fields=("name", "ticker", "a", "b", "c")).collect()] == [1]


def merge_rows(spark, rows):
    df = spark.createDataFrame(rows, "entity int, priority int, rank int, v string, w string")
    return {r.entity: (r.v, r.w) for r in merge_by_priority(df, "entity", ("v", "w"), "priority", "rank").collect()}


def test_priority_merge(spark):
    rows = [(1, 1, 1, None, None), (1, 5, 2, "A", "x"), (1, 3, 3, "B", None), (2, 1, 5, "late", None), (2, 1, 4, "early", None)]
    assert merge_rows(spark, rows) == {1: ("B", "x"), 2: ("early", None)}
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        assert merge_rows(spark, rows) == {1: ("B", "x"), 2: ("early", None)}


def test_unknown_source_comes_last(spark):
    df = spark.createDataFrame([(s,) for s in (*SOURCES, "other")], "source string")
    got = {r.source: r.p for r in df.select("source", source_priority(F.col("source")).alias("p")).collect()}
    assert got["icomarks"] == 0 and got["icobazaar"] == 6 and got["other"] == 7


def records(spark, rows):
    raw = spark.createDataFrame(rows, "rank long, source string, name string, ticker string, web_page string, description string, platform string, team_score string")
    return conform(raw, PROFILE_SCHEMA, keep=("rank",))


def test_consolidate(spark):
    df = records(
        spark,
        [
            (1, "icobench", "Foo", "FOO", "http://foo.io", 'a "quoted" text', "ETH", "4.0"),
            (2, "icomarks", "foo", "F", "http://m.io", None, "Ethereum", None),
            (3, "trackico", "Bar", "F", None, "third", "Own", "1"),
            (4, "tokentops", "Lone", "L", None, "x", "y", None),
            (5, "tokentops", "Lone", None, None, "x", "y", "2"),
            (6, "tokentops", "Thin", "T", None, None, None, "2"),
        ],
    )
    got = {r.entity: r for r in consolidate(df).collect()}
    assert set(got) == {1, 3, 4}
    foo = got[1]
    assert (foo.source, foo.name, foo.ticker, foo.platform) == ("icomarks", "foo", "F", "Ethereum")
    assert (foo.description, foo.team_score, foo.web_page) == ("a quoted text", 4.0, "http://m.io")
    assert got[3].description == "third"
    joined = {r.entity for r in consolidate(df, transitive=True).collect()}
    assert joined == {1, 4}


def test_missing_keys_match_only_on_request(spark):
    df = records(spark, [(1, "icomarks", "A", "A", None, "d", "p", None), (2, "trackico", "B", "B", None, "d", "p", None)])
    assert consolidate(df).count() == 2
    assert consolidate(df, null_matches=True).count() == 1


def test_country_table_is_large_enough(spark):
    table = countries.country_table(spark)
    assert 450 < len(table) < 1000 and {table["DE"], table["GERMANY"], table["FRENCH REPUBLIC"]} == {"DEU", "FRA"}
