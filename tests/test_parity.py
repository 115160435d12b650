"""Every registered query against its SQL twin."""

import os

import pytest
from parity import compare, connect

from entityloom.catalog import CATALOG
from entityloom.schema import SOURCE_ORDER

FOLDER = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER) == ""


def test_entry_file(spark):
    import __spark_entry__ as entry_file

    assert entry_file.entry(spark).count() > 0
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


def test_entities_from_pages_model(spark):
    """Greedy clusters and priority merge of the whole chain against plain Python."""
    profiles = CATALOG["profiles_from_pages"].run(spark, FOLDER).collect()
    rows = sorted((r.asDict() for r in profiles), key=lambda r: (-SOURCE_ORDER.index(r["source"]), r["ico_url"]))
    priority = {"icomarks": 0, "icoratings": 3, "icobench": 5}
    want, left = {}, list(enumerate(rows, 1))
    while left:
        seed = left[0]
        same = [x for x in left if x[1]["name"].upper() == seed[1]["name"].upper() or x[1]["ticker"] == seed[1]["ticker"]]
        left = [x for x in left if x not in same]
        same.sort(key=lambda x: (priority[x[1]["source"]], x[0]))
        fields = ("source", "name", "ticker", "status", "country", "website_overall_rating", "risk_score", "telegram_page")
        want[seed[0]] = {f: next((r[f] for _, r in same if r[f] is not None), None) for f in fields}
    got = {r["entity"]: r for r in (x.asDict() for x in CATALOG["entities_from_pages"].run(spark, FOLDER).collect())}
    assert {k: {f: v for f, v in r.items() if f != "entity"} for k, r in got.items()} == want
