import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source, lang) rows, with clashing extra columns."""

    def make(rows):
        full = [(*r, *("en", "s")[len(r) - 2 :])[:4] if len(r) == 4 else (r[0], r[1], "s", "en") for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, source string, lang string")
        extra = {c: df["doc_id"] for c in ("fp", "uid", "line", "FOUND", "root", "host", "piece", "size")}
        return df.withColumns(extra)

    return make
