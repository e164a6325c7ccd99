from __future__ import annotations

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text) of the smallest documents table."""
    return duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture
def frame(spark):
    """Rows (doc_id, text) as a table with extra columns whose names clash."""
    def make(rows, extra=True):
        base = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
        if not extra:
            return base
        for name in ("key", "sig", "component_id", "score", "host", "n_words", "piece", "length", "hashes", "class"):
            base = base.selectExpr("*", f"'x' as {name}")
        return base
    return make


#: nulls, empty and blank texts, ties, repeated rows and ids, a long text
ODD_ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "one two three four five six"), (None, "one two three four five six"),
    (6, "ONE two three four five six"), (7, "é ñ ß ☃ ▁ x"), (8, "a b c d e f g h i j " * 30), (8, "another text under the same id 8"),
    (9, " ".join(f"w{i}" for i in range(9000))), (None, None),
]
