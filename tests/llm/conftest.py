from __future__ import annotations

import duckdb
import pytest

from tallywork.llm.shared import ship

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)


@pytest.fixture
def docs(llm):
    """A table of documents, with columns whose names operators use for their own."""
    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        full = [(*r, *([None] * (5 - len(r)))) for r in rows]
        return llm.createDataFrame(full, schema).selectExpr("*", "1 AS id", "2 AS n", "'x' AS t", "3 AS row", "4 AS score", "5 AS _pass", "6 AS _kept", "7 AS root", "8 AS _toxicity", "9 AS label")
    return make


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def tuples(df, *columns):
    """Rows as tuples in a stable order."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
