from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names
    operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        table = spark.createDataFrame(full, DOCUMENT)
        return table.selectExpr("*", "'x' AS score", "1 AS size", "2 AS n_removed", "3 AS root", "4 AS row")

    return make


@pytest.fixture(scope="session")
def llm_documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
