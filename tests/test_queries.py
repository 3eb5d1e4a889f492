"""Every registered query against its SQL, or for rows where SQL cannot express it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
import oracle

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir).toArrow()
    assert found.num_rows > 0
    assert oracle.difference(found, oracle.sql_result(duck, SQL[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    table = QUERIES[name](spark, sf_dir).toArrow()
    assert table.num_rows > 0
    assert len(set(table.column_names)) == len(table.column_names)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    table = entry_module.entry(spark)
    assert table.columns == ["id"] + [f"F{d}" for d in range(1, 29)]
    ids = [row["id"] for row in table.collect()]
    validation = [i for i in ids if i.endswith("_validation")]
    assert ids == sorted(validation) + sorted(set(ids) - set(validation))
