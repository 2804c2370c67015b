"""Every registered query against its DuckDB statement, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from checks.oracles import ORACLES
from postlens.plans.catalog import QUERIES



@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_states_its_result():
    # A system of equations is solved in those; tests/test_linear.py solves it again.
    assert QUERIES.keys() - ORACLES.keys() == {"linear_score", "linear_accuracy"} and ORACLES.keys() <= QUERIES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    wanted = sorted(repr(tuple(dict(zip(names, row, strict=True))[c] for c in columns)) for row in cursor.fetchall())
    assert sorted(names) == columns
    assert got == wanted
    assert got, "a query without rows checks nothing"


def test_the_model_knows_unseen_documents(spark, sf_dir):
    row = QUERIES["classifier_accuracy"](spark, sf_dir).first()
    assert row.accuracy > 0.6 and row.scored > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "total_score" in df.columns
