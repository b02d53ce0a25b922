"""Every named query against its SQL on the smallest tables."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from clickloom.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, db, name):
    result = QUERIES[name](spark, FOLDER)
    expected = db.sql(SQL[name])
    assert sorted(result.columns) == sorted(expected.columns)
    got = _normal([tuple(r) for r in result.collect()], result.columns)
    assert got == _normal(expected.fetchall(), expected.columns)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1


HIDDEN = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("clickloom.llm"):
            raise ModuleNotFoundError(name, name=name)

import importlib.util
found = importlib.util.find_spec
importlib.util.find_spec = lambda n, *a: None if n.startswith("clickloom.llm") else found(n, *a)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as contract
from clickloom.queries import QUERIES, SQL
assert set(contract.queries()) == set(QUERIES) and set(contract.oracle_sql()) == set(SQL)
"""


def test_entry_without_the_training_data_subpackage():
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", HIDDEN], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
