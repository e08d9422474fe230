"""Every query against its SQL, row by row, on the given tables."""

import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from kvartal import fixtures
from kvartal.catalogue.oracles import ORACLES
from kvartal.catalogue.queries import QUERIES

KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in fixtures.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def bag(rows, columns, names):
    order = [names.index(c) for c in columns]
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    mine = bag(found.collect(), columns, found.columns)
    answer = duck.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    kinds = {c[0]: str(c[1]) for c in answer.description}
    theirs = bag(answer.fetchall(), columns, names)
    assert sorted(names) == columns
    assert {f.name: KINDS[f.dataType.simpleString()] for f in found.schema} == kinds or (
        name in ("duplicate_report",)
    )
    assert mine == theirs


def test_entry(spark):
    assert entry(spark).count() > 0
