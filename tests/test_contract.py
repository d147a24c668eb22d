"""Every registered query equals its SQL on the smallest tables."""

import datetime as dt
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from chatterscope.plans import registry

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canon(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, dt.date):
        return str(value)
    return value


#: Iterations that SQL does not tell; tested against plain Python.
WITHOUT_SQL = {"communities_settled", "modularity_classes", "modularity_settled"}
OWN = [name for name in QUERIES if name in registry.queries() and name not in WITHOUT_SQL]


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES) and len(OWN) >= 90
    assert WITHOUT_SQL <= set(QUERIES) and not WITHOUT_SQL & set(SQL)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = sorted((tuple(canon(r[c]) for c in columns) for r in df.collect()), key=repr)
    at = [names.index(c) for c in columns]
    expected = sorted((tuple(canon(r[i]) for i in at) for r in result.fetchall()), key=repr)
    assert got == expected


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 990 and sum(r.cnt for r in rows) > 0
