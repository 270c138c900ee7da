"""Every registered query against its SQL on the smallest test tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{FOLDER}/{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


# the queries of the llm package have their tests in tests/llm
NAMES = sorted(set(entry.QUERIES))


def test_names():
    assert set(entry.QUERIES) == set(entry.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, engine, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    relation = engine.sql(entry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    places = [relation.columns.index(c) for c in columns]
    expected = ordered([tuple(plain(r[i]) for i in places) for r in relation.fetchall()])
    found = ordered([tuple(plain(r[c]) for c in columns) for r in df.collect()])
    assert found == expected
    assert found


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
