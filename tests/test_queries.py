"""Every registered query against its SQL, on the smallest data set."""

import math

import duckdb
import pytest

import __spark_entry__
from checks.registry import ORACLES, QUERIES
from conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    cells = [tuple(value(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(cells, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    assert got == canonical([c[0] for c in result.description], result.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
