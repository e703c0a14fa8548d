"""Every registered query against an independent SQL engine on the smallest driver tables."""

import os
from collections import Counter

import pytest

from statforge.plans.oracle import ORACLE
from statforge.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not on this machine")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def norm(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    return round(float(value), 9) if isinstance(value, (int, float)) else str(value)


def bag(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in records)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    mine = df.collect()
    if name not in ORACLE:
        assert mine
        return
    cursor = sql.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, mine) == bag(columns, cursor.fetchall())
