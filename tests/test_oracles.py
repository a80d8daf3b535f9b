"""Every registered query against DuckDB. ORACLE_SF_DIR picks the scale, ORACLE_KEYS some queries."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KEYS = [k for k in contract.queries() if k in os.environ.get("ORACLE_KEYS", k).split(",")]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, duck, key):
    df = contract.queries()[key](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    sql = contract.oracle_sql().get(key)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    mine, theirs = plain(got, df.columns), plain(cursor.fetchall(), names)
    assert len(mine) == len(theirs)
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    assert not wrong, f"{len(wrong)} of {len(mine)} rows differ; first: {repr(wrong[0])[:1500]}"
