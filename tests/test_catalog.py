"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "dtype") and value.dtype.kind in "iuf":
        return f"{float(value):.9g}"
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


def test_contract_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    row = contract.entry(spark).first()
    assert row["total"] == 500
    assert row["kept"] + row["discarded_target"] + row["discarded_overlay"] == 500


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, FOLDER)
    mine = [tuple(r) for r in result.collect()]
    assert not any(isinstance(v, float) and math.isinf(v) for r in mine for v in r)
    text = contract.oracle_sql().get(name)
    if text is None:
        assert mine
        return
    theirs = duck.execute(text)
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(result.columns)
    assert rows(result.columns, mine) == rows(names, theirs.fetchall())
