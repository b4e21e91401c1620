"""Every registered query against DuckDB on the smallest test tables, sorted by column name."""

import importlib

import duckdb
import pytest

from smelter.workload.oracles import ORACLES
from smelter.workload.queries import QUERIES

entry = importlib.import_module("__spark_entry__")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(columns).collect()]
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "category", "order_lines", "sales_amount", "quantity"]
    assert df.count() > 0
