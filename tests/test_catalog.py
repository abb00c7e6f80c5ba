"""Registered queries against their statements in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

from casemill import catalog
from casemill.catalog.inputs import TABLES

SF = "/root/testdata/sf0.001"


def plain(value):
    if value is None or isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        value = float(value)
        return "nan" if math.isnan(value) else round(value, 6)
    return str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cursor = duck.execute(catalog.SQL[name])
    told = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(told)
    order = sorted(told)
    ours = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    theirs = sorted((tuple(plain(r[told.index(c)]) for c in order) for r in cursor.fetchall()), key=repr)
    assert ours == theirs


def test_page_bounds(spark):
    from casemill.plans.cases import page

    rows = spark.range(5).orderBy("id")
    assert page(rows, None).count() == 5 and page(rows, 2, 1).count() == 2
    for limit, offset, most in ((0, 0, None), (5, 0, 4), (1, -1, None)):
        with pytest.raises(ValueError):
            page(rows, limit, offset, most)


def test_spread_join_keeps_rows_without_key(spark):
    from casemill.operators.keyed import spread_join

    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, w string")
    assert sorted(map(tuple, spread_join(left, right, ["k"]).collect()), key=str) == sorted([(1, "a", "x"), (1, "b", "x"), (None, "c", None), (2, "d", None)], key=str)
    assert spread_join(left, right, ["k"], "inner").count() == 2
