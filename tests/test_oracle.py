"""Every registered dataset against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from lakefold.plans.catalog import ORACLE, QUERIES
from lakefold.plans.layers import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    assert s_types == {d[0]: str(d[1]) for d in res.description}
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "qtd_notas" in df.columns
