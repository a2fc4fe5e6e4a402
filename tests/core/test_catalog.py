"""Every registered query of the engine against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from registra.plans.catalog import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def value(v):
    if hasattr(v, "tolist") and not hasattr(v, "isoformat"):
        v = v.tolist()
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(pd.Timestamp(v)) if hasattr(v, "isoformat") else str(v)


def rows(pdf, columns):
    return sorted(tuple(value(v) for v in r) for r in pdf[columns].itertuples(index=False))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
