"""Spark vs DuckDB on the smoke data for every registered query that has a SQL twin.

The full comparison of all queries is ``scripts/compare_oracle.py`` at sf0.01.
"""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

KEYS = sorted(k for k in E.oracle_sql() if not k.startswith("op"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "orders", "lineitem", "events", "customer", "part", "supplier", "nation", "region"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def v(x):
        return float(f"{x:.9g}") if isinstance(x, float) and math.isfinite(x) else x
    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_its_sql_twin(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _norm(df.columns, df.collect()) == _norm(rel.columns, rel.fetchall())
