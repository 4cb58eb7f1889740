"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import TABLES, compare  # noqa: E402
from reelframe.catalog import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_SMALL)
    rel = duck.execute(contract.oracle_sql()[name])
    err = compare(df.collect(), df.columns, rel.fetchall(), [d[0] for d in rel.description])
    assert err is None, err


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("genre", "string"), ("year", "bigint"), ("ratio", "double")]
    rows = df.collect()
    assert rows and [(r.genre, r.year) for r in rows] == sorted((r.genre, r.year) for r in rows)
