"""Every catalogue query against its DuckDB oracle on the smallest given tables."""

from __future__ import annotations

import hashlib
import json
import math
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return v


def _digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return hashlib.sha256(
        "\n".join(sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)).encode()
    ).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(rows) == len(expected)
    assert _digest(df.columns, rows) == _digest(columns, expected)


def test_every_query_has_rows_or_is_file_based(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
