"""Queries against their SQL on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tidewright.llm.queries import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def normal(value):
    return round(value, 9) if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted((tuple(normal(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    actual = sorted((tuple(normal(v) for v in r) for r in df.select(*columns).collect()), key=str)
    assert actual == expected


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5
