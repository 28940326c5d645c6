"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidewright import catalog

SF = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int | float | decimal.Decimal):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 6) + 0.0
    return str(value)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 90


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(normal(r[i]) for i in order) for r in result.fetchall())
    actual = Counter(tuple(normal(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert actual == expected


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["year_month", "brand", "gross_margin", "sales_amount", "lines"]
    assert df.count() > 0


def test_whole_leads_at_five_digits(spark):
    """More than 9,999 customers: every lead goes to the customer that has its whole number."""
    folder = SF.parent / "sf0.1"
    con = duckdb.connect()
    for f in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    name, columns = "t3_conform_customer_whole_leads", ["customer_id", "customer_crm_id", "email", "address", "is_lead"]
    expected = Counter(con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())
    actual = Counter(map(tuple, QUERIES[name](spark, str(folder)).select(*columns).collect()))
    assert actual == expected
    assert max(c for c, lead, *_ in actual if lead) > 9_999
    assert all(int(lead[1:]) == c for c, lead, *_ in actual if lead)
