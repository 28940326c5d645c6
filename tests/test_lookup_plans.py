"""The keys by which facts find their dimension rows."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tests.erp import rows_of
from tests.test_plans import plan_of
from tidewright.operators.lookup import NULL_SPREAD, Lookup, star_lookup


def test_a_broadcast_dimension_is_held_by_one_whole_number(spark):
    facts = spark.range(100).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("customer_id"), "id")
    # holds every stand-in of a NULL; nullable, as a stored key is
    dim = spark.range(-2 * NULL_SPREAD, 50).select(F.expr("nullif(id, 1000)").alias("customer_key"))
    found = star_lookup(facts, {"dim_customer": dim}, [Lookup("dim_customer", "customer_key", "customer_id", "customer_key")])
    assert re.search(r"HashedRelationBroadcastMode\(List\(input\[0, bigint, \w+\]\),", plan_of(found))
    assert rows_of(found, "id", "customer_key") == sorted(((i, i if i % 2 == 0 and i < 50 else None) for i in range(100)), key=str)


def test_missing_days_find_no_day(spark):
    facts = spark.sql("SELECT id, if(id = 1, date'2024-01-02', null) AS sold FROM range(200)")
    dim = spark.sql(f"SELECT explode(sequence(date'1900-01-01' - INTERVAL {NULL_SPREAD} DAY, date'1900-01-01')) AS date").union(spark.sql("SELECT date'2024-01-02'"))
    found = star_lookup(facts, {"dim_date": dim.selectExpr("date", "year(date) AS date_key")}, [Lookup("dim_date", "date", "sold", "sold_key", value="date_key")])
    assert rows_of(found.filter("sold_key is not null"), "id", "sold_key") == [(1, 2024)] and found.count() == 200
