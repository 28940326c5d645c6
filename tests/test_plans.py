"""What the physical plans must and must not contain."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tests.erp import company, rows_of
from tidewright.operators.pairs import frequent_pairs
from tidewright.plans import reports
from tidewright.session import scratch_root

SF = "/root/testdata/sf0.001"
QUERIES = entry_point.queries()


def plan_of(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["s3_incremental_scan", "p2_changed_sales_lines", "t8_ledger_full", "g10_fact_sales",
                                  "g11_fact_transaction", "r3_stock_status", "m1_pk_upsert", "t3_conform_customer"])
def test_no_cartesian_product_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan


def test_watermark_is_pushed_into_the_scan(spark):
    plan = plan_of(QUERIES["s3_incremental_scan"](spark, SF))
    assert "GreaterThan(o_orderdate,1998-06-30T00:00)" in plan
    assert "o_totalprice" not in plan  # pruned
    plan = plan_of(QUERIES["p4_rounded_watermark"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-15T12:00:00.500)" in plan


def test_changed_sales_push_one_filter_per_branch(spark):
    plan = plan_of(QUERIES["p2_changed_sales_lines"](spark, SF))
    assert "GreaterThan(o_orderdate,1998-06-30T00:00)" in plan
    assert "GreaterThan(l_shipdate,1998-06-30T00:00)" in plan


def test_merge_shuffles_each_side_once_by_the_key(spark):
    plan = plan_of(QUERIES["m1_pk_upsert"](spark, SF))
    assert plan.count("FullOuter") == 1
    assert plan.count("Exchange hashpartitioning") <= 2


def test_running_totals_follow_the_daily_aggregate(spark):
    plan = plan_of(QUERIES["w3_running_balance"](spark, SF))
    assert plan.index("Window") < plan.index("partial_sum")  # printed top down: the aggregate feeds the window


def test_lookups_read_only_the_keys_of_a_dimension(spark):
    plan = plan_of(QUERIES["g10_fact_sales"](spark, SF))
    customers = next(line for line in plan.splitlines() if "customer.parquet" in line)
    assert "c_name" not in customers


def test_bands_equal_their_definition(spark):
    values = [1, 1, 1, 2, 3, 3, 10, 50, 50, 1000]
    frame = spark.createDataFrame([(v,) for v in values], "v int")
    expected = sorted({(v, max(-(-sum(x <= v for x in values) * 5 // len(values)), 1)) for v in values}, key=str)
    cuts = reports._band_cuts(frame, "v", 5).first()[0]
    bands = [(v, 1 + sum(cut is None or cut < v for cut in cuts)) for v in sorted(set(values))]
    assert sorted(bands, key=str) == expected


def test_company_fixture_is_complete(spark):
    assert all(df.count() >= 1 for df in company(spark).values())


def test_roll_up_reaches_the_root_and_refuses_cycles(spark):
    chain = spark.createDataFrame([(i, i - 1 if i > 1 else None) for i in range(1, 7)], "account_key int, parent_id int")
    totals = spark.createDataFrame([(6, 10)], "account_key int, amount int")
    assert rows_of(reports.account_rollup(chain, totals), "account_key", "rolled_amount") == [(i, 10) for i in range(1, 7)]
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "account_key int, parent_id int")
    with pytest.raises(reports.HierarchyCycle):
        reports.account_rollup(ring, totals)


def test_a_long_chain_takes_few_jobs_and_torn_members_are_refused(spark):
    n = 10_000
    chain = spark.range(1, n + 1).select(F.col("id").alias("account_key"), F.when(F.col("id") > 1, F.col("id") - 1).alias("parent_id"))
    totals = chain.select("account_key", F.lit(1).alias("amount"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "roll-up of a chain")
    writes = len(written_tables(spark))
    found = reports.account_rollup(chain, totals)
    assert len(written_tables(spark)) - writes <= 16
    assert len(tracker.getJobIdsForGroup("chain")) < 150  # a shuffle stage of the adaptive plan is a job of its own
    spark.sparkContext.setJobGroup("rest", "")
    assert {r[0]: r[1] for r in found.select("account_key", "rolled_amount").collect()} == {i: n + 1 - i for i in range(1, n + 1)}
    torn = spark.createDataFrame([(1, None), (2, 1), (3, 1), (3, 2)], "account_key int, parent_id int")
    with pytest.raises(reports.TwoParents):
        reports.account_rollup(torn, torn.selectExpr("account_key", "1 AS amount"))


def written_tables(spark) -> list:
    import os

    folder = f"{scratch_root(spark).removeprefix('file:')}/tidewright"
    return os.listdir(folder) if os.path.isdir(folder) else []


def test_totals_of_a_tree_equal_sums_over_descendants(spark):
    rng = random.Random(6)
    parent = {i: rng.choice([None, *range(max(0, i - 9), i)]) if i else None for i in range(200)}
    parent[200] = 777  # an id that is a parent only
    amounts = {i: rng.choice([None, rng.randint(-9, 9)]) for i in parent if rng.random() < 0.7}
    expected: dict = {}
    for i in amounts:
        at = i
        while at is not None:
            expected.setdefault(at, []).append(amounts[i])
            at = parent.get(at)
    members = spark.createDataFrame(list(parent.items()), "account_key int, parent_id int").repartition(5)
    totals = spark.createDataFrame(list(amounts.items()), "account_key int, amount int")
    found = {r[0]: (r[1], r[2]) for r in reports.account_rollup(members, totals).collect()}
    assert found == {k: (sum(x for x in v if x is not None) if any(x is not None for x in v) else None, len(v)) for k, v in expected.items()}


SALES = "id int, order_date_key int, product_key int, sales_territory_key int, sales_amount int, gross_margin int, order_quantity int"


@pytest.mark.parametrize("seed", range(3))
def test_changed_lines_leave_no_stale_month(spark, seed):
    rng = random.Random(seed)

    def line(i):
        return (i, rng.choice([20240101, 20240131, 20240215, None]), rng.randint(1, 2), 1, rng.choice([None, 5, 7]), rng.choice([None, 1]), 1)

    old = {i: line(i) for i in range(12)}
    new = {**{i: r for i, r in old.items() if i != 3}, **{i: line(i) for i in (0, 1, 2, 12, 13)}}
    frame = lambda rows: spark.createDataFrame(list(rows), SALES)
    before, after = frame(old[i] for i in (0, 1, 2, 3)), frame(new[i] for i in (0, 1, 2, 12, 13))
    expected = rows_of(reports.monthly_metrics(frame(new.values())))
    state = reports.retracted_metrics(reports.metric_state(frame(old.values())), before, after)
    assert rows_of(reports.metrics_of(state)) == expected
    assert rows_of(state) == rows_of(reports.metric_state(frame(new.values())))
    fresh = reports.refreshed_metrics(reports.monthly_metrics(frame(old.values())), frame(new.values()), after, before)
    assert rows_of(fresh) == expected


def test_star_facts_are_pruned_to_what_is_asked(spark):
    plan = plan_of(QUERIES["d4_orphans"](spark, SF))
    lines = {line.split("ReadSchema: ")[1] for line in plan.splitlines() if "lineitem.parquet" in line and "ReadSchema" in line}
    assert lines and all("l_extendedprice" not in x and "l_tax" not in x and "l_discount" not in x and x.count(":") <= 3 for x in lines), lines


def test_pairs_of_huge_baskets_are_made_by_blocks(spark):
    rng = random.Random(2)
    baskets = {b: {rng.randint(1, 40) for _ in range(rng.choice([1, 2, 5, 35]))} for b in range(60)}
    lines = [(b, i) for b, items in baskets.items() for i in items for _ in range(rng.choice([1, 2]))] + [(None, 1), (1, None)]
    frame = spark.createDataFrame(lines, "basket int, item int")
    for support, block in ((1, 512), (3, 8), (3, 1)):
        holds = {i: sum(i in x for x in baskets.values()) for i in range(1, 41)}
        counts = {(a, b): sum(a in x and b in x for x in baskets.values()) for a in range(1, 41) for b in range(a + 1, 41)}
        expected = sorted((a, b, n, holds[a], holds[b]) for (a, b), n in counts.items() if n >= support)
        found = frequent_pairs(frame, "basket", "item", support, basket_items=block)
        assert sorted(map(tuple, found.select("left_item", "right_item", "orders", "left_orders", "right_orders").collect())) == expected
    assert frequent_pairs(frame.limit(0), "basket", "item", 2).count() == 0
    with pytest.raises(ValueError):
        frequent_pairs(frame, "basket", "item", 0)


def test_a_refresh_reads_only_the_touched_months(spark, tmp_path):
    sales = spark.createDataFrame(
        [(20240100 + d, 1, 1, 1, 1, 1, "2024-01") for d in (1, 2)] + [(20240201, 1, 1, 1, 1, 1, "2024-02")],
        "order_date_key int, product_key int, sales_territory_key int, sales_amount int, gross_margin int, order_quantity int, month_part string",
    )
    sales.write.partitionBy("month_part").parquet(f"{tmp_path}/sales")
    stored = spark.read.parquet(f"{tmp_path}/sales")
    fresh = reports.refreshed_metrics(reports.monthly_metrics(stored), stored, stored.filter("order_date_key = 20240201"))
    assert rows_of(fresh, "year_month", "lines") == [("2024-01", 2), ("2024-02", 1)]
    assert "PartitionFilters: [isnotnull(month_part" in fresh._jdf.queryExecution().toString()
