"""How often the ledger's operators and queries read their tables."""

from __future__ import annotations

import re
import time

from tests.erp import at
from tests.test_ledger import known, tables
from tests.test_plans import QUERIES, SF, plan_of
from tidewright.catalog.standins import Tables
from tidewright.operators.ledger import ledger_batch, ledger_full, ledger_increment, ledger_merged
from tidewright.session import BY_ONE_KEY, _settings, written, written_by


def scans(df, name: str) -> int:
    """Parquet scans of the table in the plan, before equal exchanges are shared."""
    return len(re.findall(rf"FileScan parquet [^\n]*{re.escape(name)}", plan_of(df)))


def kept(spark):
    stock, moves = tables(spark)
    return written(stock, "kept-stock"), written(moves, "kept-moves"), written(known(spark, []), "kept-ledger")


def test_full_ledger_reads_stock_for_its_places_and_its_day_only(spark):
    stock, moves, _ = kept(spark)
    plan = ledger_full(stock, moves)
    assert scans(plan, "kept-stock") == 2 and scans(plan, "kept-moves") == 1


def test_increment_makes_moved_and_opening_rows_in_one_pass(spark):
    stock, moves, ledger = kept(spark)
    plan = ledger_increment(stock, moves, ledger, at(9), at(30))
    assert scans(plan, "kept-stock") == 2 and scans(plan, "kept-moves") == 1 and scans(plan, "kept-ledger") == 1


def test_a_batch_reads_the_ledger_for_balances_and_for_late_days_only(spark):
    stock, moves, ledger = kept(spark)
    plan = ledger_batch(stock, moves, ledger, at(9), at(30))
    assert scans(plan, "kept-ledger") == 2


def test_the_batch_query_merges_a_stored_batch(spark):
    assert "Window" not in plan_of(QUERIES["t8_ledger_batch"](spark, SF))


def test_the_incremental_query_sums_the_stock_once(spark, monkeypatch):
    calls, stock = [], Tables.stock
    monkeypatch.setattr(Tables, "stock", lambda self: calls.append(1) or stock(self))
    QUERIES["t8_ledger_incremental"](spark, SF)
    assert len(calls) == 1


def test_the_rebuilt_query_reads_lines_for_movements_and_touched_products_only(spark):
    assert scans(QUERIES["t8_ledger_rebuilt"](spark, SF), "lineitem.parquet") == 3


def test_the_increment_query_reads_lines_for_movements_only(spark):
    assert scans(QUERIES["t8_ledger_increment"](spark, SF), "lineitem.parquet") == 1


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())}


def test_a_written_frame_leaves_no_shuffle_files(spark):
    before = {x for x in shuffle_files(spark) if x.startswith("shuffle_")}
    written(spark.range(1000).repartition(3).groupBy("id").count(), "counted")
    for _ in range(50):  # they are removed in the background
        left = {x for x in shuffle_files(spark) if x.startswith("shuffle_")} - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


def by_product(spark, monkeypatch):
    monkeypatch.setattr("tidewright.session.shuffle_tasks", lambda spark: 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    stock, moves, _ = kept(spark)
    return stock, moves, written_by(known(spark, []), "kept-ledger", "product_id")


def test_a_stored_ledger_is_merged_and_corrected_where_it_lies(spark, monkeypatch):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        stock, moves, ledger = by_product(spark, monkeypatch)
        for attribution in ("once", "per_pair"):
            with _settings(spark, BY_ONE_KEY):
                plan = plan_of(ledger_batch(stock, moves, ledger, at(9), at(30), attribution=attribution))
            assert not re.search(r"Exchange hashpartitioning\(product_id#\w+, location_id#", plan)
        batch = written_by(ledger_batch(stock, moves, ledger, at(9), at(30)), "kept-batch", "product_id")
        with _settings(spark, BY_ONE_KEY):
            assert "Exchange" not in plan_of(ledger_merged(ledger, batch))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [t for t in spark.catalog.listTables("default") if t.name.startswith("tidewright_")]


def test_the_queries_store_their_ledgers_by_product(spark, monkeypatch):
    keys = []
    monkeypatch.setattr("tidewright.catalog.entities.written_by", lambda df, label, key: keys.append((label, key)) or written_by(df, label, key))
    QUERIES["t8_ledger_batch"](spark, SF)
    QUERIES["t8_ledger_late"](spark, SF)
    assert keys == [(x, "product_id") for x in ("ledger", "ledger-batch", "ledger-merged")] * 2
