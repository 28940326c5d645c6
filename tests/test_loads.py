"""Whole loads through the stored layers."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.erp import COMPANY, D, at, company, raw, rows_of
from tidewright.operators import quality
from tidewright.plans import loads
from tidewright.plans.star import relookup
from tidewright.sources.raw_tables import RAW_TABLES
from tidewright.sources.store import TypeChange
from tidewright.streaming.micro_batches import landing_stream, merge_batches

NOW, LATER = at(28), at(29)
STRICT = loads.Options(lookback=dt.timedelta(0))  # rows with the time of the mark are not read again


@pytest.fixture(scope="module")
def raw_files(spark, tmp_path_factory):
    """The tiny company written once; customers have one mail each, as the keyed merge needs."""
    root = tmp_path_factory.mktemp("company")
    tables = company(spark)
    tables["email_address"] = tables["email_address"].filter("EmailAddressID <> 2")
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{root}/{name}")
    return {name: (f"{root}/{name}", rows.schema) for name, rows in tables.items()}


@pytest.fixture
def lake(spark, store, raw_files):
    spark.sql("CREATE DATABASE raw")
    for name, (path, schema) in raw_files.items():
        spark.catalog.createTable(f"raw.{name}", path=path, source="parquet", schema=schema)
    loads.create_tables(store)
    loads.load_calendar(store, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    return store


def mark_row(store, layer, table):
    return store.marks(layer).filter(F.col("table_name") == table).first()


# ---- raw ------------------------------------------------------------------------------------------


def test_raw_full_load_counts_rejects_and_sets_the_mark(spark, store):
    landed = spark.createDataFrame(
        [("1", "Day", "07:00", "15:00", "2024-01-03 10:00:00"), ("x", "Bad", None, None, None)],
        "ShiftID string, Name string, StartTime string, EndTime string, ModifiedDate string",
    )
    with pytest.raises(ValueError, match="no full load"):
        loads.load_raw_full(store, "shift", landed, NOW)
    stores = spark.createDataFrame(
        [("1", "Shop", "2024-01-03 10:00:00"), ("x", "Bad", "2024-01-02T00:00:00Z")],
        "BusinessEntityID string, Name string, ModifiedDate string",
    )
    result = loads.load_raw_full(store, "store", stores, NOW)
    assert (result.status, result.row_count, result.new_mark) == (loads.SUCCESS, 2, at(3, 10))
    assert result.rejected == {"BusinessEntityID": 1}
    assert store.read("raw", "store").schema == RAW_TABLES["store"].schema
    assert mark_row(store, "raw", "store").row_count == 2


def test_raw_full_load_of_nothing_is_an_error(spark, store):
    with pytest.raises(loads.EmptySource):
        loads.load_raw_full(store, "store", raw(spark, "store", []), NOW)


def test_raw_mark_falls_back_to_the_load_time(spark, store):
    result = loads.load_raw_full(store, "store", raw(spark, "store", [{"BusinessEntityID": 1}]), NOW)
    assert result.new_mark == NOW


def test_raw_incremental_creates_then_merges_then_finds_nothing(spark, store):
    table = "sales_territory"
    first = raw(spark, table, [{"TerritoryID": 1, "Name": "A", "ModifiedDate": at(1)}, {"TerritoryID": 2, "Name": "B", "ModifiedDate": at(2)}])
    created = loads.load_raw_incremental(store, table, first, NOW)
    assert (created.previous_mark, created.rows_changed) == (None, 2)
    second = raw(spark, table, [
        {"TerritoryID": 1, "Name": "A2", "ModifiedDate": at(3)},
        {"TerritoryID": 2, "Name": "tied with the mark", "ModifiedDate": at(2)},
        {"TerritoryID": 3, "Name": "C", "ModifiedDate": at(3)},
    ])
    merged = loads.load_raw_incremental(store, table, second, NOW)
    assert (merged.previous_mark, merged.new_mark, merged.rows_changed, merged.row_count) == (at(2), at(3), 2, 3)
    assert rows_of(store.read("raw", table), "TerritoryID", "Name") == [(1, "A2"), (2, "B"), (3, "C")]
    nothing = loads.load_raw_incremental(store, table, second, NOW)
    assert nothing.status == loads.NO_NEW_DATA and nothing.new_mark == at(3)
    again = loads.load_raw_incremental(store, table, second, NOW, lookback=dt.timedelta(days=2))
    assert again.rows_changed == 3  # the look-back takes the tied row in


# ---- conformed ------------------------------------------------------------------------------------


def test_full_loads_fill_every_conformed_and_star_table(lake):
    for table in loads.CONFORMED_ORDER:
        result = loads.load_conformed_full(lake, table, NOW)
        assert result.row_count > 0, table
        assert result.new_mark is not None
    for table in loads.STAR_ORDER:
        assert loads.load_star_full(lake, table, NOW).row_count > 0, table
    facts = {r.sales_order_detail_id: r for r in lake.read("star", "fact_sales").collect()}
    assert (facts[1].customer_key, facts[1].product_key, facts[1].employee_key, facts[1].order_date_key) == (1, 1, 31, 20240102)
    # no such member, no such product, and a time of day finds no calendar row
    assert (facts[2].employee_key, facts[2].sales_territory_key, facts[2].order_date_key) == (None, None, None)
    assert facts[3].product_key is None and facts[None].customer_key is None
    lines = {r.transaction_line_id: r for r in lake.read("star", "fact_transaction").collect()}
    assert (lines[1].transaction_date_key, lines[1].debit_amount) == (20240102, Decimal("10.01"))
    assert (lines[2].department_key, lines[2].transaction_date_key) == (None, None)
    stock = lake.read("star", "fact_product_inventory")
    assert stock.schema["location_key"].dataType.typeName() == "integer"
    assert rows_of(stock.filter("product_key = 2"), "location_key", "date_key", "unit_balance") == [(1, 20240109, 12), (1, 20240110, 7)]
    orphaned = {r.column_name: r.orphan_rows for r in quality.orphans(lake.read("star", "fact_sales"), ["customer_key", "employee_key"]).collect()}
    assert orphaned == {"customer_key": 1, "employee_key": 3}


def test_incremental_without_a_mark_equals_the_full_load(lake):
    copies = ["account", "class", "transaction", "customer", "employee", "product"]
    for table in copies:
        loads.load_conformed_incremental(lake, table, NOW)
        incremental = rows_of(lake.read("conformed", table))
        assert incremental
        loads.load_conformed_full(lake, table, NOW)
        assert rows_of(lake.read("conformed", table)) == incremental, table


def test_second_incremental_run_changes_nothing(lake):
    conformed = ["customer", "product_inventory", "sales", "transaction", "budget", "opportunity"]
    star = ["dim_customer", "fact_sales", "fact_budget"]
    for table in conformed:
        loads.load_conformed_incremental(lake, table, NOW, STRICT)
    for table in star:
        # products and territories are not loaded here: their keys stay NULL
        loads.load_star_incremental(lake, table, NOW, STRICT)
    before = {t: rows_of(lake.read("conformed", t)) for t in conformed}
    for table in conformed:
        assert loads.load_conformed_incremental(lake, table, LATER, STRICT).rows_changed == 0, table
    assert before == {t: rows_of(lake.read("conformed", t)) for t in conformed}
    for table in star:
        assert loads.load_star_incremental(lake, table, LATER, STRICT).rows_changed == 0, table
    # hash-compared tables are marked with the load time, the others with their data
    assert mark_row(lake, "conformed", "budget").max_modified_date == LATER
    assert mark_row(lake, "conformed", "customer").max_modified_date == at(4)
    assert mark_row(lake, "conformed", "customer").last_load_time == LATER


def test_budget_lines_without_department_are_not_inserted_again(lake, spark):
    loads.load_conformed_incremental(lake, "budget", NOW)
    changed = [{**r, "budget": D("41")} if r["department_id"] is None else r for r in COMPANY["m_budget"]]
    lake.replace("raw", "m_budget", raw(spark, "m_budget", changed))
    result = loads.load_conformed_incremental(lake, "budget", LATER)
    assert (result.rows_changed, result.row_count) == (1, 2)
    got = rows_of(lake.read("conformed", "budget"), "department_id", "budget", "modified_date")
    assert got == [(1, Decimal("100.00"), NOW), (None, Decimal("41.00"), LATER)]


def test_sales_update_keeps_the_order_id(lake, spark):
    loads.load_conformed_incremental(lake, "sales", NOW)
    detail = [dict(r) for r in COMPANY["sales_order_detail"]]
    detail[0].update(SalesOrderID=101, OrderQty=9, ModifiedDate=at(9))
    lake.replace("raw", "sales_order_detail", raw(spark, "sales_order_detail", detail))
    result = loads.load_conformed_incremental(lake, "sales", LATER)
    assert result.rows_changed == 1
    row = lake.read("conformed", "sales").filter("sales_order_detail_id = 1").first()
    assert (row.sales_order_id, row.order_quantity, row.customer_id) == (100, 9, 2)


def test_duplicated_customers_stop_the_merge(lake, spark):
    loads.load_conformed_incremental(lake, "customer", NOW)
    mails = COMPANY["email_address"]
    lake.replace("raw", "email_address", raw(spark, "email_address", mails))
    touched = [{**r, "ModifiedDate": at(20)} for r in COMPANY["customer"]]
    lake.replace("raw", "customer", raw(spark, "customer", touched))
    before = rows_of(lake.read("conformed", "customer"))
    with pytest.raises(ValueError, match="more than once"):
        loads.load_conformed_incremental(lake, "customer", LATER)
    assert rows_of(lake.read("conformed", "customer")) == before


def test_too_long_text_stops_the_load(lake, spark):
    rows = [{**COMPANY["department"][0], "department_code": "ELEVEN CHAR"}]
    lake.replace("raw", "department", raw(spark, "department", rows))
    with pytest.raises(Exception, match="department_code longer than 10"):
        loads.load_conformed_full(lake, "department", NOW)


def test_late_dimension_rows_are_looked_up_again(lake, spark):
    loads.load_conformed_full(lake, "customer", NOW)
    loads.load_conformed_full(lake, "opportunity", NOW)
    loads.load_star_full(lake, "fact_opportunity", NOW)  # before its dimension
    assert lake.read("star", "fact_opportunity").first().customer_key is None
    loads.load_star_full(lake, "dim_customer", NOW)
    assert loads.load_star_incremental(lake, "fact_opportunity", LATER, STRICT).rows_changed == 0
    repaired = relookup(
        "fact_opportunity", lake.read("star", "fact_opportunity"), lake.read("conformed", "opportunity"), loads.StarTables(lake)
    )
    assert rows_of(repaired, "opportunity_key", "customer_key") == [(1, 1)]


def test_calendar_range_is_replaced_in_place(lake):
    days = loads.load_calendar(lake, dt.date(2024, 1, 15), dt.date(2024, 2, 10))
    assert days == 41
    dates = lake.read("star", "dim_date")
    assert dates.select("date").distinct().count() == 41
    leap = lake.read("star", "dim_date").filter("date_key = 20240131").first()
    assert (leap.iso_year_week, leap.last_date_of_quarter, leap.is_leap_year) == ("2024-5", dt.date(2024, 3, 31), True)


def test_preview_and_row_counts(lake):
    assert loads.preview(lake, "raw", "person", 3).count() == 3
    counts = rows_of(quality.row_counts({"person": lake.read("raw", "person")}))
    assert counts == [("person", 4)]


# ---- store ----------------------------------------------------------------------------------------


def test_merge_rewrites_only_touched_partitions(spark, store):
    store.create("star", "monthly", "id INT, v VARCHAR(5), ym VARCHAR(7)", partition_by=["ym"])
    rows = spark.createDataFrame([(1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", "2024-03")], "id int, v string, ym string")
    store.replace_partitions("star", "monthly", rows, "ym", ["2024-01", "2024-02", "2024-03"])
    files = set(store.read("star", "monthly").filter("ym = '2024-03'").inputFiles())
    batch = spark.createDataFrame([(1, "z", "2024-02"), (4, "n", "2024-04")], "id int, v string, ym string")
    staged = store.stage(batch, None, "t")
    assert staged.small and staged.rows == 2
    counts = store.merge("star", "monthly", staged, ["id"], partition="ym")
    assert counts["rows_changed"] == 2
    # the row moved from January, whose partition is gone, to February; March keeps its files
    assert rows_of(store.read("star", "monthly"), "id", "v", "ym") == [
        (1, "z", "2024-02"), (2, "b", "2024-02"), (3, "c", "2024-03"), (4, "n", "2024-04")]
    assert set(store.read("star", "monthly").filter("ym = '2024-03'").inputFiles()) == files
    assert "2024-01" not in str(spark.sql("SHOW PARTITIONS star.monthly").collect())


def test_failed_write_leaves_the_table(spark, store):
    store.replace("star", "t", spark.range(3).toDF("id"))
    bad = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        store.replace("star", "t", bad)
    assert store.read("star", "t").count() == 3


def test_stream_of_landing_files_is_merged_and_replayable(spark, store, tmp_path):
    table = RAW_TABLES["sales_territory"]
    landing = str(tmp_path / "landing")
    raw(spark, "sales_territory", [{"TerritoryID": 1, "Name": "A", "ModifiedDate": at(1)}]).write.parquet(landing)
    options = {"checkpoint": str(tmp_path / "cp")}

    def run(**more):
        stream = landing_stream(spark, landing, table.schema)
        merge_batches(stream, store, "raw", "sales_territory", table.keys, "ModifiedDate", **{**options, **more}).awaitTermination()

    run()
    raw(spark, "sales_territory", [
        {"TerritoryID": 1, "Name": "A1", "ModifiedDate": at(2)},
        {"TerritoryID": 1, "Name": "A2", "ModifiedDate": at(3)},
        {"TerritoryID": 2, "Name": "B", "ModifiedDate": at(3)},
    ]).write.mode("append").parquet(landing)
    run()
    expected = [(1, "A2"), (2, "B")]
    assert rows_of(store.read("raw", "sales_territory"), "TerritoryID", "Name") == expected
    run(checkpoint=str(tmp_path / "cp2"))  # everything replayed
    assert rows_of(store.read("raw", "sales_territory"), "TerritoryID", "Name") == expected


# ---- safety of stored tables ------------------------------------------------------------------------


class Killed(RuntimeError):
    pass


def month_rows(spark, rows):
    return spark.createDataFrame(rows, "id long, month_part string, value string")


@pytest.mark.parametrize("step", range(6))
def test_a_merge_that_dies_at_any_step_loses_no_row(spark, store, monkeypatch, step):
    store.reload_partitioned("raw", "t", month_rows(spark, [(1, "2024-01", "a"), (2, "2024-01", "b"), (3, "2024-02", "c")]), "month_part")
    batch = [(1, "2024-01", "new"), (3, "2024-03", "moved"), (4, "2024-02", "added")]

    def load():
        staged = store.stage(month_rows(spark, batch), None, "t")
        return store.merge("raw", "t", staged, ["id"], partition="month_part")

    calls, run = [], type(spark).sql

    def dying(self, text, *args, **more):
        if text.startswith("ALTER TABLE"):
            calls.append(text)
            if len(calls) == step + 1:
                raise Killed(text)
        return run(self, text, *args, **more)

    monkeypatch.setattr(type(spark), "sql", dying)
    try:
        load()
    except Killed:
        ids = {r.id for r in store.read("raw", "t").collect()}
        assert {1, 2} <= ids  # a row that moves to another month comes back with the repeated batch
    monkeypatch.setattr(type(spark), "sql", run)
    load()
    assert rows_of(store.read("raw", "t"), "id", "value") == [(1, "new"), (2, "b"), (3, "moved"), (4, "added")]
    spark.sql("DROP DATABASE raw CASCADE")


def test_a_batch_touches_only_its_key_ranges(spark, store):
    rows = spark.range(0, 5_000_000, 500_000).select("id", F.lit("old").alias("value"))
    store.reload_partitioned("raw", "wide", loads.by_key(rows, ["id"]), loads.KEY_PART)
    before = {v: store._location(f"DESCRIBE FORMATTED raw.wide PARTITION ({loads.KEY_PART}='{v}')") for v in store.partitions("raw", "wide")}
    batch = spark.createDataFrame([(500_000, "new"), (4_600_000, "new")], "id long, value string")
    staged = store.stage(loads.by_key(batch, ["id"]), None, "wide")
    counts = store.merge("raw", "wide", staged, ["id"], partition=loads.KEY_PART, by_key=True)
    after = {v: store._location(f"DESCRIBE FORMATTED raw.wide PARTITION ({loads.KEY_PART}='{v}')") for v in store.partitions("raw", "wide")}
    assert {v for v in after if after[v] != before.get(v)} == {"0", "4"}
    assert (counts["inserted"], counts["updated"], store.read("raw", "wide").count()) == (1, 1, 11)
    assert store.read("raw", "wide").columns == ["id", "value"]
    store.replace("raw", "wide", rows.withColumn("more", F.lit(1)))
    assert len(store.superseded("raw", "wide")) == 2
    assert store.read("raw", "wide").count() == 10


def test_unreadable_times_are_kept_and_counted(spark, store):
    columns = "BusinessEntityID string, Name string, ModifiedDate string"
    config = next(n for n, c in RAW_TABLES.items() if c.has_incremental and c.time_column == "ModifiedDate" and n == "sales_territory")
    first = raw(spark, config, [{"TerritoryID": 1, "Name": "A", "ModifiedDate": at(1)}])
    loads.load_raw_incremental(store, config, first, NOW)
    text = spark.createDataFrame(
        [("2", "B", "31/12/2024 10:00"), ("3", "C", "2024-01-05 10:00:00"), ("x", "D", "2024-01-06 10:00:00")],
        columns.replace("BusinessEntityID", "TerritoryID"),
    )
    result = loads.load_raw_incremental(store, config, text, LATER)
    assert rows_of(store.read("raw", config).filter("Name <> 'A'"), "Name", "TerritoryID") == [("B", 2), ("C", 3), ("D", None)]
    assert result.rejected == {"ModifiedDate": 1, "TerritoryID": 1}


def test_late_movements_and_balances(lake):
    """A repeated increment changes nothing; balances are those of the ledger's last days."""
    loads.load_conformed_full(lake, "product_inventory", NOW)
    loads.load_conformed_incremental(lake, "product_inventory", LATER)
    first = rows_of(lake.read("conformed", "product_inventory"))
    loads.load_conformed_incremental(lake, "product_inventory", LATER)
    assert rows_of(lake.read("conformed", "product_inventory")) == first
    stored = lake.read("conformed", "product_inventory")
    from tidewright.operators.ledger import BALANCE_COLUMNS, current_balances

    kept = lake.read("conformed", loads.BALANCES)
    assert rows_of(kept, *BALANCE_COLUMNS) == rows_of(current_balances(stored), *BALANCE_COLUMNS)


def test_null_keys_may_not_repeat_where_nulls_are_equal(spark):
    from tidewright.operators.upsert import DuplicateSourceKey, check_source

    target = spark.createDataFrame([(1, None, 5)], "a int, b int, n int")
    batch = spark.createDataFrame([(1, None, 6), (1, None, 7)], "a int, b int, n int")
    check_source(target, batch, ["a", "b"])
    with pytest.raises(DuplicateSourceKey):
        check_source(target, batch, ["a", "b"], null_safe=True)


@pytest.mark.parametrize("step", range(9))
def test_a_full_load_that_dies_at_any_statement_loses_no_row(spark, store, monkeypatch, step):
    """After it an incremental load finds every row, old or new."""
    rows = [{"TerritoryID": i, "Name": "old", "ModifiedDate": at(1)} for i in range(1, 6)]
    loads.load_raw_full(store, "sales_territory", raw(spark, "sales_territory", rows), NOW)
    again = raw(spark, "sales_territory", [{**r, "Name": "new"} for r in rows])
    calls, run = [], type(spark).sql

    def dying(self, text, *args, **more):
        if text.startswith(("ALTER", "DROP", "CREATE TABLE")):
            calls.append(text)
            if len(calls) == step + 1:
                raise Killed(text)
        return run(self, text, *args, **more)

    monkeypatch.setattr(type(spark), "sql", dying)
    died = False
    try:
        loads.load_raw_full(store, "sales_territory", again, LATER)
    except Killed:
        died = True
    monkeypatch.setattr(type(spark), "sql", run)
    batch = raw(spark, "sales_territory", [{"TerritoryID": 6, "Name": "added", "ModifiedDate": at(2)}])
    loads.load_raw_incremental(store, "sales_territory", batch, LATER)
    held = rows_of(store.read("raw", "sales_territory"), "TerritoryID", "Name")
    assert [r[0] for r in held] == [1, 2, 3, 4, 5, 6]
    assert len({r[1] for r in held[:5]}) == 1 and (died or held[0][1] == "new")
    assert not any(spark.catalog.tableExists(f"raw.sales_territory{end}") for end in ("__old",)) or died


def test_a_table_that_vanished_is_not_made_of_a_batch(spark, store):
    first = raw(spark, "sales_territory", [{"TerritoryID": 1, "Name": "A", "ModifiedDate": at(1)}])
    loads.load_raw_incremental(store, "sales_territory", first, NOW)
    spark.sql("DROP TABLE raw.sales_territory")
    late = raw(spark, "sales_territory", [{"TerritoryID": 2, "Name": "B", "ModifiedDate": at(2)}])
    with pytest.raises(loads.LostTable):
        loads.load_raw_incremental(store, "sales_territory", late, LATER)


def test_marks_of_loads_side_by_side_are_all_kept(spark, store, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    other = type(store)(spark, store.root)
    store.advance("raw", "first", at(1), NOW, 1, 1)
    store.marks("raw").collect()  # one load has read the log when another one writes
    other.advance("raw", "second", at(2), NOW, 2, 2)
    store.advance("raw", "first", at(3), LATER, 3, 3)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: Store_of(store).advance("raw", f"t{i}", at(i), NOW, i, i), range(4, 12)))
    store.advance("raw", "first", None, LATER, 4, 0)  # no new data: the mark stays
    expected = [("first", at(3), 4), ("second", at(2), 2)] + [(f"t{i}", at(i), i) for i in range(4, 12)]
    assert rows_of(store.marks("raw"), "table_name", "max_modified_date", "row_count") == sorted(expected, key=str)
    assert store.compact_marks("raw") == 12 and len(store.partitions("raw", "water_mark")) == 1
    store.advance("raw", "second", at(20), LATER, 5, 5)
    assert store.mark("raw", "second") == at(20) and store.mark("raw", "first") == at(3) and store.counted("raw", "t7") == 7


def Store_of(store):
    return type(store)(store.spark, store.root)


def test_a_batch_with_a_new_and_a_wider_column_is_merged_part_by_part(spark, store):
    rows = spark.createDataFrame([(1, 10, D(1), "2024-01"), (2, 20, D(2), "2024-02")], "id long, n int, price decimal(8,2), month_part string")
    store.reload_partitioned("raw", "grown", rows, "month_part")
    place = "DESCRIBE FORMATTED raw.grown PARTITION (month_part='2024-01')"
    before = store._location(place)
    batch = spark.createDataFrame([(2, 1 << 40, D(3), "new", "2024-02")], "id long, n long, price decimal(12,4), note string, month_part string")
    store.merge("raw", "grown", store.stage(batch, None, "grown"), ["id"], partition="month_part")
    assert store.read("raw", "grown").dtypes == [("id", "bigint"), ("n", "bigint"), ("price", "decimal(12,4)"), ("note", "string"), ("month_part", "string")]
    assert rows_of(store.read("raw", "grown")) == [(1, 10, D(1), None, "2024-01"), (2, 1 << 40, D(3), "new", "2024-02")]
    assert store._location(place) == before  # the other part was not rewritten
    narrow = spark.createDataFrame([(1, 7, "2024-01")], "id long, n int, month_part string")
    store.merge("raw", "grown", store.stage(narrow, None, "grown"), ["id"], partition="month_part")
    assert rows_of(store.read("raw", "grown"), "id", "n", "note") == [(1, 7, None), (2, 1 << 40, "new")]
    bad = spark.createDataFrame([(1, "seven", "2024-01")], "id long, n string, month_part string")
    with pytest.raises(TypeChange):
        store.merge("raw", "grown", store.stage(bad, None, "grown"), ["id"], partition="month_part")


def test_an_interleaved_snapshot_is_narrow_in_every_column(spark, store):
    """Files whose least and greatest values a filter on one column meets: few for each column, where a sorted snapshot has few for the first one only."""
    rows = spark.range(40_000).select(
        (F.col("id") * 7919 % 40_000).cast("int").alias("a"), (F.col("id") * 104_729 % 39_989).cast("int").alias("b"), F.expr("date'2020-01-01' + cast(id * 31 % 997 AS int)").alias("d")
    )
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.replace("star", "z", rows, sort=["a", "b", "d"], interleave=True)
        store.replace("star", "s", rows, sort=["a", "b", "d"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    met = {}
    for name in ("z", "s"):
        table = store.read("star", name)
        assert rows_of(table.agg(F.count("*"), F.sum("a"), F.sum("b"), F.min("d"))) == rows_of(rows.agg(F.count("*"), F.sum("a"), F.sum("b"), F.min("d")))
        spans = table.groupBy(F.input_file_name()).agg(*[f(c).alias(f"{f.__name__}_{c}") for c in "abd" for f in (F.min, F.max)])
        filters = {"a": (20_000, 20_100), "b": (10_000, 10_100), "d": (dt.date(2020, 6, 1), dt.date(2020, 6, 4))}
        met[name] = {c: spans.filter((F.col(f"min_{c}") <= F.lit(hi)) & (F.col(f"max_{c}") >= F.lit(lo))).count() / spans.count() for c, (lo, hi) in filters.items()}
    assert all(share <= 0.5 for share in met["z"].values()), met
    assert met["s"]["b"] > 0.9 and met["s"]["d"] > 0.9, met


def test_interleaving_takes_nulls_texts_and_empty_tables(spark, store):
    rows = spark.createDataFrame([("b", None, 1), (None, at(1), 2), ("a", at(2), 3)], "t string, at timestamp, id int")
    store.replace("star", "odd", rows, sort=["t", "at"], interleave=True)
    assert rows_of(store.read("star", "odd"), "id") == [(1,), (2,), (3,)]
    store.replace("star", "odd", rows.limit(0), sort=["t", "at"], interleave=True)
    assert store.read("star", "odd").count() == 0


@pytest.mark.parametrize("null_safe", [False, True])
def test_rows_are_found_in_any_part_whatever_their_key(spark, store, null_safe):
    """Where the key does not decide the part, the parts that hold a batch's keys are found by the key's range, NULL keys included."""
    rows = spark.createDataFrame([(1, "2024-01", "a"), (None, "2024-02", "b"), (50, "2024-03", "c"), (99, "2024-04", "d")], "id long, month_part string, value string")
    store.reload_partitioned("raw", "any", rows, "month_part")
    batch = spark.createDataFrame([(50, "2024-05", "moved"), (None, "2024-02", "new"), (60, "2024-01", "added")], "id long, month_part string, value string")
    store.merge("raw", "any", store.stage(batch, None, "any"), ["id"], partition="month_part", null_safe=null_safe)
    held = rows_of(store.read("raw", "any"), "id", "month_part", "value")
    expected = [(1, "2024-01", "a"), (50, "2024-05", "moved"), (60, "2024-01", "added"), (99, "2024-04", "d"), (None, "2024-02", "new")]
    assert held == sorted(expected + ([] if null_safe else [(None, "2024-02", "b")]), key=str)
