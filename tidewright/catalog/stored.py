"""The stored path: loads and merges over tables of a store of their own."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.catalog.entities import Staff, conform_copies, gl_lines
from tidewright.catalog.registry import ORACLES, query, table
from tidewright.catalog.standins import LOAD_TS, MARK, Tables, sql
from tidewright.operators.profile import QUANTILES
from tidewright.plans import conform, loads
from tidewright.plans.layouts import star_layout
from tidewright.plans.star import dimension_load
from tidewright.session import scratch_path, written
from tidewright.sources.schema import length_checked
from tidewright.sources.store import SMALL_ROWS_CONF, Store
from tidewright.streaming.micro_batches import landing_stream, merge_batch, merge_batches


def _store(spark) -> Store:
    return Store(spark, scratch_path(spark, "lake"), prefix=f"q{uuid.uuid4().hex[:12]}_")


def _two_loads(spark, sf) -> Store:
    """Orders up to the mark, then everything with new numbers: only later orders may change. A third load finds nothing."""
    store, landed = _store(spark), Tables(spark, sf).header()
    renamed = landed.withColumn("SalesOrderNumber", F.concat(F.lit("new-"), "SalesOrderNumber"))
    loads.load_raw_incremental(store, "sales_order_header", landed.filter(F.col("ModifiedDate") <= F.lit(MARK)), LOAD_TS)
    loads.load_raw_incremental(store, "sales_order_header", renamed, LOAD_TS)
    loads.load_raw_incremental(store, "sales_order_header", renamed, LOAD_TS)
    return store


@query(
    "s7_raw_incremental_load",
    sql(
        f"""SELECT SalesOrderID AS order_id, CustomerID AS customer_id, CAST(ModifiedDate AS TIMESTAMP) AS modified_date,
            CASE WHEN ModifiedDate > TIMESTAMP '{MARK}' THEN 'new-' ELSE '' END || SalesOrderNumber AS number FROM x_header""",
        "header",
    ),
)
def s7_raw_incremental_load(spark, sf):
    rows = _two_loads(spark, sf).read("raw", "sales_order_header")
    return rows.select(
        F.col("SalesOrderID").alias("order_id"),
        F.col("CustomerID").alias("customer_id"),
        F.col("ModifiedDate").alias("modified_date"),
        F.col("SalesOrderNumber").alias("number"),
    )


@query(
    "i1_control_rows",
    sql(
        f"""SELECT 'sales_order_header' AS table_name, 'raw' AS layer_type, CAST(max(ModifiedDate) AS TIMESTAMP) AS max_modified_date,
            TIMESTAMP '{LOAD_TS}' AS last_load_time, count(*) AS row_count, count(*) FILTER (ModifiedDate > TIMESTAMP '{MARK}') AS rows_changed
           FROM x_header""",
        "header",
    ),
)
def i1_control_rows(spark, sf):
    """What the loads recorded: newest time, size and changes come from the writes themselves."""
    return _two_loads(spark, sf).marks("raw")


@query(
    "s8_raw_full_load",
    sql("SELECT Status AS status, count(*) AS orders, (SELECT count(*) FROM x_header) AS recorded FROM x_header GROUP BY 1", "header"),
)
def s8_raw_full_load(spark, sf):
    store = _store(spark)
    done = loads.load_raw_full(store, "sales_order_header", Tables(spark, sf).header(), LOAD_TS)
    counted = store.read("raw", "sales_order_header").groupBy(F.col("Status").alias("status")).agg(F.count(F.lit(1)).alias("orders"))
    return counted.withColumn("recorded", F.lit(done.row_count).cast("bigint"))


_MERGED = """SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m') AS month_part,
       CASE WHEN o_orderkey % 7 = 0 THEN 'merged' ELSE o_orderstatus END AS status
     FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 7 = 0"""


def _stored_merge(spark, sf, small: bool):
    store, month = _store(spark), F.date_format("o_orderdate", "yyyy-MM")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), month.alias("month_part"), F.col("o_orderstatus").alias("status"))
    store.reload_partitioned("raw", "orders", orders.filter("order_id % 3 <> 0").select("order_id", "status", "month_part"), "month_part")
    batch = orders.filter("order_id % 7 = 0").withColumn("status", F.lit("merged"))
    staged = store.stage(batch.select("order_id", "status", "month_part"), None, "orders")
    before = spark.conf.get(SMALL_ROWS_CONF, None)
    if not small:
        spark.conf.set(SMALL_ROWS_CONF, "0")
    try:
        store.merge("raw", "orders", staged, ["order_id"], partition="month_part")
    finally:
        if not small:
            spark.conf.unset(SMALL_ROWS_CONF) if before is None else spark.conf.set(SMALL_ROWS_CONF, before)
    return store.read("raw", "orders").select("order_id", "month_part", "status")


@query("m1_store_merge_small", _MERGED)
def m1_store_merge_small(spark, sf):
    """A staged batch merged into a table stored by month, broadcast."""
    return _stored_merge(spark, sf, small=True)


@query("m1_store_merge_large", _MERGED)
def m1_store_merge_large(spark, sf):
    """The same where the batch counts as large: both sides are shuffled."""
    return _stored_merge(spark, sf, small=False)


@query("o1_sorted_snapshot", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1999-01-01'")
def o1_sorted_snapshot(spark, sf):
    """A snapshot written in ranges of a column, so that scans skip files; replaced once by itself."""
    store, orders = _store(spark), table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    store.replace("raw", "orders", orders.limit(0))
    store.replace("raw", "orders", orders, sort=["o_orderdate"])
    return store.read("raw", "orders").filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("date"))


@query("o1_interleaved_snapshot", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_custkey < 20")
def o1_interleaved_snapshot(spark, sf):
    """A snapshot in the interleaved order of three columns, filtered by the second one."""
    store, orders = _store(spark), table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    store.replace("raw", "orders", orders, sort=["o_orderdate", "o_custkey", "o_orderkey"], interleave=True)
    return store.read("raw", "orders").filter("o_custkey < 20")


@query(
    "s5_quarantine",
    sql(
        f"""SELECT CAST(SalesOrderID AS VARCHAR) AS source_key, u.c AS column_name, u.v AS raw_value, 'not a ' || u.k AS reason, TIMESTAMP '{LOAD_TS}' AS load_time
           FROM x_header, LATERAL (SELECT 'CustomerID' AS c, 'c-' || CustomerID AS v, 'int' AS k WHERE SalesOrderID % 50 = 3
             UNION ALL SELECT 'OrderDate', 'soon', 'timestamp' WHERE SalesOrderID % 70 = 3) u""",
        "header",
    ),
)
def s5_quarantine(spark, sf):
    """Rejected raw values of a full and an incremental load, each written in the pass that wrote its rows."""
    store, landed = _store(spark), Tables(spark, sf).header()
    order = F.col("SalesOrderID")
    bad = landed.withColumns({
        "CustomerID": F.when(order % 50 == 3, F.concat(F.lit("c-"), F.col("CustomerID").cast("string"))).otherwise(F.col("CustomerID").cast("string")),
        "OrderDate": F.when(order % 70 == 3, F.lit("soon")).otherwise(F.col("OrderDate").cast("string")),
    })
    loads.load_raw_full(store, "sales_order_header", bad.filter(F.col("ModifiedDate") <= F.lit(MARK)), LOAD_TS)
    loads.load_raw_incremental(store, "sales_order_header", bad, LOAD_TS)
    return store.rejects("raw", "sales_order_header").drop("table_name")


_PROFILED = {"l_orderkey": True, "l_partkey": True, "l_quantity": True, "l_shipdate": True, "l_returnflag": False}


@query(
    "d2_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls,
            {f"CAST({e('min', c)} AS DOUBLE)" if number else "NULL"} AS least_number, {f"CAST({e('max', c)} AS DOUBLE)" if number else "NULL"} AS greatest_number,
            {"NULL" if number else f"min({c})"} AS least_text, {"NULL" if number else f"max({c})"} AS greatest_text,
            true AS distinct_within_5_percent, true AS quantiles_within_2_percent FROM lineitem"""
        for c, number in _PROFILED.items()
        for e in [lambda f, x: f"epoch({f}({x}))" if x == "l_shipdate" else f"{f}({x})"]
    ),
)
def d2_profile(spark, sf):
    """Profiles of three loads merged without reading their rows again; the estimates are held against exact counts and ranks."""
    lines = table(spark, sf, "lineitem").select(*_PROFILED)
    store = _store(spark)
    for third in range(3):
        store.keep_profile("raw", "lines", lines.filter(F.col("l_orderkey") % 3 == third))
    found = written(store.profile("raw", "lines"), "profile")
    exact = []
    for c, number in _PROFILED.items():
        value = F.unix_micros(F.col(c).cast("timestamp")) / 1e6 if c == "l_shipdate" else F.col(c).cast("double") if number else F.lit(0.0)
        estimates = found.filter(F.col("column_name") == c).select("quantiles", "distinct_values")  # one row
        ranks = [F.count_if(value < F.col("quantiles")[i]).alias(f"below{i}") for i in range(5)] + [F.count_if(value <= F.col("quantiles")[i]).alias(f"upto{i}") for i in range(5)]
        sums = lines.crossJoin(F.broadcast(estimates)).agg(
            F.count_distinct(c).alias("exact"), F.max("distinct_values").alias("about"), F.count(F.col(c)).alias("n"), *ranks
        )
        near = F.abs(F.col("exact") - F.col("about")) <= F.greatest(F.lit(1), F.col("exact") * 0.05)
        within = [(F.col(f"below{i}") <= (q + 0.02) * F.col("n")) & (F.col(f"upto{i}") >= (q - 0.02) * F.col("n")) for i, q in enumerate(QUANTILES)]
        exact.append(sums.select(F.lit(c).alias("column_name"), near.alias("distinct_within_5_percent"), (reduce(and_, within) if number else F.lit(True)).alias("quantiles_within_2_percent")))
    checks = reduce(DataFrame.unionByName, exact)
    return found.drop("quantiles", "frequent", "distinct_values").join(checks, "column_name")


@query(
    "i5_marks_side_by_side",
    """SELECT table_name, 'raw' AS layer_type, CAST(newest AS TIMESTAMP) AS max_modified_date, rows AS row_count
       FROM (SELECT 'orders' AS table_name, max(o_orderdate) AS newest, count(*) AS rows FROM orders
             UNION ALL SELECT 'lineitem', max(l_shipdate), count(*) FROM lineitem)""",
)
def i5_marks_side_by_side(spark, sf):
    """Two loads that have both read the log before either writes to it; the log is folded in between."""
    first = _store(spark)
    second = Store(spark, first.root, first.prefix)
    orders, lines = (table(spark, sf, t).agg(F.max(c).alias("newest"), F.count(F.lit(1)).alias("n")).first() for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")))
    first.advance("raw", "orders", MARK, LOAD_TS, 0, 0)
    for store in (first, second):
        store.mark("raw", "orders")
    second.advance("raw", "lineitem", lines["newest"], LOAD_TS, lines["n"], lines["n"])
    first.advance("raw", "orders", orders["newest"], LOAD_TS, orders["n"], orders["n"])
    first.compact_marks("raw")
    first.advance("raw", "orders", None, LOAD_TS, orders["n"], 0)  # no new data: the mark stays
    return first.marks("raw").select("table_name", "layer_type", "max_modified_date", "row_count")


@query(
    "s6_evolved_merge",
    """SELECT o_orderkey AS order_id, CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey + 5000000000 ELSE o_custkey END AS BIGINT) AS customer,
         CASE WHEN o_orderkey % 7 = 0 THEN 'new' END AS note FROM orders""",
)
def s6_evolved_merge(spark, sf):
    """A batch with a wider and a new column merged into a stored table; parts that it does not touch are read with the new layout."""
    store, month = _store(spark), F.date_format("o_orderdate", "yyyy-MM").alias("month_part")
    orders = table(spark, sf, "orders")
    store.reload_partitioned("raw", "orders", orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").cast("int").alias("customer"), month), "month_part")
    batch = orders.filter("o_orderkey % 7 = 0").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_orderkey") + F.lit(5_000_000_000)).cast("long").alias("customer"), F.lit("new").alias("note"), month
    )
    store.merge("raw", "orders", store.stage(batch, None, "orders"), ["order_id"], partition="month_part")
    return store.read("raw", "orders").select("order_id", "customer", "note")


@query(
    "s15_micro_batches",
    """SELECT o_orderkey AS order_id, o_orderdate AS changed, CASE WHEN o_orderkey % 3 = 0 THEN 'again-' ELSE '' END || o_orderstatus AS status FROM orders""",
)
def s15_micro_batches(spark, sf):
    """Landing files taken by two runs of a stream; then its first batch is replayed with other contents and is fenced off."""
    store, landing, place = _store(spark), scratch_path(spark, "landing"), scratch_path(spark, "stream")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("changed"), F.col("o_orderstatus").alias("status"))
    first = orders.withColumn("changed", F.col("changed") - F.expr("INTERVAL 1 DAY")).filter("order_id % 3 = 0 OR order_id % 3 = 1")
    again = orders.filter("order_id % 3 = 0").withColumn("status", F.concat(F.lit("again-"), "status"))
    for rows in (first.withColumn("changed", F.when(F.col("order_id") % 3 == 1, F.col("changed") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("changed"))), again.unionByName(orders.filter("order_id % 3 = 2"))):
        rows.write.mode("append").parquet(landing)
        stream = landing_stream(spark, landing, rows.schema)
        merge_batches(stream, store, "raw", "orders", ["order_id"], "changed", checkpoint=place).awaitTermination()
    if merge_batch(store, "raw", "orders", ["order_id"], "changed", place, first.withColumn("status", F.lit("stale")), 0):
        raise AssertionError("a replayed batch was merged again")
    return store.read("raw", "orders")


@query("s12_preview", "SELECT least(5, count(*)) AS rows FROM orders")
def s12_preview(spark, sf):
    """The first rows of a loaded table."""
    return loads.preview(_two_loads(spark, sf), "raw", "sales_order_header").agg(F.count(F.lit(1)).alias("rows"))


_EARLY = "TIMESTAMP '1995-01-01 00:00:00' AS modified_date"


def _dimension(spark, sf, name: str, entity: str):
    return length_checked(dimension_load(name, conform_copies(spark, sf)[entity]), star_layout(name))


@query(
    "g1_dim_account",
    f"""SELECT n_nationkey AS account_key, n_regionkey + 100 AS parent_id, n_nationkey AS account_code, n_regionkey AS parent_account_code,
        n_name AS account_description, 'asset' AS account_type, {_EARLY} FROM nation""",
)
def g1_dim_account(spark, sf):
    return _dimension(spark, sf, "dim_account", "account")


@query(
    "g2_dim_class",
    f"""SELECT s_suppkey AS class_key, s_nationkey AS parent_class_id, CAST(s_suppkey AS VARCHAR) AS class_code, s_name AS class_name,
        1 AS class_level, 1 AS sort_order, true AS is_debit_normal, {_EARLY} FROM supplier""",
)
def g2_dim_class(spark, sf):
    return _dimension(spark, sf, "dim_class", "class")


@query(
    "g4_dim_department",
    f"SELECT r_regionkey AS department_key, left(r_name, 2) AS department_code, r_name AS name, r_name AS group_name, {_EARLY} FROM region",
)
def g4_dim_department(spark, sf):
    return _dimension(spark, sf, "dim_department", "department")


@query(
    "g6_dim_location",
    """SELECT s_suppkey AS location_key, s_name AS name, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS cost_rate,
        CAST(1 AS DOUBLE) AS availability, TIMESTAMP '1995-01-01 00:00:01' AS modified_date FROM supplier""",
)
def g6_dim_location(spark, sf):
    return _dimension(spark, sf, "dim_location", "location")


@query("g8_dim_sales_territory", f"SELECT n_nationkey AS sales_territory_key, CAST(n_regionkey AS VARCHAR) AS sales_territory_group, n_name AS sales_territory_country, {_EARLY} FROM nation")
def g8_dim_sales_territory(spark, sf):
    """The territory's whole layout, through the renamed columns of its conformed table."""
    return _dimension(spark, sf, "dim_sales_territory", "sales_territory")


def _of_entity(entity: str, conformed: str, replace: str = "") -> str:
    return f"SELECT * {replace} RENAME ({entity}_id AS {entity}_key) FROM ({ORACLES[conformed]})"


@query("g3_dim_customer", _of_entity("customer", "t3_conform_customer"))
def g3_dim_customer(spark, sf):
    return length_checked(dimension_load("dim_customer", conform.conform_customer(Tables(spark, sf))), star_layout("dim_customer"))


_NUMBER_AS_TEXT = "REPLACE (employee_national_number::VARCHAR AS employee_national_number)"


@query("g5_dim_employee", _of_entity("employee", "t5_conform_employee", _NUMBER_AS_TEXT))
def g5_dim_employee(spark, sf):
    return length_checked(dimension_load("dim_employee", conform.conform_employee(Staff(spark, sf))), star_layout("dim_employee"))


@query("g7_dim_product", _of_entity("product", "t7_conform_product"))
def g7_dim_product(spark, sf):
    return length_checked(dimension_load("dim_product", conform.conform_product(Tables(spark, sf))), star_layout("dim_product"))


@query("g11_repaired_keys", ORACLES["g11_fact_transaction"])
def g11_repaired_keys(spark, sf):
    """Facts loaded into created tables (S10) before a third of the accounts, whose keys are looked up again once they are there."""
    store, t = _store(spark), Tables(spark, sf)
    loads.create_tables(store)
    store.replace("conformed", "transaction", gl_lines(spark, sf))
    for name in ("dim_department", "dim_class", "dim_date"):
        store.replace("star", name, getattr(t, name)())
    store.replace("star", "dim_account", t.dim_account().filter("account_key % 3 <> 1"))
    loads.load_star_full(store, "fact_transaction", LOAD_TS)
    store.replace("star", "dim_account", t.dim_account())
    loads.repair_keys(store, "fact_transaction", LOAD_TS)
    return store.read("star", "fact_transaction").drop(loads.MONTH_PART)


@query(
    "i8_load_time_marks",
    sql(
        f"""SELECT 'budget' AS table_name, TIMESTAMP '{LOAD_TS}' AS max_modified_date, count(*) AS row_count FROM x_m_budget
            UNION ALL SELECT 'survey', TIMESTAMP '{LOAD_TS}', count(*) FROM x_m_survey""",
        "m_budget",
        "m_survey",
    ),
)
def i8_load_time_marks(spark, sf):
    """Tables that are read whole and compared by hash are marked with the time of their load (I8, I9), whatever their rows say."""
    store, t = _store(spark), Tables(spark, sf)
    loads.create_tables(store)
    for name in ("m_budget", "m_survey"):
        store.replace("raw", name, getattr(t, name)())
    for name in ("budget", "survey"):
        loads.load_conformed_incremental(store, name, LOAD_TS)
    return store.marks("conformed").select("table_name", "max_modified_date", "row_count")
