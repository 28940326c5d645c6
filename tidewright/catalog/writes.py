"""Upserts, reloads and watermarks (M, I, D7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewright.catalog.registry import query, table
from tidewright.catalog.standins import LOAD_TS, MARK, cents
from tidewright.functions import scalars as fx
from tidewright.operators import upsert as up
from tidewright.operators import watermark as wm
from tidewright.session import written
from tidewright.sources.landing import newer_rows

_ORDER = "o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate AS modified_date"
# orders known up to the mark, and a batch of all orders of the last year before it and everything after
_OLD = f"SELECT {_ORDER} FROM orders WHERE o_orderdate <= TIMESTAMP '{MARK}'"
_BATCH = f"""SELECT o_orderkey AS order_id, o_custkey + 1 AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) + 10 AS price,
    CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END AS modified_date
    FROM orders WHERE o_orderdate > TIMESTAMP '{MARK}' - INTERVAL 365 DAY"""


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        cents("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("modified_date"),
        F.col("o_orderstatus").alias("status"),
    )


def _old(spark, sf):
    return _orders(spark, sf).filter(F.col("modified_date") <= F.lit(MARK)).drop("status")


def _batch(spark, sf):
    rows = newer_rows(_orders(spark, sf), "modified_date", MARK, lookback=dt.timedelta(days=365))
    moved = F.when(F.col("status") == "P", F.col("modified_date")).otherwise(
        F.col("modified_date") + F.expr("interval 1 day")
    )
    return rows.select(
        "order_id",
        (F.col("customer_id") + 1).alias("customer_id"),
        (F.col("price") + 10).cast("decimal(18,2)").alias("price"),
        moved.alias("modified_date"),
    )


def _merge_sql(condition: str) -> str:
    return f"""WITH t AS ({_OLD}), s AS ({_BATCH})
        SELECT coalesce(t.order_id, s.order_id) AS order_id,
            CASE WHEN {condition} THEN s.customer_id ELSE t.customer_id END AS customer_id,
            CAST(CASE WHEN {condition} THEN s.price ELSE t.price END AS DOUBLE) AS price,
            CASE WHEN {condition} THEN s.modified_date ELSE t.modified_date END AS modified_date
        FROM t FULL JOIN s ON t.order_id = s.order_id"""


@query("m1_pk_upsert", _merge_sql("s.order_id IS NOT NULL"))
def m1_pk_upsert(spark, sf):
    return up.merged_rows(up.merge_frame(_old(spark, sf), _batch(spark, sf), ["order_id"]))


@query(
    "m2_business_key_upsert",
    """SELECT coalesce(t.c_custkey, s.c_custkey) AS customer_key, coalesce(s.c_name, t.c_name) AS name,
        CASE WHEN s.c_custkey IS NOT NULL THEN upper(s.c_mktsegment) ELSE 'old ' || t.c_mktsegment END AS segment,
        CASE WHEN t.c_custkey IS NULL THEN s.c_nationkey ELSE t.c_nationkey END AS nation_key
       FROM (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') t
       FULL JOIN (SELECT * FROM customer WHERE c_acctbal > 3000) s ON t.c_custkey = s.c_custkey""",
)
def m2_business_key_upsert(spark, sf):
    """Renamed columns on the way; the nation is written at insert only (M7)."""
    customers = table(spark, sf, "customer")
    target = customers.filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("name"),
        F.concat_ws(" ", F.lit("old"), "c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
    )
    source = customers.filter("c_acctbal > 3000").select(
        F.col("c_custkey").alias("customer_key"), "c_name", F.upper("c_mktsegment").alias("c_segment"), "c_nationkey"
    )
    names = {"name": "c_name", "segment": "c_segment"}
    merged = up.merge_frame(
        target,
        source,
        ["customer_key"],
        update=names,
        insert={**names, "customer_key": "customer_key", "nation_key": "c_nationkey"},
    )
    return up.merged_rows(merged)


@query(
    "m3_hash_diff_upsert",
    """SELECT coalesce(t.k, s.k) AS customer_id,
        CAST(CASE WHEN t.k IS NULL OR t.h <> s.h THEN s.bal ELSE t.bal END AS DOUBLE) AS balance,
        CASE WHEN t.k IS NULL OR t.h <> s.h THEN s.h ELSE t.h END AS row_hash,
        CASE WHEN t.k IS NULL OR t.h <> s.h THEN 2 ELSE 1 END AS version
       FROM (SELECT c_custkey AS k, CAST(c_acctbal AS DECIMAL(18,2)) AS bal,
               md5(c_custkey || '|' || c_mktsegment || '|' || CAST(c_acctbal AS DECIMAL(18,2))) AS h
             FROM customer WHERE c_mktsegment <> 'FURNITURE') t
       FULL JOIN (SELECT c_custkey AS k, bal, md5(c_custkey || '|' || c_mktsegment || '|' || bal) AS h FROM
               (SELECT *, CAST(CASE WHEN c_acctbal < 1500 THEN CAST(c_acctbal AS DECIMAL(18,2)) + 100
                   ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS bal FROM customer)) s ON t.k = s.k""",
)
def m3_hash_diff_upsert(spark, sf):
    customers = table(spark, sf, "customer").withColumn("bal", cents("c_acctbal"))

    def hashed(df, version):
        return df.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("bal").alias("balance"),
            fx.row_hash(F.col("c_custkey"), F.col("c_mktsegment"), F.col("bal")).alias("row_hash"),
            F.lit(version).alias("version"),
        )

    target = hashed(customers.filter("c_mktsegment <> 'FURNITURE'"), 1)
    raised = F.when(F.col("c_acctbal") < 1500, F.col("bal") + 100).otherwise(F.col("bal")).cast("decimal(18,2)")
    source = hashed(customers.withColumn("bal", raised), 2)
    return up.merged_rows(up.merge_frame(target, source, ["customer_id"], when=up.hash_differs()))


@query("m4_date_diff_upsert", _merge_sql("t.order_id IS NULL OR t.modified_date <> s.modified_date"))
def m4_date_diff_upsert(spark, sf):
    merged = up.merge_frame(_old(spark, sf), _batch(spark, sf), ["order_id"], when=up.date_differs())
    return up.merged_rows(merged)


@query(
    "m5_truncate_reload",
    "SELECT s_suppkey, s_name, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM supplier",
)
def m5_truncate_reload(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", cents("s_acctbal").alias("balance"))
    return written(rows, "reload")


@query(
    "m6_range_replace",
    """SELECT o_orderkey, o_orderdate,
            CASE WHEN o_orderdate BETWEEN DATE '1996-03-01' AND DATE '1997-02-28' THEN 0 ELSE o_custkey END AS o_custkey
       FROM orders WHERE NOT (o_orderdate BETWEEN DATE '1996-03-01' AND DATE '1997-02-28' AND o_orderkey % 3 = 0)""",
)
def m6_range_replace(spark, sf):
    """A year of orders replaced by other rows; all days outside the range are kept."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    first, last = dt.date(1996, 3, 1), dt.date(1997, 2, 28)
    fresh = orders.filter(F.col("o_orderdate").between(F.lit(first), F.lit(last)) & (F.col("o_orderkey") % 3 != 0))
    return up.replace_range(orders, fresh.withColumn("o_custkey", F.lit(0).cast("bigint")), "o_orderdate", first, last)


@query(
    "m8_upsert_counts",
    f"""WITH t AS ({_OLD}), s AS ({_BATCH})
        SELECT count(*) FILTER (WHERE t.order_id IS NULL) AS inserted,
            count(*) FILTER (WHERE t.modified_date <> s.modified_date) AS updated,
            count(*) FILTER (WHERE t.order_id IS NOT NULL AND (s.order_id IS NULL OR t.modified_date = s.modified_date)) AS kept,
            count(*) FILTER (WHERE t.order_id IS NULL OR t.modified_date <> s.modified_date) AS rows_changed
        FROM t FULL JOIN s ON t.order_id = s.order_id""",
)
def m8_upsert_counts(spark, sf):
    return up.action_counts(
        up.merge_frame(_old(spark, sf), _batch(spark, sf), ["order_id"], when=up.date_differs())
    )


@query(
    "m9_null_key_upsert",
    """WITH t AS (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey % 7 END AS department, o_orderstatus AS status,
            count(*) AS n FROM orders GROUP BY 1, 2),
        s AS (SELECT department, status, n + 1 AS n FROM t WHERE status <> 'P')
       SELECT t.department, t.status, coalesce(s.n, t.n) AS n FROM t LEFT JOIN s USING (department, status)
       UNION ALL SELECT department, status, n FROM s WHERE department IS NULL""",
)
def m9_null_key_upsert(spark, sf):
    """Rows with a NULL key never match: kept on one side, inserted from the other."""
    department = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") % 7)
    target = (
        table(spark, sf, "orders")
        .groupBy(department.alias("department"), F.col("o_orderstatus").alias("status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    source = target.filter("status <> 'P'").withColumn("n", F.col("n") + 1)
    return up.merged_rows(up.merge_frame(target, source, ["department", "status"]))


@query(
    "i5_watermark_record",
    f"""SELECT 'orders' AS table_name, TIMESTAMP '{MARK}' AS max_modified_date, 'conformed' AS layer_type,
            TIMESTAMP '{LOAD_TS}' AS last_load_time, CAST(0 AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS rows_changed
          WHERE FALSE
        UNION ALL SELECT 'orders', max(o_orderdate), 'conformed', TIMESTAMP '{LOAD_TS}', count(*), count(*) FROM orders
        UNION ALL SELECT 'lineitem', max(l_shipdate), 'conformed', TIMESTAMP '{LOAD_TS}', count(*), count(*) FROM lineitem
        UNION ALL SELECT 'events', date_trunc('second', max(ts)), 'conformed', TIMESTAMP '{LOAD_TS}', count(*), count(*) FROM events
        UNION ALL SELECT 'empty', TIMESTAMP '{MARK}', 'conformed', TIMESTAMP '{LOAD_TS}', 0, 0
        UNION ALL SELECT 'untouched', TIMESTAMP '{MARK}', 'conformed', TIMESTAMP '{MARK}', 5, 5""",
)
def i5_watermark_record(spark, sf):
    stored = spark.createDataFrame(
        [
            ("orders", MARK, "conformed", MARK, 1, 1),
            ("empty", MARK, "conformed", MARK, 3, 3),
            ("untouched", MARK, "conformed", MARK, 5, 5),
        ],
        wm.WATERMARK_DDL,
    )
    orders, lines, events = (table(spark, sf, t) for t in ("orders", "lineitem", "events"))
    rows = (
        wm.marks_of(orders, "orders", "conformed", "o_orderdate", LOAD_TS)
        .unionByName(wm.marks_of(lines, "lineitem", "conformed", "l_shipdate", LOAD_TS))
        .unionByName(
            wm.marks_of(events.select(F.date_trunc("second", "ts").alias("ts")), "events", "conformed", "ts", LOAD_TS)
        )
        .unionByName(wm.marks_of(orders.filter("o_orderkey IS NULL"), "empty", "conformed", "o_orderdate", LOAD_TS))
    )
    return wm.record(stored, rows)


@query(
    "d7_partition_by_month",
    """SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1998-01' AND '1998-06' GROUP BY 1""",
)
def d7_partition_by_month(spark, sf):
    """Written by month, read back with a filter on the month: only its folders are listed and read."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey", cents("o_totalprice").alias("price"), F.date_format("o_orderdate", "yyyy-MM").alias("year_month")
    )
    # the rebalance splits a month that outgrows a task and joins small ones
    stored = written(rows.hint("rebalance", F.col("year_month")), "by-month", partition_by=["year_month"])
    return (
        stored.filter(F.col("year_month").between("1998-01", "1998-06"))
        .groupBy("year_month")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("price").alias("amount"))
    )


