"""Scans, scalars, joins, windows (S, F, P, J, W)."""

from __future__ import annotations

import datetime as dt


from pyspark.sql import functions as F

from tidewright.catalog.registry import query, table
from tidewright.catalog.standins import MARK, Tables, cents, sql
from tidewright.functions import scalars as fx
from tidewright.operators.ledger import daily_movements, with_running
from tidewright.operators.picks import first_per_group, latest_per_group
from tidewright.session import written
from tidewright.sources.landing import newer_rows
from tidewright.sources.schema import apply_schema, ddl_schema, length_checked, parse_schema, reject_counts

MARK_SQL = f"TIMESTAMP '{MARK}'"


@query(
    "s1_declared_schema_cast",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS props_number,
        TRY_CAST(event_type AS INTEGER) AS type_number, CAST(value AS DECIMAL(19,4))::DOUBLE AS amount,
        CAST(CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS VARCHAR) AS day, CAST(NULL AS VARCHAR) AS missing
       FROM events""",
)
def s1_declared_schema_cast(spark, sf):
    declared = parse_schema(
        {
            "fields": [
                {"name": "event_id", "type": "IntegerType"},
                {"name": "props_number", "type": "IntegerType"},
                {"name": "type_number", "type": "IntegerType"},
                {"name": "amount", "type": "DecimalType(19,4)"},
                {"name": "day", "type": "DateType"},
                {"name": "missing", "type": "StringType"},
            ]
        }
    )
    landed = table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("props_number"),
        F.col("event_type").alias("type_number"),
        F.col("value").cast("string").alias("amount"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    return apply_schema(landed, declared)


@query(
    "s1_reject_counts",
    """SELECT 0::BIGINT AS rejected_event_id, count(*) AS rejected_event_type,
        count(*) FILTER (WHERE user_id > 100) AS rejected_user_id FROM events""",
)
def s1_reject_counts(spark, sf):
    landed = table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.when(F.col("user_id") > 100, F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
    )
    return reject_counts(landed, ddl_schema("event_id int, event_type timestamp, user_id int"))


@query(
    "s2_full_snapshot",
    """SELECT n_nationkey AS nation_id, n_name AS name, r_name AS region, NULL::VARCHAR AS note
       FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def s2_full_snapshot(spark, sf):
    layout = "nation_id INT, name VARCHAR(25), region VARCHAR(25), note VARCHAR(10)"
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nation_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("region"),
        F.lit(None).cast("string").alias("note"),
    )
    return written(length_checked(rows, layout), "snapshot")


@query(
    "s3_incremental_scan",
    f"SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > {MARK_SQL}",
)
def s3_incremental_scan(spark, sf):
    return newer_rows(table(spark, sf, "orders"), "o_orderdate", MARK).select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    "s3_lookback_scan",
    f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > {MARK_SQL} - INTERVAL 30 DAY",
)
def s3_lookback_scan(spark, sf):
    rows = newer_rows(table(spark, sf, "orders"), "o_orderdate", MARK, lookback=dt.timedelta(days=30))
    return rows.select("o_orderkey", "o_orderdate")


@query(
    "f1_concat_null_semantics",
    """SELECT c_custkey, coalesce(first, '') || ' ' || coalesce(last, '') AS blank_name, first || ' ' || last AS strict_name
       FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name END AS first,
             CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS last FROM customer)""",
)
def f1_concat_null_semantics(spark, sf):
    people = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("first"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("last"),
    )
    first, last = F.col("first"), F.col("last")
    return people.select(
        "c_custkey",
        fx.concat_blank(first, F.lit(" "), last).alias("blank_name"),
        F.concat(first, F.lit(" "), last).alias("strict_name"),
    )


@query(
    "f4_row_hash",
    """SELECT o_orderkey, md5(o_orderkey || '|' || coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, '')
         || '|' || CAST(o_totalprice AS DECIMAL(18,2)) || '|' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         || '|' || left('order of the customer with number ' || o_custkey, 30)) AS row_hash FROM orders""",
)
def f4_row_hash(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        fx.row_hash(
            F.col("o_orderkey"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
            fx.money(F.col("o_totalprice")),
            fx.time_text(F.col("o_orderdate")),
            fx.cast_varchar(F.concat_ws(" ", F.lit("order of the customer with number"), "o_custkey")),
        ).alias("row_hash"),
    )


@query(
    "f7_round_second",
    """SELECT event_id, date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS second_ts,
        CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events""",
)
def f7_round_second(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fx.round_second(F.col("ts")).alias("second_ts"), F.to_date("ts").alias("day")
    )


@query(
    "p4_rounded_watermark",
    """SELECT event_id FROM events
       WHERE date_trunc('second', ts + INTERVAL 500 MILLISECOND) > TIMESTAMP '2024-01-15 12:00:00'""",
)
def p4_rounded_watermark(spark, sf):
    rows = table(spark, sf, "events").filter(fx.newer_than(F.col("ts"), dt.datetime(2024, 1, 15, 12, 0, 0)))
    return rows.select("event_id")


@query(
    "p8_case_and_sentinels",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name WHEN c_mktsegment = 'MACHINERY' THEN 'store ' || c_nationkey
          ELSE 'Unknown Customer' END AS name,
        coalesce(CASE WHEN c_acctbal > 0 THEN c_nationkey END, -1) AS territory_id,
        CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS is_lead FROM customer WHERE c_custkey IS NOT NULL""",
)
def p8_case_and_sentinels(spark, sf):
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", F.col("c_name"))
        .when(segment == "MACHINERY", F.concat_ws(" ", F.lit("store"), "c_nationkey"))
        .otherwise(F.lit("Unknown Customer"))
    )
    return (
        table(spark, sf, "customer")
        .filter(F.col("c_custkey").isNotNull())
        .select(
            "c_custkey",
            name.alias("name"),
            fx.or_no_member(F.when(F.col("c_acctbal") > 0, F.col("c_nationkey"))).alias("territory_id"),
            fx.flag(F.col("c_acctbal") > 5000).alias("is_lead"),
        )
    )


@query(
    "p10_later_of_two",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
        CASE WHEN o_orderdate > ship THEN o_orderdate ELSE ship END AS modified_date
       FROM orders JOIN (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS ship FROM lineitem)
         ON o_orderkey = l_orderkey WHERE o_orderdate > {MARK_SQL} OR ship > {MARK_SQL}""",
)
def p10_later_of_two(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_shipdate",
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("ship"),
    )
    order_new, line_new = F.col("o_orderdate") > F.lit(MARK), F.col("ship") > F.lit(MARK)
    same = F.col("o_orderkey") == F.col("l_orderkey")
    changed = (
        orders.filter(order_new)
        .join(lines, same)
        .unionByName(orders.filter(~F.coalesce(order_new, F.lit(False))).join(lines.filter(line_new), same))
    )
    return changed.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_shipdate",
        fx.later_of(F.col("o_orderdate"), F.col("ship")).alias("modified_date"),
    )


@query(
    "p12_snapshot_scalar",
    """SELECT l_returnflag, count(*) AS lines, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity
       FROM lineitem WHERE CAST(l_shipdate AS DATE) <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) GROUP BY 1""",
)
def p12_snapshot_scalar(spark, sf):
    snapshot = table(spark, sf, "orders").agg(F.max("o_orderdate").alias("snapshot"))
    day = F.date_trunc("day", F.col("l_shipdate"))
    return (
        table(spark, sf, "lineitem")
        .join(F.broadcast(snapshot), day <= F.date_trunc("day", F.col("snapshot")))  # one row by construction
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast("int")).alias("quantity"))
    )


@query(
    "j3_filtered_left_join",
    """SELECT c_custkey, o_orderkey AS last_order, n_name FROM customer
       LEFT JOIN (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
                  FROM orders) o ON o_custkey = c_custkey AND o.rn = 1
       LEFT JOIN nation ON n_nationkey = coalesce(CASE WHEN c_acctbal > 0 THEN c_nationkey END, 0) AND n_regionkey <> 1""",
)
def j3_filtered_left_join(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.coalesce(F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")), F.lit(0)).alias("nation")
    )
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    last = latest_per_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    nations = table(spark, sf, "nation").filter("n_regionkey <> 1").select("n_nationkey", "n_name")
    return (
        customers.join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(nations, F.col("nation") == F.col("n_nationkey"), "left")
        .select("c_custkey", F.col("o_orderkey").alias("last_order"), "n_name")
    )


@query(
    "j4_computed_key_join",
    """SELECT c.c_custkey, o_orderkey, l.c_name AS lead FROM orders JOIN customer c ON o_custkey = c.c_custkey
       LEFT JOIN (SELECT c_name FROM customer WHERE c_acctbal > 8000) l
         ON c.c_custkey = CAST(right(l.c_name, 4) AS INTEGER)""",
)
def j4_computed_key_join(spark, sf):
    customers = table(spark, sf, "customer")
    leads = customers.filter("c_acctbal > 8000").select(
        F.col("c_name").alias("lead"), fx.tail_int(F.col("c_name")).alias("lead_key")
    )
    named = customers.select("c_custkey").join(leads, F.col("c_custkey") == F.col("lead_key"), "left")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orders.join(named, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "o_orderkey", "lead")


@query(
    "j6_safe_cast_join",
    """SELECT o_orderkey, c_name FROM
        (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END AS text_key FROM orders)
       LEFT JOIN customer ON TRY_CAST(text_key AS BIGINT) = c_custkey""",
)
def j6_safe_cast_join(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("none"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("text_key"),
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return orders.join(customers, F.col("text_key").try_cast("bigint") == F.col("c_custkey"), "left").select(
        "o_orderkey", "c_name"
    )


@query(
    "j7_composite_key_join",
    sql(
        """SELECT b.ProductID AS product_id, b.LocationID AS location_id, units, s.Quantity AS opening FROM
        (SELECT l_partkey AS ProductID, CAST(l_suppkey % 5 AS INTEGER) AS LocationID,
            CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS units FROM lineitem GROUP BY 1, 2) b
        LEFT JOIN x_stock s ON s.ProductID = b.ProductID AND s.LocationID = b.LocationID""",
        "stock",
    ),
)
def j7_composite_key_join(spark, sf):
    keys = ["ProductID", "LocationID"]
    balances = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("ProductID"), (F.col("l_suppkey") % 5).cast("int").alias("LocationID"))
        .agg(F.sum(F.col("l_quantity").cast("int")).alias("units"))
    )
    opening = Tables(spark, sf).stock().select(*keys, F.col("Quantity").alias("opening"))
    return balances.join(opening, keys, "left").select(
        F.col("ProductID").alias("product_id"), F.col("LocationID").alias("location_id"), "units", "opening"
    )


@query(
    "j8_not_exists",
    """SELECT p_partkey, p_name FROM part WHERE NOT EXISTS
       (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_shipdate > TIMESTAMP '2001-06-30')""",
)
def j8_not_exists(spark, sf):
    moved = newer_rows(table(spark, sf, "lineitem"), "l_shipdate", dt.datetime(2001, 6, 30)).select("l_partkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return parts.join(moved, F.col("p_partkey") == F.col("l_partkey"), "left_anti")


@query(
    "w1_first_per_group",
    """SELECT s_nationkey, s_suppkey, s_name FROM (SELECT *, row_number() OVER
       (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS rn FROM supplier) WHERE rn = 1""",
)
def w1_first_per_group(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_nationkey", "s_acctbal", "s_suppkey", "s_name")
    return first_per_group(suppliers, ["s_nationkey"], ["s_acctbal", "s_suppkey"]).drop("s_acctbal")


@query(
    "w2_latest_per_group",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def w2_latest_per_group(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return latest_per_group(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "d6_deduplicate",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (SELECT *, row_number() OVER
       (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def d6_deduplicate(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    return latest_per_group(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query(
    "w3_running_balance",
    sql(
        """SELECT ProductID AS product_id, CAST(day AS VARCHAR) AS day, CAST(units_in AS BIGINT) AS units_in,
            CAST(units_out AS BIGINT) AS units_out,
            CAST((2 * c + n) // (2 * n) AS DOUBLE) / 100 AS avg_cost,
            CAST(sum(units_in - units_out) OVER (PARTITION BY ProductID ORDER BY day
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running
        FROM (SELECT ProductID, CAST(TransactionDate AS DATE) AS day,
            sum(CASE WHEN TransactionType IN ('P', 'W') THEN Quantity ELSE 0 END) AS units_in,
            sum(CASE WHEN TransactionType IN ('S', 'I') THEN Quantity ELSE 0 END) AS units_out,
            CAST(sum(ActualCost) * 100 AS BIGINT) AS c, count(*) AS n
            FROM x_movements GROUP BY 1, 2)""",
        "movements",
    ),
)
def w3_running_balance(spark, sf):
    series = with_running(daily_movements(Tables(spark, sf).movements()))
    return series.select(
        F.col("ProductID").alias("product_id"),
        "day",
        F.col("day_in").alias("units_in"),
        F.col("day_out").alias("units_out"),
        fx.money(F.col("day_cost")).alias("avg_cost"),
        "running",
    )


@query(
    "u1_union_all_balances",
    f"""SELECT o_custkey AS customer_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, 'moved' AS kind
        FROM orders WHERE o_orderdate > {MARK_SQL} GROUP BY 1
        UNION ALL SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE), 'opening' FROM customer
        WHERE c_acctbal > 0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate > {MARK_SQL})""",
)
def u1_union_all_balances(spark, sf):
    moved = (
        newer_rows(table(spark, sf, "orders"), "o_orderdate", MARK)
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.sum(cents("o_totalprice")).alias("amount"))
    )
    idle = (
        table(spark, sf, "customer")
        .filter("c_acctbal > 0")
        .select(F.col("c_custkey").alias("customer_id"), cents("c_acctbal").alias("amount"))
        .join(moved, "customer_id", "left_anti")
    )
    return moved.withColumn("kind", F.lit("moved")).unionByName(idle.withColumn("kind", F.lit("opening")))


@query(
    "o1_ordered_load",
    "SELECT o_orderkey, o_orderdate FROM orders",
)
def o1_ordered_load(spark, sf):
    """Range-partitioned and sorted files: later date filters skip files by their min/max.

    The order key breaks ties, so that a day holding a large share of the rows spans several tasks.
    """
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    ranged = rows.repartitionByRange("o_orderdate", "o_orderkey").sortWithinPartitions("o_orderdate")
    return written(ranged, "ordered")


@query(
    "i2_watermark_default",
    "SELECT count(*) AS rows_loaded, max(o_orderdate) AS newest FROM orders WHERE o_orderdate > TIMESTAMP '1900-01-01'",
)
def i2_watermark_default(spark, sf):
    from tidewright.operators.watermark import empty_watermarks, mark_or_start

    mark = mark_or_start(empty_watermarks(spark), "orders", "conformed")
    return newer_rows(table(spark, sf, "orders"), "o_orderdate", mark).agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.max("o_orderdate").alias("newest")
    )


