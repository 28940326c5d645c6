"""Calendar, dimension and fact loads (G)."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap

from pyspark.sql import functions as F

from tidewright.catalog import entities as en
from tidewright.catalog.registry import query, table
from tidewright.catalog.standins import MARK, Tables, spread_day, sql
from tidewright.operators.calendar import calendar
from tidewright.operators.upsert import merge_frame, merged_rows
from tidewright.plans.sales import sales_changed
from tidewright.plans.star import FACTS, dimension, fact_load, relookup
from tidewright.session import written

@query(
    "g9_dim_date",
    """SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, strftime(d, '%Y-%m-%d') AS date, day(d) AS day,
        dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_of_week_name, left(dayname(d), 3) AS day_of_week_short_name,
        left(dayname(d), 1) AS day_of_week_first_letter, dayofyear(d) AS day_of_year, week(d) AS iso_week,
        isoyear(d) AS iso_year, isoyear(d) || '-' || week(d) AS iso_year_week, month(d) AS month,
        monthname(d) AS month_name, left(monthname(d), 3) AS month_short_name, quarter(d) AS quarter,
        CASE quarter(d) WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' ELSE 'IV' END AS quarter_name,
        year(d) AS year, strftime(d, '%Y-%m') AS year_month,
        year(d) || '-' || CASE quarter(d) WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' ELSE 'IV' END AS year_quarter,
        strftime(date_trunc('month', d), '%Y-%m-%d') AS first_date_of_month,
        strftime(last_day(d), '%Y-%m-%d') AS last_date_of_month,
        strftime(date_trunc('quarter', d), '%Y-%m-%d') AS first_date_of_quarter,
        strftime(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS last_date_of_quarter,
        year(d) || '-01-01' AS first_date_of_year, year(d) || '-12-31' AS last_date_of_year,
        day(last_day(d)) AS nb_days_of_month, day(last_day(make_date(year(d), 2, 1))) = 29 AS is_leap_year
       FROM (SELECT unnest(generate_series((SELECT date_trunc('year', min(o_orderdate)) FROM orders),
           (SELECT last_day(max(o_orderdate)) FROM orders), INTERVAL 1 DAY)) AS d)""",
)
def g9_dim_date(spark, sf):
    """The calendar of the years the orders span; the two bounds are read from the orders."""
    first, last = (
        table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    )
    end = (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    return calendar(spark, first.replace(month=1, day=1), end)


_DIM_FULL = """SELECT 'customer' AS dimension, c_custkey AS key, c_name AS name FROM customer
    UNION ALL SELECT 'product', p_partkey, p_name FROM part
    UNION ALL SELECT 'employee', s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'territory', n_nationkey, n_name FROM nation"""


def _sources(spark, sf):
    named = {
        "customer": ("customer", "c_custkey", "c_name"),
        "product": ("part", "p_partkey", "p_name"),
        "employee": ("supplier", "s_suppkey", "s_name"),
        "territory": ("nation", "n_nationkey", "n_name"),
    }
    for entity, (base, key, name) in named.items():
        yield entity, table(spark, sf, base).select(
            F.col(key).cast("bigint").alias("id"), F.col(name).alias("name"), spread_day(key).alias("modified_date")
        )


@query("g1_dim_load_full", _DIM_FULL)
def g1_dim_load_full(spark, sf):
    parts = [
        dimension(rows, "id", "key").select(F.lit(entity).alias("dimension"), "key", "name")
        for entity, rows in _sources(spark, sf)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "g1_dim_load_incremental",
    f"""SELECT dimension, key, CASE WHEN changed <= TIMESTAMP '{MARK}' THEN 'old ' || name ELSE name END AS name, changed AS modified_date
        FROM (SELECT *, TIMESTAMP '1995-01-01' + INTERVAL 1 DAY * CAST(key % 2000 AS INTEGER) AS changed FROM ({_DIM_FULL}))
        WHERE changed > TIMESTAMP '{MARK}' OR changed <= TIMESTAMP '1999-06-30'""",
)
def g1_dim_load_incremental(spark, sf):
    """Dimension rows newer than the mark merged by key into older dimensions."""
    result = None
    for entity, rows in _sources(spark, sf):
        stored = dimension(rows.filter("modified_date <= timestamp_ntz'1999-06-30'"), "id", "key")
        stored = stored.withColumn("name", F.concat(F.lit("old "), "name"))
        merged = merged_rows(merge_frame(stored, dimension(rows, "id", "key", MARK), ["key"]))
        named = merged.select(F.lit(entity).alias("dimension"), "key", "name", "modified_date")
        result = named if result is None else result.unionByName(named)
    return result


# ---- facts ----------------------------------------------------------------------------------------


def dims(spark, sf):
    """Dimensions by name, each built only when a lookup asks for it."""
    return Tables(spark, sf)


FACT_SALES = """SELECT s.sales_order_id AS sales_order_key, c.customer_key, p.product_key, e.employee_key,
    t.sales_territory_key, d.date_key AS order_date_key, s.sales_order_number, s.sales_order_detail_id, s.order_quantity,
    s.unit_price, s.unit_cost, s.discount_percentage, s.sales_amount, s.total_product_cost, s.gross_margin,
    s.discount_amount, s.modified_date
  FROM {} s LEFT JOIN x_dim_customer c ON c.customer_key = s.customer_id
  LEFT JOIN x_dim_product p ON p.product_key = s.product_id
  LEFT JOIN x_dim_employee e ON e.employee_key = s.employee_id
  LEFT JOIN x_dim_sales_territory t ON t.sales_territory_key = s.sales_territory_id
  LEFT JOIN x_dim_date d ON d.date = s.order_date"""
SALES_TABLES = ("header", "detail", "cost", "dim_customer", "dim_product", "dim_employee", "dim_sales_territory", "dim_date")


def fact_sales(spark, sf):
    return fact_load("fact_sales", en.full_sales(spark, sf), dims(spark, sf))


@query(
    "g10_fact_sales",
    sql(f"SELECT {en.AS_DOUBLES} FROM f", *SALES_TABLES, s=en.FULL_SALES, f=FACT_SALES.format("s")),
)
def g10_fact_sales(spark, sf):
    return fact_sales(spark, sf)


@query(
    "g10_fact_sales_incremental",
    sql(
        f"""SELECT {en.AS_DOUBLES} FROM (SELECT * FROM c UNION ALL BY NAME SELECT * REPLACE (0 AS order_quantity) FROM f
            WHERE (modified_date <= TIMESTAMP '1999-06-30' OR modified_date IS NULL)
              AND NOT EXISTS (SELECT 1 FROM c WHERE c.sales_order_key = f.sales_order_key
                AND c.sales_order_detail_id = f.sales_order_detail_id))""",
        *SALES_TABLES,
        s=en.FULL_SALES,
        f=FACT_SALES.format("s"),
        changed=en.CHANGED_SALES,
        c=FACT_SALES.format("changed"),
    ),
)
def g10_fact_sales_incremental(spark, sf):
    """Facts of changed sales merged by order and line into older facts."""
    t = Tables(spark, sf)
    stored = fact_sales(spark, sf).filter("modified_date <= timestamp'1999-06-30' or modified_date is null")
    changed = sales_changed(t.header(), t.detail(), t.cost(), MARK)
    fresh = fact_load("fact_sales", changed, dims(spark, sf), mark=MARK)
    stored = written(stored.withColumn("order_quantity", F.lit(0)), "facts")
    return merged_rows(merge_frame(stored, written(fresh, "facts-batch"), list(FACTS["fact_sales"].keys)))


FACT_GL = """SELECT g.transaction_id AS transaction_key, a.account_key, dp.department_key, c.class_key,
    d.date_key AS transaction_date_key, transaction_code, transaction_line_id, transaction_type, entry_type, description,
    debit_amount, credit_amount, amount, modified_date
  FROM g LEFT JOIN x_dim_account a ON a.account_key = g.account_id
  LEFT JOIN x_dim_department dp ON dp.department_key = g.department_id
  LEFT JOIN x_dim_class c ON c.class_key = g.class_id LEFT JOIN x_dim_date d ON d.date = g.transaction_date"""
GL_TABLES = ("gl", "dim_account", "dim_department", "dim_class", "dim_date")


def fact_transaction(spark, sf):
    return fact_load("fact_transaction", en.gl_lines(spark, sf), dims(spark, sf))


@query("g11_fact_transaction", sql(f"SELECT {en.GL_DOUBLES} FROM f", *GL_TABLES, g=en.GL, f=FACT_GL))
def g11_fact_transaction(spark, sf):
    return fact_transaction(spark, sf)


@query(
    "g12_fact_inventory",
    sql(
        """SELECT p.product_key, l.location_key, d.date_key, unit_in, unit_out, unit_cost, unit_balance, modified_date
           FROM ledger g LEFT JOIN x_dim_date d ON d.date = g.transaction_date
           LEFT JOIN x_dim_location l ON l.location_key = g.location_id
           LEFT JOIN x_dim_product p ON p.product_key = g.product_id""",
        "stock",
        "movements",
        "dim_date",
        "dim_location",
        "dim_product",
        **en.FULL_LEDGER,
    ),
)
def g12_fact_inventory(spark, sf):
    return fact_inventory(spark, sf)


def fact_inventory(spark, sf):
    ledger = en.full_ledger(spark, sf).withColumn("location_id", F.col("location_id").cast("string"))
    return fact_load("fact_product_inventory", ledger, dims(spark, sf))


FACT_BUDGET = """SELECT a.account_key, dp.department_key, d.date_key AS budget_date_key, budget, modified_date
    FROM b LEFT JOIN x_dim_date d ON d.date = b.budget_date LEFT JOIN x_dim_account a ON a.account_key = b.account_id
    LEFT JOIN x_dim_department dp ON dp.department_key = b.department_id"""


def fact_budget(spark, sf):
    return fact_load("fact_budget", en.budgets(spark, sf), dims(spark, sf))


@query(
    "g13_fact_budget",
    sql(
        "SELECT * REPLACE (CAST(budget AS DOUBLE) AS budget) FROM f",
        "m_budget",
        "dim_date",
        "dim_account",
        "dim_department",
        b=en.BUDGET,
        f=FACT_BUDGET,
    ),
)
def g13_fact_budget(spark, sf):
    return fact_budget(spark, sf)


# events lie in 2024: the calendar of these two facts covers the event days
_EVENT_DATE = """SELECT DISTINCT CAST(ts AS DATE) AS date, year(ts) * 10000 + month(ts) * 100 + day(ts) AS date_key
    FROM events"""


def event_dims(spark, sf, last=dt.date(2024, 12, 31)):
    """Dimensions with a calendar over all event days."""
    return ChainMap({"dim_date": calendar(spark, dt.date(2024, 1, 1), last)}, dims(spark, sf))


def fact_opportunity(spark, sf):
    return fact_load("fact_opportunity", en.opportunities(spark, sf), event_dims(spark, sf))


@query(
    "g14_fact_opportunity",
    sql(
        """SELECT opportunity_key, c.customer_key, d.date_key AS close_date_key, opportunity_id, opportunity_stage,
            CAST(estimated_value AS DOUBLE) AS estimated_value, modified_date
           FROM o LEFT JOIN event_date d ON d.date = CAST(o.close_date AS DATE) LEFT JOIN x_dim_customer c ON c.customer_key = o.customer_id""",
        "opportunity",
        "customer",
        "leads",
        "dim_customer",
        crm=en.CRM,
        o=en.OPPORTUNITY,
        event_date=_EVENT_DATE,
    ),
)
def g14_fact_opportunity(spark, sf):
    return fact_opportunity(spark, sf)


FACT_SURVEY = """SELECT survey_id AS survey_key, c.customer_key, p.product_key, d.date_key AS survey_date_key,
    survey_code, overall_rating, quality_rating, price_rating, service_rating, recommendation, purchase_channel,
    customers_segment, comments, modified_date
  FROM s LEFT JOIN x_dim_customer c ON c.customer_key = s.customer_id
  LEFT JOIN x_dim_product p ON p.product_key = s.product_id LEFT JOIN event_date d ON d.date = CAST(s.survey_date AS DATE)"""


def fact_survey(spark, sf):
    return fact_load("fact_survey", en.surveys(spark, sf), event_dims(spark, sf))


@query(
    "g15_fact_survey",
    sql(FACT_SURVEY, "m_survey", "dim_customer", "dim_product", s=en.SURVEY, event_date=_EVENT_DATE),
)
def g15_fact_survey(spark, sf):
    return fact_survey(spark, sf)


@query(
    "j9_date_key_whole_days",
    """SELECT event_id AS survey_key, CASE WHEN ts < TIMESTAMP '2024-01-25' THEN year(ts) * 10000 + month(ts) * 100 + day(ts) END AS whole_day_key,
        CAST(NULL AS INTEGER) AS exact_key FROM events""",
)
def j9_date_key_whole_days(spark, sf):
    """A time of day finds no calendar row unless it is cut to its day first."""
    answers = en.surveys(spark, sf).drop("survey_date")
    times = table(spark, sf, "events").select(F.col("event_id").alias("survey_id"), F.col("ts").alias("survey_date"))
    timed = answers.join(times, "survey_id")
    keys = ["survey_key", "survey_date_key"]
    cut = fact_load("fact_survey", timed, event_dims(spark, sf, dt.date(2024, 1, 24)), whole_days=True).select(*keys)
    exact = fact_load("fact_survey", timed, event_dims(spark, sf, dt.date(2024, 1, 24))).select(*keys)
    return cut.withColumnRenamed("survey_date_key", "whole_day_key").join(
        exact.withColumnRenamed("survey_date_key", "exact_key"), "survey_key"
    )


@query(
    "g14_relookup_late_keys",
    sql(
        """SELECT opportunity_key, c.customer_key, d.date_key AS close_date_key, opportunity_id, opportunity_stage,
            CAST(estimated_value AS DOUBLE) AS estimated_value, modified_date
           FROM o JOIN customer ON c_custkey = customer_id AND (c_mktsegment = 'BUILDING' OR c_acctbal < 0)
           LEFT JOIN x_dim_customer c ON c.customer_key = o.customer_id
           LEFT JOIN event_date d ON d.date = CAST(o.close_date AS DATE)""",
        "opportunity",
        "customer",
        "leads",
        "dim_customer",
        crm=en.CRM,
        o=en.OPPORTUNITY,
        event_date=_EVENT_DATE,
    ),
)
def g14_relookup_late_keys(spark, sf):
    """Facts loaded before their customers arrived get their keys once the dimension rows are there."""
    year = calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    complete = ChainMap({"dim_date": year}, dims(spark, sf))
    late = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("customer_key"))
    early = ChainMap({"dim_customer": complete["dim_customer"].join(late, "customer_key", "left_anti")}, complete)
    source = en.opportunities(spark, sf)
    stored = fact_load("fact_opportunity", source, early)
    return relookup("fact_opportunity", stored, source, complete)


@query(
    "flagship_margin_by_brand",
    sql(
        """SELECT strftime(s.order_date, '%Y-%m') AS year_month, p.brand, CAST(sum(gross_margin) AS DOUBLE) AS gross_margin,
            CAST(sum(sales_amount) AS DOUBLE) AS sales_amount, count(*) AS lines
           FROM s JOIN x_dim_product p ON p.product_key = s.product_id JOIN x_dim_date d ON d.date = s.order_date GROUP BY 1, 2""",
        *SALES_TABLES,
        s=en.FULL_SALES,
    ),
)
def flagship_margin_by_brand(spark, sf):
    """Monthly gross margin per product brand: sales lines, star lookup, calendar and one aggregate."""
    facts = fact_sales(spark, sf).filter("product_key is not null and order_date_key is not null")
    d = dims(spark, sf)
    per_product = facts.groupBy("order_date_key", "product_key").agg(
        F.sum("gross_margin").alias("gross_margin"),
        F.sum("sales_amount").alias("sales_amount"),
        F.count(F.lit(1)).alias("lines"),
    )
    months = d["dim_date"].select(F.col("date_key").alias("order_date_key"), "year_month")
    return (
        per_product.join(d["dim_product"].select("product_key", "brand"), "product_key")
        .join(months, "order_date_key")
        .groupBy("year_month", "brand")
        .agg(
            F.sum("gross_margin").alias("gross_margin"),
            F.sum("sales_amount").alias("sales_amount"),
            F.sum("lines").alias("lines"),
        )
    )

