"""Reports and quality checks on the star tables (R, D)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewright.catalog import entities as en
from tidewright.catalog import stars as st
from tidewright.catalog.registry import query, table
from tidewright.catalog.standins import LOAD_TS, MARK, Tables, sql
from tidewright.operators import quality
from tidewright.operators import watermark as wm
from tidewright.plans import reports
from tidewright.session import written

_MONTH = "printf('%04d-%02d', {0} // 10000, {0} % 10000 // 100)"
_SALES = {"s": en.FULL_SALES, "f": st.FACT_SALES.format("s")}
_GL = {"g": en.GL, "f": st.FACT_GL}


def _sales_sql(body: str, **extra: str) -> str:
    return sql(body, *st.SALES_TABLES, **_SALES, **extra)


def _gl_sql(body: str, *more: str, **extra: str) -> str:
    return sql(body, *st.GL_TABLES, *more, **_GL, **extra)


@query(
    "r1_sales_by_territory",
    _sales_sql(
        """SELECT sales_territory_group, sales_territory_country, CAST(sum(sales_amount) AS DOUBLE) AS sales_amount,
            CAST(sum(gross_margin) AS DOUBLE) AS gross_margin, CAST(sum(order_quantity) AS BIGINT) AS order_quantity, count(*) AS lines
           FROM f LEFT JOIN x_dim_sales_territory USING (sales_territory_key) GROUP BY 1, 2"""
    ),
)
def r1_sales_by_territory(spark, sf):
    territories = Tables(spark, sf).dim_sales_territory()
    labels = ["sales_territory_group", "sales_territory_country"]
    return reports.sales_by(st.fact_sales(spark, sf), territories, "sales_territory_key", labels)


@query(
    "r1_sales_by_product",
    _sales_sql(
        """SELECT brand, category, CAST(sum(sales_amount) AS DOUBLE) AS sales_amount,
            CAST(sum(gross_margin) AS DOUBLE) AS gross_margin, CAST(sum(order_quantity) AS BIGINT) AS order_quantity, count(*) AS lines
           FROM f LEFT JOIN x_dim_product USING (product_key) GROUP BY 1, 2"""
    ),
)
def r1_sales_by_product(spark, sf):
    products = Tables(spark, sf).dim_product()
    return reports.sales_by(st.fact_sales(spark, sf), products, "product_key", ["brand", "category"])


@query(
    "r1_sales_by_period",
    _sales_sql(
        f"""SELECT year, year_month, CAST(sum(sales_amount) AS DOUBLE) AS sales_amount, CAST(sum(gross_margin) AS DOUBLE) AS gross_margin,
            CAST(grouping(year) * 2 + grouping(year_month) AS INTEGER) AS level
           FROM (SELECT *, order_date_key // 10000 AS year, {_MONTH.format('order_date_key')} AS year_month FROM f)
           GROUP BY ROLLUP (year, year_month)"""
    ),
)
def r1_sales_by_period(spark, sf):
    return reports.sales_by_period(st.fact_sales(spark, sf))


_OPPORTUNITY = {
    "crm": en.CRM,
    "o": en.OPPORTUNITY,
    "event_date": st._EVENT_DATE,
}


@query(
    "r2_pipeline_by_stage",
    sql(
        f"""SELECT opportunity_stage, CASE WHEN date_key IS NOT NULL THEN {_MONTH.format('date_key')} END AS close_month,
            CAST(sum(estimated_value) AS DOUBLE) AS estimated_value, count(*) AS opportunities
           FROM o LEFT JOIN event_date d ON d.date = CAST(o.close_date AS DATE) GROUP BY 1, 2""",
        "opportunity",
        "customer",
        "leads",
        **_OPPORTUNITY,
    ),
)
def r2_pipeline_by_stage(spark, sf):
    return reports.pipeline_by_stage(st.fact_opportunity(spark, sf))


@query(
    "r2_pipeline_forecast",
    sql(
        f"""SELECT close_month, opportunity_stage, opportunities, CAST(estimated_value AS DOUBLE) AS estimated_value, rate,
            rate * CAST(estimated_value AS DOUBLE) AS expected_value,
            sum(rate * CAST(estimated_value AS DOUBLE)) OVER (ORDER BY coalesce(close_month, '9999'), opportunity_stage ROWS UNBOUNDED PRECEDING) AS running_expected
           FROM (SELECT *, CASE opportunity_stage WHEN 'click' THEN 0.25::DOUBLE ELSE win_rate END AS rate
                 FROM (SELECT CASE WHEN date_key IS NOT NULL THEN {_MONTH.format('date_key')} END AS close_month, opportunity_stage,
                         sum(estimated_value) AS estimated_value, count(*) AS opportunities
                       FROM o LEFT JOIN event_date d ON d.date = CAST(o.close_date AS DATE) GROUP BY 1, 2),
                      (SELECT CAST(sum(estimated_value) FILTER (opportunity_stage = 'purchase') AS DOUBLE) / CAST(sum(estimated_value) AS DOUBLE) AS win_rate
                       FROM o WHERE opportunity_stage IN ('purchase', 'error'))
                 WHERE opportunity_stage NOT IN ('purchase', 'error'))""",
        "opportunity",
        "customer",
        "leads",
        **_OPPORTUNITY,
    ),
)
def r2_pipeline_forecast(spark, sf):
    return reports.pipeline_forecast(st.fact_opportunity(spark, sf), "purchase", "error", {"click": 0.25})


@query(
    "r3_stock_status",
    sql(
        """SELECT product_id AS product_key, CAST(sum(unit_balance) AS BIGINT) AS on_hand, max(date_key) AS as_of_key,
            count(*) AS locations, sum(unit_balance) < max(safety_stock_level) AS below_safety,
            sum(unit_balance) < max(reorder_point) AS below_reorder
           FROM (SELECT *, row_number() OVER (PARTITION BY product_id, location_key ORDER BY date_key DESC, unit_balance DESC) AS rn
             FROM ledger LEFT JOIN x_dim_location ON location_key = location_id JOIN x_dim_date ON date = transaction_date) l
           JOIN x_dim_product p ON p.product_key = l.product_id WHERE rn = 1 GROUP BY 1""",
        "stock",
        "movements",
        "dim_date",
        "dim_location",
        "dim_product",
        **en.FULL_LEDGER,
    ),
)
def r3_stock_status(spark, sf):
    return reports.stock_status(st.fact_inventory(spark, sf), Tables(spark, sf).dim_product())


@query(
    "r4_income_statement",
    _gl_sql(
        f"""SELECT account_type, {_MONTH.format('transaction_date_key')} AS year_month, CAST(sum(debit_amount) AS DOUBLE) AS debit_amount,
            CAST(sum(credit_amount) AS DOUBLE) AS credit_amount, CAST(sum(debit_amount) - sum(credit_amount) AS DOUBLE) AS net_amount
           FROM f LEFT JOIN x_dim_account USING (account_key) GROUP BY 1, 2"""
    ),
)
def r4_income_statement(spark, sf):
    return reports.income_statement(st.fact_transaction(spark, sf), Tables(spark, sf).dim_account())


@query(
    "r5_balance_sheet",
    _gl_sql(
        f"""SELECT account_key, year_month, CAST(movement AS DOUBLE) AS movement, CAST(sum(movement) OVER
            (PARTITION BY account_key ORDER BY year_month) AS DOUBLE) AS balance
           FROM (SELECT account_key, {_MONTH.format('transaction_date_key')} AS year_month,
             sum(debit_amount) - sum(credit_amount) AS movement FROM f GROUP BY 1, 2)"""
    ),
)
def r5_balance_sheet(spark, sf):
    return reports.balance_sheet(st.fact_transaction(spark, sf))


@query(
    "r6_cash_flow",
    _gl_sql(
        f"""SELECT year_month, CAST(net_flow AS DOUBLE) AS net_flow, CAST(sum(net_flow) OVER (ORDER BY year_month) AS DOUBLE) AS running_flow
           FROM (SELECT {_MONTH.format('transaction_date_key')} AS year_month,
             sum(debit_amount) - sum(credit_amount) AS net_flow FROM f GROUP BY 1)"""
    ),
)
def r6_cash_flow(spark, sf):
    return reports.cash_flow(st.fact_transaction(spark, sf))


@query(
    "r7_budget_vs_actual",
    _gl_sql(
        f"""SELECT coalesce(p.account_key, a.account_key) AS account_key, coalesce(p.department_key, a.department_key) AS department_key,
            coalesce(p.year_month, a.year_month) AS year_month, CAST(coalesce(budget, 0) AS DOUBLE) AS budget,
            CAST(coalesce(actual, 0) AS DOUBLE) AS actual, CAST(coalesce(actual, 0) - coalesce(budget, 0) AS DOUBLE) AS variance
           FROM (SELECT account_key, department_key, {_MONTH.format('budget_date_key')} AS year_month, sum(budget) AS budget FROM fb GROUP BY 1, 2, 3) p
           FULL JOIN (SELECT account_key, department_key, {_MONTH.format('transaction_date_key')} AS year_month, sum(amount) AS actual FROM f GROUP BY 1, 2, 3) a
             ON p.account_key = a.account_key AND p.department_key = a.department_key AND p.year_month = a.year_month""",
        "m_budget",
        b=en.BUDGET,
        fb=st.FACT_BUDGET,
    ),
)
def r7_budget_vs_actual(spark, sf):
    return reports.budget_vs_actual(st.fact_budget(spark, sf), st.fact_transaction(spark, sf))


@query(
    "r8_month_over_month",
    _sales_sql(
        f"""SELECT year_month, CAST(sales_amount AS DOUBLE) AS sales_amount,
            CAST(lag(sales_amount) OVER (ORDER BY year_month) AS DOUBLE) AS previous_amount,
            CAST(sales_amount - lag(sales_amount) OVER (ORDER BY year_month) AS DOUBLE) AS change_amount
           FROM (SELECT {_MONTH.format('order_date_key')} AS year_month, sum(sales_amount) AS sales_amount FROM f GROUP BY 1)"""
    ),
)
def r8_month_over_month(spark, sf):
    return reports.month_over_month(st.fact_sales(spark, sf))


_VALUE = """SELECT customer_key, sum(sales_amount) AS sales_amount, sum(gross_margin) AS gross_margin,
    count(DISTINCT sales_order_key) AS orders, max(order_date_key) AS last_order_key FROM f GROUP BY 1"""


@query(
    "r9_customer_segments",
    _sales_sql(
        """SELECT customer_key, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary,
            CAST(greatest(ceil(5.0 * count(*) OVER (ORDER BY -recency_days) / count(*) OVER ()), 1) AS INTEGER) AS r_band,
            CAST(greatest(ceil(5.0 * count(*) OVER (ORDER BY frequency) / count(*) OVER ()), 1) AS INTEGER) AS f_band,
            CASE WHEN monetary IS NOT NULL THEN
              CAST(greatest(ceil(5.0 * count(*) OVER (ORDER BY monetary NULLS FIRST) / count(*) OVER ()), 1) AS INTEGER) END AS m_band
           FROM (SELECT customer_key, date_diff('day', strptime(CAST(last_order_key AS VARCHAR), '%Y%m%d'), TIMESTAMP '2002-01-01') AS recency_days,
             orders AS frequency, sales_amount AS monetary FROM v WHERE customer_key IS NOT NULL)""",
        v=_VALUE,
    ),
)
def r9_customer_segments(spark, sf):
    return reports.customer_segments(st.fact_sales(spark, sf), dt.date(2002, 1, 1))


@query(
    "r10_customer_value",
    _sales_sql(
        """SELECT customer_key, CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(gross_margin AS DOUBLE) AS gross_margin,
            orders, last_order_key FROM v""",
        v=_VALUE,
    ),
)
def r10_customer_value(spark, sf):
    return reports.customer_value(st.fact_sales(spark, sf))


@query(
    "r11_cross_sell",
    _sales_sql(
        """SELECT a.category AS left_item, b.category AS right_item, count(*) AS orders
           FROM c a JOIN c b ON a.sales_order_key = b.sales_order_key AND a.category < b.category GROUP BY 1, 2""",
        c="SELECT DISTINCT sales_order_key, category FROM f JOIN x_dim_product USING (product_key)",
    ),
)
def r11_cross_sell(spark, sf):
    return reports.product_affinity(st.fact_sales(spark, sf), Tables(spark, sf).dim_product(), "category")


@query(
    "r11_product_pairs",
    _sales_sql(
        """SELECT left_item, right_item, orders, l.orders_with AS left_orders, r.orders_with AS right_orders,
            orders::DOUBLE * (SELECT count(DISTINCT sales_order_key) FROM c) / (l.orders_with::DOUBLE * r.orders_with) AS lift
           FROM (SELECT a.product_key AS left_item, b.product_key AS right_item, count(*) AS orders
                 FROM c a JOIN c b ON a.sales_order_key = b.sales_order_key AND a.product_key < b.product_key GROUP BY 1, 2 HAVING count(*) >= 2)
           JOIN held l ON l.product_key = left_item JOIN held r ON r.product_key = right_item""",
        c="SELECT DISTINCT sales_order_key, product_key FROM f WHERE sales_order_key IS NOT NULL AND product_key IS NOT NULL",
        held="SELECT product_key, count(*) AS orders_with FROM c GROUP BY 1",
    ),
)
def r11_product_pairs(spark, sf):
    """Products that at least two orders have in common."""
    return reports.product_pairs(st.fact_sales(spark, sf), min_support=2)


@query(
    "r12_survey_ratings",
    sql(
        """SELECT recommendation, purchase_channel, avg(overall_rating) AS avg_overall_rating, avg(quality_rating) AS avg_quality_rating,
            avg(price_rating) AS avg_price_rating, avg(service_rating) AS avg_service_rating, count(*) AS answers
           FROM s GROUP BY 1, 2""",
        "m_survey",
        s=en.SURVEY,
    ),
)
def r12_survey_ratings(spark, sf):
    return reports.survey_ratings(st.fact_survey(spark, sf), ["recommendation", "purchase_channel"])


_ABOVE = """SELECT {key}, {key} AS root FROM {members}
    UNION ALL SELECT up.{key}, m.{parent} FROM up JOIN {members} m ON m.{key} = up.root WHERE m.{parent} IS NOT NULL"""


@query(
    "r13_account_rollup",
    _gl_sql(
        """SELECT root AS account_key, CAST(sum(amount) AS DOUBLE) AS rolled_amount, count(*) AS accounts
           FROM up JOIN (SELECT account_key, sum(amount) AS amount FROM f GROUP BY 1) USING (account_key) GROUP BY 1""",
        up=_ABOVE.format(key="account_key", parent="parent_id", members="x_dim_account"),
    ),
)
def r13_account_rollup(spark, sf):
    facts = st.fact_transaction(spark, sf).select("account_key", "amount")
    return reports.account_rollup(Tables(spark, sf).dim_account(), facts)


@query(
    "r13_class_rollup",
    f"""WITH RECURSIVE members AS (SELECT c_custkey AS class_key, CASE WHEN c_custkey > 1 THEN c_custkey // 2 END AS parent_class_id FROM customer),
       up AS ({_ABOVE.format(key="class_key", parent="parent_class_id", members="members")})
       SELECT root AS class_key, sum(amount)::DOUBLE AS rolled_amount, count(*) AS classes
       FROM up JOIN (SELECT o_custkey AS class_key, sum(o_totalprice::DECIMAL(18,2)) AS amount FROM orders GROUP BY 1) USING (class_key) GROUP BY 1""",
)
def r13_class_rollup(spark, sf):
    """Orders added up along a hierarchy of customers that is as deep as the table is long."""
    key = F.col("c_custkey")
    members = table(spark, sf, "customer").select(
        key.alias("class_key"), F.when(key > 1, F.floor(key / 2)).alias("parent_class_id")
    )
    totals = table(spark, sf, "orders").select(F.col("o_custkey").alias("class_key"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return reports.account_rollup(members, totals, "class_key", "parent_class_id", "classes")


_METRICS = f"""SELECT {_MONTH.format('order_date_key')} AS year_month, product_key, sales_territory_key,
    CAST(sum(sales_amount) AS DOUBLE) AS sales_amount, CAST(sum(gross_margin) AS DOUBLE) AS gross_margin,
    CAST(sum(order_quantity) AS BIGINT) AS order_quantity, count(*) AS lines FROM f GROUP BY 1, 2, 3"""


@query("r14_monthly_metrics", _sales_sql(_METRICS))
def r14_monthly_metrics(spark, sf):
    return reports.monthly_metrics(st.fact_sales(spark, sf))


@query(
    "r14_refreshed_metrics",
    _sales_sql(
        f"""SELECT year_month, product_key, sales_territory_key, CASE WHEN year_month IN (SELECT DISTINCT {_MONTH.format('order_date_key')}
              FROM f WHERE modified_date > TIMESTAMP '{MARK}') THEN sales_amount ELSE -1.0 END AS sales_amount, gross_margin, order_quantity, lines FROM m""",
        m=_METRICS,
    ),
)
def r14_refreshed_metrics(spark, sf):
    """Only the months touched by sales after the mark are computed anew."""
    facts = written(st.fact_sales(spark, sf), "fact-sales")
    stored = reports.monthly_metrics(facts).withColumn("sales_amount", F.lit(-1).cast("decimal(28,2)"))
    return reports.refreshed_metrics(stored, facts, facts.filter(F.col("modified_date") > F.lit(MARK)))


# lines that change: some move on by a month, some lose their date, some are deleted, some come only now
_KIND = "(sales_order_key * 7 + product_key) % 13"
_MOVED_DAY = "CAST(strftime(strptime(CAST(order_date_key AS VARCHAR), '%Y%m%d') + INTERVAL 1 MONTH, '%Y%m%d') AS INTEGER)"
_CHANGED = f"""SELECT * REPLACE (CASE WHEN {_KIND} = 1 THEN {_MOVED_DAY} WHEN {_KIND} = 2 THEN NULL ELSE order_date_key END AS order_date_key,
    CASE WHEN {_KIND} = 3 THEN sales_amount + 1 ELSE sales_amount END AS sales_amount) FROM f WHERE {_KIND} IS DISTINCT FROM 4"""


def _changes(facts):
    """Facts as stored, and of the changed lines the versions before and after."""
    kind = (F.col("sales_order_key") * 7 + F.col("product_key")) % 13
    day = F.to_date(F.col("order_date_key").cast("string"), "yyyyMMdd")
    moved = F.date_format(F.add_months(day, 1), "yyyyMMdd").cast("int")
    after = facts.withColumns({
        "order_date_key": F.when(kind == 1, moved).when(kind == 2, F.lit(None).cast("int")).otherwise(F.col("order_date_key")),
        "sales_amount": F.when(kind == 3, F.col("sales_amount") + 1).otherwise(F.col("sales_amount")).cast(facts.schema["sales_amount"].dataType),
    })
    return facts.filter(~F.coalesce(kind == 5, F.lit(False))), facts.filter(kind.isin(1, 2, 3, 4)), after.filter(kind.isin(1, 2, 3, 5))


@query("r14_retracted_metrics", _sales_sql(_METRICS.replace("FROM f ", "FROM changed "), changed=_CHANGED))
def r14_retracted_metrics(spark, sf):
    """Changed lines taken out as they were and put in as they are: no month keeps a line that left it."""
    stored, old, new = _changes(written(st.fact_sales(spark, sf), "fact-sales"))
    return reports.metrics_of(reports.retracted_metrics(reports.metric_state(stored), old, new))


# ---- quality --------------------------------------------------------------------------------------


@query(
    "d1_rowcount_reconcile",
    sql(
        """SELECT 'sales' AS table_name, (SELECT count(*) FROM lineitem) AS left_count, (SELECT count(*) FROM s) AS right_count,
            (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM s) AS difference
           UNION ALL SELECT 'transaction', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), 0
           UNION ALL SELECT 'survey', (SELECT count(*) FROM events), (SELECT count(*) FROM events), 0
           UNION ALL SELECT 'store', (SELECT count(*) FROM supplier), NULL, (SELECT count(*) FROM supplier)""",
        "header",
        "detail",
        "cost",
        s=en.FULL_SALES,
    ),
)
def d1_rowcount_reconcile(spark, sf):
    raw = {
        "sales": table(spark, sf, "lineitem"),
        "transaction": table(spark, sf, "orders"),
        "survey": table(spark, sf, "events"),
        "store": table(spark, sf, "supplier"),
    }
    conformed = {
        "sales": en.full_sales(spark, sf),
        "transaction": en.gl_lines(spark, sf),
        "survey": en.surveys(spark, sf),
    }
    return quality.reconcile(raw, conformed)


@query(
    "d1_differing_rows",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 7 THEN 'changed' WHEN o_orderkey % 1000 = 8 THEN 'left only' ELSE 'right only' END AS difference
       FROM orders WHERE o_orderkey % 1000 IN (7, 8) UNION ALL SELECT -1 - o_orderkey, 'right only' FROM orders WHERE o_orderkey % 1000 = 9""",
)
def d1_differing_rows(spark, sf):
    """A copy with changed, missing and additional rows, held against its source range by range."""
    orders = table(spark, sf, "orders")
    kind = F.col("o_orderkey") % 1000
    copy = orders.filter(kind != 8).withColumn("o_orderstatus", F.when(kind == 7, F.lit("?")).otherwise(F.col("o_orderstatus")))
    more = orders.filter(kind == 9).withColumn("o_orderkey", (-1 - F.col("o_orderkey")).cast(orders.schema["o_orderkey"].dataType))
    return quality.differing_rows(orders, copy.unionByName(more).repartition(3), ["o_orderkey"], width=50)


@query(
    "d2_null_profile",
    _gl_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS row_count FROM f"
            for c in ("transaction_key", "account_key", "department_key", "class_key", "transaction_date_key", "amount")
        )
    ),
)
def d2_null_profile(spark, sf):
    columns = ["transaction_key", "account_key", "department_key", "class_key", "transaction_date_key", "amount"]
    return quality.null_profile(st.fact_transaction(spark, sf).select(*columns))


@query(
    "d3_key_uniqueness",
    """SELECT count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS repeated_keys, CAST(sum(n - 1) AS BIGINT) AS excess_rows
       FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
)
def d3_key_uniqueness(spark, sf):
    return quality.key_uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "d3_repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def d3_repeated_keys(spark, sf):
    return quality.repeated(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "d4_orphans",
    _sales_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS orphan_rows, count(*) AS row_count FROM f"
            for c in ("customer_key", "product_key", "employee_key", "sales_territory_key", "order_date_key")
        )
    ),
)
def d4_orphans(spark, sf):
    columns = ["customer_key", "product_key", "employee_key", "sales_territory_key", "order_date_key"]
    return quality.orphans(st.fact_sales(spark, sf), columns)


@query(
    "d4_orphan_keys",
    """SELECT o_custkey AS customer_id, count(*) AS orphan_rows FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0) GROUP BY 1""",
)
def d4_orphan_keys(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("customer_id"))
    return quality.orphan_keys(orders, "customer_id", Tables(spark, sf).dim_customer(), "customer_key")


@query(
    "d5_freshness",
    f"""SELECT table_name, 'raw' AS layer_type, newest AS max_modified_date,
        CAST(floor((epoch(TIMESTAMP '{LOAD_TS}') - epoch(newest)) / 3600) AS BIGINT) AS hours_behind
       FROM (SELECT 'orders' AS table_name, max(o_orderdate) AS newest FROM orders
             UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem)""",
)
def d5_freshness(spark, sf):
    marks = wm.marks_of(table(spark, sf, "orders"), "orders", "raw", "o_orderdate", LOAD_TS).unionByName(
        wm.marks_of(table(spark, sf, "lineitem"), "lineitem", "raw", "l_shipdate", LOAD_TS)
    )
    return quality.freshness(marks, LOAD_TS)


@query(
    "d2_text_lengths",
    """SELECT 'name' AS column_name, 10 AS max_length, count(*) FILTER (WHERE length(p_name) > 10) AS too_long FROM part
       UNION ALL SELECT 'brand', 7, count(*) FILTER (WHERE length(p_brand) > 7) FROM part""",
)
def d2_text_lengths(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return quality.too_long(parts, "name VARCHAR(10), brand VARCHAR(7)")
