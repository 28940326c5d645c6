"""Reports on the star tables (R1-R14). Facts are summed by their keys before dimensions are joined."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewright.functions.scalars import month_of_key
from tidewright.operators.pairs import frequent_pairs
from tidewright.session import written


def _sum(name: str, alias: str | None = None) -> Column:
    return F.sum(name).alias(alias or name)


def sales_by(sales: DataFrame, dimension: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Sales, margin and quantity by labels of one dimension.

    The fact shrinks to one row per key before the dimension is met: a hot key costs one row per task.
    """
    per_key = sales.groupBy(key).agg(
        _sum("sales_amount"), _sum("gross_margin"), _sum("order_quantity"), F.count(F.lit(1)).alias("lines")
    )
    named = per_key.join(dimension.select(key, *labels), key, "left")
    return named.groupBy(*labels).agg(
        _sum("sales_amount"), _sum("gross_margin"), _sum("order_quantity"), _sum("lines")
    )


def sales_by_period(sales: DataFrame) -> DataFrame:
    """Sales by year and month with subtotals per year and in total."""
    by_day = sales.groupBy("order_date_key").agg(_sum("sales_amount"), _sum("gross_margin"))
    month = month_of_key(F.col("order_date_key"))
    return (
        by_day.withColumn("year_month", month)
        .withColumn("year", F.left("year_month", F.lit(4)).cast("int"))
        .rollup("year", "year_month")
        .agg(_sum("sales_amount"), _sum("gross_margin"), F.grouping_id().cast("int").alias("level"))
    )


def pipeline_by_stage(opportunities: DataFrame) -> DataFrame:
    """Open value and count by stage and close month (R2)."""
    return opportunities.groupBy(
        "opportunity_stage", month_of_key(F.col("close_date_key")).alias("close_month")
    ).agg(_sum("estimated_value"), F.count(F.lit(1)).alias("opportunities"))


def pipeline_forecast(opportunities: DataFrame, won: str, lost: str, stage_rates: Mapping[str, float] | None = None) -> DataFrame:
    """Expected value of open opportunities by close month and stage (R2), and its running total over the months.

    An opportunity counts with the rate of its stage; a stage without one counts with the win rate of what is closed: won value over
    won and lost value. Opportunities are summed per month and stage before anything else; what is joined and windowed are those sums.
    """
    sums = pipeline_by_stage(opportunities)
    stage, value = F.col("opportunity_stage"), F.col("estimated_value").cast("double")
    closed = F.sum(F.when(stage.isin(won, lost), value))
    rate = sums.agg((F.sum(F.when(stage == won, value)) / closed).alias("win_rate"))
    given = F.lit(None).cast("double")
    for name, share in (stage_rates or {}).items():
        given = F.when(stage == name, F.lit(float(share))).otherwise(given)
    open_ones = sums.filter(~F.coalesce(stage.isin(won, lost), F.lit(False)))
    weighed = open_ones.crossJoin(F.broadcast(rate)).withColumn("rate", F.coalesce(given, "win_rate"))  # one row by construction
    expected = (F.col("rate") * F.col("estimated_value").cast("double")).alias("expected_value")
    months = weighed.select("close_month", "opportunity_stage", "opportunities", "estimated_value", "rate", expected)
    order = F.coalesce("close_month", F.lit("9999"))  # without a date: last
    upto = Window.orderBy(order, F.coalesce("opportunity_stage", F.lit(""))).rowsBetween(Window.unboundedPreceding, 0)  # a row per month and stage
    return months.withColumn("running_expected", F.sum("expected_value").over(upto))


def stock_status(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Latest balance per product and location against the product's stock levels."""
    latest = inventory.groupBy("product_key", "location_key").agg(
        F.max(F.struct("date_key", "unit_balance")).alias("last")
    )
    per_product = latest.groupBy("product_key").agg(
        F.sum("last.unit_balance").alias("on_hand"),
        F.max("last.date_key").alias("as_of_key"),
        F.count(F.lit(1)).alias("locations"),
    )
    levels = products.select("product_key", "safety_stock_level", "reorder_point")
    return per_product.join(levels, "product_key", "left").select(
        "product_key",
        "on_hand",
        "as_of_key",
        "locations",
        (F.col("on_hand") < F.col("safety_stock_level")).alias("below_safety"),
        (F.col("on_hand") < F.col("reorder_point")).alias("below_reorder"),
    )


def income_statement(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Debit, credit and net by account type and month."""
    per_account = transactions.groupBy("account_key", month_of_key(F.col("transaction_date_key")).alias("year_month")).agg(
        _sum("debit_amount"), _sum("credit_amount")
    )
    typed = per_account.join(accounts.select("account_key", "account_type"), "account_key", "left")
    return (
        typed.groupBy("account_type", "year_month")
        .agg(_sum("debit_amount"), _sum("credit_amount"))
        .withColumn("net_amount", F.col("debit_amount") - F.col("credit_amount"))
    )


def _monthly(transactions: DataFrame, keys: Sequence[str]) -> DataFrame:
    return transactions.groupBy(*keys, month_of_key(F.col("transaction_date_key")).alias("year_month")).agg(
        _sum("debit_amount"), _sum("credit_amount")
    )


def balance_sheet(transactions: DataFrame) -> DataFrame:
    """Balance per account at the end of each month (R5): the window runs over months, not lines."""
    upto = Window.partitionBy("account_key").orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    monthly = _monthly(transactions, ["account_key"])
    net = F.col("debit_amount") - F.col("credit_amount")
    return monthly.select("account_key", "year_month", net.alias("movement"), F.sum(net).over(upto).alias("balance"))


def cash_flow(transactions: DataFrame) -> DataFrame:
    """Net flow per month and running total (R6): one window, over one row per month."""
    monthly = _monthly(transactions, [])
    net = F.col("debit_amount") - F.col("credit_amount")
    upto = Window.orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select("year_month", net.alias("net_flow"), F.sum(net).over(upto).alias("running_flow"))


def budget_vs_actual(budget: DataFrame, transactions: DataFrame) -> DataFrame:
    """Monthly budget and actual per account and department; either side may be missing."""
    planned = budget.groupBy(
        "account_key", "department_key", month_of_key(F.col("budget_date_key")).alias("year_month")
    ).agg(_sum("budget"))
    actual = transactions.groupBy(
        "account_key", "department_key", month_of_key(F.col("transaction_date_key")).alias("year_month")
    ).agg(_sum("amount", "actual"))
    zero = F.lit(0)
    joined = planned.join(actual, ["account_key", "department_key", "year_month"], "full_outer")
    return joined.select(
        "account_key",
        "department_key",
        "year_month",
        F.coalesce("budget", zero).alias("budget"),
        F.coalesce("actual", zero).alias("actual"),
        (F.coalesce("actual", zero) - F.coalesce("budget", zero)).alias("variance"),
    )


def month_over_month(sales: DataFrame) -> DataFrame:
    """Monthly sales with the month before and the change."""
    monthly = sales.groupBy(month_of_key(F.col("order_date_key")).alias("year_month")).agg(_sum("sales_amount"))
    before = F.lag("sales_amount").over(Window.orderBy("year_month"))  # one row per month
    return monthly.select(
        "year_month",
        "sales_amount",
        before.alias("previous_amount"),
        (F.col("sales_amount") - before).alias("change_amount"),
    )


def customer_value(sales: DataFrame) -> DataFrame:
    """Revenue, margin, orders and last order day per customer."""
    per_order = sales.groupBy("customer_key", "sales_order_key").agg(
        _sum("sales_amount"), _sum("gross_margin"), F.max("order_date_key").alias("day_key")
    )
    return per_order.groupBy("customer_key").agg(
        _sum("sales_amount"),
        _sum("gross_margin"),
        F.count(F.lit(1)).alias("orders"),
        F.max("day_key").alias("last_order_key"),
    )


def _band_cuts(values: DataFrame, column: str, bands: int) -> DataFrame:
    """One row: for each band but the last, the largest value whose share of rows at or below it stays within the band.

    Exact, yet without a task that holds all values: distinct values are counted and cut into ranges; the rows before a range
    place each of its values. Range sums are one row per range.
    """
    counted = values.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranged = written(counted.repartitionByRange("value").withColumn("range", F.spark_partition_id()), f"ranges-{column}")
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range").agg(F.sum("n").alias("rows"))
    before = sums.select("range", F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    total = values.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(column).isNull()).alias("missing"))
    placed = ranged.join(F.broadcast(before), "range").crossJoin(F.broadcast(total))  # one row by construction
    upto = F.col("missing") + F.col("before") + F.sum("n").over(inside)
    band = F.greatest(F.ceil(upto * bands / F.col("total")), F.lit(1))
    cuts = [F.max(F.when(F.col("band") <= b, F.col("value"))) for b in range(1, bands)]
    return placed.select("value", band.alias("band")).agg(F.array(*cuts).alias(f"_{column}_cuts"))


def _band(column: str) -> Column:
    value = F.col(column)
    above = F.filter(F.col(f"_{column}_cuts"), lambda cut: cut.isNull() | (cut < value))
    return F.when(value.isNotNull(), (F.size(above) + 1).cast("int"))


def customer_segments(sales: DataFrame, as_of: dt.date, bands: int = 5) -> DataFrame:
    """Recency, frequency and monetary bands per customer (R9); 1 is the weakest band.

    Equal values share a band, unlike ``ntile``, which would also need every row in one sorted task. A customer's band is the
    number of cut values below its own: ``bands - 1`` values per measure are broadcast, and no customers are joined.
    """
    day = F.to_date(F.col("last_order_key").cast("string"), "yyyyMMdd")
    base = (
        customer_value(sales)
        .filter(F.col("customer_key").isNotNull())
        .select(
            "customer_key",
            F.datediff(F.lit(as_of), day).alias("recency_days"),
            F.col("orders").alias("frequency"),
            F.col("sales_amount").alias("monetary"),
        )
    )
    # one row per customer, read by each measure and once more: written once instead of summed up each time
    scored = written(base.withColumn("recency_rank", -F.col("recency_days")), "customer-value")
    for column, name in (("recency_rank", "r"), ("frequency", "f"), ("monetary", "m")):
        cuts = F.broadcast(_band_cuts(scored, column, bands))  # one row by construction
        scored = scored.crossJoin(cuts).withColumn(f"{name}_band", _band(column)).drop(f"_{column}_cuts")
    return scored.drop("recency_rank")


def survey_ratings(surveys: DataFrame, keys: Sequence[str] = ("product_key", "purchase_channel")) -> DataFrame:
    """Average of the four ratings."""
    ratings = ["overall_rating", "quality_rating", "price_rating", "service_rating"]
    return surveys.groupBy(*keys).agg(
        *[F.avg(r).alias(f"avg_{r}") for r in ratings], F.count(F.lit(1)).alias("answers")
    )


def product_affinity(sales: DataFrame, products: DataFrame, label: str) -> DataFrame:
    """How many orders hold both of two product groups.

    The pairs are made of ``label`` values (category, brand), a short list, not of order lines: each
    order is first reduced to its distinct labels, so an order with a million lines yields no more
    pairs than there are label pairs.
    """
    labelled = sales.select("sales_order_key", "product_key").join(products.select("product_key", label), "product_key")
    baskets = labelled.select("sales_order_key", F.col(label).alias("item")).distinct()
    baskets = baskets.groupBy("sales_order_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    # identical baskets are counted once and carry their number of orders
    counted = baskets.filter(F.size("items") > 1).groupBy("items").agg(F.count(F.lit(1)).alias("orders"))
    left = counted.select("orders", "items", F.posexplode("items").alias("place", "left_item"))
    pairs = left.select("orders", "left_item", F.explode(F.slice("items", F.col("place") + 2, F.size("items"))).alias("right_item"))
    return pairs.groupBy("left_item", "right_item").agg(_sum("orders"))


def product_pairs(sales: DataFrame, min_support: int) -> DataFrame:
    """Products bought together (R11), exactly, for pairs in at least ``min_support`` orders.

    ``lift`` compares the orders with both to what the shares of either alone would give.
    """
    baskets = sales.filter("product_key IS NOT NULL").select(F.count_distinct("sales_order_key").alias("all_orders"))
    pairs = frequent_pairs(sales, "sales_order_key", "product_key", min_support)
    lift = F.col("orders").cast("double") * F.col("all_orders") / (F.col("left_orders").cast("double") * F.col("right_orders"))
    return pairs.crossJoin(F.broadcast(baskets)).withColumn("lift", lift).drop("all_orders")  # one row by construction


class HierarchyCycle(ValueError):
    """A member of a hierarchy that is its own ancestor."""


class TwoParents(ValueError):
    """A member of a hierarchy that is listed with different parents."""


def account_rollup(accounts: DataFrame, totals: DataFrame, key: str = "account_key", parent: str = "parent_id", count: str = "accounts") -> DataFrame:
    """Totals added up along the hierarchy (R13): every member's amount counts for itself and each of its ancestors.

    ``totals`` has (key, amount). With other column names the same serves the class hierarchy. Ids that occur as parents only are members too.

    Pointer doubling, one row per member: in round k a member points to its ancestor 2**k levels up and holds the total of its
    descendants less than 2**k levels down. Adding it to that ancestor's and following the pointer twice doubles both. A chain of
    10,000 members takes 14 rounds; no table of members and ancestors is made. Pointers that are left after as many rounds as the
    number of members allows run in a circle.
    """
    edges = accounts.filter(F.col(key).isNotNull()).select(F.col(key).alias("member"), F.col(parent).alias("above"))
    named = edges.unionByName(edges.filter("above IS NOT NULL").select(F.col("above").alias("member"), F.lit(None).cast(edges.schema["above"].dataType).alias("above")))
    own = totals.groupBy(F.col(key).alias("member")).agg(_sum("amount"), F.count(F.lit(1)).alias("_rows"))
    members = named.groupBy("member").agg(F.max("above").alias("above"), F.count_distinct("above").alias("parents"))
    total_type = own.agg(_sum("amount")).schema["amount"].dataType
    state = members.join(own, "member", "left").select(
        "member", "above", "parents", F.col("amount").cast(total_type).alias("total"), F.when(F.col("_rows").isNotNull(), 1).otherwise(0).cast("long").alias("held")
    )
    seen = Observation()
    live = F.count_if(F.col("above").isNotNull()).alias("live")
    state = written(state.observe(seen, live, F.count(F.lit(1)).alias("members"), F.count_if(F.col("parents") > 1).alias("torn")).drop("parents"), "members")
    found = seen.get
    if found["torn"]:
        raise TwoParents(f"{found['torn']} of {key} have several values of {parent}")
    rounds = max(1, found["members"]).bit_length()
    while found["live"]:
        if not rounds:
            raise HierarchyCycle(f"a {key} is its own ancestor")
        rounds, seen = rounds - 1, Observation()
        pushed = state.filter("above IS NOT NULL").groupBy(F.col("above").alias("member")).agg(F.sum("total").alias("more"), F.sum("held").alias("more_held"))
        onward = state.filter("above IS NOT NULL").select(F.col("member").alias("step"), F.col("above").alias("next"))
        added = state.join(pushed, "member", "left").join(onward, F.col("above") == F.col("step"), "left")
        total = F.coalesce(F.col("total") + F.col("more"), "total", "more").cast(total_type).alias("total")
        state = written(added.select("member", F.col("next").alias("above"), total, (F.col("held") + F.coalesce("more_held", F.lit(0))).alias("held")).observe(seen, live), "members")
        found = seen.get
    return state.filter("held > 0").select(F.col("member").alias(key), F.col("total").alias("rolled_amount"), F.col("held").alias(count))


def monthly_metrics(sales: DataFrame) -> DataFrame:
    """Pre-aggregated month by product and territory."""
    return sales.groupBy(
        month_of_key(F.col("order_date_key")).alias("year_month"), "product_key", "sales_territory_key"
    ).agg(_sum("sales_amount"), _sum("gross_margin"), _sum("order_quantity"), F.count(F.lit(1)).alias("lines"))


METRIC_KEYS = ["year_month", "product_key", "sales_territory_key"]
MEASURES = ["sales_amount", "gross_margin", "order_quantity"]


def metric_state(sales: DataFrame, sign: int = 1) -> DataFrame:
    """Monthly metrics that can be taken back (R14): per measure also how many of its values are not NULL. ``sign=-1`` takes rows out."""
    sums = [x for m in MEASURES for x in (F.coalesce(F.sum(m) * sign, F.lit(0)).alias(m), (F.count(m) * sign).alias(f"{m}_values"))]
    month = month_of_key(F.col("order_date_key")).alias("year_month")
    return sales.groupBy(month, *METRIC_KEYS[1:]).agg(*sums, (F.count(F.lit(1)) * sign).alias("lines"))


def metrics_of(state: DataFrame) -> DataFrame:
    """What ``monthly_metrics`` would give: groups without rows are gone, a measure without values is NULL."""
    measures = [F.when(F.col(f"{m}_values") > 0, F.col(m)).alias(m) for m in MEASURES]
    return state.filter("lines > 0").select(*METRIC_KEYS, *measures, "lines")


def retracted_metrics(state: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """The state after facts changed (R14): ``old`` versions count as minus rows, ``new`` ones as plus rows, no other fact is read.

    A line that moves to another month leaves the one it was in; lines without a date key have a month of their own, NULL; a group whose
    last line goes is empty and drops out. Deleted lines are in ``old`` only, inserted ones in ``new`` only.
    """
    change = metric_state(new).unionByName(metric_state(old, sign=-1))
    summed = [F.sum(c).cast(state.schema[c].dataType).alias(c) for c in state.columns if c not in METRIC_KEYS]
    return state.unionByName(change).groupBy(*METRIC_KEYS).agg(*summed).filter("lines > 0")


def refreshed_metrics(metrics: DataFrame, sales: DataFrame, changed: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Metrics with only the months touched by ``changed`` sales computed anew.

    ``before`` holds the changed lines as they were: the months that they leave are touched too. Without it, lines must not have moved.
    The months are few and reach the driver, so that the scan of the sales is cut to them: by partition where they are
    stored by month, else by ranges of the date key that are pushed down. Lines without a date key are a month of their own, which lies in
    any partition.
    """
    moved = changed.select("order_date_key") if before is None else changed.select("order_date_key").union(before.select("order_date_key"))
    touched = {r[0] for r in moved.select(month_of_key(F.col("order_date_key")).alias("year_month")).distinct().collect()}
    months = sorted(touched - {None})
    fresh = []
    if months and "month_part" in sales.columns:
        fresh.append(sales.filter(F.col("month_part").isin(months) & F.col("order_date_key").isNotNull()))
    elif months:
        firsts = [int(m.replace("-", "")) * 100 for m in months]
        fresh.append(sales.filter(reduce(or_, [F.col("order_date_key").between(f, f + 99) for f in firsts])))
    if None in touched:
        fresh.append(sales.filter(F.col("order_date_key").isNull()))
    if not fresh:
        return metrics
    gone = F.col("year_month").isin(months)
    keep = metrics.filter(F.coalesce(~gone, F.lit(None not in touched)))
    return keep.unionByName(monthly_metrics(reduce(DataFrame.unionByName, fresh)))
