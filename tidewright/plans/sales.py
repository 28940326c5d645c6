"""Sales lines (T9): order header, order line and product cost joined and measured."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.scalars import later_of, money, or_no_member, round_second

CLOSED_STATUS = 5  # fixed value: only shipped orders count as sales


def _headers(header: DataFrame) -> DataFrame:
    return header.filter(F.col("Status") == CLOSED_STATUS).select(
        "SalesOrderID",
        "CustomerID",
        "SalesPersonID",
        "TerritoryID",
        "SalesOrderNumber",
        "OrderDate",
        F.col("ModifiedDate").alias("header_modified"),
    )


def _lines(detail: DataFrame) -> DataFrame:
    return detail.select(
        F.col("SalesOrderID").alias("line_order"),
        "SalesOrderDetailID",
        "ProductID",
        "OrderQty",
        "UnitPrice",
        "UnitPriceDiscount",
        "LineTotal",
        F.col("ModifiedDate").alias("line_modified"),
    )


def _measured(joined: DataFrame, order_date: Column, modified: Column, full: bool) -> DataFrame:
    quantity = F.col("OrderQty") if full else F.col("OrderQty").try_cast("int")

    def amount(name: str) -> Column:
        return F.col(name) if full else F.col(name).try_cast("decimal(19,4)")

    def integer(name: str) -> Column:
        return F.col(name) if full else F.col(name).try_cast("int")

    unit_cost = F.coalesce(amount("StandardCost"), F.lit(0).cast("decimal(19,4)"))
    cost_per_unit = money(unit_cost) if full else unit_cost
    total_cost = quantity * cost_per_unit
    return joined.select(
        F.col("SalesOrderID").alias("sales_order_id"),
        integer("CustomerID").alias("customer_id"),
        integer("ProductID").alias("product_id"),
        or_no_member(integer("SalesPersonID")).alias("employee_id"),
        or_no_member(integer("TerritoryID")).alias("sales_territory_id"),
        F.col("SalesOrderNumber").alias("sales_order_number"),
        F.col("SalesOrderDetailID").alias("sales_order_detail_id"),
        order_date.cast("timestamp").alias("order_date"),
        quantity.alias("order_quantity"),
        money(amount("UnitPrice")).alias("unit_price"),
        money(unit_cost).alias("unit_cost"),
        money(amount("UnitPriceDiscount")).alias("discount_percentage"),
        money(amount("LineTotal")).alias("sales_amount"),
        money(total_cost).alias("total_product_cost"),
        money(amount("LineTotal") - total_cost).alias("gross_margin"),
        money(quantity * amount("UnitPrice") * amount("UnitPriceDiscount")).alias("discount_amount"),
        modified.alias("modified_date"),
    )


def _costs(product: DataFrame) -> DataFrame:
    return product.select(F.col("ProductID").alias("cost_product"), "StandardCost")


def sales_full(header: DataFrame, detail: DataFrame, product: DataFrame) -> DataFrame:
    """All closed orders with their lines; an order without lines stays as one row of NULL measures."""
    joined = (
        _headers(header)
        .join(_lines(detail), F.col("SalesOrderID") == F.col("line_order"), "left")
        .join(_costs(product), F.col("ProductID") == F.col("cost_product"), "left")
    )
    # rounding keeps the order of times, so the later one can be picked first and rounded once
    modified = round_second(later_of(F.col("header_modified"), F.col("line_modified")))
    return _measured(joined, round_second(F.col("OrderDate")), modified, full=True)


def sales_changed(header: DataFrame, detail: DataFrame, product: DataFrame, mark: dt.datetime) -> DataFrame:
    """Lines of closed orders where the header or the line is newer than the mark (P5).

    An OR over both sides of a join can reach neither scan. It is split into two disjoint joins, each
    with one side cut down by a filter that is pushed to its scan: changed headers with all their lines,
    and the other headers (NULL times included) with changed lines only.
    """
    headers = _headers(header).withColumn("order_key", F.col("SalesOrderID").try_cast("bigint"))
    headers = headers.filter(F.col("order_key").isNotNull())
    lines = _lines(detail).withColumn("line_key", F.col("line_order").try_cast("bigint"))
    lines = lines.filter(F.col("SalesOrderDetailID").try_cast("bigint").isNotNull())
    header_new, line_new = F.col("header_modified") > F.lit(mark), F.col("line_modified") > F.lit(mark)
    same_order = F.col("order_key") == F.col("line_key")
    by_header = headers.filter(header_new).join(lines, same_order)
    by_line = headers.filter(~F.coalesce(header_new, F.lit(False))).join(lines.filter(line_new), same_order)
    joined = by_header.unionByName(by_line).join(
        _costs(product), F.col("ProductID").try_cast("int") == F.col("cost_product").try_cast("int"), "left"
    )
    modified = round_second(later_of(F.col("header_modified"), F.col("line_modified")))
    return _measured(joined, F.to_date("OrderDate"), modified, full=False)


# order id and line id are written once; every other column follows a newer line
SALES_UPDATE = [
    "customer_id",
    "product_id",
    "employee_id",
    "sales_territory_id",
    "sales_order_number",
    "order_date",
    "order_quantity",
    "unit_price",
    "unit_cost",
    "discount_percentage",
    "sales_amount",
    "total_product_cost",
    "gross_margin",
    "discount_amount",
    "modified_date",
]
