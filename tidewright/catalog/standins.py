"""The benchmark tables dressed as business tables, once as DataFrames and once as SQL.

Each function returns the frame that the production operators expect; ``SQL`` holds the same table as a
select over the parquet views. Whole tables are used throughout.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.catalog.registry import table
from tidewright.operators.calendar import calendar

MARK = dt.datetime(1998, 6, 30)
EVENT_MARK = dt.datetime(2024, 1, 15, 12, 0, 0)
LOAD_TS = dt.datetime(2002, 1, 1)
FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
STOCK_DAY = dt.datetime(1999, 12, 31)


def cents(name: str, scale: int = 2, precision: int = 18) -> Column:
    return F.col(name).cast(f"decimal({precision},{scale})")


def line_number() -> Column:
    """A number per order line: order, line and the last digits of the price (lines repeat in these tables)."""
    price_cents = F.floor(F.col("l_extendedprice") * 100 + 0.5) % 1_000_000
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + price_cents


def spread_day(key: str) -> Column:
    """A day between 1995 and mid-2000, derived from an id."""
    return F.expr(f"timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast({key} % 2000 as int))")


class Tables(Mapping):
    """Stand-in tables by raw name, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def base(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def __iter__(self):
        return iter(SQL)

    def __len__(self):
        return len(SQL)

    # ---- sales ------------------------------------------------------------------------------------

    def header(self) -> DataFrame:
        priority = F.col("o_orderpriority")
        return self.base("orders").select(
            F.col("o_orderkey").alias("SalesOrderID"),
            F.col("o_custkey").alias("CustomerID"),
            F.when(priority != "5-LOW", F.col("o_custkey") % 50).alias("SalesPersonID"),
            F.when(priority != "4-NOT SPECIFIED", F.col("o_custkey") % 25).alias("TerritoryID"),
            F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")).alias("SalesOrderNumber"),
            F.col("o_orderdate").alias("OrderDate"),
            F.when(F.col("o_orderstatus") == "F", F.lit(5)).otherwise(F.lit(1)).alias("Status"),
            F.col("o_orderdate").alias("ModifiedDate"),
        )

    def detail(self) -> DataFrame:
        price, discount = cents("l_extendedprice", 4, 19), cents("l_discount", 4, 19)
        return self.base("lineitem").select(
            F.col("l_orderkey").alias("SalesOrderID"),
            line_number().alias("SalesOrderDetailID"),
            F.col("l_quantity").cast("int").alias("OrderQty"),
            F.col("l_partkey").alias("ProductID"),
            price.alias("UnitPrice"),
            discount.alias("UnitPriceDiscount"),
            (price * (F.lit(1) - discount)).cast("decimal(19,4)").alias("LineTotal"),
            F.col("l_shipdate").alias("ModifiedDate"),
        )

    def cost(self) -> DataFrame:
        return self.base("part").select(
            F.col("p_partkey").alias("ProductID"),
            (cents("p_retailprice") * F.lit("0.615").cast("decimal(4,3)")).cast("decimal(19,4)").alias("StandardCost"),
        )

    # ---- people -----------------------------------------------------------------------------------

    def customer(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return self.base("customer").select(
            F.col("c_custkey").alias("CustomerID"),
            F.when(segment.isin("BUILDING", "AUTOMOBILE"), F.col("c_custkey")).alias("PersonID"),
            F.when(segment.isin("MACHINERY", "FURNITURE", "AUTOMOBILE"), F.col("c_custkey")).alias("StoreID"),
            F.col("c_nationkey").alias("TerritoryID"),
            spread_day("c_custkey").alias("ModifiedDate"),
        )

    def leads(self) -> DataFrame:
        lead = F.concat(F.lit("L"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
        return self.base("customer").filter("c_acctbal > 5000").select(lead.alias("lead_id"))

    def person(self) -> DataFrame:
        return self.base("customer").select(
            F.col("c_custkey").alias("BusinessEntityID"),
            F.left("c_name", F.lit(8)).alias("FirstName"),
            F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("LastName"),
            F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int")).alias("BirthDate"),
            F.when(F.col("c_acctbal") > 4000, F.lit("F")).otherwise(F.lit("M")).alias("Gender"),
        )

    def store(self) -> DataFrame:
        nation = self.base("nation").select("n_nationkey", "n_name")
        return (
            self.base("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("BusinessEntityID"),
                F.concat_ws(" ", "c_mktsegment", F.lit("of"), "n_name").alias("Name"),
            )
        )

    def email_address(self) -> DataFrame:
        customers = self.base("customer")
        first = customers.select(
            F.col("c_custkey").alias("BusinessEntityID"),
            F.lit(1).alias("EmailAddressID"),
            F.concat(F.lower("c_name"), F.lit("@one.example")).alias("EmailAddress"),
        )
        second = customers.filter("c_acctbal > 9000").select(
            F.col("c_custkey").alias("BusinessEntityID"),
            F.lit(2).alias("EmailAddressID"),
            F.concat(F.lower("c_name"), F.lit("@two.example")).alias("EmailAddress"),
        )
        return first.unionByName(second)

    def person_phone(self) -> DataFrame:
        return self.base("customer").select(
            F.col("c_custkey").alias("BusinessEntityID"),
            F.concat_ws("-", "c_nationkey", "c_custkey").alias("PhoneNumber"),
            F.lit(1).alias("PhoneNumberTypeID"),
        )

    def business_entity_address(self) -> DataFrame:
        return self.base("orders").select(
            F.col("o_custkey").alias("BusinessEntityID"), F.col("o_orderkey").alias("AddressID")
        )

    def address(self) -> DataFrame:
        return self.base("orders").select(
            F.col("o_orderkey").alias("AddressID"),
            F.when(F.col("o_orderstatus") != "P", F.concat_ws(" ", F.lit("Street"), "o_orderkey")).alias("AddressLine1"),
            F.concat_ws(" ", F.lit("Dock"), "o_orderkey").alias("AddressLine2"),
        )

    # ---- products ---------------------------------------------------------------------------------

    def product(self) -> DataFrame:
        return self.base("part").select(
            F.col("p_partkey").alias("ProductID"),
            F.col("p_name").alias("Name"),
            F.concat_ws("-", "p_brand", "p_partkey").alias("ProductNumber"),
            F.when(F.col("p_size") > 25, F.lit("true")).otherwise(F.lit("false")).alias("MakeFlag"),
            F.when(F.col("p_retailprice") > 950, F.lit("1")).otherwise(F.lit("0")).alias("FinishedGoodsFlag"),
            F.lit("red").alias("Color"),
            F.col("p_size").alias("SafetyStockLevel"),
            (F.col("p_size") * 2).alias("ReorderPoint"),
            cents("p_retailprice", 4, 19).alias("StandardCost"),
            cents("p_retailprice", 4, 19).alias("ListPrice"),
            F.col("p_size").cast("string").alias("Size"),
            F.lit(None).cast("decimal(8,2)").alias("Weight"),
            F.lit(1).alias("DaysToManufacture"),
            F.left("p_type", F.lit(1)).alias("ProductLine"),
            F.right("p_type", F.lit(1)).alias("Class"),
            F.lit("U").alias("Style"),
            F.when(F.col("p_size") <= 45, F.col("p_size")).alias("ProductSubcategoryID"),
            F.substring("p_brand", 7, 9).cast("int").alias("ProductModelID"),
            spread_day("p_partkey").alias("SellStartDate"),
            F.lit(None).cast("timestamp").alias("SellEndDate"),
            spread_day("p_partkey").alias("ModifiedDate"),
        )

    def product_sub_category(self) -> DataFrame:
        return (
            self.base("part")
            .groupBy(F.col("p_size").alias("ProductSubcategoryID"))
            .agg(F.min("p_size").alias("size"))
            .select(
                "ProductSubcategoryID",
                (F.col("size") % 7).alias("ProductCategoryID"),
                F.concat_ws(" ", F.lit("Size"), "size").alias("Name"),
            )
        )

    def product_category(self) -> DataFrame:
        return self.base("region").select(F.col("r_regionkey").alias("ProductCategoryID"), F.col("r_name").alias("Name"))

    def product_model(self) -> DataFrame:
        model = F.substring("p_brand", 7, 9).cast("int")
        return self.base("part").groupBy(model.alias("ProductModelID")).agg(F.min("p_brand").alias("Name"))

    def product_model_description_culture(self) -> DataFrame:
        model = F.col("ProductModelID")
        return self.product_model().select(
            model,
            (model + 100).alias("ProductDescriptionID"),
            F.when(model % 2 == 0, F.lit("en    ")).otherwise(F.lit("fr")).alias("CultureID"),
        )

    def product_description(self) -> DataFrame:
        model = F.col("ProductModelID")
        return self.product_model().select(
            (model + 100).alias("ProductDescriptionID"),
            F.when(model <= 20, F.concat_ws(" ", F.lit("About"), "Name")).alias("Description"),
        )

    # ---- stock ------------------------------------------------------------------------------------

    def stock(self) -> DataFrame:
        """Counted stock per part and place, from the lines shipped up to the stock day."""
        return (
            self.base("lineitem")
            .filter(F.col("l_shipdate") <= F.lit(STOCK_DAY))
            .groupBy(F.col("l_partkey").alias("ProductID"), (F.col("l_suppkey") % 5).cast("int").alias("LocationID"))
            .agg(
                (F.sum(F.col("l_quantity").cast("int")) - 20).cast("int").alias("Quantity"),
                F.max("l_shipdate").alias("ModifiedDate"),
            )
        )

    def movements(self) -> DataFrame:
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        kind = (
            F.when(flag == "A", F.lit("P"))
            .when(flag == "R", F.lit("W"))
            .when(status == "O", F.lit("S"))
            .otherwise(F.lit("X"))
        )
        return self.base("lineitem").select(
            F.col("l_partkey").alias("ProductID"),
            F.col("l_shipdate").alias("TransactionDate"),
            kind.alias("TransactionType"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            cents("l_extendedprice", 4, 19).alias("ActualCost"),
            F.col("l_shipdate").alias("ModifiedDate"),
        )

    # ---- ledger, budget, crm, survey --------------------------------------------------------------

    def gl(self) -> DataFrame:
        amount = cents("o_totalprice", 4, 19)
        zero = F.lit(0).cast("decimal(19,4)")
        debit = F.col("o_orderstatus") == "F"
        return self.base("orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("transaction_code"),
            F.lit(1).alias("transaction_line_id"),
            (F.col("o_custkey") % 25).alias("account_id"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") % 7).alias("department_id"),
            F.left("o_orderpriority", F.lit(1)).cast("int").alias("class_id"),
            F.col("o_orderstatus").alias("transaction_type"),
            F.when(debit, F.lit("debit")).otherwise(F.lit("credit")).alias("entry_type"),
            F.col("o_orderpriority").alias("description"),
            F.col("o_orderdate").alias("transaction_date"),
            F.when(debit, amount).otherwise(zero).alias("debit_amount"),
            F.when(debit, zero).otherwise(amount).alias("credit_amount"),
            amount.alias("amount"),
            F.col("o_orderdate").alias("ModifiedDate"),
        )

    def m_budget(self) -> DataFrame:
        return (
            self.base("orders")
            .groupBy(
                (F.col("o_custkey") % 25).alias("account_id"),
                F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") % 7).alias("department_id"),
                F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"),
            )
            .agg(F.sum(cents("o_totalprice")).cast("decimal(18,2)").alias("budget"))
        )

    def m_survey(self) -> DataFrame:
        value = F.floor("value").cast("int")
        return self.base("events").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("survey_code"),
            F.col("user_id").alias("customer_id"),
            (F.col("event_id") % 2500).alias("product_id"),
            F.to_date("ts").alias("survey_date"),
            (value % 5 + 1).alias("overall_rating"),
            (value % 4 + 1).alias("quality_rating"),
            (value % 3 + 1).alias("price_rating"),
            F.when(value > 2, value % 2 + 1).alias("service_rating"),
            F.left("event_type", F.lit(10)).alias("recommendation"),
            F.when(F.col("value") > 10, F.lit("web")).otherwise(F.lit("store")).alias("purchase_channel"),
            F.when(F.col("value") > 5, F.lit("gold")).alias("customer_segment"),
            F.concat(F.lit("my opinion about this product is "), F.col("props")).alias("comments"),
        )

    def opportunity(self) -> DataFrame:
        return self.base("events").select(
            F.col("event_id").alias("opportunity_key"),
            F.concat(F.lit("O"), F.col("event_id").cast("string")).alias("opportunity_id"),
            F.concat(F.lit("L"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("lead_id"),
            F.col("event_type").alias("opportunity_stage"),
            cents("value").alias("estimated_value"),
            F.to_date("ts").alias("close_date"),
        )

    # ---- dimensions -------------------------------------------------------------------------------

    def dim_date(self) -> DataFrame:
        return calendar(self.spark, FIRST_DAY, LAST_DAY)

    def dim_customer(self) -> DataFrame:
        return self.base("customer").filter("c_acctbal >= 0").select(
            F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
        )

    def dim_product(self) -> DataFrame:
        return self.base("part").select(
            F.col("p_partkey").alias("product_key"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            F.col("p_size").alias("safety_stock_level"),
            (F.col("p_size") * 4).alias("reorder_point"),
        )

    def dim_employee(self) -> DataFrame:
        return self.base("supplier").select(F.col("s_suppkey").alias("employee_key"), F.col("s_name").alias("name"))

    def dim_sales_territory(self) -> DataFrame:
        region = self.base("region")
        return (
            self.base("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("sales_territory_key"),
                F.col("r_name").alias("sales_territory_group"),
                F.col("n_name").alias("sales_territory_country"),
            )
        )

    def dim_account(self) -> DataFrame:
        """Chart of accounts: nations below regions below one root."""
        region = self.base("region")
        leaves = (
            self.base("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("account_key"),
                (F.col("n_regionkey") + 100).alias("parent_id"),
                F.col("r_name").alias("account_type"),
            )
        )
        groups = region.select(
            (F.col("r_regionkey") + 100).alias("account_key"), F.lit(1000).alias("parent_id"), F.col("r_name").alias("account_type")
        )
        top = region.agg((F.max("r_regionkey") * 0 + 1000).alias("account_key")).select(
            "account_key", F.lit(None).cast("int").alias("parent_id"), F.lit("ALL").alias("account_type")
        )
        return leaves.unionByName(groups).unionByName(top)

    def dim_department(self) -> DataFrame:
        return self.base("region").select(F.col("r_regionkey").alias("department_key"), F.col("r_name").alias("name"))

    def dim_class(self) -> DataFrame:
        return (
            self.base("orders")
            .groupBy("o_orderpriority")
            .agg(F.min(F.left("o_orderpriority", F.lit(1)).cast("int")).alias("class_key"))
            .filter("class_key < 5")
            .select("class_key", F.col("o_orderpriority").alias("class_name"))
        )

    def dim_location(self) -> DataFrame:
        return self.base("region").filter("r_regionkey < 4").select(
            F.col("r_regionkey").alias("location_key"), F.col("r_name").alias("name")
        )


class Staff(Tables):
    """Suppliers dressed as employees: only the tables the employee plan reads."""

    def employee(self) -> DataFrame:
        return self.base("supplier").select(
            F.col("s_suppkey").alias("BusinessEntityID"),
            (F.col("s_suppkey") + 1000).alias("NationalIDNumber"),
            F.lit("Buyer").alias("JobTitle"),
            F.date_add(F.lit("1960-01-01").cast("date"), F.col("s_suppkey").cast("int")).alias("BirthDate"),
            F.lit("F").alias("Gender"),
            F.date_add(F.lit("1990-01-01").cast("date"), F.col("s_suppkey").cast("int")).alias("HireDate"),
            F.when(F.col("s_acctbal") > 0, F.lit(1)).otherwise(F.lit(0)).alias("CurrentFlag"),
            spread_day("s_suppkey").alias("ModifiedDate"),
        )

    def person(self) -> DataFrame:
        nation = self.base("nation").filter("n_regionkey <> 0")
        return (
            self.base("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("BusinessEntityID"),
                F.col("n_name").alias("FirstName"),
                F.when(F.col("s_acctbal") > 2000, F.col("s_name")).alias("LastName"),
            )
        )

    def email_address(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_suppkey").alias("BusinessEntityID"),
            F.col("l_orderkey").alias("EmailAddressID"),
            F.concat(F.lit("part"), F.col("l_partkey").cast("string"), F.lit("@s.example")).alias("EmailAddress"),
        )

    def person_phone(self) -> DataFrame:
        return self.base("lineitem").filter("l_returnflag = 'R'").select(
            F.col("l_suppkey").alias("BusinessEntityID"),
            F.col("l_linenumber").alias("PhoneNumberTypeID"),
            F.concat(F.lit("+"), F.col("l_orderkey").cast("string")).alias("PhoneNumber"),
        )

    def employee_department_history(self) -> DataFrame:
        balance = F.col("s_acctbal")
        open_row = self.base("supplier").select(
            F.col("s_suppkey").alias("BusinessEntityID"),
            F.when(balance <= 1000, F.lit("1999-01-01")).cast("date").alias("EndDate"),
        )
        second = self.base("supplier").filter("s_acctbal > 9000").select(
            F.col("s_suppkey").alias("BusinessEntityID"), F.lit(None).cast("date").alias("EndDate")
        )
        return open_row.unionByName(second)

    def business_entity_address(self) -> DataFrame:
        return self.base("lineitem").select(
            F.col("l_suppkey").alias("BusinessEntityID"), F.col("l_orderkey").alias("AddressID")
        )


_DAY = "TIMESTAMP '1995-01-01 00:00:00' + INTERVAL 1 DAY * CAST({} % 2000 AS INTEGER)"

# The same tables as SQL over the parquet views.
SQL: dict[str, str] = {
    "header": """SELECT o_orderkey AS SalesOrderID, o_custkey AS CustomerID,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey % 50 END AS SalesPersonID,
        CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey % 25 END AS TerritoryID,
        'SO' || o_orderkey AS SalesOrderNumber, o_orderdate AS OrderDate,
        CASE WHEN o_orderstatus = 'F' THEN 5 ELSE 1 END AS Status, o_orderdate AS ModifiedDate FROM orders""",
    "detail": """SELECT l_orderkey AS SalesOrderID,
        (l_orderkey * 8 + l_linenumber) * 1000000 + CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) % 1000000 AS SalesOrderDetailID,
        CAST(l_quantity AS INTEGER) AS OrderQty, l_partkey AS ProductID,
        CAST(l_extendedprice AS DECIMAL(19,4)) AS UnitPrice, CAST(l_discount AS DECIMAL(19,4)) AS UnitPriceDiscount,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(6,2))) AS DECIMAL(19,4)) AS LineTotal,
        l_shipdate AS ModifiedDate FROM lineitem""",
    "cost": """SELECT p_partkey AS ProductID,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.615 AS DECIMAL(4,3)) AS DECIMAL(19,4)) AS StandardCost
        FROM part""",
    "customer": f"""SELECT c_custkey AS CustomerID,
        CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN c_custkey END AS PersonID,
        CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE', 'AUTOMOBILE') THEN c_custkey END AS StoreID,
        c_nationkey AS TerritoryID, {_DAY.format('c_custkey')} AS ModifiedDate FROM customer""",
    "leads": "SELECT 'L' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS lead_id FROM customer WHERE c_acctbal > 5000",
    "person": """SELECT c_custkey AS BusinessEntityID, left(c_name, 8) AS FirstName,
        CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS LastName,
        DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS BirthDate,
        CASE WHEN c_acctbal > 4000 THEN 'F' ELSE 'M' END AS Gender FROM customer""",
    "store": """SELECT c_custkey AS BusinessEntityID, c_mktsegment || ' of ' || n_name AS Name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "email_address": """SELECT c_custkey AS BusinessEntityID, 1 AS EmailAddressID,
        lower(c_name) || '@one.example' AS EmailAddress FROM customer
        UNION ALL SELECT c_custkey, 2, lower(c_name) || '@two.example' FROM customer WHERE c_acctbal > 9000""",
    "person_phone": """SELECT c_custkey AS BusinessEntityID, c_nationkey || '-' || c_custkey AS PhoneNumber,
        1 AS PhoneNumberTypeID FROM customer""",
    "business_entity_address": "SELECT o_custkey AS BusinessEntityID, o_orderkey AS AddressID FROM orders",
    "address": """SELECT o_orderkey AS AddressID,
        CASE WHEN o_orderstatus <> 'P' THEN 'Street ' || o_orderkey END AS AddressLine1,
        'Dock ' || o_orderkey AS AddressLine2 FROM orders""",
    "product": f"""SELECT p_partkey AS ProductID, p_name AS Name, p_brand || '-' || p_partkey AS ProductNumber,
        p_size > 25 AS MakeFlag, p_retailprice > 950 AS FinishedGoodsFlag, 'red' AS Color,
        p_size AS SafetyStockLevel, p_size * 2 AS ReorderPoint,
        CAST(p_retailprice AS DECIMAL(19,4)) AS StandardCost, CAST(p_retailprice AS DECIMAL(19,4)) AS ListPrice,
        CAST(p_size AS VARCHAR) AS Size, left(p_type, 1) AS ProductLine, right(p_type, 1) AS Class, 'U' AS Style,
        CASE WHEN p_size <= 45 THEN p_size END AS ProductSubcategoryID,
        CAST(substr(p_brand, 7) AS INTEGER) AS ProductModelID, {_DAY.format('p_partkey')} AS ModifiedDate FROM part""",
    "product_sub_category": """SELECT DISTINCT p_size AS ProductSubcategoryID, p_size % 7 AS ProductCategoryID,
        'Size ' || p_size AS Name FROM part""",
    "product_category": "SELECT r_regionkey AS ProductCategoryID, r_name AS Name FROM region",
    "product_model": "SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS ProductModelID, p_brand AS Name FROM part",
    "product_model_description_culture": """SELECT ProductModelID, ProductModelID + 100 AS ProductDescriptionID,
        CASE WHEN ProductModelID % 2 = 0 THEN 'en    ' ELSE 'fr' END AS CultureID FROM x_product_model""",
    "product_description": """SELECT ProductModelID + 100 AS ProductDescriptionID,
        CASE WHEN ProductModelID <= 20 THEN 'About ' || Name END AS Description FROM x_product_model""",
    "stock": """SELECT l_partkey AS ProductID, CAST(l_suppkey % 5 AS INTEGER) AS LocationID,
        CAST(sum(CAST(l_quantity AS INTEGER)) - 20 AS INTEGER) AS Quantity, max(l_shipdate) AS ModifiedDate
        FROM lineitem WHERE l_shipdate <= TIMESTAMP '1999-12-31' GROUP BY 1, 2""",
    "movements": """SELECT l_partkey AS ProductID, l_shipdate AS TransactionDate,
        CASE WHEN l_returnflag = 'A' THEN 'P' WHEN l_returnflag = 'R' THEN 'W'
             WHEN l_linestatus = 'O' THEN 'S' ELSE 'X' END AS TransactionType,
        CAST(l_quantity AS INTEGER) AS Quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS ActualCost,
        l_shipdate AS ModifiedDate FROM lineitem""",
    "gl": """SELECT o_orderkey AS transaction_id, 'T' || o_orderkey AS transaction_code, 1 AS transaction_line_id,
        o_custkey % 25 AS account_id,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey % 7 END AS department_id,
        CAST(left(o_orderpriority, 1) AS INTEGER) AS class_id, o_orderstatus AS transaction_type,
        CASE WHEN o_orderstatus = 'F' THEN 'debit' ELSE 'credit' END AS entry_type, o_orderpriority AS description,
        o_orderdate AS transaction_date,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS debit_amount,
        CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS credit_amount,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS ModifiedDate FROM orders""",
    "m_budget": """SELECT o_custkey % 25 AS account_id,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey % 7 END AS department_id,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS budget FROM orders GROUP BY 1, 2, 3""",
    "m_survey": """SELECT event_id AS id, 'S' || event_id AS survey_code, user_id AS customer_id,
        event_id % 2500 AS product_id, CAST(ts AS DATE) AS survey_date,
        CAST(floor(value) AS INTEGER) % 5 + 1 AS overall_rating, CAST(floor(value) AS INTEGER) % 4 + 1 AS quality_rating,
        CAST(floor(value) AS INTEGER) % 3 + 1 AS price_rating,
        CASE WHEN CAST(floor(value) AS INTEGER) > 2 THEN CAST(floor(value) AS INTEGER) % 2 + 1 END AS service_rating,
        left(event_type, 10) AS recommendation, CASE WHEN value > 10 THEN 'web' ELSE 'store' END AS purchase_channel,
        CASE WHEN value > 5 THEN 'gold' END AS customer_segment,
        'my opinion about this product is ' || props AS comments FROM events""",
    "opportunity": """SELECT event_id AS opportunity_key, 'O' || event_id AS opportunity_id,
        'L' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS lead_id, event_type AS opportunity_stage,
        CAST(value AS DECIMAL(18,2)) AS estimated_value, CAST(ts AS DATE) AS close_date FROM events""",
    "dim_date": """SELECT CAST(d AS DATE) AS date, year(d) * 10000 + month(d) * 100 + day(d) AS date_key
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS g(d)""",
    "dim_customer": "SELECT c_custkey AS customer_key, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_acctbal >= 0",
    "dim_product": """SELECT p_partkey AS product_key, p_name AS name, p_brand AS brand, p_type AS category,
        p_size AS safety_stock_level, p_size * 4 AS reorder_point FROM part""",
    "dim_employee": "SELECT s_suppkey AS employee_key, s_name AS name FROM supplier",
    "dim_sales_territory": """SELECT n_nationkey AS sales_territory_key, r_name AS sales_territory_group,
        n_name AS sales_territory_country FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_account": """SELECT n_nationkey AS account_key, n_regionkey + 100 AS parent_id, r_name AS account_type
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT r_regionkey + 100, 1000, r_name FROM region UNION ALL SELECT 1000, NULL, 'ALL'""",
    "dim_department": "SELECT r_regionkey AS department_key, r_name AS name FROM region",
    "dim_class": """SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INTEGER) AS class_key, o_orderpriority AS class_name
        FROM orders WHERE left(o_orderpriority, 1) < '5'""",
    "dim_location": "SELECT r_regionkey AS location_key, r_name AS name FROM region WHERE r_regionkey < 4",
    # employees
    "staff": f"""SELECT s_suppkey AS BusinessEntityID, s_suppkey + 1000 AS NationalIDNumber, 'Buyer' AS JobTitle,
        DATE '1960-01-01' + CAST(s_suppkey AS INTEGER) AS BirthDate, 'F' AS Gender,
        DATE '1990-01-01' + CAST(s_suppkey AS INTEGER) AS HireDate,
        CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS CurrentFlag, {_DAY.format('s_suppkey')} AS ModifiedDate FROM supplier""",
    "staff_person": """SELECT s_suppkey AS BusinessEntityID, n_name AS FirstName,
        CASE WHEN s_acctbal > 2000 THEN s_name END AS LastName
        FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 0""",
    "staff_email": """SELECT l_suppkey AS BusinessEntityID, l_orderkey AS EmailAddressID,
        'part' || l_partkey || '@s.example' AS EmailAddress FROM lineitem""",
    "staff_phone": """SELECT l_suppkey AS BusinessEntityID, l_linenumber AS PhoneNumberTypeID,
        '+' || l_orderkey AS PhoneNumber FROM lineitem WHERE l_returnflag = 'R'""",
    "staff_history": """SELECT s_suppkey AS BusinessEntityID,
        CASE WHEN s_acctbal <= 1000 THEN DATE '1999-01-01' END AS EndDate FROM supplier
        UNION ALL SELECT s_suppkey, NULL FROM supplier WHERE s_acctbal > 9000""",
    "staff_address": "SELECT l_suppkey AS BusinessEntityID, l_orderkey AS AddressID FROM lineitem",
}


def sql(body: str, *names: str, **extra: str) -> str:
    """``body`` with the named stand-ins (as ``x_<name>``) and extra CTEs in front."""
    parts = []
    wanted = list(names)
    if any(n.startswith("product_model_") or n == "product_description" for n in wanted) and "product_model" not in wanted:
        wanted.insert(0, "product_model")
    for n in wanted:
        parts.append(f"x_{n} AS ({SQL[n]})")
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body
