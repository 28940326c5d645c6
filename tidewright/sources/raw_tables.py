"""The raw tables: one row of configuration each, one operator for all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tidewright.sources.schema import ddl_schema

# Columns, types and merge keys of the raw tables.
_RAW = {
    "account": (
        "account_id int, parent_id int, account_code int, parent_account_code int, account_description string, "
        "account_type string, ModifiedDate timestamp",
        "account_id",
    ),
    "address": (
        "AddressID int, AddressLine1 string, AddressLine2 string, City string, StateProvinceID int, "
        "PostalCode string, rowguid string, ModifiedDate timestamp",
        "AddressID",
    ),
    "business_entity": ("BusinessEntityID int, rowguid string, ModifiedDate timestamp", "BusinessEntityID"),
    "business_entity_address": (
        "BusinessEntityID int, AddressID int, AddressTypeID int, rowguid string, ModifiedDate timestamp",
        "BusinessEntityID, AddressID, AddressTypeID",
    ),
    "class": (
        "class_id int, class_code int, class_name string, class_description string, parent_class_id int, "
        "class_level int, sort_order int, is_debit_normal int, ModifiedDate timestamp",
        "class_id",
    ),
    "customer": (
        "CustomerID int, PersonID int, StoreID int, TerritoryID int, AccountNumber string, rowguid string, "
        "ModifiedDate timestamp",
        "CustomerID",
    ),
    "department": (
        "DepartmentID int, Name string, GroupName string, ModifiedDate timestamp, department_code string",
        "DepartmentID",
    ),
    "email_address": (
        "BusinessEntityID int, EmailAddressID int, EmailAddress string, rowguid string, ModifiedDate timestamp",
        "BusinessEntityID, EmailAddressID",
    ),
    "employee": (
        "BusinessEntityID int, NationalIDNumber int, LoginID string, JobTitle string, BirthDate date, "
        "MaritalStatus string, Gender string, HireDate date, SalariedFlag int, VacationHours int, "
        "SickLeaveHours int, CurrentFlag int, rowguid string, ModifiedDate timestamp",
        "BusinessEntityID, NationalIDNumber",
    ),
    "employee_department_history": (
        "BusinessEntityID int, DepartmentID int, ShiftID int, StartDate date, EndDate date, ModifiedDate timestamp",
        "BusinessEntityID, DepartmentID",
    ),
    "location": (
        "LocationID int, Name string, CostRate decimal(19,4), Availability int, ModifiedDate timestamp",
        "LocationID",
    ),
    "person": (
        "BusinessEntityID int, PersonType string, NameStyle string, Title string, FirstName string, "
        "MiddleName string, LastName string, Suffix string, EmailPromotion string, AdditionalContactInfo string, "
        "Demographics string, rowguid string, ModifiedDate timestamp, BirthDate date, Gender string",
        "BusinessEntityID",
    ),
    "person_phone": (
        "BusinessEntityID int, PhoneNumber string, PhoneNumberTypeID int, ModifiedDate timestamp",
        "BusinessEntityID, PhoneNumber, PhoneNumberTypeID",
    ),
    "product": (
        "ProductID int, Name string, ProductNumber string, MakeFlag string, FinishedGoodsFlag string, Color string, "
        "SafetyStockLevel int, ReorderPoint int, StandardCost decimal(19,4), ListPrice decimal(19,4), Size string, "
        "SizeUnitMeasureCode string, WeightUnitMeasureCode string, Weight decimal(8,2), DaysToManufacture int, "
        "ProductLine string, Class string, Style string, ProductSubcategoryID int, ProductModelID int, "
        "SellStartDate timestamp, SellEndDate timestamp, rowguid string, ModifiedDate timestamp",
        "ProductID",
    ),
    "product_category": (
        "ProductCategoryID int, Name string, rowguid string, ModifiedDate timestamp",
        "ProductCategoryID",
    ),
    "product_description": (
        "ProductDescriptionID int, Description string, rowguid string, ModifiedDate timestamp",
        "ProductDescriptionID",
    ),
    "product_inventory": (
        "ProductID int, LocationID int, Shelf string, Bin int, Quantity int, rowguid string, ModifiedDate timestamp",
        "ProductID, LocationID",
    ),
    "product_model": (
        "ProductModelID int, Name string, CatalogDescription string, Intructions string, rowguid string, "
        "ModifiedDate timestamp",
        "ProductModelID",
    ),
    "product_model_description_culture": (
        "ProductModelID int, ProductDescriptionID int, CultureID string, ModifiedDate timestamp",
        "ProductModelID, ProductDescriptionID",
    ),
    "product_sub_category": (
        "ProductSubcategoryID int, ProductCategoryID int, Name string, rowguid string, ModifiedDate timestamp",
        "ProductSubcategoryID",
    ),
    "product_transaction_history": (
        "TransactionID int, ProductID int, ReferenceOrderID int, ReferenceOrderLineID int, TransactionDate timestamp, "
        "TransactionType string, Quantity int, ActualCost decimal(19,4), ModifiedDate timestamp",
        "TransactionID, ProductID",
    ),
    "purchase_order_detail": (
        "PurchaseOrderID int, PurchaseOrderDetailID int, DueDate timestamp, OrderQty int, ProductID int, "
        "UnitPrice decimal(19,4), LineTotal decimal(19,4), ReceivedQty int, RejectedQty int, StockedQty int, "
        "ModifiedDate timestamp",
        "PurchaseOrderID, PurchaseOrderDetailID",
    ),
    "purchase_order_header": (
        "PurchaseOrderID int, RevisionNumber int, Status int, EmployeeID int, VendorID int, ShipMethodID int, "
        "OrderDate timestamp, ShipDate timestamp, SubTotal decimal(19,4), TaxAmt decimal(19,4), "
        "Freight decimal(19,4), TotalDue decimal(19,4), ModifiedDate timestamp",
        "PurchaseOrderID",
    ),
    "sales_order_detail": (
        "SalesOrderID int, SalesOrderDetailID int, CarrierTrackingNumber string, OrderQty int, ProductID int, "
        "SpecialOfferID int, UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4), LineTotal decimal(19,4), "
        "rowguid string, ModifiedDate timestamp",
        "SalesOrderID, SalesOrderDetailID",
    ),
    "sales_order_header": (
        "SalesOrderID int, RevisionNumber int, OrderDate timestamp, DueDate timestamp, ShipDate timestamp, "
        "Status int, OnlineOrderFlag string, SalesOrderNumber string, PurchaseOrderNumber string, "
        "AccountNumber string, CustomerID int, SalesPersonID int, TerritoryID int, BillToAddressID int, "
        "ShipToAddressID int, ShipMethodID int, CreditCardID int, CreditCardApprovalCode string, "
        "CurrencyRateID int, SubTotal decimal(19,4), TaxAmt decimal(19,4), Freight decimal(19,4), "
        "TotalDue decimal(19,4), rowguid string, ModifiedDate timestamp",
        "SalesOrderID",
    ),
    "sales_territory": (
        "TerritoryID int, Name string, CountryRegionCode string, `Group` string, SalesYTD decimal(19,4), "
        "SalesLastYear decimal(19,4), CostLastYear decimal(19,4), rowguid string, ModifiedDate timestamp",
        "TerritoryID",
    ),
    "shift": ("ShiftID int, Name string, StartTime string, EndTime string, ModifiedDate timestamp", "ShiftID"),
    "store": (
        "BusinessEntityID int, Name string, SalesPersonID string, Demographics string, rowguid string, "
        "ModifiedDate timestamp",
        "BusinessEntityID",
    ),
    "transaction": (
        "transaction_id int, transaction_code string, transaction_line_id int, account_id int, account_code int, "
        "class_id int, department_id int, department_code string, transaction_type string, entry_type string, "
        "description string, transaction_date timestamp, debit_amount decimal(19,4), credit_amount decimal(19,4), "
        "amount decimal(19,4), ModifiedDate timestamp",
        "transaction_id, transaction_line_id",
    ),
    # read by the conformed layer; layout inferred from its use
    "leads": ("lead_id string", "lead_id"),
    "opportunity": (
        "opportunity_key int, opportunity_id string, lead_id string, opportunity_stage string, "
        "estimated_value decimal(18,2), close_date date, modified_date timestamp",
        "opportunity_key",
    ),
    "m_budget": (
        "account_id int, department_id int, date date, budget decimal(18,2)",
        "account_id, department_id, date",
    ),
    "m_survey": (
        "id int, survey_code string, customer_id int, product_id int, survey_date date, overall_rating int, "
        "quality_rating int, price_rating int, service_rating int, recommendation string, purchase_channel string, "
        "customer_segment string, comments string",
        "id",
    ),
}
FULL_ONLY = ("store", "leads", "opportunity", "m_budget", "m_survey")  # no incremental extract
INCREMENTAL_ONLY = ("shift",)  # no full extract
TIME_COLUMN = "ModifiedDate"


@dataclass(frozen=True)
class RawTable:
    name: str
    schema: T.StructType
    keys: list[str]
    time_column: str | None

    @property
    def has_full(self) -> bool:
        return self.name not in INCREMENTAL_ONLY

    @property
    def has_incremental(self) -> bool:
        return self.name not in FULL_ONLY


def _config(name: str) -> RawTable:
    ddl, keys = _RAW[name]
    schema = ddl_schema(ddl)
    time_column = TIME_COLUMN if TIME_COLUMN in schema.names else None
    return RawTable(name, schema, [k.strip() for k in keys.split(",")], time_column)


RAW_TABLES: dict[str, RawTable] = {name: _config(name) for name in _RAW}
