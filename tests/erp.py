"""Small business fixtures: one helper that fills missing columns, and the rows of a tiny company."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tidewright.sources.raw_tables import RAW_TABLES

DAY1 = dt.datetime(2024, 1, 1)
D = Decimal


def at(day: int, hour: int = 0, minute: int = 0, second: int = 0, micro: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour, minute, second, micro)


def raw(spark, table: str, rows: list[dict]):
    schema = RAW_TABLES[table].schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


COMPANY: dict[str, list[dict]] = {
    "customer": [
        {"CustomerID": 1, "PersonID": 11, "ModifiedDate": at(1)},
        {"CustomerID": 2, "StoreID": 22, "ModifiedDate": at(2)},
        {"CustomerID": 3, "ModifiedDate": at(3)},
        {"CustomerID": 4, "PersonID": 14, "StoreID": 22, "ModifiedDate": at(4)},
        {"CustomerID": None, "PersonID": 11, "ModifiedDate": at(5)},
    ],
    "leads": [{"lead_id": "CRM0001"}],
    "person": [
        {"BusinessEntityID": 11, "FirstName": "Ann", "LastName": "Lee", "Gender": "F", "BirthDate": dt.date(1980, 5, 6)},
        {"BusinessEntityID": 14, "FirstName": "Bo", "LastName": None},
        {"BusinessEntityID": 31, "FirstName": "Cy", "LastName": None},
        {"BusinessEntityID": 32, "FirstName": "Di", "LastName": "Fox"},
    ],
    "store": [{"BusinessEntityID": 22, "Name": "Corner Shop"}],
    "email_address": [
        {"BusinessEntityID": 11, "EmailAddressID": 2, "EmailAddress": "b@x"},
        {"BusinessEntityID": 11, "EmailAddressID": 1, "EmailAddress": "a@x"},
        {"BusinessEntityID": 31, "EmailAddressID": 9, "EmailAddress": "z@x"},
        {"BusinessEntityID": 31, "EmailAddressID": 3, "EmailAddress": "c@x"},
    ],
    "person_phone": [{"BusinessEntityID": 31, "PhoneNumber": "555", "PhoneNumberTypeID": 1}],
    "business_entity_address": [
        {"BusinessEntityID": 11, "AddressID": 7, "AddressTypeID": 1},
        {"BusinessEntityID": 11, "AddressID": 6, "AddressTypeID": 2},
        {"BusinessEntityID": 22, "AddressID": 7, "AddressTypeID": 1},
    ],
    "address": [
        {"AddressID": 6, "AddressLine1": None, "AddressLine2": "Back door"},
        {"AddressID": 7, "AddressLine1": "Main St", "AddressLine2": "x"},
    ],
    "employee": [
        {"BusinessEntityID": 31, "NationalIDNumber": 900, "JobTitle": "Clerk", "CurrentFlag": 1, "ModifiedDate": at(1)},
        {"BusinessEntityID": 32, "NationalIDNumber": 901, "JobTitle": "Boss", "CurrentFlag": 0, "ModifiedDate": at(1)},
        {"BusinessEntityID": 33, "NationalIDNumber": 902, "JobTitle": "Ghost", "CurrentFlag": 1, "ModifiedDate": at(1)},
    ],
    "employee_department_history": [
        {"BusinessEntityID": 31, "DepartmentID": 1, "StartDate": dt.date(2020, 1, 1), "EndDate": dt.date(2021, 1, 1)},
        {"BusinessEntityID": 31, "DepartmentID": 2, "StartDate": dt.date(2021, 1, 1), "EndDate": None},
    ],
    "product": [
        {"ProductID": 1, "Name": "Bolt", "StandardCost": D("1.2350"), "ListPrice": D("2"), "MakeFlag": "true",
         "FinishedGoodsFlag": "false", "ProductSubcategoryID": 5, "ProductModelID": 8, "ModifiedDate": at(1)},
        {"ProductID": 2, "Name": "Nut", "StandardCost": None, "ListPrice": D("1"), "ProductModelID": 9, "ModifiedDate": at(2)},
        {"ProductID": 3, "Name": "Gear", "StandardCost": D("3"), "ListPrice": D("9"), "ProductSubcategoryID": 5,
         "ModifiedDate": at(3)},
    ],
    "product_sub_category": [{"ProductSubcategoryID": 5, "ProductCategoryID": 50, "Name": "Fasteners"}],
    "product_category": [{"ProductCategoryID": 50, "Name": "Parts"}],
    "product_model": [{"ProductModelID": 8, "Name": "M8"}, {"ProductModelID": 9, "Name": "M9"}],
    "product_model_description_culture": [
        {"ProductModelID": 8, "ProductDescriptionID": 80, "CultureID": "en    "},
        {"ProductModelID": 8, "ProductDescriptionID": 81, "CultureID": "fr"},
        {"ProductModelID": 9, "ProductDescriptionID": 90, "CultureID": "en"},
    ],
    "product_description": [
        {"ProductDescriptionID": 80, "Description": "A steel bolt"},
        {"ProductDescriptionID": 81, "Description": "Un boulon"},
        {"ProductDescriptionID": 90, "Description": None},
    ],
    "sales_order_header": [
        {"SalesOrderID": 100, "Status": 5, "CustomerID": 1, "SalesPersonID": 31, "TerritoryID": 1, "SalesOrderNumber": "SO100",
         "OrderDate": at(2), "ModifiedDate": at(2)},
        {"SalesOrderID": 101, "Status": 5, "CustomerID": 2, "SalesOrderNumber": "SO101", "OrderDate": at(3, 10), "ModifiedDate": at(3)},
        {"SalesOrderID": 102, "Status": 1, "CustomerID": 2, "SalesOrderNumber": "SO102", "OrderDate": at(3), "ModifiedDate": at(3)},
        {"SalesOrderID": 103, "Status": 5, "CustomerID": 9, "SalesOrderNumber": "SO103", "OrderDate": at(4), "ModifiedDate": at(4)},
    ],
    "sales_order_detail": [
        {"SalesOrderID": 100, "SalesOrderDetailID": 1, "OrderQty": 3, "ProductID": 1, "UnitPrice": D("2.0000"),
         "UnitPriceDiscount": D("0.0250"), "LineTotal": D("5.8500"), "ModifiedDate": at(5)},
        {"SalesOrderID": 101, "SalesOrderDetailID": 2, "OrderQty": 1, "ProductID": 2, "UnitPrice": D("1.0000"),
         "UnitPriceDiscount": D("0"), "LineTotal": D("1.0000"), "ModifiedDate": at(1)},
        {"SalesOrderID": 101, "SalesOrderDetailID": 3, "OrderQty": 2, "ProductID": 77, "UnitPrice": D("4.0000"),
         "UnitPriceDiscount": D("0"), "LineTotal": D("8.0000"), "ModifiedDate": None},
        {"SalesOrderID": 102, "SalesOrderDetailID": 4, "OrderQty": 2, "ProductID": 1, "UnitPrice": D("4.0000"),
         "UnitPriceDiscount": D("0"), "LineTotal": D("8.0000"), "ModifiedDate": at(5)},
    ],
    "product_inventory": [
        {"ProductID": 1, "LocationID": 1, "Quantity": 500, "ModifiedDate": at(10)},
        {"ProductID": 1, "LocationID": 2, "Quantity": 50, "ModifiedDate": at(10)},
        {"ProductID": 1, "LocationID": 3, "Quantity": 5, "ModifiedDate": at(10)},
        {"ProductID": 2, "LocationID": 1, "Quantity": 7, "ModifiedDate": at(9)},
        {"ProductID": 3, "LocationID": 1, "Quantity": 4, "ModifiedDate": at(9)},
    ],
    "product_transaction_history": [
        {"TransactionID": 1, "ProductID": 1, "TransactionDate": at(8), "TransactionType": "P", "Quantity": 100,
         "ActualCost": D("1.0000"), "ModifiedDate": at(8)},
        {"TransactionID": 2, "ProductID": 2, "TransactionDate": at(9), "TransactionType": "W", "Quantity": 10,
         "ActualCost": D("2.0000"), "ModifiedDate": at(9)},
        {"TransactionID": 3, "ProductID": 2, "TransactionDate": at(10), "TransactionType": "S", "Quantity": 4,
         "ActualCost": D("3.0000"), "ModifiedDate": at(10)},
        {"TransactionID": 4, "ProductID": 2, "TransactionDate": at(10), "TransactionType": "I", "Quantity": 1,
         "ActualCost": D("4.0000"), "ModifiedDate": at(10)},
        {"TransactionID": 5, "ProductID": 2, "TransactionDate": at(10), "TransactionType": "Q", "Quantity": 999,
         "ActualCost": D("5.0000"), "ModifiedDate": at(10)},
        {"TransactionID": 6, "ProductID": 2, "TransactionDate": at(20), "TransactionType": "P", "Quantity": 1,
         "ActualCost": D("1.0000"), "ModifiedDate": at(20)},
    ],
    "account": [
        {"account_id": 1, "account_code": 10, "account_description": "Cash", "account_type": "asset", "ModifiedDate": at(1, 0, 0, 0, 499000)},
        {"account_id": 2, "parent_id": 1, "account_code": 11, "account_type": "asset", "ModifiedDate": at(1, 0, 0, 0, 500000)},
    ],
    "class": [{"class_id": 1, "class_code": 5, "class_name": "C", "is_debit_normal": 1, "ModifiedDate": at(1)}],
    "department": [
        {"DepartmentID": 1, "Name": "Engineering and research", "GroupName": "R", "department_code": "ENG", "ModifiedDate": at(1)}
    ],
    "location": [{"LocationID": 1, "Name": "Hall", "CostRate": D("1.2350"), "Availability": 3, "ModifiedDate": at(1)},
                 {"LocationID": 2, "Name": "Yard", "CostRate": D("0"), "Availability": 1, "ModifiedDate": at(1)}],
    "sales_territory": [{"TerritoryID": 1, "Name": "Norway", "Group": "Europe", "ModifiedDate": at(1)}],
    "transaction": [
        {"transaction_id": 1, "transaction_code": "T1", "transaction_line_id": 1, "account_id": 1, "department_id": 1, "class_id": 1,
         "transaction_date": at(2), "debit_amount": D("10.0050"), "credit_amount": D("0"), "amount": D("10.0050"), "ModifiedDate": at(2)},
        {"transaction_id": 1, "transaction_code": "T1", "transaction_line_id": 2, "account_id": 2, "department_id": 8, "class_id": 1,
         "transaction_date": at(2, 8), "debit_amount": D("0"), "credit_amount": D("10"), "amount": D("10"), "ModifiedDate": at(2)},
    ],
    "opportunity": [
        {"opportunity_key": 1, "opportunity_id": "O1", "lead_id": "CRM0001", "opportunity_stage": "won", "estimated_value": D("5.50"),
         "close_date": dt.date(2024, 1, 9), "modified_date": at(1)},
        {"opportunity_key": 2, "opportunity_id": "O2", "lead_id": "CRM0099", "opportunity_stage": "lost", "estimated_value": D("1"),
         "close_date": dt.date(2024, 1, 9), "modified_date": at(1)},
    ],
    "m_budget": [
        {"account_id": 1, "department_id": 1, "date": dt.date(2024, 1, 1), "budget": D("100")},
        {"account_id": 1, "department_id": None, "date": dt.date(2024, 1, 1), "budget": D("40")},
    ],
    "m_survey": [
        {"id": 1, "survey_code": "S1", "customer_id": 1, "product_id": 1, "survey_date": dt.date(2024, 1, 3), "overall_rating": 5,
         "quality_rating": 4, "price_rating": 3, "service_rating": None, "recommendation": "yes", "purchase_channel": "web",
         "customer_segment": "gold", "comments": "thirty characters are kept ok " + "first tail"},
    ],
}


def company(spark) -> dict:
    return {table: raw(spark, table, rows) for table, rows in COMPANY.items()}
