"""Conformed entities (T1-T7, T10-T14): raw tables in, business names and types out.

``raw`` maps a raw table name to its DataFrame. ``mark`` restricts the driving table to rows newer than
a watermark; changes in the joined tables alone do not refresh a row. Runtime bloom filters built from
the few changed rows keep the joined tables from being shuffled whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.scalars import (
    cast_varchar,
    concat_blank,
    flag,
    money,
    newer_than,
    round_second,
    row_hash,
    same_text,
    tail_int,
    time_text,
)
from tidewright.operators.picks import first_per_group

Raw = Mapping[str, DataFrame]

# Texts that appear in results.
UNKNOWN_CUSTOMER = "Unknown Customer"
DESCRIPTION_CULTURE = "en"

# One entry per entity that is a plain copy: conformed name -> raw name.
COPIES: dict[str, dict[str, str]] = {
    "account": {
        "account_id": "account_id",
        "parent_id": "parent_id",
        "account_code": "account_code",
        "parent_account_code": "parent_account_code",
        "account_description": "account_description",
        "account_type": "account_type",
    },
    "class": {
        "class_id": "class_id",
        "parent_class_id": "parent_class_id",
        "class_code": "class_code",
        "class_name": "class_name",
        "class_level": "class_level",
        "sort_order": "sort_order",
        "is_debit_normal": "is_debit_normal",
    },
    "department": {
        "department_id": "DepartmentID",
        "department_code": "department_code",
        "name": "Name",
        "group_name": "GroupName",
    },
    "location": {
        "location_id": "LocationID",
        "name": "Name",
        "cost_rate": "CostRate",
        "availability": "Availability",
    },
    "sales_territory": {
        "sales_territory_id": "TerritoryID",
        "sales_territory_group": "Group",
        "sales_territory_country": "Name",
    },
    "transaction": {
        "transaction_id": "transaction_id",
        "transaction_code": "transaction_code",
        "transaction_line_id": "transaction_line_id",
        "account_id": "account_id",
        "department_id": "department_id",
        "class_id": "class_id",
        "transaction_type": "transaction_type",
        "entry_type": "entry_type",
        "description": "description",
        "transaction_date": "transaction_date",
        "debit_amount": "debit_amount",
        "credit_amount": "credit_amount",
        "amount": "amount",
    },
}
AMOUNT_COLUMNS = {"debit_amount", "credit_amount", "amount"}


def since(df: DataFrame, mark: dt.datetime | None, time_column: str = "ModifiedDate") -> DataFrame:
    return df if mark is None else df.filter(newer_than(F.col(time_column), mark))


def conform_copy(
    entity: str, source: DataFrame, mark: dt.datetime | None = None, columns: Mapping[str, str] | None = None
) -> DataFrame:
    """Rename, keep the listed columns, round the time to seconds and money to cents."""
    columns = columns or COPIES[entity]

    def value(new: str, old: str) -> Column:
        raw = F.col(f"`{old}`")
        return (money(raw) if new in AMOUNT_COLUMNS else raw).alias(new)

    return since(source, mark).select(
        *[value(new, old) for new, old in columns.items()], round_second(F.col("ModifiedDate")).alias("modified_date")
    )


def first_address(raw: Raw) -> DataFrame:
    """Per business entity: the address with the smallest id, main line before second line."""
    links = first_per_group(raw["business_entity_address"].select("BusinessEntityID", "AddressID"), ["BusinessEntityID"], ["AddressID"])
    lines = raw["address"].select("AddressID", F.coalesce("AddressLine1", "AddressLine2").alias("address"))
    return links.join(lines, "AddressID", "left").select(F.col("BusinessEntityID").alias("address_entity"), "address")


def conform_customer(
    raw: Raw, mark: dt.datetime | None = None, dedupe: bool = False, lead_digits: int | None = 4
) -> DataFrame:
    """Customer with name, contact, first address and lead flag.

    Several e-mails, phones or leads of one customer give several rows unless ``dedupe`` picks the first
    of each. A lead belongs to the customer numbered by the last ``lead_digits`` characters of its id; None takes
    all digits at its end.
    """
    customers = since(raw["customer"], mark).filter(F.col("CustomerID").isNotNull())
    leads = raw["leads"].select("lead_id", tail_int(F.col("lead_id"), lead_digits).alias("lead_customer"))
    people = raw["person"].select(
        F.col("BusinessEntityID").alias("person_entity"), "FirstName", "LastName", "BirthDate", "Gender"
    )
    stores = raw["store"].select(F.col("BusinessEntityID").alias("store_entity"), F.col("Name").alias("store_name"))
    emails = raw["email_address"].select(
        F.col("BusinessEntityID").alias("email_entity"), "EmailAddressID", "EmailAddress"
    )
    phones = raw["person_phone"].select(
        F.col("BusinessEntityID").alias("phone_entity"), "PhoneNumberTypeID", "PhoneNumber"
    )
    if dedupe:
        leads = first_per_group(leads, ["lead_customer"], ["lead_id"])
        emails = first_per_group(emails, ["email_entity"], ["EmailAddressID"])
        phones = first_per_group(phones, ["phone_entity"], ["PhoneNumberTypeID"])
    entity = F.coalesce("PersonID", "StoreID")
    joined = (
        customers.join(leads, F.col("CustomerID") == F.col("lead_customer"), "left")
        .join(people, F.col("PersonID") == F.col("person_entity"), "left")
        .join(stores, F.col("StoreID") == F.col("store_entity"), "left")
        .join(phones, F.col("PersonID") == F.col("phone_entity"), "left")
        .join(emails, entity == F.col("email_entity"), "left")
        .join(first_address(raw), entity == F.col("address_entity"), "left")
    )
    name = (
        F.when(F.col("PersonID").isNotNull(), F.concat("FirstName", F.lit(" "), "LastName"))
        .when(F.col("StoreID").isNotNull(), F.col("store_name"))
        .otherwise(F.lit(UNKNOWN_CUSTOMER))
    )
    return joined.select(
        F.col("CustomerID").alias("customer_id"),
        F.col("CustomerID").alias("customer_erp_id"),
        F.col("lead_id").alias("customer_crm_id"),
        name.alias("name"),
        F.col("EmailAddress").alias("email"),
        F.col("PhoneNumber").alias("phone"),
        "address",
        F.to_date("BirthDate").alias("birth_day"),
        F.col("Gender").alias("gender"),
        flag(F.col("lead_id").isNotNull()).alias("is_lead"),
        flag(F.col("PersonID").isNotNull()).alias("is_person"),
        round_second(F.col("ModifiedDate")).alias("modified_date"),
    )


def conform_employee(raw: Raw, mark: dt.datetime | None = None) -> DataFrame:
    """Employee with person name, first e-mail, phone and address (T5).

    Only open department rows are joined, so ``end_date`` is NULL and two open rows give two rows.
    """
    staff = since(raw["employee"], mark).select(
        "BusinessEntityID", "NationalIDNumber", "JobTitle", "BirthDate", "Gender", "HireDate", "CurrentFlag", "ModifiedDate"
    )
    people = raw["person"].select(F.col("BusinessEntityID").alias("person_entity"), "FirstName", "LastName")
    emails = first_per_group(
        raw["email_address"].select(F.col("BusinessEntityID").alias("email_entity"), "EmailAddressID", "EmailAddress"),
        ["email_entity"],
        ["EmailAddressID"],
    )
    phones = first_per_group(
        raw["person_phone"].select(F.col("BusinessEntityID").alias("phone_entity"), "PhoneNumberTypeID", "PhoneNumber"),
        ["phone_entity"],
        ["PhoneNumberTypeID"],
    )
    open_rows = (
        raw["employee_department_history"]
        .filter(F.col("EndDate").isNull())
        .select(F.col("BusinessEntityID").alias("department_entity"), "EndDate")
    )
    entity = F.col("BusinessEntityID")
    return (
        staff.join(people, entity == F.col("person_entity"))
        .join(emails, entity == F.col("email_entity"), "left")
        .join(phones, entity == F.col("phone_entity"), "left")
        .join(open_rows, entity == F.col("department_entity"), "left")
        .join(first_address(raw), entity == F.col("address_entity"), "left")
        .select(
            entity.alias("employee_id"),
            F.col("NationalIDNumber").alias("employee_national_number"),
            concat_blank(F.col("FirstName"), F.lit(" "), F.col("LastName")).alias("name"),
            F.col("JobTitle").alias("position"),
            F.col("BirthDate").alias("birth_day"),
            F.col("Gender").alias("gender"),
            F.col("EmailAddress").alias("email"),
            F.col("PhoneNumber").alias("phone"),
            "address",
            F.col("HireDate").alias("start_date"),
            F.col("EndDate").alias("end_date"),
            flag(F.col("CurrentFlag") == 1).alias("is_valid"),
            round_second(F.col("ModifiedDate")).alias("modified_date"),
        )
    )


def conform_product(raw: Raw, mark: dt.datetime | None = None) -> DataFrame:
    """Product with category, subcategory and its English description, else its name."""
    products = since(raw["product"], mark)
    subcategories = raw["product_sub_category"].select(
        F.col("ProductSubcategoryID").alias("sub_id"), F.col("ProductCategoryID").alias("sub_category"), F.col("Name").alias("subcategory")
    )
    categories = raw["product_category"].select(F.col("ProductCategoryID").alias("category_id"), F.col("Name").alias("category"))
    models = raw["product_model"].select(F.col("ProductModelID").alias("model_id"))
    english = (
        raw["product_model_description_culture"]
        .filter(same_text(F.col("CultureID"), F.lit(DESCRIPTION_CULTURE)))
        .select(F.col("ProductModelID").alias("culture_model"), F.col("ProductDescriptionID").alias("text_id"))
    )
    texts = raw["product_description"].select(F.col("ProductDescriptionID").alias("description_id"), F.col("Description").alias("text"))
    # the small tables are joined to each other first, the products meet each result once
    grouping = subcategories.join(categories, F.col("sub_category") == F.col("category_id"), "left")
    wording = models.join(english, F.col("model_id") == F.col("culture_model"), "left").join(
        texts, F.col("text_id") == F.col("description_id"), "left"
    )
    return (
        products.join(grouping, F.col("ProductSubcategoryID") == F.col("sub_id"), "left")
        .join(wording, F.col("ProductModelID") == F.col("model_id"), "left")
        .select(
            F.col("ProductID").alias("product_id"),
            F.col("Name").alias("name"),
            "category",
            "subcategory",
            F.col("ProductNumber").alias("model"),
            F.col("ProductLine").alias("line"),
            F.col("Class").alias("class"),
            F.col("Style").alias("style"),
            F.col("Color").alias("color"),
            F.col("Size").alias("size"),
            F.col("Weight").alias("weight"),
            F.coalesce("text", "Name").alias("description"),
            F.col("StandardCost").alias("standard_cost"),
            F.col("ListPrice").alias("list_price"),
            F.col("MakeFlag").cast("boolean").alias("make_flag"),
            F.col("FinishedGoodsFlag").cast("boolean").alias("finished_goods_flag"),
            F.col("SafetyStockLevel").alias("safety_stock_level"),
            F.col("ReorderPoint").alias("reorder_point"),
            F.col("DaysToManufacture").alias("days_to_manufacture"),
            round_second(F.col("SellStartDate")).alias("sell_start_date"),
            round_second(F.col("SellEndDate")).alias("sell_end_date"),
            round_second(F.col("ModifiedDate")).alias("modified_date"),
        )
    )


def conform_opportunity(opportunity: DataFrame, customers: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Opportunities of known leads, with a hash over their content.

    Customers without a CRM id cannot match and are dropped before the shuffle.
    """
    known = customers.filter(F.col("customer_crm_id").isNotNull()).select("customer_id", "customer_crm_id")
    joined = opportunity.join(known, F.col("lead_id") == F.col("customer_crm_id"))
    close = F.col("close_date")
    return joined.select(
        "opportunity_key",
        "opportunity_id",
        "customer_id",
        "opportunity_stage",
        "estimated_value",
        "close_date",
        row_hash(
            F.col("opportunity_key"),
            F.col("opportunity_id"),
            F.col("customer_id"),
            F.col("opportunity_stage"),
            money(F.col("estimated_value")),
            _style_text(joined, "close_date", close),
        ).alias("row_hash"),
        F.lit(load_ts).cast("timestamp").alias("modified_date"),
    )


def _style_text(df: DataFrame, name: str, value: Column) -> Column:
    """Text of a date or of a timestamp to the second, as the column's type asks."""
    return value.cast("string") if df.schema[name].dataType.typeName() == "date" else time_text(value)


def conform_budget(budget: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Budget lines with a hash over all four columns."""
    return budget.select(
        "account_id",
        "department_id",
        F.col("date").alias("budget_date"),
        "budget",
        row_hash(
            F.col("account_id"), F.col("department_id"), _style_text(budget, "date", F.col("date")), money(F.col("budget"))
        ).alias("row_hash"),
        F.lit(load_ts).cast("timestamp").alias("modified_date"),
    )


def conform_survey(survey: DataFrame, load_ts: dt.datetime, full_text_hash: bool = False) -> DataFrame:
    """Survey answers with a hash over twelve columns.

    The hash sees 30 characters of each text, so a change further on is not noticed, unless
    ``full_text_hash`` is set.
    """

    def text(name: str) -> Column:
        value = F.col(name).cast("string")
        return value if full_text_hash else cast_varchar(value)

    answers = ["overall_rating", "quality_rating", "price_rating", "service_rating"]
    words = ["recommendation", "purchase_channel", "customer_segment", "comments"]
    return survey.select(
        F.col("id").alias("survey_id"),
        "survey_code",
        "customer_id",
        "product_id",
        "survey_date",
        *answers,
        "recommendation",
        "purchase_channel",
        F.col("customer_segment").alias("customers_segment"),
        "comments",
        row_hash(
            text("survey_code"),
            text("customer_id"),
            text("product_id"),
            _style_text(survey, "survey_date", F.col("survey_date")),
            *[text(c) for c in answers + words],
        ).alias("row_hash"),
        F.lit(load_ts).cast("timestamp").alias("modified_date"),
    )
