from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.erp import COMPANY, D, at, company, raw, rows_of
from tidewright.plans import conform
from tidewright.plans.sales import sales_changed, sales_full


def test_customer_names_contacts_and_flags(spark):
    got = {r.customer_id: r for r in conform.conform_customer(company(spark), dedupe=True).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert (got[1].name, got[1].email, got[1].address) == ("Ann Lee", "a@x", "Back door")
    assert (got[1].customer_crm_id, got[1].is_lead, got[1].is_person) == ("CRM0001", 1, 1)
    assert got[1].birth_day == dt.date(1980, 5, 6)
    assert (got[2].name, got[2].address, got[2].is_lead, got[2].is_person) == ("Corner Shop", "Main St", 0, 0)
    assert got[3].name == "Unknown Customer"
    assert got[4].name is None  # a person without a last name, although a store is known


def test_customer_fans_out_on_several_mails_unless_deduplicated(spark):
    rows = conform.conform_customer(company(spark)).filter("customer_id = 1").collect()
    assert sorted(r.email for r in rows) == ["a@x", "b@x"]


def test_customer_mark_looks_at_the_driving_table_only(spark):
    rows = conform.conform_customer(company(spark), at(2), dedupe=True).collect()
    assert sorted(r.customer_id for r in rows) == [3, 4]


def test_employee_takes_first_mail_and_open_department(spark):
    got = rows_of(conform.conform_employee(company(spark)), "employee_id", "name", "email", "phone", "end_date", "is_valid")
    assert got == [(31, "Cy ", "c@x", "555", None, 1), (32, "Di Fox", None, None, None, 0)]


def test_two_open_departments_give_two_rows(spark):
    tables = company(spark)
    extra = [{"BusinessEntityID": 31, "DepartmentID": 3, "EndDate": None}]
    tables["employee_department_history"] = tables["employee_department_history"].unionByName(
        raw(spark, "employee_department_history", extra)
    )
    assert conform.conform_employee(tables).filter("employee_id = 31").count() == 2


def test_product_description_and_categories(spark):
    got = rows_of(
        conform.conform_product(company(spark)), "product_id", "category", "subcategory", "description", "make_flag"
    )
    assert got == [
        (1, "Parts", "Fasteners", "A steel bolt", True),
        (2, None, None, "Nut", None),
        (3, "Parts", "Fasteners", "Gear", None),
    ]


def test_copies_round_times_and_take_the_department_code(spark):
    tables = company(spark)
    accounts = rows_of(conform.conform_copy("account", tables["account"]), "account_id", "modified_date")
    assert accounts == [(1, at(1)), (2, at(1, 0, 0, 1))]
    assert rows_of(conform.conform_copy("department", tables["department"]), "department_code") == [("ENG",)]
    later = conform.conform_copy("account", tables["account"], at(1))
    assert rows_of(later, "account_id") == [(2,)]


def test_opportunities_of_known_leads(spark):
    tables = company(spark)
    customers = conform.conform_customer(tables, dedupe=True)
    got = conform.conform_opportunity(tables["opportunity"], customers, at(9)).collect()
    assert [(r.opportunity_key, r.customer_id, r.modified_date) for r in got] == [(1, 1, at(9))]
    assert len(got[0].row_hash) == 32


def test_survey_hash_misses_changes_after_thirty_characters(spark):
    def hashes(comment, **options):
        row = {**COMPANY["m_survey"][0], "comments": comment}
        return conform.conform_survey(raw(spark, "m_survey", [row]), at(1), **options).first().row_hash

    start = COMPANY["m_survey"][0]["comments"][:30]
    assert hashes(start + "one") == hashes(start + "two")
    assert hashes(start + "one", full_text_hash=True) != hashes(start + "two", full_text_hash=True)
    assert hashes("other") != hashes(start)


def sales_tables(spark):
    tables = company(spark)
    return tables["sales_order_header"], tables["sales_order_detail"], tables["product"]


def test_full_sales_measures(spark):
    rows = {r.sales_order_detail_id: r for r in sales_full(*sales_tables(spark)).collect()}
    assert set(rows) == {1, 2, 3, None}  # status 1 is left out, the order without lines stays
    first = rows[1]
    assert first.unit_cost == Decimal("1.24") and first.total_product_cost == Decimal("3.72")
    assert first.gross_margin == Decimal("2.13") and first.discount_percentage == Decimal("0.03")
    assert first.discount_amount == Decimal("0.15")
    assert first.modified_date == at(5)  # the line is newer
    assert rows[2].modified_date == at(3) and rows[2].unit_cost == 0
    assert rows[3].modified_date is None
    assert (rows[2].employee_id, rows[2].sales_territory_id) == (-1, -1)
    assert rows[2].order_date == at(3, 10)
    assert rows[None].sales_order_id == 103 and rows[None].sales_amount is None


def test_changed_sales_by_header_or_line(spark):
    rows = {r.sales_order_detail_id: r for r in sales_changed(*sales_tables(spark), at(2)).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].total_product_cost == Decimal("3.71")  # cost is multiplied before rounding
    assert rows[2].order_date == at(3)  # the time of day is cut
    assert {r.sales_order_detail_id for r in sales_changed(*sales_tables(spark), at(3)).collect()} == {1}


def test_changed_sales_equal_the_plain_or_filter(spark):
    header, detail, product = sales_tables(spark)
    for day in range(1, 7):
        mark = at(day)
        plain = (
            header.filter("Status = 5").alias("h")
            .join(detail.alias("d"), "SalesOrderID")
            .filter((F.col("h.ModifiedDate") > F.lit(mark)) | (F.col("d.ModifiedDate") > F.lit(mark)))
            .select("SalesOrderDetailID")
        )
        assert rows_of(sales_changed(header, detail, product, mark), "sales_order_detail_id") == rows_of(plain)


def test_sale_with_missing_header_time_is_found_by_its_line(spark):
    header = raw(spark, "sales_order_header", [{"SalesOrderID": 1, "Status": 5, "OrderDate": at(1), "ModifiedDate": None}])
    detail = raw(spark, "sales_order_detail", [{"SalesOrderID": 1, "SalesOrderDetailID": 7, "OrderQty": 1, "ProductID": 1,
                 "UnitPrice": D("1"), "UnitPriceDiscount": D("0"), "LineTotal": D("1"), "ModifiedDate": at(5)}])
    product = raw(spark, "product", [{"ProductID": 1, "StandardCost": D("1")}])
    assert rows_of(sales_changed(header, detail, product, at(2)), "sales_order_detail_id") == [(7,)]
