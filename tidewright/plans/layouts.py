"""Fixed layouts of the conformed and star tables."""

from __future__ import annotations

# Column names, types and lengths of the stored tables.
CONFORMED = {
    "account": "account_id INT, parent_id INT, account_code INT, parent_account_code INT, "
    "account_description VARCHAR(255), account_type VARCHAR(50), modified_date TIMESTAMP",
    "class": "class_id INT, parent_class_id INT, class_code VARCHAR(50), class_name VARCHAR(500), class_level INT, "
    "sort_order INT, is_debit_normal BOOLEAN, modified_date TIMESTAMP",
    "customer": "customer_id INT, customer_erp_id INT, customer_crm_id VARCHAR(10), name VARCHAR(255), "
    "email VARCHAR(255), phone VARCHAR(100), address VARCHAR(255), birth_day DATE, gender VARCHAR(1), is_lead INT, "
    "is_person INT, modified_date TIMESTAMP",
    "department": "department_id INT, department_code VARCHAR(10), name VARCHAR(255), group_name VARCHAR(255), "
    "modified_date TIMESTAMP",
    "employee": "employee_id INT, employee_national_number VARCHAR(25), name VARCHAR(255), position VARCHAR(255), "
    "birth_day DATE, gender VARCHAR(1), email VARCHAR(255), phone VARCHAR(100), address VARCHAR(255), "
    "start_date DATE, end_date DATE, is_valid INT, modified_date TIMESTAMP",
    "location": "location_id INT, name VARCHAR(255), cost_rate DECIMAL(18,2), availability DECIMAL(18,2), "
    "modified_date TIMESTAMP",
    "product": "product_id INT, name VARCHAR(255), category VARCHAR(50), subcategory VARCHAR(50), model VARCHAR(50), "
    "line VARCHAR(2), class VARCHAR(2), style VARCHAR(2), color VARCHAR(25), size VARCHAR(5), weight DECIMAL(18,2), "
    "description VARCHAR(500), standard_cost DECIMAL(18,4), list_price DECIMAL(18,4), make_flag BOOLEAN, "
    "finished_goods_flag BOOLEAN, safety_stock_level INT, reorder_point INT, days_to_manufacture INT, "
    "sell_start_date TIMESTAMP, sell_end_date TIMESTAMP, modified_date TIMESTAMP",
    "product_inventory": "product_id INT, location_id VARCHAR(50), transaction_date TIMESTAMP, unit_in INT, "
    "unit_out INT, unit_cost DECIMAL(18,2), unit_balance INT, modified_date TIMESTAMP",
    "sales": "sales_order_id INT, customer_id INT, product_id INT, employee_id INT, sales_territory_id INT, "
    "sales_order_number VARCHAR(25), sales_order_detail_id INT, order_date TIMESTAMP, order_quantity INT, "
    "unit_price DECIMAL(18,2), unit_cost DECIMAL(18,2), discount_percentage DECIMAL(18,2), "
    "sales_amount DECIMAL(18,2), total_product_cost DECIMAL(18,2), gross_margin DECIMAL(18,2), "
    "discount_amount DECIMAL(18,2), modified_date TIMESTAMP",
    "sales_territory": "sales_territory_id INT, sales_territory_group VARCHAR(50), "
    "sales_territory_country VARCHAR(50), modified_date TIMESTAMP",
    "transaction": "transaction_id INT, transaction_code VARCHAR(25), transaction_line_id INT, account_id INT, "
    "department_id INT, class_id INT, transaction_type VARCHAR(50), entry_type VARCHAR(25), "
    "description VARCHAR(500), transaction_date TIMESTAMP, debit_amount DECIMAL(18,2), credit_amount DECIMAL(18,2), "
    "amount DECIMAL(18,2), modified_date TIMESTAMP",
    "opportunity": "opportunity_key INT, opportunity_id VARCHAR(10), customer_id INT, "
    "opportunity_stage VARCHAR(255), estimated_value DECIMAL(18,2), close_date TIMESTAMP, row_hash VARCHAR(64), "
    "modified_date TIMESTAMP",
    "budget": "account_id INT, department_id INT, budget_date TIMESTAMP, budget DECIMAL(18,2), "
    "row_hash VARCHAR(64), modified_date TIMESTAMP",
    "survey": "survey_id INT, survey_code VARCHAR(50), customer_id INT, product_id INT, survey_date TIMESTAMP, "
    "overall_rating INT, quality_rating INT, price_rating INT, service_rating INT, recommendation VARCHAR(10), "
    "purchase_channel VARCHAR(25), customers_segment VARCHAR(25), comments VARCHAR(255), row_hash VARCHAR(64), "
    "modified_date TIMESTAMP",
}

STAR_FACTS = {
    "fact_sales": "sales_order_key INT, customer_key INT, product_key INT, employee_key INT, "
    "sales_territory_key INT, sales_order_number VARCHAR(25), sales_order_detail_id INT, order_date_key INT, "
    "order_quantity INT, unit_price DECIMAL(18,2), unit_cost DECIMAL(18,2), discount_percentage DECIMAL(18,2), "
    "sales_amount DECIMAL(18,2), total_product_cost DECIMAL(18,2), gross_margin DECIMAL(18,2), "
    "discount_amount DECIMAL(18,2), modified_date TIMESTAMP",
    "fact_transaction": "transaction_key INT, transaction_code VARCHAR(25), transaction_line_id INT, "
    "account_key INT, department_key INT, class_key INT, transaction_type VARCHAR(50), entry_type VARCHAR(25), "
    "description VARCHAR(500), transaction_date_key INT, debit_amount DECIMAL(18,2), credit_amount DECIMAL(18,2), "
    "amount DECIMAL(18,2), modified_date TIMESTAMP",
    "fact_product_inventory": "product_key INT, location_key INT, date_key INT, unit_in INT, unit_out INT, "
    "unit_cost DECIMAL(18,2), unit_balance INT, modified_date TIMESTAMP",
    "fact_budget": "account_key INT, department_key INT, budget_date_key INT, budget DECIMAL(18,2), "
    "modified_date TIMESTAMP",
    "fact_opportunity": "opportunity_key INT, opportunity_id VARCHAR(10), customer_key INT, "
    "opportunity_stage VARCHAR(255), estimated_value DECIMAL(18,2), close_date_key INT, modified_date TIMESTAMP",
    "fact_survey": "survey_key INT, survey_code VARCHAR(50), customer_key INT, product_key INT, "
    "survey_date_key INT, overall_rating INT, quality_rating INT, price_rating INT, service_rating INT, "
    "recommendation VARCHAR(10), purchase_channel VARCHAR(25), customers_segment VARCHAR(25), "
    "comments VARCHAR(255), modified_date TIMESTAMP",
}

# dimensions keep the layout of their conformed table, with the id column renamed to the key
DIMENSION_KEYS = {
    "dim_account": ("account", "account_id", "account_key"),
    "dim_class": ("class", "class_id", "class_key"),
    "dim_customer": ("customer", "customer_id", "customer_key"),
    "dim_department": ("department", "department_id", "department_key"),
    "dim_employee": ("employee", "employee_id", "employee_key"),
    "dim_location": ("location", "location_id", "location_key"),
    "dim_product": ("product", "product_id", "product_key"),
    "dim_sales_territory": ("sales_territory", "sales_territory_id", "sales_territory_key"),
}


def star_layout(table: str) -> str:
    if table in STAR_FACTS:
        return STAR_FACTS[table]
    source, id_column, key = DIMENSION_KEYS[table]
    return CONFORMED[source].replace(f"{id_column} ", f"{key} ", 1)
