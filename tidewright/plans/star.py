"""Star schema loads (G1-G15): one dimension load and one fact load, driven by configuration."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.lookup import Lookup, star_lookup
from tidewright.plans.layouts import DIMENSION_KEYS


def newer(df: DataFrame, mark: dt.datetime | None, column: str = "modified_date") -> DataFrame:
    """Conformed times are whole seconds already, so the mark is compared as it is."""
    return df if mark is None else df.filter(F.col(column) > F.lit(mark))


def dimension(source: DataFrame, id_column: str, key: str, mark: dt.datetime | None = None) -> DataFrame:
    """Conformed rows with the id renamed to the key; type-1, no surrogate keys."""
    return newer(source, mark).withColumnRenamed(id_column, key)


def dimension_load(name: str, conformed: DataFrame, mark: dt.datetime | None = None) -> DataFrame:
    _, id_column, key = DIMENSION_KEYS[name]
    return dimension(conformed, id_column, key, mark)


def _key(dim: str, key: str, on: str, cast: str | None = None) -> Lookup:
    return Lookup(dimension=dim, key=key, on=on, name=key, cast=cast)


def _date(on: str, name: str) -> Lookup:
    return Lookup(dimension="dim_date", key="date", on=on, name=name, value="date_key")


@dataclass(frozen=True)
class Fact:
    """A fact table: its conformed source, renamed columns, lookups and merge key."""

    source: str
    lookups: tuple[Lookup, ...]
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    rename: Mapping[str, str] = field(default_factory=dict)  # fact column -> source column

    def columns(self) -> list[str]:
        return [*self.rename, *[look.name for look in self.lookups], *self.measures, "modified_date"]


# the customer key of fact_opportunity is looked up in both modes
FACTS: dict[str, Fact] = {
    "fact_sales": Fact(
        source="sales",
        rename={"sales_order_key": "sales_order_id"},
        lookups=(
            _key("dim_customer", "customer_key", "customer_id"),
            _key("dim_product", "product_key", "product_id"),
            _key("dim_employee", "employee_key", "employee_id"),
            _key("dim_sales_territory", "sales_territory_key", "sales_territory_id"),
            _date("order_date", "order_date_key"),
        ),
        measures=(
            "sales_order_number",
            "sales_order_detail_id",
            "order_quantity",
            "unit_price",
            "unit_cost",
            "discount_percentage",
            "sales_amount",
            "total_product_cost",
            "gross_margin",
            "discount_amount",
        ),
        keys=("sales_order_key", "sales_order_detail_id"),
    ),
    "fact_transaction": Fact(
        source="transaction",
        rename={"transaction_key": "transaction_id"},
        lookups=(
            _key("dim_account", "account_key", "account_id"),
            _key("dim_department", "department_key", "department_id"),
            _key("dim_class", "class_key", "class_id"),
            _date("transaction_date", "transaction_date_key"),
        ),
        measures=(
            "transaction_code",
            "transaction_line_id",
            "transaction_type",
            "entry_type",
            "description",
            "debit_amount",
            "credit_amount",
            "amount",
        ),
        keys=("transaction_key", "transaction_line_id"),
    ),
    "fact_product_inventory": Fact(
        source="product_inventory",
        lookups=(
            _key("dim_product", "product_key", "product_id"),
            _key("dim_location", "location_key", "location_id", cast="int"),
            _date("transaction_date", "date_key"),
        ),
        measures=("unit_in", "unit_out", "unit_cost", "unit_balance"),
        keys=("product_key", "location_key", "date_key"),
    ),
    "fact_budget": Fact(
        source="budget",
        lookups=(
            _key("dim_account", "account_key", "account_id"),
            _key("dim_department", "department_key", "department_id"),
            _date("budget_date", "budget_date_key"),
        ),
        measures=("budget",),
        keys=("account_key", "department_key", "budget_date_key"),
    ),
    "fact_opportunity": Fact(
        source="opportunity",
        rename={"opportunity_key": "opportunity_key"},
        lookups=(_key("dim_customer", "customer_key", "customer_id"), _date("close_date", "close_date_key")),
        measures=("opportunity_id", "opportunity_stage", "estimated_value"),
        keys=("opportunity_key",),
    ),
    "fact_survey": Fact(
        source="survey",
        rename={"survey_key": "survey_id"},
        lookups=(
            _key("dim_customer", "customer_key", "customer_id"),
            _key("dim_product", "product_key", "product_id"),
            _date("survey_date", "survey_date_key"),
        ),
        measures=(
            "survey_code",
            "overall_rating",
            "quality_rating",
            "price_rating",
            "service_rating",
            "recommendation",
            "purchase_channel",
            "customers_segment",
            "comments",
        ),
        keys=("survey_key",),
    ),
}


def fact_load(
    name: str,
    conformed: DataFrame,
    dimensions: Mapping[str, DataFrame],
    mark: dt.datetime | None = None,
    *,
    whole_days: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fact rows with looked-up keys; ``mark`` keeps only rows newer than the watermark.

    A date key is found only for a time at midnight; ``whole_days`` cuts the time of day first. ``keep`` names source
    columns that are passed on.
    """
    fact = FACTS[name]
    lookups = fact.lookups
    if whole_days:
        lookups = tuple(
            Lookup(look.dimension, look.key, look.on, look.name, look.value, exact_time=False, cast=look.cast)
            if look.dimension == "dim_date"
            else look
            for look in lookups
        )
    asked = {look.on for look in lookups}
    slim = newer(conformed, mark).select(
        *[F.col(old).alias(f"kept_{new}") for new, old in fact.rename.items()],
        *sorted(asked),
        *fact.measures,
        *keep,
        "modified_date",
    )
    found = star_lookup(slim, dimensions, lookups)
    return found.select(
        *[F.col(f"kept_{new}").alias(new) for new in fact.rename],
        *[look.name for look in lookups],
        *fact.measures,
        "modified_date",
        *keep,
    )


def late_rows(name: str, fact_rows: DataFrame, conformed: DataFrame) -> DataFrame:
    """Conformed rows whose stored fact misses a key.

    Only facts identified by renamed source ids can be traced back to their source rows; of the others every
    conformed row that has the id of a late dimension row would have to be loaded again.
    """
    fact = FACTS[name]
    if not fact.rename:
        raise ValueError(f"{name} keeps no source id")
    missing = reduce(or_, [F.col(look.name).isNull() for look in fact.lookups])
    ids = fact_rows.filter(missing).select(*fact.rename).distinct()
    on = [ids[new].eqNullSafe(conformed[old]) for new, old in fact.rename.items()]
    return conformed.join(ids, on, "left_semi")


def relookup(name: str, fact_rows: DataFrame, conformed: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Facts that miss a key, looked up again: repairs the keys of dimension rows that came late."""
    return fact_load(name, late_rows(name, fact_rows, conformed), dimensions)
