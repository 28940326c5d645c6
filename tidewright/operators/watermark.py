"""High-water marks of incremental loads.

The control table has one row per (table_name, layer_type). ``row_count`` is the size of the table after
the load, ``rows_changed`` what this load inserted and updated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.scalars import EPOCH_START

WATERMARK_DDL = (
    "table_name string, max_modified_date timestamp, layer_type string, "
    "last_load_time timestamp, row_count bigint, rows_changed bigint"
)
WATERMARK_KEYS = ["table_name", "layer_type"]


def empty_watermarks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], WATERMARK_DDL)


def last_mark(marks: DataFrame, table: str, layer: str) -> dt.datetime | None:
    """The stored mark, or None if the row is missing or holds NULL (I1). One row reaches the driver."""
    row = (
        marks.filter((F.col("table_name") == table) & (F.col("layer_type") == layer))
        .agg(F.max("max_modified_date").alias("mark"))
        .first()
    )
    return row["mark"]


def mark_or_start(marks: DataFrame, table: str, layer: str) -> dt.datetime:
    """The stored mark, or 1900-01-01 if missing or NULL."""
    return last_mark(marks, table, layer) or EPOCH_START


def next_mark(
    observed_max: dt.datetime | None,
    previous: dt.datetime | None,
    load_ts: dt.datetime,
    rule: str = "data",
) -> dt.datetime | None:
    """The mark to store after a load.

    ``data``: newest time seen, else the old mark. ``load_time``: the time of the load (hash-diff
    tables). ``data_or_now``: newest time seen, else the load time (raw layer).
    """
    if rule == "load_time":
        return load_ts
    if rule == "data_or_now":
        return observed_max or load_ts
    if rule != "data":
        raise ValueError(f"unknown watermark rule: {rule}")
    return observed_max or previous


def mark_row(
    spark: SparkSession,
    table: str,
    layer: str,
    mark: dt.datetime | None,
    load_ts: dt.datetime,
    row_count: int | None,
    rows_changed: int | None,
) -> DataFrame:
    return spark.createDataFrame([(table, mark, layer, load_ts, row_count, rows_changed)], WATERMARK_DDL)


def marks_of(data: DataFrame, table: str, layer: str, time_column: str, load_ts: dt.datetime) -> DataFrame:
    """Control row computed from the data itself: newest time and row count in one aggregate (A3)."""
    return data.agg(F.max(time_column).alias("newest"), F.count(F.lit(1)).alias("rows")).select(
        F.lit(table).alias("table_name"),
        F.col("newest").cast("timestamp").alias("max_modified_date"),
        F.lit(layer).alias("layer_type"),
        F.lit(load_ts).cast("timestamp").alias("last_load_time"),
        F.col("rows").alias("row_count"),
        F.col("rows").alias("rows_changed"),
    )


def record(marks: DataFrame, rows: DataFrame) -> DataFrame:
    """Control table after the upsert of ``rows`` by (table_name, layer_type).

    A NULL mark in ``rows`` keeps the old one. Old and new rows meet in one aggregate, without a join.
    """
    both = marks.withColumn("is_new", F.lit(False)).unionByName(rows.withColumn("is_new", F.lit(True)))
    new_mark = F.max(F.when(F.col("is_new"), F.col("max_modified_date")))
    rest = [F.max_by(c, "is_new").alias(c) for c in ("last_load_time", "row_count", "rows_changed")]
    grouped = both.groupBy(*WATERMARK_KEYS).agg(
        F.coalesce(new_mark, F.max("max_modified_date")).alias("max_modified_date"), *rest
    )
    return grouped.select(*marks.columns)


def latest(log: DataFrame) -> DataFrame:
    """Control rows from a log of them (I4, I5): per (table_name, layer_type) the one with the largest run number.

    A NULL mark does not replace an earlier one.
    """
    marked = F.when(F.col("max_modified_date").isNotNull(), F.col("run"))
    rest = [F.max_by(c, "run").alias(c) for c in ("last_load_time", "row_count", "rows_changed")]
    grouped = log.groupBy(*WATERMARK_KEYS).agg(F.max_by("max_modified_date", marked).alias("max_modified_date"), *rest)
    return grouped.select("table_name", "max_modified_date", "layer_type", "last_load_time", "row_count", "rows_changed")
