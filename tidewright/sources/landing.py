"""Partitioned scans of landing files and JDBC tables: full (S2) and newer than a mark (S3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.sources.raw_tables import RawTable
from tidewright.sources.schema import apply_schema

TEXT_FORMATS = ("json", "csv")


def read_landing(spark: SparkSession, path: str, fmt: str, schema: T.StructType, **options) -> DataFrame:
    """Landing files as they are written. JSON and CSV are read as text so that bad values can be counted."""
    reader = spark.read.format(fmt).options(**options)
    if fmt in TEXT_FORMATS:
        text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
        reader = reader.schema(text)
        if fmt == "csv":
            reader = reader.option("header", "true")
    return reader.load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """One connection per partition of the key range; filters and columns are pushed into the source query."""
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties={"fetchsize": "10000", **(properties or {})},
    )


def newer_rows(
    df: DataFrame,
    time_column: str,
    mark: dt.datetime | None,
    lookback: dt.timedelta = dt.timedelta(0),
) -> DataFrame:
    """Rows strictly newer than the mark; no mark means all rows.

    The predicate stays on the bare column and so reaches a parquet or JDBC scan. ``lookback`` re-reads
    a stretch before the mark; upserts make the repeat harmless.
    """
    if mark is None:
        return df
    return df.filter(F.col(time_column) > F.lit(mark - lookback))


def full_extract(raw: DataFrame, table: RawTable, *more: Column) -> DataFrame:
    return apply_schema(raw, table.schema, *more)


def incremental_extract(
    raw: DataFrame, table: RawTable, mark: dt.datetime | None, lookback: dt.timedelta = dt.timedelta(0), *more: Column
) -> DataFrame:
    """Typed sources are filtered on the bare column; of text sources rows whose time cannot be read are kept as well."""
    if table.time_column is None:
        raise ValueError(f"{table.name} has no time column to extract by")
    kind = raw.schema[table.time_column].dataType
    if isinstance(kind, T.StringType):
        if mark is None:
            return apply_schema(raw, table.schema, *more)
        # a time that is there but cannot be read keeps its row: it is counted, never dropped
        time = F.try_to_timestamp(F.col(f"`{table.time_column}`"))
        unread = F.col(f"`{table.time_column}`").isNotNull() & time.isNull()
        return apply_schema(raw.filter(unread | (time > F.lit(mark - lookback))), table.schema, *more)
    return apply_schema(newer_rows(raw, table.time_column, mark, lookback), table.schema, *more)
