"""Data-quality checks (D1-D6): one pass per table, counts only, no rows on the driver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.session import written
from tidewright.sources.schema import split_ddl


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table."""
    counted = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def reconcile(left: Mapping[str, DataFrame], right: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of the same tables in two layers, with the difference."""
    a = row_counts(left).withColumnRenamed("row_count", "left_count")
    b = row_counts(right).withColumnRenamed("row_count", "right_count")
    joined = a.join(b, "table_name", "full_outer")
    return joined.withColumn("difference", F.coalesce("left_count", F.lit(0)) - F.coalesce("right_count", F.lit(0)))


RANGE_KEYS = 100_000  # values of a whole-number key in one range
RANGE_BUCKETS = 4_096  # ranges of the hash of any other key


def _range(df: DataFrame, keys: Sequence[str], width: int) -> Column:
    first = df.schema[keys[0]].dataType
    part = F.floor(F.col(f"`{keys[0]}`") / width) if isinstance(first, T.IntegralType) else F.pmod(F.xxhash64(*keys), F.lit(RANGE_BUCKETS))
    return F.coalesce(part.cast("long"), F.lit(-1).cast("long"))


def _row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Of the named columns in their order; a NULL is told from an empty text and from a NULL in another column."""
    values = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*values, *[v.isNull() for v in values])


def content_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str], width: int = RANGE_KEYS) -> DataFrame:
    """Per range of keys its rows and the sum of their hashes, which does not depend on their order (D1). One partial row per range and task is shuffled."""
    hashed = df.select(_range(df, keys, width).alias("key_range"), _row_hash(df, columns).cast("decimal(20,0)").alias("h"))
    return hashed.groupBy("key_range").agg(F.count(F.lit(1)).alias("row_count"), F.sum("h").alias("content"))


def differing_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int = RANGE_KEYS) -> DataFrame:
    """Ranges of keys in which two tables of the same columns do not hold the same rows (D1): found by their sums, no row is joined."""
    columns = sorted(left.columns)
    if columns != sorted(right.columns):
        raise ValueError("the tables have different columns")
    a, b = (content_sums(df, keys, columns, width).withColumnsRenamed({"row_count": f"{n}_count", "content": f"{n}_content"}) for df, n in ((left, "left"), (right, "right")))
    both = a.join(b, "key_range", "full_outer")
    same = F.col("left_content").eqNullSafe(F.col("right_content")) & F.col("left_count").eqNullSafe(F.col("right_count"))
    return both.filter(~same).select("key_range", *[F.coalesce(f"{n}_count", F.lit(0)).alias(f"{n}_count") for n in ("left", "right")])


def differing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int = RANGE_KEYS) -> DataFrame:
    """Keys whose rows differ, with ``difference``: changed, left only or right only (D1). Only rows of differing ranges are compared one by one."""
    columns = sorted(left.columns)
    ranges = written(differing_ranges(left, right, keys, width), "ranges").select("key_range")

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = df.withColumn("key_range", _range(df, keys, width)).join(ranges, "key_range", "left_semi")
        hashed = rows.select(*[F.col(f"`{k}`") for k in keys], _row_hash(df, columns).cast("decimal(20,0)").alias("h"))
        return hashed.groupBy(*keys).agg(F.struct(F.count(F.lit(1)), F.sum("h")).alias(name))  # keys may repeat

    a, b = side(left, "_left"), side(right, "_right").withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys])
    both = a.join(b, on, "full_outer").filter(~F.col("_left").eqNullSafe(F.col("_right")))
    kind = F.when(F.col("_right").isNull(), "left only").when(F.col("_left").isNull(), "right only").otherwise("changed")
    return both.select(*[F.when(F.col("_left").isNull(), F.col(f"`_r_{k}`")).otherwise(F.col(f"`{k}`")).alias(k) for k in keys], kind.alias("difference"))


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: nulls and rows (D2). All counts come from one aggregate, unpivoted afterwards."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"n_{i}")).alias("nulls"), F.col("_rows").alias("row_count"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys included, with their number of rows (D3)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys, keys that repeat, rows in excess (D3)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("copies") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("excess_rows"),
    )


def orphans(fact: DataFrame, lookup_columns: Sequence[str]) -> DataFrame:
    """Per key column: facts whose dimension was not found."""
    profile = null_profile(fact.select(*lookup_columns))
    return profile.select("column_name", F.col("nulls").alias("orphan_rows"), "row_count")


def orphan_keys(fact: DataFrame, on: str, dimension: DataFrame, key: str) -> DataFrame:
    """The source ids that no dimension row answers to, with their rows; ids are counted before the join."""
    per_id = fact.groupBy(on).agg(F.count(F.lit(1)).alias("orphan_rows"))
    return per_id.join(dimension.select(key), F.col(on) == F.col(key), "left_anti")


def freshness(marks: DataFrame, now: dt.datetime) -> DataFrame:
    """Whole hours since the newest loaded change of each table."""
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("max_modified_date")
    return marks.select("table_name", "layer_type", "max_modified_date", F.floor(age / 3600).alias("hours_behind"))


def too_long(df: DataFrame, varchar_ddl: str) -> DataFrame:
    """Per VARCHAR(n) column: values longer than n."""
    limits = {}
    for item in split_ddl(varchar_ddl):
        name, kind = item.split(None, 1)
        if kind.lower().startswith("varchar"):
            limits[name] = int(kind[kind.index("(") + 1 : kind.index(")")])
    counts = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_length"), F.col(c).alias("too_long")) for c, n in limits.items()]
    return counts.select(F.inline(F.array(*entries)))
