"""Column profiles that are kept per load and merged instead of rescanned.

One pass over a batch gives, per column: rows, NULLs, least and greatest value, a HyperLogLog sketch of its distinct values, a KLL sketch of
its quantiles, and its most frequent values. All of these merge: the profile of a table is that of its loads put together, whatever their
number, at the cost of one small row per column and load. A profile describes what was loaded; a row loaded again in a new version counts again.

Numbers, dates and times have quantiles (of their number, or their seconds since 1970); texts and the rest have least and greatest text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_LG_K = 14  # standard error 1.04 / sqrt(2**14), below one percent
KLL_K = 400  # rank error of about 0.7 percent
TRACKED = 1_000  # values counted for the most frequent ones: exact up to so many distinct values
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
STATE_DDL = (
    "column_name string, row_count bigint, nulls bigint, least_number double, greatest_number double, least_text string, greatest_text string, "
    "distinct_sketch binary, quantile_sketch binary, frequent binary, frequent_tracked int"
)


def _number(column: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    if isinstance(kind, T.BooleanType):
        return column.cast("int").cast("double")
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp")) / 1e6
    return None


def _top_state(text: Column) -> Column:
    return F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED))


def profile_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column, to be stored with the load; all columns are summed up in one aggregate."""
    names = list(columns) if columns is not None else df.columns
    sums, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, name in enumerate(names):
        kind, value = df.schema[name].dataType, F.col(f"`{name}`")
        text, number = value.cast("string"), _number(value, kind)
        sums += [
            F.count(value).alias(f"n{i}"), F.hll_sketch_agg(text, F.lit(HLL_LG_K)).alias(f"d{i}"), _top_state(text).alias(f"t{i}"),
            (F.min(text) if number is None else F.min(number)).alias(f"a{i}"), (F.max(text) if number is None else F.max(number)).alias(f"b{i}"),
        ]
        if number is not None:
            sums.append(F.call_function("kll_sketch_agg_double", number, F.lit(KLL_K)).alias(f"q{i}"))
        none = lambda kind: F.lit(None).cast(kind)
        ends = (F.col(f"a{i}"), F.col(f"b{i}"))
        rows.append(F.struct(
            F.lit(name).alias("column_name"), F.col("rows").alias("row_count"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            *[(none("double") if number is None else e).alias(n) for e, n in zip(ends, ("least_number", "greatest_number"))],
            *[(e if number is None else none("string")).alias(n) for e, n in zip(ends, ("least_text", "greatest_text"))],
            F.col(f"d{i}").alias("distinct_sketch"),
            (none("binary") if number is None else F.when(F.col(f"n{i}") > 0, F.col(f"q{i}"))).alias("quantile_sketch"),
            F.when(F.col(f"n{i}") > 0, F.col(f"t{i}.sketch")).alias("frequent"), F.lit(TRACKED).alias("frequent_tracked"),
        ))
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def merged_profiles(states: DataFrame) -> DataFrame:
    """The profile of all loads together, from their rows; columns that only some loads have are NULL in no other."""
    top = F.struct(F.col("frequent").alias("sketch"), F.col("frequent_tracked").alias("maxItemsTracked"), F.lit(None).cast("string").alias("itemDataType"), F.lit("item STRING NOT NULL").alias("itemDataTypeDDL"))
    texts = states.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("nulls").alias("nulls"), F.min("least_number").alias("least_number"), F.max("greatest_number").alias("greatest_number"),
        F.min("least_text").alias("least_text"), F.max("greatest_text").alias("greatest_text"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
    )
    quantiles = states.filter("quantile_sketch IS NOT NULL").groupBy("column_name").agg(F.call_function("kll_merge_agg_double", F.col("quantile_sketch")).alias("quantile_sketch"))
    frequent = states.filter("frequent IS NOT NULL").groupBy("column_name").agg(F.call_function("approx_top_k_combine", top, F.lit(TRACKED)).alias("top"))
    joined = texts.join(quantiles, "column_name", "left").join(frequent, "column_name", "left")  # a row per column
    return joined.select(*texts.columns, "quantile_sketch", F.col("top.sketch").alias("frequent"), F.lit(TRACKED).alias("frequent_tracked"))


def described(states: DataFrame, top: int = 5, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """What a profile says: counts, ends, distinct values (estimated), quantiles (in rank within about a percent), most frequent values with their counts."""
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    state = F.struct(F.col("frequent").alias("sketch"), F.col("frequent_tracked").alias("maxItemsTracked"), F.lit(None).cast("string").alias("itemDataType"), F.lit("item STRING NOT NULL").alias("itemDataTypeDDL"))
    return states.select(
        "column_name", "row_count", "nulls", "least_number", "greatest_number", "least_text", "greatest_text",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        F.when(F.col("quantile_sketch").isNotNull(), F.call_function("kll_sketch_get_quantile_double", F.col("quantile_sketch"), at)).alias("quantiles"),
        F.when(F.col("frequent").isNotNull(), F.call_function("approx_top_k_estimate", state, F.lit(top))).alias("frequent"),
    )
