"""Declared schemas (S1) and strict casting with reject counts."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names of the declarations and the decimal used when no precision is given.
TYPE_NAMES = {
    "IntegerType": T.IntegerType(),
    "StringType": T.StringType(),
    "FloatType": T.FloatType(),
    "DoubleType": T.DoubleType(),
    "DateType": T.DateType(),
    "TimestampType": T.TimestampType(),
    "BooleanType": T.BooleanType(),
}
DEFAULT_DECIMAL = T.DecimalType(19, 4)


class UnknownType(ValueError):
    """A declared type name that no Spark type answers to."""


def parse_type(name: str) -> T.DataType:
    """Spark type of a declared name; a misspelt name is an error, never a silent string."""
    name = name.strip()
    if name in TYPE_NAMES:
        return TYPE_NAMES[name]
    head, _, arguments = name.partition("(")
    if head != "DecimalType":
        raise UnknownType(name)
    numbers = [n.strip() for n in arguments.rstrip(")").split(",")]
    if len(numbers) == 2 and all(n.isdigit() for n in numbers):
        return T.DecimalType(int(numbers[0]), int(numbers[1]))
    return DEFAULT_DECIMAL


def parse_schema(declaration: str | dict) -> T.StructType:
    """``{"fields": [{"name", "type", "nullable"}]}`` as a ``StructType``."""
    spec = json.loads(declaration) if isinstance(declaration, str) else declaration
    return T.StructType(
        [T.StructField(f["name"], parse_type(f["type"]), f.get("nullable", True)) for f in spec["fields"]]
    )


# Short names used by the table layouts of this package.
SHORT_TYPES = {
    "int": "IntegerType",
    "bigint": "LongType",
    "string": "StringType",
    "date": "DateType",
    "timestamp": "TimestampType",
    "boolean": "BooleanType",
}


def ddl_schema(ddl: str) -> T.StructType:
    """``name type, ...`` as a ``StructType``, without needing a running session."""
    fields = []
    for item in split_ddl(ddl):
        name, kind = item.split(None, 1)
        if kind.startswith("decimal("):
            precision, scale = kind[len("decimal(") : -1].split(",")
            data_type = T.DecimalType(int(precision), int(scale))
        else:
            data_type = getattr(T, SHORT_TYPES[kind])()
        fields.append(T.StructField(name.strip("`"), data_type, True))
    return T.StructType(fields)


def _bare_name(column: str) -> Column:
    return F.col(f"`{column}`")


def _cast(column: str, wanted: T.DataType, present: T.DataType) -> Column:
    raw = _bare_name(column)
    if wanted == present:
        return raw
    if isinstance(wanted, T.TimestampType) and isinstance(present, T.StringType):
        return F.try_to_timestamp(raw)
    if isinstance(wanted, T.DateType) and isinstance(present, T.StringType):
        return F.to_date(F.try_to_timestamp(raw))
    if isinstance(wanted, T.IntegerType) and isinstance(present, T.StringType):
        # whole numbers written with a fraction of zeros ("12.0") are accepted, "12.5" is rejected
        number = raw.try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number).try_cast("int")
    return raw.try_cast(wanted)


def apply_schema(df: DataFrame, schema: T.StructType, *more: Column) -> DataFrame:
    """Columns in declared order, each cast on its own; bad values become NULL, missing columns NULL. ``more`` are added as they are."""
    present = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (_cast(f.name, f.dataType, present[f.name]) if f.name in present else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ],
        *more,
    )


def reject_metrics(df: DataFrame, schema: T.StructType) -> list[Column]:
    """Per column: how many values were present but could not be cast. For ``observe`` on the raw frame."""
    present = {f.name: f.dataType for f in df.schema.fields}
    return [
        F.count_if(
            _bare_name(f.name).isNotNull() & _cast(f.name, f.dataType, present[f.name]).isNull()
        ).alias(f"rejected_{f.name}")
        for f in schema.fields
        if f.name in present
    ]


REJECTS = "_rejects"


def rejected_values(df: DataFrame, schema: T.StructType, keys: Sequence[str] = ()) -> Column:
    """Per row the values that were present but could not be cast, with their column, text and reason, and the row's key as it came.

    Appended to the cast columns it is written in the same pass as they are; rows without rejects hold NULL.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    key = F.concat_ws("|", *[F.coalesce(_bare_name(k).cast("string"), F.lit("")) for k in keys if k in present])
    found = [
        F.when(
            _bare_name(f.name).isNotNull() & _cast(f.name, f.dataType, present[f.name]).isNull(),
            F.struct(
                key.alias("source_key"), F.lit(f.name).alias("column_name"), _bare_name(f.name).cast("string").alias("raw_value"),
                F.lit(f"not a {f.dataType.simpleString()}").alias("reason"),
            ),
        )
        for f in schema.fields
        if f.name in present and present[f.name] != f.dataType
    ]
    if not found:
        return F.lit(None).cast(REJECT_TYPE).alias(REJECTS)
    kept = F.filter(F.array(*found), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, kept).cast(REJECT_TYPE).alias(REJECTS)


REJECT_TYPE = "array<struct<source_key:string,column_name:string,raw_value:string,reason:string>>"


def reject_rows(frame: DataFrame) -> DataFrame:
    """One row per rejected value of a written frame that holds ``REJECTS``; no other column is read."""
    return frame.filter(F.col(REJECTS).isNotNull()).select(F.inline(REJECTS))


def reject_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row with the reject count of every declared column."""
    return df.agg(*reject_metrics(df, schema))


def length_checked(df: DataFrame, varchar_ddl: str) -> DataFrame:
    """Columns cast to a table layout; text longer than its VARCHAR(n) is an error, as on a table insert."""
    columns = []
    for item in split_ddl(varchar_ddl):
        name, kind = item.split(None, 1)
        kind = kind.replace("NOT NULL", "").replace("not null", "").strip()
        if kind.lower().startswith("varchar"):
            limit = int(kind[kind.index("(") + 1 : kind.index(")")])
            text = F.col(name).cast("string")
            problem = F.concat(F.lit(f"{name} longer than {limit}: "), text)
            columns.append(F.when(F.length(text) > limit, F.raise_error(problem)).otherwise(text).alias(name))
        elif kind.lower().startswith("timestamp"):
            columns.append(F.date_trunc("second", F.col(name) + F.expr("interval 500 milliseconds")).alias(name))
        else:
            columns.append(F.col(name).cast(kind).alias(name))
    return df.select(*columns)


def split_ddl(ddl: str) -> list[str]:
    """Column items of a DDL text, commas inside DECIMAL(p,s) kept together."""
    items, depth, start = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            items.append(ddl[start:i].strip())
            start = i + 1
    items.append(ddl[start:].strip())
    return [i for i in items if i]


def plain_ddl(varchar_ddl: str) -> str:
    """The same layout with VARCHAR(n) written as STRING, for parquet files and empty tables."""
    plain = []
    for item in split_ddl(varchar_ddl):
        name, kind = item.split(None, 1)
        plain.append(f"{name} {'string' if kind.lower().startswith('varchar') else kind.replace('NOT NULL', '').strip()}")
    return ", ".join(plain)
