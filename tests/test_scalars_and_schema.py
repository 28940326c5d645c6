from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.erp import at
from tidewright.functions import scalars as fx
from tidewright.sources import schema as sc
from tidewright.sources.landing import incremental_extract, read_landing
from tidewright.sources.raw_tables import RAW_TABLES


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ts(value: dt.datetime):
    return F.lit(value).cast("timestamp")


def test_round_second_halves_go_up(spark):
    got = one(spark, fx.round_second(ts(at(1, 0, 0, 0, 499999))), fx.round_second(ts(at(1, 0, 0, 0, 500000))))
    assert got == (at(1), at(1, 0, 0, 1))


def test_newer_than_equals_the_rounded_comparison(spark):
    mark = at(5, 12)
    offsets = [-2_000_000, -500_001, -500_000, -1, 0, 1, 499_999, 500_000, 500_001, 1_000_000]
    rows = spark.createDataFrame([(mark + dt.timedelta(microseconds=o),) for o in offsets], "t timestamp")
    both = rows.select(fx.newer_than(F.col("t"), mark).alias("a"), (fx.round_second(F.col("t")) > F.lit(mark)).alias("b"))
    assert all(r.a == r.b for r in both.collect())


def test_later_of_lets_a_missing_right_side_win(spark):
    early, late, none = ts(at(1)), ts(at(2)), F.lit(None).cast("timestamp")
    assert one(spark, fx.later_of(late, early), fx.later_of(early, late)) == (at(2), at(2))
    assert one(spark, fx.later_of(late, none), fx.later_of(none, late)) == (None, at(2))


def test_null_concatenation(spark):
    null = F.lit(None).cast("string")
    assert one(spark, fx.concat_blank(F.lit("Ann"), F.lit(" "), null), F.concat(F.lit("Ann"), F.lit(" "), null)) == ("Ann ", None)


def test_row_hash_separates_columns_and_reads_null_as_blank(spark):
    a = fx.row_hash(F.lit("ab"), F.lit("c"))
    b = fx.row_hash(F.lit("a"), F.lit("bc"))
    blank = fx.row_hash(F.lit("x"), F.lit(None))
    x, y, z, w = one(spark, a, b, blank, fx.row_hash(F.lit("x"), F.lit("")))
    assert x != y and z == w and len(z) == 32 and z == z.lower()


def test_hash_text_is_cut_at_thirty_characters(spark):
    assert one(spark, fx.cast_varchar(F.lit("x" * 31))) == ("x" * 30,)


def test_money_rounds_half_up(spark):
    assert one(spark, fx.money(F.lit(Decimal("0.025"))), fx.money(F.lit(Decimal("1.2350")))) == (Decimal("0.03"), Decimal("1.24"))


def test_tail_int_rejects_bad_text(spark):
    assert one(spark, fx.tail_int(F.lit("CRM0042"))) == (42,)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fx.tail_int(F.lit("CRM00x2")))


def test_month_of_key_keeps_null(spark):
    assert one(spark, fx.month_of_key(F.lit(20240305)), fx.month_of_key(F.lit(None).cast("int"))) == ("2024-03", None)


def test_declared_types():
    got = sc.parse_schema(
        '{"fields":[{"name":"a","type":"DecimalType(8, 2)"},{"name":"b","type":"DecimalType"},'
        '{"name":"c","type":"TimestampType","nullable":false}]}'
    )
    assert [f.dataType for f in got] == [T.DecimalType(8, 2), T.DecimalType(19, 4), T.TimestampType()]
    assert [f.nullable for f in got] == [True, True, False]


def test_misspelt_type_is_an_error():
    with pytest.raises(sc.UnknownType):
        sc.parse_type("IntergerType")


def test_raw_tables_are_complete():
    declared = [t for t in RAW_TABLES.values() if t.time_column == "ModifiedDate"]
    assert len(declared) == 29
    assert sum(t.has_full for t in declared) == 28 and sum(t.has_incremental for t in declared) == 28
    for t in RAW_TABLES.values():
        assert set(t.keys) <= set(t.schema.names)
    assert RAW_TABLES["product"].schema["ReorderPoint"].dataType == T.IntegerType()


def test_strict_cast_counts_rejects(spark):
    landed = spark.createDataFrame(
        [("1", "2024-01-05T10:00:00+02:00", "3.5", "2024-02-30"), ("x", "bad", None, "2024-02-29"), ("2.0", None, "1", None)],
        "id string, t string, d string, day string",
    )
    schema = sc.ddl_schema("id int, t timestamp, d decimal(19,4), day date")
    rows = [tuple(r) for r in sc.apply_schema(landed, schema).collect()]
    assert rows[0] == (1, dt.datetime(2024, 1, 5, 8), Decimal("3.5000"), None)
    assert rows[1] == (None, None, None, dt.date(2024, 2, 29))
    assert rows[2][0] == 2
    assert sc.reject_counts(landed, schema).first().asDict() == {
        "rejected_id": 1,
        "rejected_t": 1,
        "rejected_d": 0,
        "rejected_day": 1,
    }


def test_varchar_overflow_is_an_error(spark):
    df = spark.createDataFrame([("abcdef", dt.datetime(2024, 1, 1, 0, 0, 0, 600000))], "code string, t timestamp")
    ok = sc.length_checked(df, "code VARCHAR(6), t TIMESTAMP").first()
    assert tuple(ok) == ("abcdef", at(1, 0, 0, 1))
    with pytest.raises(Exception, match="code longer than 5"):
        sc.length_checked(df, "code VARCHAR(5), t TIMESTAMP").collect()


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet", "orc"])
def test_landing_formats_and_incremental_filter(spark, tmp_path, fmt):
    table = RAW_TABLES["shift"]
    rows = spark.createDataFrame(
        [(1, "Day", "07:00", "15:00", at(1)), (2, "Night", "23:00", "07:00", at(2))], table.schema
    )
    path = str(tmp_path / fmt)
    writer = rows.write.option("header", "true") if fmt == "csv" else rows.write
    writer.format(fmt).save(path)
    landed = read_landing(spark, path, fmt, table.schema)
    assert incremental_extract(landed, table, None).count() == 2
    # strictly newer: a row at the mark is not read again
    newer = incremental_extract(landed, table, at(1)).collect()
    assert [r.ShiftID for r in newer] == [2]
    assert incremental_extract(landed, table, at(2), lookback=dt.timedelta(days=1)).count() == 1


def test_time_filter_reaches_the_parquet_scan(spark, tmp_path):
    table = RAW_TABLES["shift"]
    spark.createDataFrame([(1, "Day", "07:00", "15:00", at(1))], table.schema).write.parquet(str(tmp_path / "p"))
    df = incremental_extract(spark.read.parquet(str(tmp_path / "p")), table, at(1)).select("ShiftID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ModifiedDate" in plan and "StartTime" not in plan.split("ReadSchema")[-1]
