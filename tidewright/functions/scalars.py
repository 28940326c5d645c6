"""Scalar column helpers (F1-F20, P2, P7-P10): every one is a native expression, none is a UDF."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the results and must stay as they are.
EPOCH_START = dt.datetime(1900, 1, 1)  # watermark of a table that was never loaded
VARCHAR_DEFAULT = 30  # length of a VARCHAR cast without a length
HASH_SEPARATOR = "|"
NO_MEMBER = -1  # stands for "no sales person" / "no territory"
INBOUND_TYPES = ("P", "W")  # stock movement codes that add units
OUTBOUND_TYPES = ("S", "I")  # stock movement codes that remove units
QUARTER_NAMES = ("I", "II", "III", "IV")


def money(value: Column, scale: int = 2) -> Column:
    """Amount as DECIMAL(18, scale), rounded half up."""
    return value.cast(f"decimal(18,{scale})")


def round_second(ts: Column) -> Column:
    """Timestamp rounded half up to the whole second."""
    return F.date_trunc("second", ts + F.expr("interval 500 milliseconds"))


def newer_than(ts: Column, mark: dt.datetime) -> Column:
    """``round_second(ts) > mark`` written on the bare column, so that it reaches the scan.

    For a whole-second mark the rounded time is later exactly when the raw time is at least half a
    second later. A mark with a fraction keeps its strict comparison.
    """
    if mark.microsecond:
        return ts > F.lit(mark)
    return ts >= F.lit(mark + dt.timedelta(milliseconds=500))


def later_of(left: Column, right: Column) -> Column:
    """The later of two times; NULL on the right wins, unlike ``greatest`` (P10)."""
    return F.when(left > right, left).otherwise(right)


def concat_blank(*parts: Column) -> Column:
    """Concatenation that reads NULL as the empty string (F1)."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def cast_varchar(value: Column, length: int = VARCHAR_DEFAULT) -> Column:
    """Text form cut at ``length`` characters."""
    return F.substring(value.cast("string"), 1, length)


def time_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def row_hash(*parts: Column) -> Column:
    """Lower-case MD5 over the parts joined by a bar, NULL as empty text."""
    filled = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *filled))


def tail_int(text: Column, length: int | None = 4) -> Column:
    """Integer held in the last characters; bad text is an error under ANSI mode.

    Without a length all digits at the end count, so that numbers of five and more digits keep theirs.
    """
    if length is None:
        return F.regexp_extract(F.rtrim(text), r"([0-9]+)$", 1).try_cast("int")
    return F.right(text, F.lit(length)).cast("int")


def same_text(left: Column, right: Column) -> Column:
    """Text equality that ignores trailing blanks, on either side."""
    return F.rtrim(left) == F.rtrim(right)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def or_no_member(value: Column) -> Column:
    return F.coalesce(value, F.lit(NO_MEMBER))


def units_in(kind: Column, quantity: Column) -> Column:
    """Quantity of an inbound movement, 0 for every other code."""
    return F.when(kind.isin(*INBOUND_TYPES), quantity).otherwise(F.lit(0))


def units_out(kind: Column, quantity: Column) -> Column:
    return F.when(kind.isin(*OUTBOUND_TYPES), quantity).otherwise(F.lit(0))


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_of_key(key: Column) -> Column:
    """``yyyy-MM`` of an integer date key, without a calendar join; NULL stays NULL."""
    text = key.cast("string")
    return F.concat(F.left(text, F.lit(4)), F.lit("-"), F.substring(text, 5, 2))


def quarter_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(q) for q in QUARTER_NAMES]), F.quarter(day))

