"""Interleaved-bit order over several columns (O1): files that are narrow in each of them, so that a filter on any one skips files.

A value's rank is the number of sampled cut values below it, ``BITS`` bits; the cuts of all columns come from one aggregate that keeps a
bounded sample per column, so ranks are even whatever the values are. The bits of the ranks are interleaved, highest first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 5  # ranks of a column: 2**BITS
ACCURACY = 10_000  # of the cut values: their rank is right to 1 / ACCURACY of the rows
_TEXT_BYTES = 6


def _position(column: str, kind: T.DataType) -> Column:
    """A number in the order of the column; of texts the first bytes count."""
    value = F.col(f"`{column}`")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    digits = F.rpad(F.hex(F.substring(value.cast("string").cast("binary"), 1, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0")
    return F.conv(digits, 16, 10).cast("double")


def interleaved(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``name``: the interleaved rank of these columns. NULL ranks lowest."""
    positions = [_position(c, df.schema[c].dataType) for c in columns]
    shares = F.array(*[F.lit(i / (1 << BITS)) for i in range(1, 1 << BITS)])
    cuts = df.agg(*[F.percentile_approx(p, shares, ACCURACY).alias(f"c{i}") for i, p in enumerate(positions)]).first()  # numbers, 2**BITS a column
    bits = []
    for i, position in enumerate(positions):
        at = sorted(set(cuts[i] or []))
        rank = reduce(add, [F.when(position > cut, 1).otherwise(0) for cut in at], F.lit(0))
        for bit in range(BITS):
            bits.append(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(columns) + len(columns) - 1 - i))
    return df.withColumn(name, reduce(add, bits).cast("int"))
