"""Star lookup (J9): facts left-joined to dimensions by natural key, unmatched rows get NULL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


NULL_SPREAD = 64


@dataclass(frozen=True)
class Lookup:
    """``fact.on`` is looked up in ``dimension.key``; the fact gets ``dimension.value`` under ``name``.

    ``exact_time`` keeps the plain comparison of a date with a timestamp, which holds only at midnight;
    without it the fact's time is cut to its day first.
    """

    dimension: str
    key: str
    on: str
    name: str
    value: str | None = None
    exact_time: bool = True
    cast: str | None = None


def _stand_in(place: Column, kind: T.DataType) -> Column:
    """A value of the key's type for each place; it need not be free, rows that hold it match nothing."""
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.date_sub(F.lit("1900-01-01").cast("date"), place).cast(kind)
    return (-place).cast(kind)


def star_lookup(fact: DataFrame, dimensions: Mapping[str, DataFrame], lookups: Sequence[Lookup]) -> DataFrame:
    """Each dimension is cut to its key (and value) before the join.

    No broadcast is forced: the dimensions grow with the business. Catalyst broadcasts those whose size
    is known to lie under ``spark.sql.autoBroadcastJoinThreshold``; the others are joined by a shuffle on
    the key, where AQE splits a hot key of the fact side. NULL keys, often the largest group, match nothing: stand-ins,
    picked by the row's other natural keys, spread them over ``NULL_SPREAD`` places, so that they do not meet in one task. The join keeps
    a single key: that of a whole number takes a fraction of the memory of a broadcast dimension with two.
    """
    # the natural keys alone: all of them are read anyway, any other column would be kept from being pruned
    keys = F.xxhash64(*dict.fromkeys(look.on for look in lookups))
    for look in lookups:
        value = look.value or look.key
        held = f"_{look.name}_key"
        dim = dimensions[look.dimension].select(F.col(look.key).alias(held), *([] if value == look.key else [F.col(value).alias(f"_{look.name}_value")]))
        asked = F.col(look.on)
        if not look.exact_time:
            asked = F.to_date(asked)
        if look.cast:
            asked = asked.try_cast(look.cast)
        kind = fact.select(asked.alias("asked")).schema["asked"].dataType
        spread = F.coalesce(asked, _stand_in(F.pmod(keys, F.lit(NULL_SPREAD)).cast("int") + 1, kind))
        fact = fact.join(dim, (spread == F.col(held)) & asked.isNotNull(), "left")
    names = {look.name for look in lookups}
    found = [F.col(f"_{look.name}_{'key' if look.value in (None, look.key) else 'value'}").alias(look.name) for look in lookups]
    return fact.select(*[c for c in fact.columns if c not in names and not c.startswith("_")], *found)
