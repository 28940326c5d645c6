"""One row per group (W1, W2, D6) as aggregates, combined map-side: a row_number window would shuffle every row.

A struct buffer makes Spark sort each task's rows by key on both sides of the shuffle; what is shuffled stays one row per key and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _packed(df: DataFrame, keys: Sequence[str]) -> tuple[Column, list[str]]:
    rest = [c for c in df.columns if c not in keys]
    return F.struct(*[F.col(c) for c in rest]), rest


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Row with the smallest ordering value per key; NULL sorts first, as in a T-SQL ORDER BY.

    ``min`` over a struct keeps one candidate per key and map task, so a key holding a third of the
    rows shuffles a handful of rows. Ties are settled by the remaining columns: the result is stable.
    """
    row, rest = _packed(df, keys)
    sort = [F.col(o) if isinstance(o, str) else o for o in order]
    ranked = F.struct(*[s.alias(f"o{i}") for i, s in enumerate(sort)], row.alias("row"))
    picked = df.groupBy(*keys).agg(F.min(ranked).alias("_pick"))
    return picked.select(*keys, *[F.col(f"_pick.row.{c}").alias(c) for c in rest])


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Row with the largest ordering values per key (descending order, NULL last)."""
    row, rest = _packed(df, keys)
    sort = [F.col(o) if isinstance(o, str) else o for o in order]
    ranked = F.struct(*[s.alias(f"o{i}") for i, s in enumerate(sort)], row.alias("row"))
    picked = df.groupBy(*keys).agg(F.max(ranked).alias("_pick"))
    return picked.select(*keys, *[F.col(f"_pick.row.{c}").alias(c) for c in rest])


def deduplicated(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The latest row of each business key."""
    return latest_per_group(df, keys, order)
