"""Keyed upserts as joins (M1-M8).

``merge_frame`` is lazy: it returns the target's rows after the merge plus an ``_action`` column.
A row is updated only if its key is found on both sides and ``when`` is TRUE, so a NULL comparison
keeps the old row. Keys compare by plain equality: rows with a NULL key never match, are kept on the
target side and inserted from the source side. ``null_safe`` makes NULL keys equal.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "_action"
KEEP, UPDATE, INSERT = "keep", "update", "insert"
_IN_TARGET, _IN_SOURCE = "_in_target", "_in_source"

Condition = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Differs:
    """A condition that holds where a column has another value; NULL on either side does not count as another one."""

    column: str

    def __call__(self, target: Callable[[str], Column], source: Callable[[str], Column]) -> Column:
        return target(self.column) != source(self.column)

    def sql(self) -> str:
        return f"t.`{self.column}` <> s.`{self.column}`"


def hash_differs(column: str = "row_hash") -> Condition:
    """Update only rows whose hash changed (M3)."""
    return Differs(column)


def date_differs(column: str = "modified_date") -> Condition:
    """Update only rows whose modified time changed (M4)."""
    return Differs(column)


def _old(name: str) -> Column:
    return F.col(f"`_t_{name}`")


def _new(name: str) -> Column:
    return F.col(f"`_s_{name}`")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _prefixed(df: DataFrame, prefix: str, mark: str) -> DataFrame:
    """All columns renamed, plus a presence mark: a missing side is told by the mark, never by a NULL key."""
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns], F.lit(True).alias(mark))


def merge_frame(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Mapping[str, str] | Sequence[str] | None = None,
    insert: Mapping[str, str] | None = None,
    when: Condition | None = None,
    null_safe: bool = False,
    small_source: bool = False,
) -> DataFrame:
    """Target after the merge, with ``_action``.

    ``update`` maps target columns to source columns (default: every non-key column present in the
    source); ``insert`` likewise (default: every target column present in the source, NULL elsewhere).

    Two plans give the same rows. By default both sides are hash-partitioned once by the key and
    joined full outer. With ``small_source`` (the caller has measured it, see ``sources.store``) the
    target is not shuffled at all: the source is broadcast to it, and new keys are found by an anti
    join against the few target keys that matched.

    Rows with a NULL key skip the join on both sides: they can hold a large share of the data and would
    all hash to one task. On a parquet scan their branch is an IS NULL filter that row-group statistics
    answer, so it reads next to nothing.
    """
    arriving = set(source.columns)
    if update is None:
        update = {c: c for c in target.columns if c in arriving and c not in keys}
    elif not isinstance(update, Mapping):
        update = {c: c for c in update}
    if insert is None:
        insert = {c: c for c in target.columns if c in arriving}
    types = {f.name: f.dataType for f in target.schema.fields}

    def fresh(read: Callable[[str], Column]) -> list[Column]:
        return [(read(insert[c]) if c in insert else F.lit(None)).cast(types[c]).alias(c) for c in target.columns]

    changed = F.col(_IN_SOURCE).isNotNull()
    if when is not None:
        changed = changed & F.coalesce(when(_old, _new), F.lit(False))
    action = F.when(changed, F.lit(UPDATE)).otherwise(F.lit(KEEP))

    def settled(c: str) -> Column:
        if c not in update:
            return _old(c)
        return F.when(F.col(ACTION) == UPDATE, _new(update[c]).cast(types[c])).otherwise(_old(c))

    left, right = target, source
    parts: list[DataFrame] = []
    if not null_safe:
        left, right = target.filter(~_any_null(keys)), source.filter(~_any_null(keys))
        parts = [
            target.filter(_any_null(keys)).select("*", F.lit(KEEP).alias(ACTION)),
            source.filter(_any_null(keys)).select(*fresh(F.col), F.lit(INSERT).alias(ACTION)),
        ]
    t, s = _prefixed(left, "_t_", _IN_TARGET), _prefixed(right, "_s_", _IN_SOURCE)
    tests = [_old(k).eqNullSafe(_new(k)) if null_safe else _old(k) == _new(k) for k in keys]
    on = reduce(lambda a, b: a & b, tests)

    if small_source:
        s = F.broadcast(s)  # measured by the caller: rows and bytes of the staged batch are known
        merged = t.join(s, on, "left").withColumn(ACTION, action)
        merged = merged.select(*[settled(c).alias(c) for c in target.columns], ACTION)
        found = t.select(*[_old(k) for k in keys]).join(s.select(*[_new(k) for k in keys]), on, "left_semi")
        added = s.join(found.distinct(), on, "left_anti")
        parts.append(added.select(*fresh(_new), F.lit(INSERT).alias(ACTION)))
    else:
        merged = t.join(s, on, "full_outer")
        merged = merged.withColumn(ACTION, F.when(F.col(_IN_TARGET).isNull(), F.lit(INSERT)).otherwise(action))
        born = {c: value for c, value in zip(target.columns, fresh(_new))}
        merged = merged.select(
            *[F.when(F.col(ACTION) == INSERT, born[c]).otherwise(settled(c)).alias(c) for c in target.columns],
            ACTION,
        )
    return reduce(DataFrame.unionByName, parts, merged)


class NotExpressible(ValueError):
    """A merge rule that has no SQL text."""


def merge_statement(
    table: str, source: str, target_columns: Sequence[str], source_columns: Sequence[str], keys: Sequence[str], *,
    update: Mapping[str, str] | Sequence[str] | None = None, insert: Mapping[str, str] | None = None, when: Condition | None = None, null_safe: bool = False,
) -> str:
    """The same merge as ``merge_frame`` as a MERGE statement, for catalogs whose tables have transactions (M1-M4).

    The rules are the same objects with the same defaults. NULL keys match nothing, as in ``merge_frame``, since ``=`` does not hold for them.
    """
    if when is not None and not isinstance(when, Differs):
        raise NotExpressible("the condition has no SQL text")
    arriving = set(source_columns)
    if update is None:
        update = {c: c for c in target_columns if c in arriving and c not in keys}
    elif not isinstance(update, Mapping):
        update = {c: c for c in update}
    if insert is None:
        insert = {c: c for c in target_columns if c in arriving}
    equal = "<=>" if null_safe else "="
    lines = [f"MERGE INTO {table} AS t USING {source} AS s", "ON " + " AND ".join(f"t.`{k}` {equal} s.`{k}`" for k in keys)]
    if update:
        changed = f" AND {when.sql()}" if when is not None else ""
        lines.append(f"WHEN MATCHED{changed} THEN UPDATE SET " + ", ".join(f"t.`{c}` = s.`{x}`" for c, x in update.items()))
    values = [f"s.`{insert[c]}`" if c in insert else "NULL" for c in target_columns]
    lines.append(f"WHEN NOT MATCHED THEN INSERT ({', '.join(f'`{c}`' for c in target_columns)}) VALUES ({', '.join(values)})")
    return "\n".join(lines)


def merged_rows(merged: DataFrame) -> DataFrame:
    return merged.drop(ACTION)


def action_metrics() -> list[Column]:
    """Counts for ``DataFrame.observe`` on the write of a merge: one pass, no re-scan (M8)."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(ACTION) == INSERT).alias("inserted"),
        F.count_if(F.col(ACTION) == UPDATE).alias("updated"),
    ]


def action_counts(merged: DataFrame) -> DataFrame:
    """One row: rows inserted, updated, kept, and changed in total (M8, M9)."""
    return merged.agg(
        F.count_if(F.col(ACTION) == INSERT).alias("inserted"),
        F.count_if(F.col(ACTION) == UPDATE).alias("updated"),
        F.count_if(F.col(ACTION) == KEEP).alias("kept"),
        F.count_if(F.col(ACTION) != KEEP).alias("rows_changed"),
    )


def repeated_keys(source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Keys that occur more than once, those with NULLs only if NULLs are equal; partial counts are combined before the shuffle."""
    able = source if null_safe else source.filter(~_any_null(keys))
    return able.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


class DuplicateSourceKey(ValueError):
    """A source key that matches the target occurs more than once."""


def check_source(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> None:
    """Refuse a batch in which several rows match one target row.

    Duplicates that match nothing are legal, both rows are inserted. The target is read only if the
    batch repeats a key at all. ``null_safe`` as in the merge: NULL keys then repeat and match like others.
    """
    repeated = repeated_keys(source, keys, null_safe)
    if repeated.isEmpty():
        return
    held = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    tests = [F.col(k).eqNullSafe(_old(k)) if null_safe else F.col(k) == _old(k) for k in keys]
    clash = repeated.join(held, reduce(lambda a, b: a & b, tests), "left_semi").limit(5).collect()
    if clash:
        raise DuplicateSourceKey(f"source rows match one target row more than once, e.g. {clash}")


def replace_range(current: DataFrame, fresh: DataFrame, column: str, start, end) -> DataFrame:
    """Rows of ``current`` outside [start, end] plus ``fresh`` (M6). NULL is outside any range."""
    inside = F.coalesce(F.col(column).between(F.lit(start), F.lit(end)), F.lit(False))
    return current.filter(~inside).unionByName(fresh)
