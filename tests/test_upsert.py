from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.erp import at, rows_of
from tidewright.operators import upsert as up
from tidewright.operators import watermark as wm

LAYOUT = "k int, g int, v string, h string"
ROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.integers(0, 1)), st.sampled_from("abc"),
    st.one_of(st.none(), st.sampled_from("xy")),
)


def unique(rows):
    """At most one row per key without NULLs (the duplicate guard sees to that); NULL keys may repeat."""
    seen, kept = set(), []
    for r in rows:
        key = r[:2]
        if None in key or key not in seen:
            seen.add(key)
            kept.append(r)
    return kept


def merged_by_hand(target, source, changed, null_safe):
    def match(a, b):
        return a[:2] == b[:2] and (null_safe or None not in a[:2])

    out = []
    for t in target:
        hit = [s for s in source if match(t, s)]
        if hit and changed(t, hit[0]):
            out.append((*t[:2], *hit[0][2:], up.UPDATE))
        else:
            out.append((*t, up.KEEP))
    out += [(*s, up.INSERT) for s in source if not any(match(t, s) for t in target)]
    return sorted(out, key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(ROW, max_size=8), source=st.lists(ROW, max_size=8), hashed=st.booleans())
def test_merge_equals_brute_force_in_both_plans(spark, target, source, hashed):
    target, source = unique(target), unique(source)
    t, s = spark.createDataFrame(target, LAYOUT), spark.createDataFrame(source, LAYOUT)

    def changed(a, b):
        return not hashed or (a[3] is not None and b[3] is not None and a[3] != b[3])

    when = up.hash_differs("h") if hashed else None
    expected = merged_by_hand(target, source, changed, null_safe=False)
    for small in (False, True):
        assert rows_of(up.merge_frame(t, s, ["k", "g"], when=when, small_source=small)) == expected


def test_null_safe_keys_match_themselves(spark):
    t = spark.createDataFrame([(None, 1, "a", "x"), (1, None, "b", "x")], LAYOUT)
    s = spark.createDataFrame([(None, 1, "n", "y"), (2, None, "m", "y")], LAYOUT)
    for small in (False, True):
        merged = up.merge_frame(t, s, ["k", "g"], null_safe=True, small_source=small)
        assert rows_of(merged) == sorted(
            [(None, 1, "n", "y", "update"), (1, None, "b", "x", "keep"), (2, None, "m", "y", "insert")], key=str
        )


def test_merging_twice_changes_nothing_more(spark):
    t = spark.createDataFrame([(1, 1, "a", "x"), (2, 2, "b", "x")], LAYOUT)
    s = spark.createDataFrame([(2, 2, "c", "y"), (3, 3, "d", "y")], LAYOUT)
    once = up.merged_rows(up.merge_frame(t, s, ["k", "g"], when=up.hash_differs("h")))
    twice = up.merge_frame(once, s, ["k", "g"], when=up.hash_differs("h"))
    assert up.action_counts(twice).first().rows_changed == 0
    assert rows_of(up.merged_rows(twice)) == rows_of(once)


def test_renamed_and_insert_only_columns(spark):
    t = spark.createDataFrame([(1, "old", 7)], "key int, name string, born int")
    s = spark.createDataFrame([(1, "new", 8), (2, "two", 9)], "key int, label string, born int")
    names = {"name": "label"}
    merged = up.merge_frame(t, s, ["key"], update=names, insert={**names, "key": "key", "born": "born"})
    assert rows_of(up.merged_rows(merged)) == [(1, "new", 7), (2, "two", 9)]


def test_duplicate_source_key_is_refused_only_if_it_matches(spark):
    t = spark.createDataFrame([(1, 1, "a", "x")], LAYOUT)
    twice = spark.createDataFrame([(1, 1, "b", "x"), (1, 1, "c", "x")], LAYOUT)
    fresh = spark.createDataFrame([(9, 1, "b", "x"), (9, 1, "c", "x")], LAYOUT)
    with pytest.raises(up.DuplicateSourceKey):
        up.check_source(t, twice, ["k", "g"])
    up.check_source(t, fresh, ["k", "g"])
    assert up.merged_rows(up.merge_frame(t, fresh, ["k", "g"])).count() == 3


def test_small_source_plan_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v")).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    s = spark.createDataFrame([(5, "b"), (5000, "c")], "k bigint, v string")
    plan = up.merge_frame(t, s, ["k"], small_source=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan


def test_range_replacement_keeps_everything_outside(spark):
    old = spark.createDataFrame([(1, "o"), (5, "o"), (9, "o"), (None, "o")], "d int, v string")
    new = spark.createDataFrame([(4, "n")], "d int, v string")
    assert rows_of(up.replace_range(old, new, "d", 3, 6)) == sorted([(1, "o"), (9, "o"), (None, "o"), (4, "n")], key=str)


def test_watermark_defaults_and_rules(spark):
    empty = wm.empty_watermarks(spark)
    assert wm.last_mark(empty, "t", "raw") is None
    assert wm.mark_or_start(empty, "t", "raw").year == 1900
    null_row = wm.mark_row(spark, "t", "raw", None, at(1), 0, 0)
    assert wm.mark_or_start(null_row, "t", "raw").year == 1900
    assert wm.next_mark(None, at(1), at(9)) == at(1)
    assert wm.next_mark(at(2), at(1), at(9)) == at(2)
    assert wm.next_mark(None, at(1), at(9), "data_or_now") == at(9)
    assert wm.next_mark(at(2), at(1), at(9), "load_time") == at(9)
    with pytest.raises(ValueError):
        wm.next_mark(None, None, at(1), "other")


def test_recording_a_mark_is_an_upsert_per_table_and_layer(spark):
    marks = wm.record(wm.empty_watermarks(spark), wm.mark_row(spark, "t", "raw", at(1), at(1), 5, 5))
    marks = wm.record(marks, wm.mark_row(spark, "t", "star", at(2), at(2), 6, 6))
    marks = wm.record(marks, wm.mark_row(spark, "t", "raw", None, at(3), 7, 0))
    assert rows_of(marks, "layer_type", "max_modified_date", "last_load_time", "row_count", "rows_changed") == [
        ("raw", at(1), at(3), 7, 0),
        ("star", at(2), at(2), 6, 6),
    ]


def test_merge_statements_follow_the_rules():
    from tidewright.operators.upsert import NotExpressible, date_differs, hash_differs, merge_statement

    plain = merge_statement("`c`.`t`", "b", ["id", "v", "more"], ["id", "v"], ["id"])  # M1
    assert plain.splitlines() == [
        "MERGE INTO `c`.`t` AS t USING b AS s",
        "ON t.`id` = s.`id`",
        "WHEN MATCHED THEN UPDATE SET t.`v` = s.`v`",
        "WHEN NOT MATCHED THEN INSERT (`id`, `v`, `more`) VALUES (s.`id`, s.`v`, NULL)",
    ]
    keys = merge_statement("t", "b", ["a", "d", "v"], ["a", "d", "v"], ["a", "d"], null_safe=True)  # M2
    assert "ON t.`a` <=> s.`a` AND t.`d` <=> s.`d`" in keys
    hashed = merge_statement("t", "b", ["id", "v", "row_hash"], ["id", "v", "row_hash"], ["id"], update=["v", "row_hash"], when=hash_differs())  # M3
    assert "WHEN MATCHED AND t.`row_hash` <> s.`row_hash` THEN UPDATE SET t.`v` = s.`v`, t.`row_hash` = s.`row_hash`" in hashed
    dated = merge_statement("t", "b", ["id", "v"], ["id", "w", "modified_date"], ["id"], update={"v": "w"}, insert={"id": "id", "v": "w"}, when=date_differs())  # M4
    assert "WHEN MATCHED AND t.`modified_date` <> s.`modified_date` THEN UPDATE SET t.`v` = s.`w`" in dated and "VALUES (s.`id`, s.`w`)" in dated
    with pytest.raises(NotExpressible):
        merge_statement("t", "b", ["id"], ["id"], ["id"], when=lambda old, new: old("x") > new("x"))


def test_merge_statements_are_read_as_merges(spark):
    """The text is parsed, nothing is run: tables here have no transactions."""
    from tidewright.operators.upsert import hash_differs, merge_statement

    text = merge_statement("`c`.`t`", "b", ["id", "row_hash"], ["id", "row_hash"], ["id"], when=hash_differs())
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert plan.startswith("'MergeIntoTable") and "updateaction" in plan.lower() and "insertaction" in plan.lower()
