"""The ledger against a plain Python rendering of its rules (every movement times every pair of stock rows)."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.erp import D, at, company, raw, rows_of
from tidewright.operators.ledger import current_balances, ledger_batch, ledger_full, ledger_increment, ledger_merged, ledger_rebuilt


def full_by_hand(stock, moves, onward=False, once=False):
    """With ``onward`` the days after the snapshot too; with ``once`` each movement once a place."""
    snapshot = max(s["ModifiedDate"] for s in stock).date()
    days = defaultdict(list)
    for m in moves:
        if m["TransactionDate"].date() > snapshot and not onward:
            continue
        for a in stock:
            for b in [a] if once else stock:
                if a["ProductID"] == b["ProductID"] == m["ProductID"]:
                    place = a["LocationID"] if a["LocationID"] is not None else b["LocationID"]
                    if place is not None:
                        days[m["ProductID"], place, m["TransactionDate"].date()].append(m)
    out, running = [], defaultdict(int)
    rows = []
    for key in sorted(days):
        group = days[key]
        into = sum(m["Quantity"] for m in group if m["TransactionType"] in ("P", "W"))
        off = sum(m["Quantity"] for m in group if m["TransactionType"] in ("S", "I"))
        running[key[:2]] += into - off
        cost = (sum(m["ActualCost"] for m in group) / len(group)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        rows.append((key, into, off, cost, running[key[:2]]))
    shift = {
        key[:2]: next(s["Quantity"] for s in stock if (s["ProductID"], s["LocationID"]) == key[:2]) - total
        for key, _, _, _, total in rows
        if key[2] == snapshot
    }
    for key, into, off, cost, total in rows:
        out.append((*key, into, off, cost, total + shift.get(key[:2], 0)))
    return sorted(out, key=str)


LEDGER = ["product_id", "location_id", "transaction_date", "unit_in", "unit_out", "unit_cost", "unit_balance"]
MOVE = st.builds(
    lambda p, day, kind, q, c: {"ProductID": p, "TransactionDate": at(day, 9), "TransactionType": kind, "Quantity": q,
                                "ActualCost": D(c), "ModifiedDate": at(day, 10)},
    st.integers(1, 3), st.integers(1, 12), st.sampled_from("PWSIQ"), st.integers(1, 50), st.integers(1, 20),
)
PLACE = st.tuples(st.integers(1, 3), st.one_of(st.none(), st.integers(1, 3)))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(places=st.sets(PLACE, min_size=1, max_size=6), moves=st.lists(MOVE, max_size=12))
def test_full_ledger_equals_brute_force(spark, places, moves):
    stock = [{"ProductID": p, "LocationID": l, "Quantity": 10 * i, "ModifiedDate": at(10)} for i, (p, l) in enumerate(sorted(places, key=str))]
    moves = [{**m, "TransactionID": i} for i, m in enumerate(moves)]
    got = ledger_full(raw(spark, "product_inventory", stock), raw(spark, "product_transaction_history", moves))
    assert rows_of(got, *LEDGER) == full_by_hand(stock, moves)


def tables(spark):
    t = company(spark)
    return t["product_inventory"], t["product_transaction_history"]


def test_movements_are_counted_once_per_pair_of_locations(spark):
    stock, moves = tables(spark)
    per_pair = ledger_full(stock, moves).filter("product_id = 1")
    assert rows_of(per_pair, "location_id", "unit_in", "unit_balance") == [(1, 300, 300), (2, 300, 300), (3, 300, 300)]
    once = ledger_full(stock, moves, attribution="once").filter("product_id = 1")
    assert rows_of(once, "location_id", "unit_in", "unit_balance") == [(1, 100, 100), (2, 100, 100), (3, 100, 100)]


def test_anchor_needs_a_movement_on_the_snapshot_day(spark):
    stock, moves = tables(spark)
    rows = rows_of(ledger_full(stock, moves).filter("product_id = 2"), "transaction_date", "unit_in", "unit_out", "unit_balance")
    # 7 counted units on the 10th; the 20th lies after the snapshot, the unknown code moves nothing
    assert sorted(rows) == [(dt.date(2024, 1, 9), 10, 0, 12), (dt.date(2024, 1, 10), 0, 5, 7)]
    last = ledger_full(stock, moves, anchor="last").filter("product_id = 1 and location_id = 2")
    assert rows_of(last, "unit_balance") == [(50,)]


def test_bad_options_are_refused(spark):
    stock, moves = tables(spark)
    with pytest.raises(ValueError):
        ledger_full(stock, moves, anchor="never")
    with pytest.raises(ValueError):
        ledger_full(stock, moves, attribution="twice")


def stored(spark, rows):
    return spark.createDataFrame(
        rows,
        "product_id int, location_id string, transaction_date timestamp, unit_in int, unit_out int, "
        "unit_cost decimal(18,2), unit_balance int, modified_date timestamp",
    )


def test_increment_continues_balances_and_opens_new_locations(spark):
    stock, moves = tables(spark)
    old = stored(spark, [(2, "1", at(9), 10, 0, D("2.00"), 100, at(9)), (1, "1", at(8), 100, 0, D("1"), 100, at(8))])
    got = ledger_increment(stock, moves, old, at(9), at(30))
    assert rows_of(got, *LEDGER) == sorted(
        [
            (2, "1", at(10), 0, 5, D("4.00"), 95),
            (2, "1", at(20), 1, 0, D("1.00"), 96),
            # locations without movements since the mark and without history open at the newest stock time
            (1, "2", at(10), 0, 0, D("0.00"), 50),
            (1, "3", at(10), 0, 0, D("0.00"), 5),
            (3, "1", at(10), 0, 0, D("0.00"), 4),
        ],
        key=str,
    )


def test_increment_multiplies_by_the_number_of_new_locations(spark):
    stock, _ = tables(spark)
    moves = raw(spark, "product_transaction_history", [
        {"TransactionID": 9, "ProductID": 1, "TransactionDate": at(12), "TransactionType": "P", "Quantity": 10,
         "ActualCost": D("1"), "ModifiedDate": at(12)}])
    old = stored(spark, [(1, "1", at(8), 100, 0, D("1"), 100, at(8))])
    got = ledger_increment(stock, moves, old, at(9), at(30)).filter("product_id = 1")
    assert rows_of(got, "location_id", "unit_in", "unit_balance") == [("1", 20, 120), ("2", 20, 70), ("3", 20, 25)]


def test_same_day_is_replaced_or_added(spark):
    stock, _ = tables(spark)
    moves = raw(spark, "product_transaction_history", [
        {"TransactionID": 9, "ProductID": 2, "TransactionDate": at(9, 15), "TransactionType": "P", "Quantity": 3,
         "ActualCost": D("1"), "ModifiedDate": at(9, 15)}])
    old = stored(spark, [(2, "1", at(9), 10, 0, D("2.00"), 100, at(9))])
    for same_day, units in (("replace", 3), ("add", 13)):
        inc = ledger_increment(stock, moves, old, at(9), at(30), same_day=same_day)
        merged = ledger_merged(old, inc).filter("product_id = 2")
        assert rows_of(merged, "unit_in", "unit_balance") == [(units, 103)]


def test_backdated_movements_need_a_rebuild(spark):
    stock, moves = tables(spark)
    late = raw(spark, "product_transaction_history", [
        {"TransactionID": 9, "ProductID": 2, "TransactionDate": at(5), "TransactionType": "P", "Quantity": 2,
         "ActualCost": D("1"), "ModifiedDate": at(25)}])
    old = ledger_full(stock, moves)
    old = old.select(*[F.col(c).cast("timestamp" if c in ("transaction_date", "modified_date") else old.schema[c].dataType).alias(c) for c in old.columns])
    everything = moves.unionByName(late)
    inc = ledger_increment(stock, everything, old, at(21), at(30))
    assert inc.filter("product_id = 2 and unit_in > 0").count() == 0
    rebuilt = ledger_rebuilt(stock, everything, old, at(21))
    assert rows_of(rebuilt, *LEDGER) == rows_of(
        ledger_full(stock, everything).withColumn("transaction_date", F.col("transaction_date").cast("timestamp")), *LEDGER)


def test_disjoint_days_in_two_batches_equal_one_batch(spark):
    stock, moves = tables(spark)
    start = stored(spark, [(p, str(l), at(1), 0, 0, D("0"), 0, at(1)) for p, l in ((1, 1), (1, 2), (1, 3), (2, 1), (3, 1))])
    whole = ledger_merged(start, ledger_increment(stock, moves, start, at(1), at(30)))
    first = moves.filter(F.col("ModifiedDate") <= F.lit(at(9)))
    half = ledger_merged(start, ledger_increment(stock, first, start, at(1), at(30)))
    both = ledger_merged(half, ledger_increment(stock, moves, half, at(9, 12), at(30)))
    assert rows_of(both, *LEDGER) == rows_of(whole, *LEDGER)


def known(spark, rows):
    kinds = "product_id int, location_id int, transaction_date timestamp, unit_in bigint, unit_out bigint, unit_cost decimal(18,2), unit_balance bigint, modified_date timestamp"
    days = [(p, l, dt.datetime.combine(d, dt.time()), into, off, cost, total, at(1)) for p, l, d, into, off, cost, total in rows]
    return spark.createDataFrame(days, kinds)


DAYS = "to_date(transaction_date) AS transaction_date"
LATE_PLACE = st.tuples(st.integers(1, 2), st.integers(1, 2))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(places=st.sets(LATE_PLACE, min_size=1, max_size=4), moves=st.lists(MOVE, min_size=1, max_size=12), news=st.lists(MOVE, min_size=1, max_size=5), held=st.integers(0, 12), once=st.booleans())
def test_late_movements_give_the_ledger_of_all_movements(spark, places, moves, news, held, once):
    """Snapshot on the 6th, mark on the 8th: new movements lie before, between and after both. ``held``: the last day merged by a load that died."""
    stock = [{"ProductID": p, "LocationID": l, "Quantity": 10 * i, "ModifiedDate": at(6)} for i, (p, l) in enumerate(sorted(places))]
    mark, later = at(13), at(14)
    moves = [{**m, "TransactionID": i} for i, m in enumerate(moves)]
    news = [{**m, "TransactionID": 100 + i, "ModifiedDate": later} for i, m in enumerate(news)]
    expected = full_by_hand(stock, moves + news, onward=True, once=once)
    stored = full_by_hand(stock, moves, onward=True, once=once)
    if once:  # half merged, from the first month on
        stored = [r for r in stored if r[2].day > held] + [r for r in expected if r[2].day <= held]
    late = {m["ProductID"] for m in news}
    frames = raw(spark, "product_inventory", stock), raw(spark, "product_transaction_history", moves + news)
    ledger = known(spark, stored)
    for _ in range(2):  # the repeated load changes nothing
        batch = ledger_batch(*frames, ledger, mark, later, attribution="once" if once else "per_pair")
        ledger = spark.createDataFrame(ledger_merged(ledger, batch).collect(), ledger.schema)
        found = ledger.selectExpr("product_id", "location_id", DAYS, *LEDGER[3:])
        assert [r for r in rows_of(found) if r[0] in late] == [r for r in expected if r[0] in late]


def test_an_opening_row_anchors_late_movements_and_balances_follow(spark):
    stock = [{"ProductID": 1, "LocationID": 1, "Quantity": 40, "ModifiedDate": at(6, 12)}]
    move = {"ProductID": 1, "TransactionType": "P", "ActualCost": D(2), "TransactionID": 1}
    first = ledger_increment(raw(spark, "product_inventory", stock), raw(spark, "product_transaction_history", []), known(spark, []), at(5), at(7))
    ledger = spark.createDataFrame(ledger_merged(known(spark, []), first).collect(), known(spark, []).schema)
    balances = current_balances(ledger)
    late = [{**move, "TransactionDate": at(2), "Quantity": 15, "ModifiedDate": at(8)}, {**move, "TransactionID": 2, "TransactionDate": at(9), "Quantity": 5, "ModifiedDate": at(9)}]
    batch = ledger_batch(raw(spark, "product_inventory", stock), raw(spark, "product_transaction_history", late), ledger, at(7), at(10), attribution="once", balances=balances)
    assert sorted(rows_of(batch, "transaction_date", "unit_in", "unit_balance")) == [(at(2, 0), 15, 40), (at(9, 0), 5, 45)]
    assert rows_of(current_balances(batch, balances), "last_balance") == [(45,)]
    lower = batch.withColumn("unit_balance", F.col("unit_balance") - 30)
    assert rows_of(current_balances(lower, current_balances(batch, balances)), "last_balance") == [(15,)]
