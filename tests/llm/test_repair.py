from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest

from tidewright.llm import repair

TURNS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(rows: list[tuple[str, bool, bool]], inserts: int = 4) -> tuple[int, str]:
    """Least cost and audit over all ways to edit rows (initial, removed, truncated), by trying them all."""
    best = None

    def go(i: int, cost: int, audit: str, roles: str, left: int) -> None:
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and GRAMMAR.fullmatch(roles):
            best = min(best or (cost, audit), (cost, audit))
        if left:
            for role in "ua":
                go(i, cost + 3, audit + "I", roles + role, left - 1)
        if i < len(rows):
            initial, removed, truncated = rows[i]
            go(i + 1, cost + 4, audit + "D", roles, left)
            if not removed:
                more = 3 if truncated else 0
                if initial:
                    go(i + 1, cost + more, audit + "K", roles + initial, left)
                for role in "ua":
                    go(i + 1, cost + 3 + more, audit + "R", roles + role, left)

    go(0, 0, "", "", inserts)
    return best


def searched(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    search, out = repair.Survivors(), []
    for row in rows:
        out += search.step(*row)
    rest, cost = search.finish()
    return cost, "".join(out + rest)


def test_all_short_conversations():
    kinds = [("s", False, False), ("u", False, False), ("a", False, False), ("x", False, True), ("u", True, False), ("a", False, True)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            assert searched(list(rows)) == cheapest(list(rows)), rows


@pytest.mark.parametrize("seed", range(60))
def test_longer_conversations(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["s", "u", "a", "a", "x", ""]), rng.random() < 0.15, rng.random() < 0.2) for _ in range(rng.randint(4, 7))]
    assert searched(rows) == cheapest(rows), rows


def test_equal_removed_rows_count_as_one_step():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(rng.choice("suax"), rng.random() < 0.4, False) for _ in range(5)]
        times = [rng.randint(1, 3) if removed else 1 for _, removed, _ in rows]
        search, out = repair.Survivors(), []
        for row, n in zip(rows, times):
            out += search.step(*row, times=n)
        rest, cost = search.finish()
        audit = "".join(letters.replace("D", "D" * n) for letters, n in zip(out + rest, [*times, 1]))
        assert (cost, audit) == searched([row for row, n in zip(rows, times) for _ in range(n)])


def tree_size(node: repair.Node) -> int:
    size, todo = 0, [node]
    while todo:
        size += 1
        todo += todo.pop().children
    return size


def test_clean_stretches_coalesce_and_the_tree_stays_small():
    search, widest, told = repair.Survivors(), 0, 0
    rng = random.Random(1)
    for i in range(20_000):
        told += len(search.step("ua"[i % 2], truncated=rng.random() < 0.1))
        widest = max(widest, tree_size(search.root))
    assert widest <= 12 and told > 19_990


def test_unresolved_ties_are_kept_whole():
    n = 3000  # either every row gets a role, or one is deleted first: both stay until the end
    search = repair.Survivors()
    told = sum(len(search.step("x")) for _ in range(n))
    assert tree_size(search.root) > n and told < n / 2
    rest, cost = search.finish()
    assert cost == 3 * n and "".join(rest) == "R" * (n - told)


def brute(turns: list[tuple]) -> dict:
    """Digest rows of whole conversations, by the definition."""
    out = {}
    for conv_id in {t[0] for t in turns}:
        rows = [(t[1], " " if t[2] is None else t[2], " " if t[3] is None else t[3]) for t in turns if t[0] == conv_id]
        rows.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            shown = text.rstrip(" \t\n\v\f\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = searched([(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)])
        kept, i = [], 0
        total = len(audit.replace("D", ""))
        for letter in audit:
            if letter != "D":
                named = "user" if (total - len(kept)) % 2 == 0 else "assistant"
                kept.append((rows[i][1] if letter == "K" else named, "" if letter == "I" else rows[i][2]))
            i += letter != "I"
        turn = [r[0] for r in rows if r[0] is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        gaps = max(turn) - min(turn) + 1 - len(set(turn)) if turn else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv_id] = (conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def conversations(seed: int, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Hello.", "What?", "cut off", "  \n", "", None, "Yes! ", "é.\t", "x" * 2000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for conv_id in [*range(n), None]:
        for turn in range(rng.randint(1, 9)):
            rows += [(conv_id, rng.choice([turn, turn, turn, 2 * turn, None]), rng.choice(roles), rng.choice(texts))] * rng.choice([1, 1, 1, 2, 5])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_digests_of_awkward_conversations(spark, seed):
    rows = conversations(seed)
    found = repair.audited(repair.edits(spark.createDataFrame(rows, TURNS).repartition(5))).collect()
    assert {r["conv_id"]: tuple(r) for r in found} == brute(rows)
    assert len(found) == 61


def test_conversations_without_rows_and_empty_tables(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Hi.")], TURNS)
    names = spark.createDataFrame([(1,), (2,), (2,), (None,)], "conv_id long")
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.audited(repair.edits(turns, names)).collect()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[2] == found[None] == empty and found[1][5:7] == (3, "KI")
    assert repair.audited(repair.edits(turns.limit(0))).count() == 0
    assert repair.repaired(turns.limit(0)).count() == 0


def test_repaired_rows_and_extra_columns(spark):
    rows = [(1, 0, "assistant", "Hi there."), (1, 1, "user", "And?"), (1, 2, "user", "And?"), (1, 5, "tool", "Result: 5.")]
    turns = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS edit", "'x' AS kind", "'x' AS copies", "'x' AS digest", "'x' AS place")
    found = sorted(tuple(r) for r in repair.repaired(turns).collect())
    assert found == [(1, 0, "user", "", None), (1, 1, "assistant", "Hi there.", 0), (1, 2, "user", "And?", 1), (1, 3, "assistant", "Result: 5.", 5)]


def test_a_hot_repeat_is_one_row_before_the_stream(spark):
    rows = [(7, i, "user", "again.") for i in range(5000)] + [(7, 9000, "assistant", "Done.")] + [(8, 0, "user", "Hi."), (8, 1, "assistant", "Ho.")]
    found = {r["conv_id"]: r for r in repair.audited(repair.edits(spark.createDataFrame(rows, TURNS))).collect()}
    assert found[7]["audit"] == "K" + "D" * 4999 + "K" and found[7]["duplicate"] == 4999 and found[7]["illegal"] == 4999
    assert found[7]["gaps"] == 4000 and found[8]["audit"] == "KK"
