from __future__ import annotations

import random
import zlib

import pytest

from tests.llm.conftest import DOCS, awkward_rows
from tidewright.llm import sharding


def tree(rows: list[tuple], leaves: int, first: int = 0) -> dict[int, int]:
    """Shard of every row (number, size, dims, place), one node at a time."""
    if leaves == 1 or not rows:
        return {n: first for n, *_ in rows}
    widths = [max(r[2][d] for r in rows) - min(r[2][d] for r in rows) for d in range(len(rows[0][2]))]
    dim = widths.index(max(widths))
    at = {n: (dims[dim], place) for n, _, dims, place in rows}
    goal, upto, sides = sum(r[1] for r in rows) * (leaves // 2) / leaves, 0, None
    for spot in sorted(set(at.values())):
        weight = sum(r[1] for r in rows if at[r[0]] == spot)
        upto += weight
        if upto >= goal:
            sides = (spot[0], spot[1] if upto - goal <= goal - upto + weight else spot[1] - 1)
            break
    left = [r for r in rows if at[r[0]] <= sides]
    right = [r for r in rows if at[r[0]] > sides]
    return tree(left, leaves // 2, first) | tree(right, leaves - leaves // 2, first + leaves // 2)


def many(n: int, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["w" * rng.choice([0, 5, 40, 400]) + str(rng.randrange(n // 2)) for _ in range(n)]
    return [(i, t, rng.choice(["en", "de", "fr", None]), rng.choice(["src1", "src10", "srcé", "src", None, "src0"]), 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("leaves", [1, 2, 5, 16])
def test_shards_are_those_of_a_tree_built_node_by_node(spark, leaves):
    docs = spark.createDataFrame(many(600), DOCS).repartition(4)
    packed = sharding._packed(docs, sharding.NAMES)
    located, n, _ = sharding._located(packed, sharding.NAMES, leaves, None)
    rows = [(r["doc_id"], r["size"], (r["dim0"], r["dim1"], r["dim2"]), r["place"]) for r in located.collect()]
    assert n == len(rows) == 600
    expected = tree(rows, leaves)
    found = sharding.placements(docs, leaves).collect()
    assert {r["doc_id"]: r["shard"] for r in found} == expected
    by: dict[int, list] = {}
    for r in found:
        by.setdefault(r["shard"], []).append(r)
    for shard in by.values():
        assert sorted(r["slot"] for r in shard) == list(range(len(shard)))
    total = sum(r["size"] for r in found)
    assert all(abs(sum(r["size"] for r in s) - total / leaves) < 0.1 * total / leaves + 900 for s in by.values())


def test_names_keep_their_order_behind_the_common_prefix(spark):
    names = ["https://a/1", "https://a/10", "https://a/2", "https://a/z", "https://a/é", None]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    known = sorted(n for n in names if n)
    cells = {r[0]: r[1] for r in frame.select("name", sharding.name_cell(frame["name"], known[0], known[-1])).collect()}
    assert [cells[n] for n in [None, *known]] == sorted(cells.values()) and cells[None] == 0 and len(set(cells.values())) == 6
    alike = spark.createDataFrame([("same",), (None,)], "name string")
    assert {r[0] for r in alike.select(sharding.name_cell(alike["name"], "same", "same")).collect()} == {0, 1}


def test_small_groups_of_copies_stay_together_and_hot_ones_are_split(spark):
    rng = random.Random(8)
    hot = [(i, "hot text " * 20, "en", f"s{i % 3}", 1) for i in range(1000)]
    pairs = [(2000 + i, f"pair {i // 2} " + "x" * rng.randrange(200), "en", f"s{rng.randrange(9)}", 1) for i in range(1000)]
    pairs += [(5000 + i, f"copy {i // 4} " * 9, rng.choice(["en", "de"]), f"s{rng.randrange(9)}", 1) for i in range(1000)]
    found = sharding.placements(spark.createDataFrame(hot + pairs, DOCS), 8).collect()
    shard = {r["doc_id"]: r["shard"] for r in found}
    assert len({shard[i] for i in range(1000)}) > 1
    assert all(len({shard[5000 + 4 * g + i] for i in range(4)}) == 1 for g in range(250))
    sizes = [sum(r["size"] for r in found if r["shard"] == s) for s in range(8)]
    assert max(sizes) < 1.05 * min(sizes)


def test_target_bytes_set_the_number_of_shards(spark):
    docs = spark.createDataFrame(many(300), DOCS)
    total = sum(len((t or "").encode()) + 1 for _, t, *_ in many(300))
    found = sharding.sharded(docs, target_bytes=total // 7 + 1)
    assert found.columns == [*docs.columns, *sharding.RESULTS]
    assert sorted({r["shard"] for r in found.collect()}) == list(range(7))
    with pytest.raises(ValueError):
        sharding.sharded(docs)
    with pytest.raises(ValueError):
        sharding.sharded(docs, target_bytes=0.001)


def test_awkward_rows(spark, awkward, no_docs, clashing):
    found = sharding.placements(awkward, 4).collect()
    assert len(found) == len(awkward_rows())
    expected = sorted((zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for _, t, *_ in awkward_rows())
    assert sorted((r["text_crc32"], r["size"]) for r in found) == expected
    assert {r["law"] for r in found} == {"bytes"} and {r["grown_shard"] for r in found} == {None}
    assert sharding.placements(no_docs, 4).count() == 0
    assert sharding.sharded(no_docs, target_bytes=10).count() == 0
    more = clashing.selectExpr("*", "'x' AS spot", "'x' AS Shard", "'x' AS _row", "'x' AS dim0", "'x' AS place", "'x' AS number", "'x' AS first", "'x' AS bytes")
    out = sharding.sharded(more, shards=2)
    assert out.columns == [x for x in more.columns if x.lower() not in sharding.RESULTS] + list(sharding.RESULTS)
    assert out.count() == 6 and {r["node"] + r["spot"] + r["_row"] for r in out.collect()} == {"xxx"}


def test_no_python_in_the_plan(spark, awkward):
    plan = sharding.placements(awkward, 4)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))
