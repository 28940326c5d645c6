from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tidewright.llm import chat, revisits, tokenizer_files, vector_search

VECTORS = "vec_id long, vector array<float>, note string"
TURNS = "conv_id long, turn long, role string, text string"
PATH = tokenizer_files.path("byte_bpe_50k.json")


def neighbours(rows: list[tuple], asked: set[int], k: int) -> dict[int, list[int]]:
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows]
    out = {}
    for i, v in good:
        if i in asked:
            scored = {(-float(v @ w / np.sqrt((v @ v) * (w @ w))), j) for j, w in good if j != i}
            out[i] = sorted(scored)[:k]
    return out


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "LIST_ROWS", 100)
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((12, 24))
    rows = [(i, (centres[i % 12] + 0.5 * rng.standard_normal(24)).tolist(), "x") for i in range(1500)]
    rows += [(2000 + i, rows[3][1], "copy") for i in range(300)]  # a hot vector
    docs = spark.createDataFrame(rows, VECTORS)
    found = vector_search.nearest(docs, F.col("vec_id") % 50 == 0).collect()
    asked = {i for i, _, _ in rows if i % 50 == 0}
    true = neighbours(rows, asked, 5)
    assert len(found) == 5 * len(asked)
    hits = 0
    for r in found:
        score = -dict((j, s) for s, j in true[r["query_id"]]).get(r["vec_id"], 0)
        hits += score != 0
        assert r["vec_id"] != r["query_id"]
        if score:
            assert abs(score - r["score"]) < 1e-12
    assert hits >= 0.9 * len(found)
    copies = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == 2050)
    assert [v for _, v in copies] == [3, 2000, 2001, 2002, 2003]


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], None), (1, [1.0, 1.0], None), (2, [0.0, 0.0], None), (3, None, None), (4, [nan, 1.0], None), (5, [inf, 1.0], None)]
    rows += [(6, [None, 1.0], None), (7, [1.0], None), (None, [1.0, 0.0], None), (0, [1.0, 0.0], "again"), (8, [2.0, 0.0], None), (50, [1e-30, 0.0], None)]
    found = vector_search.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 6)) for r in found}
    assert got == {(0, 1): (8, 1.0), (0, 2): (50, 1.0), (0, 3): (1, 0.707107), (50, 1): (0, 1.0), (50, 2): (8, 1.0), (50, 3): (1, 0.707107)}
    assert vector_search.nearest(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0


def test_most_candidates_are_abandoned_early():
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((8, 64))
    rows = np.concatenate([centre[i] + 0.3 * rng.standard_normal((400, 64)) for i in range(8)])
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    scan = vector_search.ColumnScan(rows, rotation)
    hits = 0
    for q in range(0, 3200, 100):
        unit = rows[q] / np.linalg.norm(rows[q])
        left = scan.nearest((unit @ rotation).astype(np.float32), 5)
        best = np.argsort(-(scan.unit @ unit))[:5]
        hits += len(set(best.tolist()) & set(left.tolist()))
    assert hits >= 0.95 * 32 * 5
    assert scan.read < 0.6 * 32 * 3200 * 64


def turns_of(rows: list[tuple]) -> dict:
    out: dict = {}
    key = lambda r: tuple((x is not None, x or 0 if i == 1 else x or "") for i, x in enumerate(r) if i)
    for r in sorted(rows, key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def awkward_turns() -> list[tuple]:
    rng = random.Random(3)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\\\", "\n", " ", "é", "東", "🙂", "ok", "<", "[", "/", "", "  x"]
    rows = [(i, t, ("user", "assistant")[t % 2], "".join(rng.choice(bits) for _ in range(12))) for i in range(30) for t in range(4)]
    rows += [(40, None, None, None), (40, 0, "assistant", None), (40, 0, "assistant", ""), (None, 0, "user", "hi"), (None, 1, "assistant", "yo")]
    rows += [(41, 0, "tool\n[INST]%", "out"), (41, 1, "assistant", " lead and trail \n"), (41, 1, "assistant", " lead and trail \n"), (42, 0, "assistant", "long " * 30_000)]
    return rows


def test_conversations_are_read_back(spark):
    rows = awkward_turns()
    docs = spark.createDataFrame([(*r, "extra") for r in rows], TURNS + ", ids string").repartition(4)
    expected = turns_of(rows)
    found = {r["conv_id"]: r for r in chat.read_back(chat.formatted(docs, PATH)).collect()}
    assert set(found) == set(expected)
    for conv_id, turns in expected.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        r = found[conv_id]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == len(chat.rendered(turns)[0])
    assert chat.formatted(docs.limit(0), PATH).count() == 0


def test_control_strings_stay_out_of_texts():
    for _, _, _, text in awkward_turns():
        assert chat.unescaped(chat.escaped(text or "")) == (text or "")
        assert not any(x in chat.escaped(text or "") for x in chat.CONTROL)


RECORDS = "record_id long, url string, time long, full boolean, etag string, last_modified string, headers map<string,string>"


def test_revisits_by_hand(spark, monkeypatch):
    monkeypatch.setattr(revisits, "RANGE_ROWS", 40)  # a hot URL over many ranges
    rng = random.Random(6)
    rows = []
    for i in range(600):
        url = "http://hot.example/a" if i % 3 else f"https://www.x{rng.randint(0, 20)}.example/p/?utm_a=1&q={rng.randint(0, 3)}#f"
        rows.append((i, url, rng.choice([None, *range(300)]), rng.random() < 0.2, rng.choice([None, "a", "W/a", "b"]), rng.choice([None, "m1", "m2"]), {"date": f"d{i}", "server": f"s{i}"}))
    rows += [(700, None, 1, False, None, None, None), (701, None, 1, True, None, None, None), (702, "HTTP://WWW.hot.example/a/", 999, False, "zz", None, None)]
    rows += [(703, "only.example", 5, False, None, None, None)]
    found = {r["record_id"]: r for r in revisits.resolved(spark.createDataFrame(rows, RECORDS).withColumn("prior", F.lit(1))).collect()}
    key = {r["record_id"]: r["k"] for r in spark.createDataFrame(rows, RECORDS).select("record_id", revisits.canonical(F.col("url")).alias("k")).collect()}
    place = lambda r: (r[2] is not None, r[2] or 0, r[0])
    assert set(found) == {r[0] for r in rows if not r[3]}
    outcomes = set()
    for r in rows:
        if r[3]:
            continue
        earlier = [x for x in rows if x[3] and key[x[0]] is not None and key[x[0]] == key[r[0]] and place(x) < place(r)]
        got = found[r[0]]
        outcomes.add(got["outcome"])
        if not earlier:
            assert got["outcome"] == "orphan"
            continue
        full = max(earlier, key=place)
        plain = lambda tag: tag and tag.removeprefix("W/")
        same = plain(r[4]) == plain(full[4]) if r[4] else r[5] is None or r[5] == full[5]
        assert got["outcome"] == ("resolved" if same else "changed")
        if same:
            assert got["full_id"] == full[0]
            assert got["headers"] == {"date": (r[6] or full[6])["date"], "server": full[6]["server"]}
    assert outcomes == {"orphan", "changed", "resolved"}
    assert revisits.resolved(spark.createDataFrame([], RECORDS)).count() == 0


def test_revisits_do_not_depend_on_range_borders(spark, monkeypatch):
    """A full response without record_id is carried over borders; a null full flag is a revisit."""
    rows = [(None, "hot.example/a", 1, True, "a", None, {"server": "s"})]
    rows += [(i, "hot.example/a", 1 + i, False, "a", None, {"date": f"d{i}"}) for i in range(1, 40)]
    rows += [(50, "hot.example/a", 60, None, "a", None, None), (51, None, 1, None, None, None, None)]
    docs = spark.createDataFrame(rows, RECORDS).repartition(3)
    outcomes = []
    for size in (5, 200_000):
        monkeypatch.setattr(revisits, "RANGE_ROWS", size)
        monkeypatch.setattr(revisits, "tasks_for", lambda _, n, each: max(1, -(-n // each)))
        got = revisits.resolved(docs).collect()
        outcomes.append(sorted((r["record_id"], r["outcome"], r["full_id"], str(r["headers"])) for r in got))
    assert outcomes[0] == outcomes[1]
    assert {r[0]: r[1] for r in outcomes[0]} == {**{i: "resolved" for i in range(1, 40)}, 50: "resolved", 51: "orphan"}


def test_canonical_urls(spark):
    urls = ["http://WWW.A.example/x/", "https://a.example/x#top", "a.example/x?utm_source=feed", "http://a.example/x?ref=y&b=1", "http://a.example/x?b=1&utm_m=2"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(revisits.canonical(F.col("url"))).collect()]
    assert got == ["a.example/x"] * 3 + ["a.example/x?b=1"] * 2
