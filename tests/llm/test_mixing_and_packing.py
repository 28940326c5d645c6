from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import DOCS, awkward_rows
from tidewright.llm import mixing, packing, tokenizer_files

PATH = tokenizer_files.path("word_bpe_49k.json")


def levels(sizes: dict) -> dict:
    """Targets by repeated sharing of the excess."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        share = left / sum(weight[s] for s in free)
        above = [s for s in free if 2 * sizes[s] < share * weight[s]]
        if not above:
            target |= {s: share * weight[s] for s in free}
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def test_targets_and_copies(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 30), "en", rng.choice(["a", "b", "c", "d", "é", "Z", None]), 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.mixed(docs).collect()
    sizes: dict = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    target = levels(sizes)
    taken: dict = {}
    for r in found:
        assert r["size"] == len(r["text"].split())
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert math.floor(r["target"] / r["source_size"]) <= r["copies"] <= math.ceil(r["target"] / r["source_size"]) <= 2
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.1)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mixed(docs.repartition(7)).collect()))
    assert mixing.emitted(docs).count() == sum(r["copies"] for r in found)


def test_many_sources_are_ranked_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES_A_TASK", 7)
    monkeypatch.setattr(mixing, "HOT_CLASSES", 10)
    rows = [(i, "w " * (i % 9), "en", f"s{i % 50:02d}" if i % 50 else None, 1) for i in range(500)]
    sizes: dict = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    target = levels(sizes)
    found = mixing.mixed(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == 500
    assert all(r["target"] == pytest.approx(target[r["source"]]) for r in found)


def test_mixing_awkward_tables(awkward, no_docs, clashing):
    found = mixing.mixed(awkward)
    assert found.count() == len(awkward_rows())
    assert found.filter("copies IS NULL OR copies < 0").count() == 0
    assert mixing.mixed(no_docs).count() == 0
    assert mixing.emitted(clashing).columns == clashing.columns
    assert {r["size"] for r in mixing.emitted(clashing).collect()} <= {"x"}
    plan = mixing.mixed(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def check_slots(rows: list, size: int) -> int:
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for slots in by.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packed_ids_are_those_of_the_tokenizer(awkward, no_docs, clashing):
    tokenizer = Tokenizer.from_file(PATH)
    rows = packing.packed(awkward, PATH).collect()
    sequences = check_slots(rows, 2048)
    got: dict = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] and r["start"] == 2048 * r["piece"]
        got.setdefault(r["doc_id"], []).extend(ids.tolist())
    expected: dict = {}
    for doc_id, text, *_ in awkward_rows():
        expected.setdefault(doc_id, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    for doc_id, texts in expected.items():
        if len(texts) == 1:
            assert got[doc_id] == texts[0]
        assert len(got[doc_id]) == sum(map(len, texts))
    assert sequences <= -(-sum(r["length"] for r in rows) // 2048) + 1
    assert packing.packed(no_docs, PATH).count() == 0
    assert packing.packed(clashing, PATH).count() == 6


def test_runs_encode_like_whole_texts():
    tokenizer, runs = Tokenizer.from_file(PATH), packing.Runs(PATH, limit=500)
    texts = ["It's ΣΑΣ x　y <|endoftext|>a, é ́ don't!! 12,345", "a<|startoftext|> b\x0bc\x0cd", "", "ﬁ ǅ İ ß 東京", "IT'S it' it'' 'tis Word, WORD!! é.é Éa\u0301, na\u0308ive- don't? x's. a_b __ -- ...\u0301 ªº µm ŉ"]
    rng = random.Random(1)
    letters = "abzABZéÉßñÑİıſ" + "0٣²½" + "'!?.,-_$%&*<|>" + "\u0301\u00a0\u3000東Σς"
    texts += [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(300)) for _ in range(20)]
    assert runs.apart
    for text, ids in zip(texts, runs.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 50, 2048])
    counts = {rng.randint(1, size): rng.randint(1, 40) for _ in range(12)}
    plan = packing.best_fit(counts, size)
    rooms: list[int] = []
    for length in sorted(counts, reverse=True):  # one by one
        for _ in range(counts[length]):
            fits = [i for i, r in enumerate(rooms) if r >= length]
            if fits:
                best = min(fits, key=lambda i: rooms[i])
                rooms[best] -= length
            else:
                rooms.append(size - length)
    assert plan.sequences == len(rooms)
    rows = []
    for length, n in counts.items():
        sequence, offset = plan.find(np.full(n, length), np.arange(n))
        rows += [{"sequence_id": s, "offset": o, "length": length} for s, o in zip(sequence.tolist(), offset.tolist())]
    assert check_slots(rows, size) == len(rooms)


def test_ranks_within_a_length_are_unique(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text")).repartition(5)
    rows = packing.packed(docs, PATH, size=8).collect()
    assert check_slots(rows, 8) == 250
