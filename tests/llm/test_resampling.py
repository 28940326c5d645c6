from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import DOCS, awkward_rows
from tidewright.llm import resampling

TARGET = [(1, "again and the same row, ONE two three"), (2, None), (3, "é ü changed!")]


def features(text: str | None) -> list[bytes]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return [x.encode() for x in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(rows: list[tuple], target: list[str | None], percent: int = 25, least: int = 20) -> list[tuple]:
    def counts(texts):
        out = [0] * 10_000
        for text in texts:
            for f in features(text):
                out[zlib.crc32(f) % 10_000] += 1
        return out

    s, t = counts(text for _, text in rows), counts(target)
    gain = [math.floor(1000 * math.log((b + 1.0) * (sum(s) + 10_000.0) / ((a + 1.0) * (sum(t) + 10_000.0)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in rows:
        buckets = [zlib.crc32(f) % 10_000 for f in features(text)]
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= 2 * least - 1), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return [tuple(r) for r in out]


def results(df) -> list[tuple]:
    return [tuple(r) for r in df.select("doc_id", *resampling.RESULTS).collect()]


@pytest.mark.parametrize("head", [0, 5, 1024])
def test_results_equal_brute_force_whatever_is_in_the_head(spark, awkward, monkeypatch, head):
    monkeypatch.setattr(resampling, "HEAD", head)
    monkeypatch.setattr(resampling, "ROWS_A_RANGE", 3)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    found = results(resampling.resampled(awkward, target))
    expected = brute([r[:2] for r in awkward_rows()], [r[1] for r in TARGET])
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert sum(r[4] is not None for r in found) == 4


def test_ranks_are_gapless_over_ranges_with_ties(spark, monkeypatch):
    monkeypatch.setattr(resampling, "ROWS_A_RANGE", 10)
    rows = [(i // 2, "w " * 25, "en", "a", 1) for i in range(200)]
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    found = results(resampling.resampled(spark.createDataFrame(rows, DOCS).repartition(5), target))
    assert sorted(found, key=str) == sorted(brute([r[:2] for r in rows], [r[1] for r in TARGET]), key=str)
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 51))


def test_crcs_are_carried_on_column_by_column():
    rng = random.Random(4)
    words = [bytes(rng.randrange(1, 256) for _ in range(rng.choice([0, 1, 7, 8, 23, 24, 25, 90]))) for _ in range(300)]
    states = np.array([rng.randrange(1 << 32) for _ in words], np.uint32)
    lengths = np.array([len(w) for w in words])
    found = resampling.crc_on(states, np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths)
    assert found.tolist() == [zlib.crc32(w, s) for w, s in zip(words, states.tolist())]


@pytest.mark.parametrize("limit", [1, 3, 10, 64, 1000])
def test_long_texts_are_cut_between_words(limit):
    rng = random.Random(limit)
    text = "".join(rng.choice(["a", "B", "é", " ", ",", "\x00", "word", "   ", "x" * 30]) for _ in range(400)).encode()
    vocabulary, expected = resampling.Vocabulary([b"word", b"a"]), sorted(zlib.crc32(f) % 10_000 for f in features(text.decode()))
    found: list[int] = []
    for block, carried in resampling.blocks(text, limit):
        words, _, pairs, _ = vocabulary.features([block])
        found += words[carried:].tolist() + pairs.tolist()
    assert sorted(found) == expected


def test_a_text_longer_than_a_block():
    vocabulary = resampling.Vocabulary([b"filler"])
    texts = [b"", b"filler, filler and more " * 9, b"short"]
    total = sum(len(words) + len(pairs) for _, _, words, _, pairs, _ in resampling._batches(vocabulary, texts, 50))
    assert total == sum(len(features(t.decode())) for t in texts)


def test_empty_tables_and_clashing_columns(spark, no_docs, awkward):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(no_docs, nothing).count() == 0
    assert sorted(results(resampling.resampled(awkward, nothing)), key=str) == sorted(brute([r[:2] for r in awkward_rows()], []), key=str)
    names = ["rank", "Weight", "score", "n_features", "_id", "_part", "_before", "_rows", "_number", "_row", "bucket"]
    rows = [(i, "w " * 30, *["x"] * len(names)) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    found = resampling.drawn(docs, nothing)
    assert found.columns == docs.columns and found.count() == 2 and {r["_id"] for r in found.collect()} == {"x"}
    assert resampling.resampled(docs, nothing).columns == ["doc_id", *[n for n in names if n.lower() not in resampling.RESULTS], *resampling.RESULTS]
