from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from tests.llm.conftest import DOCS, awkward_rows, words
from tidewright.llm import exact_dedup, substring_dedup


def normalised(text: str | None) -> bytes:
    return (text or "").encode().lower()


def test_exact_groups(awkward):
    groups = defaultdict(list)
    for doc_id, text, *_ in awkward_rows():
        groups[normalised(text)].append(doc_id)
    found = exact_dedup.exact_duplicates(awkward).collect()
    assert len(found) == len(awkward_rows())
    for r in found:
        ids = groups[normalised(r["text"])]
        assert r["text_sha256"] == hashlib.sha256(normalised(r["text"])).hexdigest()
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = [r["text_sha256"] for r in found if r["kept"]]
    assert sorted(kept) == sorted(hashlib.sha256(k).hexdigest() for k in groups)


def test_tables_that_are_too_small_spill_to_the_next_level(spark, awkward, monkeypatch):
    rows = [(i, f"text number {i % 40} " * 20, "en", "a", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(exact_dedup, "BUCKET_BYTES", 1 << 30)
    wide = exact_dedup.content_classes(docs, table_bytes=1_500)
    assert wide.count() == 40
    assert {r["copies"] for r in wide.collect()} == {10}
    small = exact_dedup.exact_duplicates(awkward, table_bytes=500).select("keep_id", "group_size", "kept", "text_sha256")
    whole = exact_dedup.exact_duplicates(awkward).select("keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(str, small.collect())) == sorted(map(str, whole.collect()))


def test_contents_of_one_digest_are_told_apart():
    table = exact_dedup.ContentTable(1 << 20)
    same = b"\0" * 32
    for i in range(50):
        assert table.add(same, b"content %d" % (i % 25), i, 1, 1)
    assert len(table.contents) == 25
    assert table.copies == [2] * 25
    assert sorted(table.largest) == list(range(25, 50))


def test_exact_on_empty_and_clashing_tables(no_docs, clashing):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    assert exact_dedup.deduplicated(no_docs).columns == no_docs.columns
    kept = exact_dedup.deduplicated(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]
    assert {r["digest"] for r in kept.collect()} == {"x"}


def cut_by_hand(rows: list[tuple], window: int) -> list[tuple]:
    first: dict = {}
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for doc_id, words in split:
        if doc_id is not None:
            for a in range(len(words) - window + 1):
                key = tuple(words[a : a + window])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, words in split:
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            least = first.get(tuple(words[a : a + window]))
            if least is not None and (doc_id is None or least < doc_id):
                gone[a : a + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((doc_id, len(words), sum(gone), kept))
    return sorted(out, key=str)


def cut(docs, **options) -> list[tuple]:
    found = substring_dedup.without_repeats(docs, **options)
    return sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str)


def test_windows_of_fifty_words(awkward):
    assert cut(awkward) == cut_by_hand(awkward_rows(), 50)


def test_many_short_windows_in_several_passes(spark):
    rows = [(i, " ".join("abcab"[(i * k) % 5] for k in range(40)), "en", "s", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert cut(docs, window=6, minimiser=2, pass_words=50) == cut_by_hand(rows, 6)


def test_no_window_reaches_into_the_next_row(spark):
    rng = random.Random(8)
    passage, tail = words(rng, 60), words(rng, 49)
    rows = [
        (1, " ".join(words(rng, 20) + passage), "en", "s", 1),
        (2, " ".join(["opener", *words(rng, 80)]), "en", "s", 1),
        (3, " ".join(words(rng, 15) + passage + ["opener"] + words(rng, 15)), "en", "s", 1),
        (4, " ".join(words(rng, 30) + tail), "en", "s", 1),
        (5, " ".join(["footer", *words(rng, 70)]), "en", "s", 1),
        (6, " ".join(words(rng, 30) + tail), "en", "s", 1),
        (7, " ".join(["footer", *words(rng, 70)]), "en", "s", 1),
        (8, " ".join(words(rng, 25) + tail + ["footer"] + words(rng, 10)), "en", "s", 1),
    ]
    found = cut(spark.createDataFrame(rows, DOCS).coalesce(1))
    assert found == cut_by_hand(rows, 50)
    assert {r[0]: r[2] for r in found} == {1: 0, 2: 0, 3: 60, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0}


def test_a_hot_minimiser_is_dealt_by_windows(spark, monkeypatch):
    """A line with other words around it in every document: its windows are spread, and equal ones still meet."""
    rng = random.Random(11)
    line, passage = words(rng, 12), words(rng, 70)
    rows = [(i, " ".join(words(rng, 60) + line + (passage if i % 4 == 0 else words(rng, 60))), "en", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 4_000)
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 8_000)
    dealt = substring_dedup.dealing(docs)
    assert dealt.hot and dealt.more > 1
    sizes = defaultdict(set)
    for _, _, _, bucket, packed in substring_dedup._super_kmers([r[1].encode() for r in rows], 50, 4, dealt):
        sizes[bucket].add(packed)
    assert max(sum(map(len, x)) for x in sizes.values()) < 16_000
    plain = defaultdict(set)
    for _, _, _, bucket, packed in substring_dedup._super_kmers([r[1].encode() for r in rows], 50, 4, substring_dedup.Deal(dealt.buckets)):
        plain[bucket].add(packed)
    assert max(sum(map(len, x)) for x in plain.values()) > 16_000
    found = cut(docs)
    assert found == cut_by_hand(rows, 50)
    assert sum(r[2] for r in found) > 0


def test_fingerprint_clashes_are_settled_by_words(spark, monkeypatch):
    import numpy as np

    words = np.array([1, 2, 3, 1, 2, 4], np.int64)
    monkeypatch.setattr(substring_dedup.c, "range_hashes", lambda v, a, b: np.zeros(len(a), np.uint64))
    least = substring_dedup._least_holder(words, np.array([0, 3]), np.array([3, 3]), np.array([7, 5]), 2, 100)
    assert least[[0, 1, 3, 4]].tolist() == [5, 7, 5, 5]


def test_substring_on_empty_and_clashing_tables(no_docs, clashing):
    assert cut(no_docs) == []
    found = substring_dedup.without_repeats(clashing)
    assert {r["print"] for r in found.collect()} == {"x"}
    assert {r["n_words"] for r in found.collect()} == {3}
