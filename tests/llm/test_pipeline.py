"""The pipeline's stages against what each must do to its own input."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.test_mixing_and_packing import check_slots
from tests.llm.test_ngram import shingles
from tidewright.llm import mixing
from tidewright.session import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids, seen = docs.columns, [], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(docs)
        docs = written(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        ids.append(sorted(r["doc_id"] for r in docs.collect()))
    whole = {r["doc_id"]: r["text"] for r in seen[0].collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert len(set(clean) - set(ids[0])) <= 0.1 * len(clean)

    last: dict[str, int] = {}
    for i in ids[0]:
        last[(whole[i] or "").encode().lower()] = i
    assert ids[1] == sorted(last.values())

    sets = {i: shingles(whole[i]) for i in ids[1]}
    part = {i: i for i in ids[1]}
    for i in ids[1]:
        for j in ids[1]:
            if j < i and sets[i] and sets[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                old, new = part[i], part[j]
                part = {k: new if p == old else p for k, p in part.items()}
    first: dict[int, int] = {}
    for i in ids[1]:
        first.setdefault(part[i], i)
    assert ids[2] == sorted(first.values())

    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(seen[3]).collect()}
    assert ids[3] == sorted(i for i, n in copies.items() for _ in range(n))

    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in rows} == set(ids[3])
    check_slots(rows, 2048)


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
