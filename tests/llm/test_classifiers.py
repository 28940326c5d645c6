from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import awkward_rows
from tidewright.llm import quality, toxicity
from tidewright.llm.labelled import held_out

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def accuracy(found, labels, column):
    rows = found.join(labels, "doc_id").filter("held_out").select("predicted", F.col(column).alias("label"), "score").collect()
    return sum(r["predicted"] == r["label"] for r in rows) / len(rows), rows


def test_held_out_rows_are_those_of_the_crc(spark):
    ids = [(i,) for i in range(-5, 40)] + [(None,)]
    for doc_id, out in spark.createDataFrame(ids, "doc_id long").select("doc_id", held_out(F.col("doc_id"))).collect():
        assert out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0)


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    net = quality.fit(docs, labels)
    right, rows = accuracy(quality.judged(docs, net), labels, "quality")
    assert right >= 0.9
    kept = quality.kept(docs, net)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_quality_gradients():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(1, 255, n).tolist()) for n in (3, 600, 1500)] + [b""]
    net, labels = quality.Network.fresh(0.5, 3), np.array([1, 0, 1, 0], np.float32)
    for k in net.weights:
        net.weights[k] = net.weights[k].astype(np.float64)

    def loss():
        chunks, owner = quality.chunked(texts)
        logits = net.logits(net.pooled(net.activations(chunks)[0], owner, np.array([len(t) for t in texts])).astype(np.float64))[0]
        return float(np.mean(np.log1p(np.exp(-np.where(labels == 1, logits, -logits)))))

    slopes = net.gradients(texts, labels)
    for name in ("out", "hidden", "filters", "filter_bias", "embed"):
        flat = np.abs(slopes[name]).ravel()
        at = int(flat.argmax())
        weights = net.weights[name].reshape(-1)
        old, step = weights[at], 1e-3
        weights[at] = old + step
        high = loss()
        weights[at] = old - step
        low = loss()
        weights[at] = old
        assert (high - low) / (2 * step) == pytest.approx(slopes[name].ravel()[at], rel=0.15, abs=1e-4)


def test_chunks_cover_whole_texts():
    for n in (1, 64, 511, 512, 513, 5000):
        text = bytes(np.random.default_rng(n).integers(1, 255, n).tolist())
        chunks, owner = quality.chunked([text, b""])
        step = quality.CHUNK - quality.OVERLAP
        assert set(owner.tolist()) == {0}
        whole = b"".join(bytes(row[: step if i + 1 < len(chunks) else quality.CHUNK].tolist()) for i, row in enumerate(chunks))
        assert whole.rstrip(b"\0") == text


@pytest.mark.parametrize("module", [quality, toxicity])
def test_awkward_tables(spark, awkward, no_docs, clashing, module):
    label = "quality" if module is quality else "toxic"
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(12)], f"doc_id long, {label} int, note string")
    model = module.fit(awkward, labels)
    found = module.judged(awkward, model).collect()
    assert len(found) == len(awkward_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in found)
    assert module.judged(no_docs, model).count() == 0
    assert module.scored(clashing, model).count() == 6
    blank = module.fit(no_docs, labels.limit(0))
    assert {r["score"] for r in module.judged(awkward, blank).collect()} == {0.5}


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    right, _ = accuracy(toxicity.judged(docs, toxicity.fit(docs, labels)), labels, "toxic")
    assert right >= 0.97


def distance(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distances():
    terms = [toxicity.Term(b"idiot", False), toxicity.Term(b"scum", False), toxicity.Term(b"worthless", False), toxicity.Term(b"lostraku", True), toxicity.Term(b"vequ", True)]
    automaton, rng = toxicity.Automaton(terms), random.Random(4)
    words = [b"idiot", b"scum", b"scun", b"vequmo", b"veq", b"lostrakuand", b"lostrkuand", b"worthles", b"wortless", b"wrthlss", b"x"]
    for _ in range(1500):
        word = list(rng.choice(terms).text + rng.choice([b"", b"", b"en", b"s"]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = [rng.choice(b"idotscumwrhlevqz")] * rng.randint(0, 1)
        words.append(bytes(word) or b"q")
    data, _ = toxicity.c.joined(words)
    kinds = automaton.match(data, *toxicity.words_of(data))
    for word, kind in zip(words, kinds.tolist()):
        best = []
        for t in terms:
            near = min(distance(word[:k], t.text) for k in range(len(word) + 1)) if t.stem else distance(word, t.text)
            if near <= t.edits:
                best.append((toxicity.STEM if t.stem else toxicity.WORD) + 2 * (near > 0))
        assert kind == min(best, default=toxicity.NONE), word


def test_quotation_is_told_from_abuse():
    model = toxicity.Model([toxicity.Term(b"idiot", False)], toxicity._GUESS, 0.1, toxicity.Automaton([toxicity.Term(b"idiot", False)]))
    plain, quoted, reported, typo = model.counts([b"you IDIOT!", b'she read "such an idiot" aloud', b"the word idiot is old", b"an idiott"])
    assert plain.tolist() == [1, 0, 0, 0, 0, 0, 0, 0]
    assert quoted.tolist() == reported.tolist() == [0, 0, 0, 0, 1, 0, 0, 0]
    assert typo.tolist() == [0, 0, 1, 0, 0, 0, 0, 0]
    scores = model.scores([b"you idiot", b'she read "such an idiot" aloud'])
    assert scores[0] > 0.5 > scores[1]


def test_an_accented_letter_is_one_edit():
    terms = [toxicity.Term(b"idiot", False), toxicity.Term("crétin".encode(), False), toxicity.Term(b"ugh", False)]
    automaton = toxicity.Automaton(terms)
    given = ["idiöt", "ídiöt", "idiot", "crétin", "cretin", "crètin", "ügh", "ugh", "idi日t", "é", "idiot"]
    data = np.frombuffer(" ".join(given).encode() + b"\n", np.uint8)
    kinds = automaton.match(data, *toxicity.words_of(data)).tolist()
    near, word, none = toxicity.NEAR_WORD, toxicity.WORD, toxicity.NONE
    assert kinds == [near, none, word, word, near, near, none, word, near, none, word]


def test_short_terms_are_learned_and_match_exactly():
    rng = random.Random(9)
    plain = ["river", "stone", "cloud", "table", "green", "walks", "quiet", "paper"]
    texts, labels = [], []
    for i in range(200):
        words = [rng.choice(plain) for _ in range(20)]
        if i % 2:
            words.insert(rng.randrange(20), "kys")
        texts.append(" ".join(words).encode())
        labels.append(i % 2)
    terms = toxicity.learn_terms(texts, labels)
    assert toxicity.Term(b"kys", False) in terms
    data = np.frombuffer(b"kys kya kyss ky", np.uint8)
    assert toxicity.Automaton(terms).match(data, *toxicity.words_of(data)).tolist() == [toxicity.WORD, toxicity.NONE, toxicity.NONE, toxicity.NONE]


def test_scores_equal_a_plain_loop_over_bytes():
    import math

    network = quality.Network.fresh(0.3)
    rng = np.random.default_rng(3)
    for name in ("filter_bias", "hidden_bias", "out_bias"):
        network.weights[name] = rng.standard_normal(network.weights[name].shape).astype(np.float32) / 4
    w = {k: v.astype(float) for k, v in network.weights.items()}
    texts = [b"", b"a", bytes(rng.integers(1, 256, 40, np.uint8)), b"word " * 100, bytes(rng.integers(1, 256, 1300, np.uint8))]

    def score(text: bytes) -> float:
        step, chunks = quality.CHUNK - quality.OVERLAP, []
        for at in range(0, max(1, len(text) - quality.OVERLAP), step) if text else ():
            part = text[at : at + quality.CHUNK].ljust(quality.CHUNK, b"\0")
            best = [0.0] * quality.FILTERS
            for first in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE):
                seen = [x for byte in part[first : first + quality.WIDTH] for x in w["embed"][byte]]
                for f in range(quality.FILTERS):
                    best[f] = max(best[f], sum(a * b for a, b in zip(seen, w["filters"][:, f])) + w["filter_bias"][f])
            chunks.append(best)
        mean = [sum(c[f] for c in chunks) / len(chunks) if chunks else 0.0 for f in range(quality.FILTERS)]
        most = [max((c[f] for c in chunks), default=0.0) for f in range(quality.FILTERS)]
        place = min(max(math.log2(max(len(text), 1)) - 4, 0), quality.SIZES - 1)
        features = mean + most + [max(0.0, 1 - abs(place - k)) for k in range(quality.SIZES)]
        hidden = [max(0.0, sum(a * b for a, b in zip(features, w["hidden"][:, h])) + w["hidden_bias"][h]) for h in range(quality.HIDDEN)]
        logit = sum(a * b for a, b in zip(hidden, w["out"])) + w["out_bias"][0] + math.log(0.3 / 0.7)
        return 1 / (1 + math.exp(-logit))

    assert network.scores(texts).tolist() == pytest.approx([score(t) for t in texts], abs=1e-5)
