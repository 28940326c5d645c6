"""Quality classifier: a convolutional network over bytes, in numpy.

A text is cut into overlapping chunks that cover all of it. Bytes are embedded, learned filters slide over each chunk, their largest
activations are kept per chunk, and a document's mean and largest activations and its length are combined into one
probability. Trained on the driver on a bounded sample of labelled rows; the weights, a few kilobytes, go to the tasks.

Null and empty texts get the score of a document without activations. Without labels of both classes the score is the share of
label 1, or 0.5. Repeated rows get the same score. Other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c
from tidewright.llm.labelled import held_out, sample

CHUNK, OVERLAP = 512, 64
EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 4, 8, 2, 32, 16
SIZES = 10  # lengths of texts are told apart by powers of two from 16 bytes on
PER_CLASS = 1000  # training documents of either class
EPOCHS = 12
THRESHOLD = 0.3
BLOCK = 256  # chunks worked on at a time


def chunked(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of all texts as rows of bytes, zeros behind the end, and the text of each."""
    step = CHUNK - OVERLAP
    counts = [max(1, -(-(len(t) - OVERLAP) // step)) if t else 0 for t in texts]
    out = np.zeros((sum(counts), CHUNK), np.uint8)
    row = 0
    for text, n in zip(texts, counts):
        if n:
            padded = np.zeros((n - 1) * step + CHUNK, np.uint8)
            padded[: len(text)] = np.frombuffer(text, np.uint8)
            out[row : row + n] = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]
            row += n
    return out, np.repeat(np.arange(len(texts)), counts)


def _windows(values: np.ndarray) -> np.ndarray:
    """(chunks, positions, WIDTH * values per byte) views of consecutive bytes."""
    each = values.shape[1] // CHUNK
    return np.lib.stride_tricks.sliding_window_view(values, WIDTH * each, axis=1)[:, :: STRIDE * each]


@dataclass
class Network:
    prior: float
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(prior: float, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        shapes = {"embed": (256, EMBED), "filters": (WIDTH * EMBED, FILTERS), "hidden": (2 * FILTERS + SIZES, HIDDEN), "out": (HIDDEN,)}
        weights = {k: (rng.standard_normal(s) * (0.5 if k == "embed" else 1 / np.sqrt(s[0]))).astype(np.float32) for k, s in shapes.items()}
        weights |= {"filter_bias": np.zeros(FILTERS, np.float32), "hidden_bias": np.zeros(HIDDEN, np.float32), "out_bias": np.zeros(1, np.float32)}
        weights["embed"][0] = 0  # the byte behind the end of a text
        return Network(prior, weights)

    def activations(self, chunks: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest activation of every filter in every chunk, and its position."""
        w, best, places = self.weights, [], []
        for i in range(0, len(chunks), BLOCK):
            part = chunks[i : i + BLOCK]
            seen = np.ascontiguousarray(_windows(w["embed"][part].reshape(len(part), -1)))
            out = (seen.reshape(-1, WIDTH * EMBED) @ w["filters"]).reshape(len(part), -1, FILTERS)
            if where:
                places.append(out.argmax(axis=1))
            best.append(np.maximum(out.max(axis=1) + w["filter_bias"], 0))
        none = np.zeros((0, FILTERS), w["filters"].dtype)
        return np.concatenate([none, *best]), np.concatenate(places) if places else None

    @staticmethod
    def pooled(best: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Per document: mean and largest activation of its chunks, and its length as a position between powers of two."""
        out = np.zeros((len(sizes), 2 * FILTERS + SIZES), best.dtype)
        counts = np.bincount(owner, minlength=len(sizes))
        has = np.flatnonzero(counts)
        if len(has):
            starts = np.concatenate(([0], np.cumsum(counts[has])[:-1]))
            out[has, :FILTERS] = np.add.reduceat(best, starts) / counts[has, None]
            out[has, FILTERS : 2 * FILTERS] = np.maximum.reduceat(best, starts)
        place = np.clip(np.log2(np.maximum(sizes, 1)) - 4, 0, SIZES - 1)
        out[:, 2 * FILTERS :] = np.maximum(0, 1 - np.abs(place[:, None] - np.arange(SIZES)))
        return out

    def logits(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights
        hidden = np.maximum(features @ w["hidden"] + w["hidden_bias"], 0)
        return hidden @ w["out"] + w["out_bias"][0], hidden

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.prior)
        chunks, owner = chunked(texts)
        features = self.pooled(self.activations(chunks)[0], owner, np.array([len(t) for t in texts]))
        logits = self.logits(features)[0].astype(np.float64) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss; a filter learns at its largest activation in each chunk."""
        w = self.weights
        chunks, owner = chunked(texts)
        best, places = self.activations(chunks, where=True)
        sizes = np.array([len(t) for t in texts])
        features = self.pooled(best, owner, sizes)
        logits, hidden = self.logits(features)
        error = ((1 / (1 + np.exp(-logits))) - labels).astype(np.float32) / len(labels)
        g = {"out": hidden.T @ error, "out_bias": error.sum(keepdims=True)}
        back = error[:, None] * w["out"] * (hidden > 0)
        g["hidden"], g["hidden_bias"] = features.T @ back, back.sum(axis=0)
        back = back @ w["hidden"].T
        counts = np.bincount(owner, minlength=len(sizes)).astype(np.float32)
        most = best == features[owner, FILTERS : 2 * FILTERS]
        into = (back[owner, :FILTERS] / counts[owner, None] + back[owner, FILTERS : 2 * FILTERS] * most) * (best > 0)
        g["filter_bias"] = into.sum(axis=0)
        at = places[:, :, None] * STRIDE + np.arange(WIDTH)
        seen = chunks[np.arange(len(chunks))[:, None, None], at]  # (chunks, filters, WIDTH) bytes
        g["filters"] = np.einsum("nf,nfk->kf", into, w["embed"][seen].reshape(len(chunks), FILTERS, -1))
        spread = into[:, :, None, None] * w["filters"].T.reshape(1, FILTERS, WIDTH, EMBED)
        flat = seen.ravel()
        g["embed"] = np.stack([np.bincount(flat, spread[..., e].ravel(), 256) for e in range(EMBED)], axis=1).astype(np.float32)
        g["embed"][0] = 0
        return g


def train(texts: list[bytes], labels: list[int], prior: float, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on batches of 32 documents; both classes weigh the same, the share of label 1 enters the score afterwards."""
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return Network(prior)
    net, rng = Network.fresh(float(np.clip(prior, 0.01, 0.99)), seed), np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in net.weights.items()}
    square = {k: np.zeros_like(v) for k, v in net.weights.items()}
    classes = [np.flatnonzero(y == v) for v in (0, 1)]
    steps = max(4, len(y) // 32)
    for step in range(1, epochs * steps + 1):
        pick = np.concatenate([rng.choice(k, 16) for k in classes])
        rate = 0.01 * (1 - (step - 1) / (epochs * steps))
        for k, g in net.gradients([texts[i] for i in pick], y[pick]).items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            net.weights[k] = (net.weights[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    return train(*sample(docs, labels, "quality", per_class))


def scored(docs: DataFrame, net: Network, name: str = "quality_score") -> DataFrame:
    """Rows of `docs` plus their score, from the text alone; a column of that name is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = c.as_bytes(batch.column("text"))
            scores = [net.scores(texts[a:b]) for a, b in c.chunks(texts, 1 << 20)]
            column = pa.array(np.concatenate([np.zeros(0), *scores]), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    own = docs.select(*c.others(docs, name))
    return own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField(name, T.DoubleType())]))


def judged(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = scored(docs.select("doc_id", "text"), net)
    score = F.col("quality_score")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted"))


def kept(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """Rows that the classifier does not reject, with the columns of the input."""
    return scored(docs, net, "_score_of_text").filter(F.col("_score_of_text") >= threshold).select(*c.others(docs))
