"""Toxicity: Levenshtein automata over a trie of terms, with scores for the context of each hit.

The lexicon is learned from a bounded sample of labelled rows: whole words, and stems (any ending), that occur in toxic
documents and hardly elsewhere. Its trie is intersected with Levenshtein automata (no edit below EDIT_FROM letters, one from there on, two
from TWO_EDITS_FROM) and made deterministic, so all words of a batch walk through one table in step, and most of them drop out
after a few letters. Letters are code points: an accented one is one letter, one edit. Terms under EDIT_FROM letters match exactly. Each hit is weighed by its window: words between quotation marks, or next to a word that reports
speech, count as quotation. Counts of hits by kind are combined into one probability by a logistic model.

Words are runs of letters, digits and bytes above 127, in lower case. Null and empty texts have no hits. Without labels of both classes
the lexicon is empty and the score is the share of label 1, or 0.5. Repeated rows get the same score.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c
from tidewright.llm.labelled import held_out, sample

PER_CLASS = 1000  # training documents of either class
TERMS = 200
EDIT_FROM, TWO_EDITS_FROM = 5, 9  # letters of a term
STEM_FROM, STEM_TO, STEM_EDIT_FROM = 4, 10, 7
WINDOW_BYTES = 60  # on either side of a hit
THRESHOLD = 0.5

NONE, WORD, STEM, NEAR_WORD, NEAR_STEM = range(5)
QUOTED = 4  # added to the kind of a hit
_OPEN = ['"', "“", "«", "‘", "„"]
_CLOSE = ['"', "”", "»", "’", "“"]
_REPORTS = re.compile(rb"\b(called|calls|said|says|saying|quote|quotes|quoted|wrote|writes|word|words|term|terms|slur|insult|insults)\b")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    edge = np.zeros(len(data) + 2, np.int8)
    edge[1:-1] = _LETTER[data]
    step = np.diff(edge)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def lowered(text: bytes) -> bytes:
    return text.decode("utf-8", "replace").lower().encode()


@dataclass(frozen=True)
class Term:
    text: bytes
    stem: bool

    @property
    def edits(self) -> int:
        letters = len(self.text.decode("utf-8", "replace"))
        if self.stem:
            return int(letters >= STEM_EDIT_FROM)
        return 2 if letters >= TWO_EDITS_FROM else int(letters >= EDIT_FROM)


class Automaton:
    """All words within the allowed edits of a term, as one table: state 0 is dead, state 1 the start."""

    def __init__(self, terms: list[Term]):
        children: list[dict[int, int]] = [{}]
        ends: list[list[Term]] = [[]]
        deepest: list[int] = [0]  # most edits that a term below this node allows
        for term in terms:
            node = 0
            deepest[0] = max(deepest[0], term.edits)
            for letter in map(ord, term.text.decode("utf-8", "replace")):
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    ends.append([])
                    deepest.append(0)
                node = children[node][letter]
                deepest[node] = max(deepest[node], term.edits)
            ends[node].append(term)
        letters = sorted({x for node in children for x in node})
        self.letters = np.array(letters, np.uint32)

        def closed(places: dict[int, int]) -> frozenset:
            """Letters of a term may be skipped for an edit each; per node only the fewest edits matter."""
            queue = sorted(places.items(), key=lambda x: x[1])
            while queue:
                node, edits = queue.pop(0)
                if places.get(node, 99) < edits:
                    continue
                for child in children[node].values():
                    if edits + 1 <= deepest[child] and edits + 1 < places.get(child, 99):
                        places[child] = edits + 1
                        queue.append((child, edits + 1))
            return frozenset(places.items())

        def kind(places: frozenset, stem: int) -> int:
            best = stem
            for node, edits in places:
                for term in ends[node]:
                    if edits <= term.edits:
                        found = (STEM if term.stem else WORD) if edits == 0 else (NEAR_STEM if term.stem else NEAR_WORD)
                        best = found if best == NONE else min(best, found)
            return best

        def stems(places: frozenset, stem: int) -> int:
            best = stem
            for node, edits in places:
                for term in ends[node]:
                    if term.stem and edits <= term.edits:
                        found = STEM if edits == 0 else NEAR_STEM
                        best = found if best == NONE else min(best, found)
            return best

        start = closed({0: 0})
        states: dict[tuple[frozenset, int], int] = {(frozenset(), NONE): 0, (start, NONE): 1}
        rows: list[list[int]] = [[0] * (len(letters) + 1)]
        kinds = [NONE, kind(start, NONE)]
        todo = [(start, NONE)]
        while todo:
            places, stem = todo.pop(0)
            row = []
            for letter in [-1, *letters]:
                after: dict[int, int] = {}
                for node, edits in places:
                    child = children[node].get(letter)
                    if child is not None and edits < after.get(child, 99):
                        after[child] = edits
                    if edits + 1 <= deepest[node] and edits + 1 < after.get(node, 99):
                        after[node] = edits + 1
                    for other in children[node].values():
                        if edits + 1 <= deepest[other] and edits + 1 < after.get(other, 99):
                            after[other] = edits + 1
                reached = closed(after)
                key = (reached, stems(reached, stem))
                if key not in states:
                    states[key] = len(states)
                    kinds.append(kind(reached, key[1]))
                    todo.append(key)
                row.append(states[key])
            rows.append(row)
        self.table = np.array(rows, np.int32)
        self.kinds = np.array(kinds, np.int8)

    def classes(self, data: np.ndarray) -> np.ndarray:
        """Column of the table for every code point of UTF-8; 0: a letter that no term has."""
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        if not len(self.letters):
            return np.zeros(len(codes), np.int64)
        place = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[place] == codes, place + 1, 0)

    def match(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Kind of every word of UTF-8, given its bytes; all words advance one letter at a time together."""
        classes = self.classes(data)
        if len(classes) < len(data):
            letters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            starts, ends = letters[starts], letters[ends]
        state = np.ones(len(starts), np.int32)
        live = np.arange(len(starts))
        offset = 0
        while len(live):
            at = starts[live] + offset
            state[live] = self.table[state[live], classes[at]]
            live = live[(state[live] != 0) & (at + 1 < ends[live])]
            offset += 1
        return self.kinds[state]


def is_quoted(data: bytes, start: int, end: int, begin: int, finish: int) -> bool:
    """Whether the hit stands between quotation marks of its line, or near a word that reports speech."""
    left, right = data[max(begin, start - WINDOW_BYTES) : start], data[end : min(finish, end + WINDOW_BYTES)]
    left, right = left[left.rfind(b"\n") + 1 :], right.split(b"\n", 1)[0]
    if _REPORTS.search(left) or _REPORTS.search(right):
        return True
    if left.count(b'"') % 2 and b'"' in right:
        return True
    before, after = left.decode("utf-8", "ignore"), right.decode("utf-8", "ignore")
    for a, b in zip(_OPEN[1:], _CLOSE[1:]):
        if before.rfind(a) > before.rfind(b) and b in after:
            return True
    return False


def _contexts(texts: list[bytes]) -> dict[tuple[str, bool], set[str]]:
    """For every word and stem, the different words it follows: copies of one passage count once."""
    found: dict[tuple[str, bool], set[str]] = defaultdict(set)
    for text in texts:
        words = re.findall(r"[^\W_]+", text.decode("utf-8", "replace").lower())
        for before, word in set(zip(["", *words], words)):
            found[(word, False)].add(before)
            for n in range(STEM_FROM, min(len(word), STEM_TO) + 1):
                found[(word[:n], True)].add(before)
    return found


def learn_terms(texts: list[bytes], labels: list[int], limit: int = TERMS) -> list[Term]:
    """Words and stems found in many different places of toxic documents, for their number, and hardly in the others."""
    toxic = _contexts([t for t, y in zip(texts, labels) if y])
    clean = _contexts([t for t, y in zip(texts, labels) if not y])
    rows = max(1, sum(labels)), max(1, len(labels) - sum(labels))
    least = max(5, 0.02 * rows[0])
    good = {
        k: len(v)
        for k, v in toxic.items()
        if len(v) >= least and len(clean.get(k, ())) / rows[1] <= 0.005 * len(v) / rows[0]
    }
    chosen: dict[tuple[str, bool], int] = {}
    for (text, stem), n in good.items():
        if any(good.get((text[:k], True), 0) >= 1.1 * n for k in range(STEM_FROM, len(text) + (not stem))):
            continue  # a shorter stem covers it
        if stem:
            longer = (m for (other, kind), m in good.items() if kind and len(other) == len(text) + 1 and other.startswith(text))
            if max(longer, default=0) >= 0.9 * n or good.get((text, False), 0) >= 0.9 * n:
                continue  # a longer stem, or one word, stands for as much
        chosen[(text, stem)] = n
    top = sorted(chosen, key=lambda k: (-chosen[k], k))[:limit]
    return [Term(text.encode(), stem) for text, stem in top]


@dataclass
class Model:
    terms: list[Term]
    weights: np.ndarray  # bias, then one weight per kind of hit, plain and quoted
    prior: float
    automaton: Automaton | None

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Hits of each kind per document: plain in columns 0-3, quoted in 4-7."""
        out = np.zeros((len(texts), 8))
        low = [lowered(t) for t in texts]
        for lo, hi in c.chunks(low):
            data, begins = c.joined(low[lo:hi])
            starts, ends = words_of(data)
            kinds = self.automaton.match(data, starts, ends)
            hits = np.flatnonzero(kinds)
            if not len(hits):
                continue
            raw = data.tobytes()
            owner = np.searchsorted(begins, starts[hits], "right") - 1
            for hit, doc in zip(hits.tolist(), owner.tolist()):
                begin, finish = int(begins[doc]), int(begins[doc]) + len(low[lo + doc])
                quoted = is_quoted(raw, int(starts[hit]), int(ends[hit]), begin, finish)
                out[lo + doc, int(kinds[hit]) - 1 + QUOTED * quoted] += 1
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.automaton is None:
            return np.full(len(texts), self.prior)
        logits = self.weights[0] + np.log1p(self.counts(texts)) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


#: What the weights are pulled towards: quotation counts little, misspelt stems less than the rest.
_GUESS = np.array([-3.0, 5.0, 5.0, 3.0, 1.0, 0.8, 0.8, 0.4, 0.1])


def train(texts: list[bytes], labels: list[int], prior: float) -> Model:
    terms = learn_terms(texts, labels) if len(set(labels)) == 2 else []
    if not terms:
        return Model([], _GUESS, prior, None)
    model = Model(terms, _GUESS.copy(), prior, Automaton(terms))
    x = np.column_stack([np.ones(len(texts)), np.log1p(model.counts(texts))])
    y = np.array(labels, float)
    weight = np.where(y == 1, prior / max(1, y.sum()), (1 - prior) / max(1, (1 - y).sum())) * len(y)
    w = _GUESS.copy()
    for _ in range(50):  # Newton's method on the penalised logistic loss
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + (w - _GUESS)
        bend = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    model.weights = w
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    return train(*sample(docs, labels, "toxic", per_class))


def scored(docs: DataFrame, model: Model, name: str = "toxicity_score") -> DataFrame:
    """Rows of `docs` plus their score, from the text alone; a column of that name is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = c.as_bytes(batch.column("text"))
            scores = [model.scores(texts[a:b]) for a, b in c.chunks(texts)]
            column = pa.array(np.concatenate([np.zeros(0), *scores]), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    own = docs.select(*c.others(docs, name))
    return own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField(name, T.DoubleType())]))


def judged(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = scored(docs.select("doc_id", "text"), model)
    score = F.col("toxicity_score")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted"))
