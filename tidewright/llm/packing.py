"""Best-fit packing planned over a histogram of lengths.

Documents become token ids, an end id after each; longer ones are cut into full pieces and a rest. The histogram of piece
lengths (`size` numbers at most) reaches the driver, where best fit in decreasing order works on counts: sequences with
the same room are ranges of numbers, and a range takes as many pieces of a length as fit. The plan's size depends on the number
of lengths, not of documents. Pieces are numbered within their length (by task, then by order in the task) and find their
slot by that rank, so a length that a third of all pieces have is no group of its own anywhere.

Ids of a text are those of its runs of non-space characters one after another, which holds for tokenizers that drop white space
and never join across it; every distinct run is encoded once per worker as long as a bounded table holds it. Null texts are empty: a
single end id. A null doc_id is kept. Repeated rows are packed as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import array
import json
import os
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewright.llm import common as c
from tidewright.session import written

SIZE = 2048
END = 0
KNOWN_RUNS = 600_000  # about 60 bytes each
FLUSH_BYTES = 4 << 20  # of ids handed on at a time
PUNCTUATION = string.punctuation.encode()
LAST_LATIN = "\u02b0"
#: How the tokenizer must cut for runs to be put together from words and punctuation (fixed value of its file).
LETTERS_APART = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_FIRST_RANK = 1 << 44


class Runs:
    """Ids of runs of non-space characters, as little-endian 32-bit integers; tables are emptied when they are full.

    The runs of some texts are looked up together, in arrays, and their ids gathered by offsets; only runs not seen before are
    looked at one by one. Where the tokenizer cuts letters from other characters and marks the ends of words, a run of Latin letters with
    punctuation behind it is put together from both parts, and many words of letters are encoded as one text and told apart by those marks.
    """

    def __init__(self, path: str, limit: int = KNOWN_RUNS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.table = _Table()
        self.known: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.tails: dict[bytes, bytes] = {b"": b""}
        rules = self.tokenizer.to_str()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.apart = bool(suffix) and json.dumps(LETTERS_APART)[1:-1] in rules and '"Lowercase"' in rules
        if self.apart:
            size = self.tokenizer.get_vocab_size()
            self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array("I", e.ids).tobytes() for e in found]

    def _learn_words(self, words: list[str]) -> None:
        groups = [words[i : i + 100] for i in range(0, len(words), 100)]
        for group, raw in zip(groups, self._plain([" ".join(g) for g in groups])):
            ids = np.frombuffer(raw, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(group) and cuts[-1] == len(ids):
                self.words.update(zip(group, (x.tobytes() for x in np.split(ids, cuts[:-1]))))
            else:
                self.words.update(zip(group, self._plain(group)))

    def _learned(self, fresh: list[bytes]) -> list[bytes]:
        """Ids of distinct runs, one after the other."""
        whole, parts = [], []
        for i, run in enumerate(fresh):
            word = run.rstrip(PUNCTUATION) if self.apart else b""
            text = word.decode("utf-8", "replace")
            lower = text.lower()
            if lower.isalpha() and (lower.isascii() or max(lower) < LAST_LATIN and max(text) < LAST_LATIN):
                parts.append((i, lower, run[len(word) :]))
            else:
                whole.append(i)
        out: list[bytes] = [b""] * len(fresh)
        for at in range(0, len(whole), 10_000):
            some = whole[at : at + 10_000]
            for i, ids in zip(some, self._plain([fresh[i].decode("utf-8", "replace") for i in some])):
                out[i] = ids
        if len(self.words) > self.limit // 2:
            self.words.clear()
        if len(self.tails) > self.limit // 4:
            self.tails = {b"": b""}
        self._learn_words(list({w for _, w, _ in parts if w not in self.words}))
        tails = list({t for _, _, t in parts if t not in self.tails})
        self.tails.update(zip(tails, self._plain([t.decode() for t in tails])))
        for i, word, tail in parts:
            out[i] = self.words[word] + self.tails[tail]
        return out

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        for lo, hi in c.chunks(texts):
            yield from self._encoded(texts[lo:hi])

    def _encoded(self, texts: list[bytes]) -> Iterator[bytes]:
        data, begins = c.joined(texts)
        starts, ends = c.spans(data)
        lengths = ends - starts
        keys = _run_keys(data, starts, lengths)
        prints = _run_prints(keys, lengths)
        distinct, at, place = np.unique(prints, return_index=True, return_inverse=True)
        # a run is looked up in the table if its whole content is its key; the rest, long ones above all, goes by a dictionary
        plain = (lengths <= _KEY_BYTES) & (keys == keys[at[place]]).all(axis=1) & (lengths == lengths[at[place]])
        asked = np.flatnonzero(plain[at])
        if self.table.size + len(asked) > self.limit:
            self.table = _Table()
        row = self.table.rows(distinct[asked])
        fresh = asked[~self.table.holds(row, distinct[asked], keys[at[asked]])]
        spots = at[fresh]
        found = self._learned([data[i:j].tobytes() for i, j in zip(starts[spots].tolist(), ends[spots].tolist())])
        self.table.add(distinct[fresh], keys[spots], found)
        row = self.table.rows(distinct[asked])
        held = self.table.holds(row, distinct[asked], keys[at[asked]])  # false where another run has the same fingerprint
        row_of = np.full(len(distinct), -1, np.int64)
        row_of[asked[held]] = row[held]

        rows = np.where(plain, row_of[place], -1)
        other = np.flatnonzero(rows < 0)
        others = [data[i:j].tobytes() for i, j in zip(starts[other].tolist(), ends[other].tolist())]
        new = list({run for run in others if run not in self.known})
        if len(self.known) + len(new) > self.limit // 8:
            self.known.clear()
            new = list(set(others))
        self.known.update(zip(new, self._learned(new)))

        counts = np.zeros(len(starts), np.int64)
        counts[rows >= 0] = self.table.counts[rows[rows >= 0]]
        counts[other] = [len(self.known[run]) // 4 for run in others]
        upto = np.concatenate([[0], np.cumsum(counts)])
        source = np.where(rows >= 0, self.table.offsets[rows], 0) - upto[:-1] if self.table.size else np.zeros(len(starts), np.int64) - upto[:-1]
        out = self.table.ids.take(np.repeat(source, counts) + np.arange(upto[-1]), mode="clip") if len(self.table.ids) else np.zeros(upto[-1], np.uint32)
        for i, run in zip(other.tolist(), others):
            out[upto[i] : upto[i + 1]] = np.frombuffer(self.known[run], np.uint32)
        cuts = upto[np.searchsorted(starts, np.append(begins, len(data)))].tolist()
        for i, j in zip(cuts[:-1], cuts[1:]):
            yield out[i:j].tobytes()


_KEY_BYTES = 24


def _run_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first 24 bytes of each run as three numbers, zeros behind its end."""
    spare = np.concatenate([data, np.zeros(_KEY_BYTES, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(spare, _KEY_BYTES)
    keys = view[starts].view("<u8").reshape(-1, 3)
    for k in range(3):
        left = np.clip(lengths - 8 * k, 0, 8)
        keys[:, k] &= _FULL[left]
    return keys


_FULL = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _run_prints(keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = c.mix(lengths.astype(np.uint64))
    for k in range(3):
        out = c.mix(out ^ keys[:, k])
    return out


class _Table:
    """Ids of runs of up to 24 bytes, found by a fingerprint and told apart by their whole content."""

    def __init__(self) -> None:
        self.size = 0
        self.prints, self.keys = np.zeros(0, np.uint64), np.zeros((0, 3), np.uint64)
        self.offsets, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def rows(self, prints: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.prints, prints), max(0, self.size - 1))

    def holds(self, rows: np.ndarray, prints: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.zeros(len(prints), bool)
        return (self.prints[rows] == prints) & (self.keys[rows] == keys).all(axis=1)

    def add(self, prints: np.ndarray, keys: np.ndarray, ids: list[bytes]) -> None:
        """`prints` are sorted; one that is there already stays as it is."""
        if not len(prints):
            return
        counts = np.array([len(x) // 4 for x in ids], np.int64)
        offsets = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), np.uint32)])
        new = ~((self.prints[self.rows(prints)] == prints) if self.size else np.zeros(len(prints), bool))
        at = np.searchsorted(self.prints, prints[new])
        self.prints, self.keys = np.insert(self.prints, at, prints[new]), np.insert(self.keys, at, keys[new], axis=0)
        self.offsets, self.counts = np.insert(self.offsets, at, offsets[new]), np.insert(self.counts, at, counts[new])
        self.size = len(self.prints)


@lru_cache(maxsize=2)
def _runs(path: str) -> Runs:
    return Runs(path)  # kept by the worker from task to task


def _piece(content: str, kind: T.DataType, arrow: pa.DataType) -> tuple[T.StructType, pa.Schema]:
    columns = [("doc_id", T.LongType(), pa.int64()), ("piece", T.IntegerType(), pa.int32()), ("start", T.LongType(), pa.int64()), ("length", T.LongType(), pa.int64())]
    columns += [(content, kind, arrow), ("task", T.LongType(), pa.int64()), ("rank", T.LongType(), pa.int64())]
    return T.StructType([T.StructField(n, k) for n, k, _ in columns]), pa.schema([(n, x) for n, _, x in columns])


_WITH_IDS = _piece("ids", T.BinaryType(), pa.binary())
_WITH_DIGEST = _piece("ids_crc32", T.LongType(), pa.int64())


def _cut(path: str, size: int, end: int, digest: bool):
    last = int(end).to_bytes(4, "little")
    schema = (_WITH_DIGEST if digest else _WITH_IDS)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ranks = TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            rows: list[list] = [[] for _ in schema]
            held = 0
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _runs(path).encode(c.as_bytes(batch.column("text")))):
                ids += last
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[at : at + 4 * size]
                    length = len(own) // 4
                    for column, value in zip(rows, (doc_id, piece, at // 4, length, zlib.crc32(own) if digest else own, task, ranks[length])):
                        column.append(value)
                    ranks[length] += 1
                held += 0 if digest else len(ids)
                if held > FLUSH_BYTES:
                    yield _batch(rows, schema)
                    rows, held = [[] for _ in schema], 0
            yield _batch(rows, schema)

    return run


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, schema)], schema=schema)


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END, digest: bool = False) -> DataFrame:
    """Written table of pieces: doc_id, piece, start, length, ids (little-endian 32-bit), task and rank within length.

    With `digest`, ids_crc32 in place of ids: to plan and check slots, ids need not be written.
    """
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut(path, size, end, digest), (_WITH_DIGEST if digest else _WITH_IDS)[0])
    return written(cut, "pieces")


@dataclass
class Plan:
    """Slots: pieces of `length` with ranks from `rank` on; `each` of them go side by side into every sequence from `sequence` on."""

    size: int
    length: list[int]
    rank: list[int]
    each: list[int]
    sequence: list[int]
    offset: list[int]
    sequences: int

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces given by length and rank."""
        keys = np.array(self.length, np.int64) * _FIRST_RANK + np.array(self.rank, np.int64)
        slot = np.searchsorted(keys, length * _FIRST_RANK + rank, "right") - 1
        nth = rank - np.array(self.rank, np.int64)[slot]
        each = np.array(self.each, np.int64)[slot]
        return np.array(self.sequence, np.int64)[slot] + nth // each, np.array(self.offset, np.int64)[slot] + nth % each * length


def best_fit(counts: dict[int, int], size: int = SIZE) -> Plan:
    """Best fit in decreasing order over {length: number of pieces}."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by room left: ranges of sequences
    slots: list[tuple[int, int, int, int, int]] = []
    opened = 0
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        left, rank, tight = counts[length], 0, length
        while left:
            while tight <= size and not room[tight]:
                tight += 1
            if tight <= size:
                space, (first, many) = tight, room[tight].pop()
            else:
                space, first, many = size, opened, -(-left // (size // length))
                opened += many
            each = space // length
            full = min(many, left // each)
            if full:
                slots.append((length, rank, each, first, size - space))
                room[space - each * length].append((first, full))
                rank, left = rank + full * each, left - full * each
            if left and full < many:  # the last sequence gets what is left
                slots.append((length, rank, left, first + full, size - space))
                room[space - left * length].append((first + full, 1))
                rank, left, full = rank + left, 0, full + 1
            if full < many:
                room[space].append((first + full, many - full))
            tight = length
    slots.sort()
    columns = [list(x) for x in zip(*slots)] or [[], [], [], [], []]
    return Plan(size, *columns, opened)


def _place(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            own = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in own), pa.array(sequence), pa.array(offset)], names=[*own, "sequence_id", "offset"])

    return run


def placed(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Pieces with sequence_id and offset; whatever columns `cut` has besides task and rank are carried along."""
    counts = written(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    plan = best_fit(histogram, size)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    own = [x for x in cut.columns if x not in ("task", "rank")]
    ranked = cut.join(offsets, ["task", "length"]).select(*[f"`{x}`" for x in own], (F.col("rank") + F.col("_before")).alias("rank"))
    fields = [f for f in cut.schema.fields if f.name in own]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(_place(plan), schema)


def packed(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset."""
    return placed(pieces(docs, path, size, end), size)
