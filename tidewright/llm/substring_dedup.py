"""Substring deduplication by super-k-mers.

A window is WINDOW consecutive words. Its minimiser is the smallest fingerprint of the runs of MINIMISER words in it.
Consecutive windows with one minimiser form a super-k-mer and travel as one packed string to the bucket of their
minimiser, so equal windows always meet. There, equal strings are folded, words become numbers, windows are sorted by
fingerprint and compared word by word, which gives the smallest doc_id that holds each window.

What goes back is one answer per distinct super-k-mer that has a window with a smaller doc_id; the documents' super-k-mers
find it by a 128-bit digest. Buckets are weighed first, by the bytes of their different super-k-mers: in one over HOT_BYTES (a minimiser
with ever other words around it) every window travels alone, to the bucket of its own fingerprint, so equal ones still meet. A passage in a third of all documents costs each task one string in the bucket, and its answer is
one row; the join back is on plain columns, so a hot one is split like any skewed join.

Windows are judged on the input. Null texts have no words. A null doc_id counts as larger than any other, so such a row
gives way to all others and never makes one of them give way; rows with the same doc_id do not make each other give way. Repeated
rows get the same result. An empty table gives no rows. Other columns are carried along untouched.
"""

from __future__ import annotations

import array
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c
from tidewright.session import written

WINDOW = 50
MINIMISER = 4
BUCKET_BYTES = 8 << 20  # of packed strings, before compression
HOT_BYTES = 64 << 20  # of a bucket; a heavier one is dealt again by windows
FLUSH_BYTES = 32 << 20
PASS_WORDS = 4_000_000  # a bucket with more words is sorted in several passes over ranges of fingerprints
SMALL_RANGES = 2_000_000  # ranges of 8 bytes that may be broadcast with their documents' keys; beyond, the join is shuffled
LAST = (1 << 63) - 1  # stands for a null doc_id


@dataclass(frozen=True)
class Deal:
    """Buckets by minimiser; those that are `hot` give their windows to `more` further ones."""

    buckets: int
    hot: tuple[int, ...] = ()
    more: int = 1


def _runs(texts: list[bytes], window: int, minimiser: int) -> Iterator[tuple]:
    """Per chunk: its first text, bytes, word starts, ends, fingerprints and texts, first words, and heads, tails, minimisers of super-k-mers."""
    for lo, hi in c.chunks(texts):
        data, begins = c.joined(texts[lo:hi])
        starts, ends, words = c.word_hashes(data)
        if len(words) < window:
            continue
        doc = np.searchsorted(begins, starts, "right") - 1
        least = c.sliding_min(c.gram_hashes(words, minimiser), window - minimiser + 1)
        n = len(words) - window + 1
        inside = doc[:n] == doc[window - 1 :]
        cut = np.ones(n, bool)
        # also where windows begin or cease to lie inside one text: none may reach into the next
        cut[1:] = (least[1:] != least[:-1]) | (doc[1:n] != doc[: n - 1]) | (inside[1:] != inside[:-1])
        heads = np.flatnonzero(cut)
        tails = np.append(heads[1:], n)
        keep = inside[heads]
        heads, tails = heads[keep], tails[keep]
        yield lo, data, starts, ends, words, doc, np.searchsorted(doc, np.arange(hi - lo)), heads, tails, least[heads]


def _super_kmers(texts: list[bytes], window: int, minimiser: int, deal: Deal) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(text, first word, windows, bucket, packed words) of every super-k-mer; words are joined by one space."""
    hot = np.array(deal.hot, np.uint64)
    for lo, data, starts, ends, words, doc, first_word, heads, tails, least in _runs(texts, window, minimiser):
        bucket = least % np.uint64(deal.buckets)
        apart = np.isin(bucket, hot)
        if apart.any():
            count = np.where(apart, tails - heads, 1)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            apart, heads = np.repeat(apart, count), np.repeat(heads, count) + place
            tails = np.where(apart, heads + 1, np.repeat(tails, count))
            own = c.range_hashes(words, heads, heads + window) % np.uint64(deal.more) + np.uint64(deal.buckets)
            bucket = np.where(apart, own, np.repeat(bucket, count))
        raw = data.tobytes()
        for a, b, d, key, x, y in zip(
            heads.tolist(), tails.tolist(), doc[heads].tolist(), bucket.tolist(), starts[heads].tolist(), ends[tails + window - 2].tolist()
        ):
            yield lo + d, a - int(first_word[d]), b - a, key, b" ".join(raw[x:y].split())


def _digest(packed: bytes) -> bytes:
    return hashlib.blake2b(packed, digest_size=16).digest()


_BLOB = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("blob", T.BinaryType())])
_BLOB_ARROW = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])


def _pack(entries: dict[bytes, list[int]], squeeze: zstandard.ZstdCompressor) -> bytes:
    """Strings with the smallest and largest doc_id that hold them."""
    lengths = np.fromiter(map(len, entries), np.int32, len(entries))
    bounds = np.array(list(entries.values()), np.int64)
    head = np.array([len(entries)], np.int64)
    return squeeze.compress(head.tobytes() + lengths.tobytes() + bounds.tobytes() + b"".join(entries))


def _unpack(blob: bytes) -> Iterator[tuple[bytes, int, int]]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    lengths = np.frombuffer(raw, np.int32, n, 8).tolist()
    bounds = np.frombuffer(raw, np.int64, 2 * n, 8 + 4 * n).reshape(n, 2).tolist()
    place = 8 + 20 * n
    for size, (low, high) in zip(lengths, bounds):
        yield raw[place : place + size], low, high
        place += size


_WEIGHT = T.StructType([T.StructField(x, T.LongType()) for x in ("bucket", "bytes", "apart")])
_WEIGHT_ARROW = pa.schema([(x, pa.int64()) for x in ("bucket", "bytes", "apart")])


def _weights(window: int, minimiser: int, buckets: int):
    """Per task and bucket: bytes of the different super-k-mers, and of their windows if each travels alone."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for _, _, starts, ends, words, _, _, heads, tails, least in _runs(c.as_bytes(batch.column("text")), window, minimiser):
                _, one = np.unique(c.range_hashes(words, heads, tails + window - 1), return_index=True)
                heads, tails, least = heads[one], tails[one], least[one]
                bucket, size = (least % np.uint64(buckets)).astype(np.int64), ends[tails + window - 2] - starts[heads]
                np.add.at(total[0], bucket, size)
                np.add.at(total[1], bucket, size * window * (tails - heads) // (tails - heads + window - 1))
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (some, *total[:, some])], schema=_WEIGHT_ARROW)

    return weigh


def dealing(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> Deal:
    """Buckets for a measured volume; the numbers of those over HOT_BYTES, a bounded share of all, reach the driver."""
    volume = c.text_volume(docs)
    # a super-k-mer carries about window - 1 words besides the (window - minimiser) / 2 that are its own
    packed = volume * (1 + 2 * window / max(1, window - minimiser))
    buckets = c.tasks_for(docs.sparkSession, int(packed), BUCKET_BYTES)
    if packed <= HOT_BYTES:
        return Deal(buckets)
    weights = docs.select("text").mapInArrow(_weights(window, minimiser, buckets), _WEIGHT).groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.sum("apart").alias("apart"))
    hot = weights.filter(F.col("bytes") > HOT_BYTES).collect()
    return Deal(buckets, tuple(sorted(r["bucket"] for r in hot)), max(1, -(-sum(r["apart"] for r in hot) // BUCKET_BYTES)))


def _deal(window: int, minimiser: int, dealt: Deal):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        held: dict[int, dict[bytes, list[int]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for bucket in list(held):
                blob = _pack(held.pop(bucket), squeeze)
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([blob], pa.binary())], schema=_BLOB_ARROW)

        for batch in batches:
            ids = [LAST if i is None else i for i in batch.column("doc_id").to_pylist()]
            for text, _, _, key, packed in _super_kmers(c.as_bytes(batch.column("text")), window, minimiser, dealt):
                doc_id, entries = ids[text], held.setdefault(key, {})
                bounds = entries.get(packed)
                if bounds is None:
                    entries[packed] = [doc_id, doc_id]
                    size += len(packed) + 150
                else:
                    bounds[0], bounds[1] = min(bounds[0], doc_id), max(bounds[1], doc_id)
                if size > FLUSH_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return deal


def _least_holder(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray, low: np.ndarray, window: int, pass_words: int) -> np.ndarray:
    """For each word place where a window starts: the smallest doc_id that holds that window (LAST elsewhere).

    words: numbers of the words of all strings; begins, sizes: where each string lies; low: its smallest doc_id.
    """
    out = np.full(len(words), LAST, np.int64)
    counts = sizes - window + 1
    at = np.repeat(begins - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    holder = np.repeat(low, counts)
    prints = c.range_hashes(words, at, at + window)
    passes = max(1, -(-len(at) // pass_words))
    part = prints % np.uint64(passes) if passes > 1 else None
    for p in range(passes):
        mine = np.arange(len(at)) if part is None else np.flatnonzero(part == p)
        order = mine[np.argsort(prints[mine], kind="stable")]
        if not len(order):
            continue
        sorted_prints = prints[order]
        new = np.ones(len(order), bool)
        new[1:] = sorted_prints[1:] != sorted_prints[:-1]
        group = np.cumsum(new) - 1
        firsts = order[new]
        # word by word against the first of the group, a block at a time
        repeats = np.flatnonzero(~new)
        wrong: set[int] = set()
        for i in range(0, len(repeats), 100_000):
            block = repeats[i : i + 100_000]
            a, b = at[order[block]], at[firsts[group[block]]]
            same = np.ones(len(block), bool)
            for j in range(window):
                same &= words[a + j] == words[b + j]
            wrong.update(group[block[~same]].tolist())
        least = np.minimum.reduceat(holder[order], np.flatnonzero(new))
        out[at[order]] = least[group]
        for g in wrong:  # one fingerprint, several windows: told apart by their words
            of: dict[bytes, int] = {}
            members = order[group == g]
            for m in members.tolist():
                key = words[at[m] : at[m] + window].tobytes()
                of[key] = min(of.get(key, LAST), int(holder[m]))
            for m in members.tolist():
                out[at[m]] = of[words[at[m] : at[m] + window].tobytes()]
    return out


_ANSWER = T.StructType([T.StructField("kmer", T.BinaryType()), T.StructField("least", T.BinaryType())])
_ANSWER_ARROW = pa.schema([("kmer", pa.binary()), ("least", pa.binary())])


def _answers(entries: dict[bytes, list[int]], window: int, pass_words: int) -> Iterator[pa.RecordBatch]:
    numbers: dict[bytes, int] = {}
    words = array.array("q")
    sizes: list[int] = []
    for packed in entries:
        own = [numbers.setdefault(w, len(numbers)) for w in packed.split()]
        words.extend(own)
        sizes.append(len(own))
    size = np.array(sizes, np.int64)
    bounds = np.array(list(entries.values()), np.int64)
    begins = np.concatenate(([0], np.cumsum(size)[:-1]))
    least = _least_holder(np.frombuffer(words, np.int64), begins, size, bounds[:, 0], window, pass_words)
    high = np.repeat(bounds[:, 1], size)
    asked = np.maximum.reduceat((least < high).astype(np.int8), begins).astype(bool)
    kmers, found = [], []
    for packed, begin, n, ask in zip(entries, begins.tolist(), sizes, asked.tolist()):
        if ask:
            kmers.append(_digest(packed))
            found.append(least[begin : begin + n - window + 1].tobytes())
    if kmers:
        yield from pa.Table.from_arrays([pa.array(kmers, pa.binary()), pa.array(found, pa.binary())], schema=_ANSWER_ARROW).to_batches(4096)


def _count(window: int, pass_words: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: dict[bytes, list[int]] = {}
        now = None
        for bucket, blob in c.arrow_rows(batches, ["bucket", "blob"]):
            if bucket != now and entries:
                yield from _answers(entries, window, pass_words)
                entries = {}
            now = bucket
            for packed, low, high in _unpack(blob):
                bounds = entries.get(packed)
                if bounds is None:
                    entries[packed] = [low, high]
                else:
                    bounds[0], bounds[1] = min(bounds[0], low), max(bounds[1], high)
        if entries:
            yield from _answers(entries, window, pass_words)

    return count


_PLACE = T.StructType(
    [
        T.StructField("kmer", T.BinaryType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("print", T.LongType()),
        T.StructField("start", T.IntegerType()),
    ]
)
_PLACE_ARROW = pa.schema([("kmer", pa.binary()), ("doc_id", pa.int64()), ("print", pa.int64()), ("start", pa.int32())])


def _places(window: int, minimiser: int, dealt: Deal):
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = batch.column("doc_id").to_pylist(), batch.column("print").to_pylist()
            rows: list[list] = [[], [], [], []]
            for text, start, _, _, packed in _super_kmers(c.as_bytes(batch.column("text")), window, minimiser, dealt):
                for column, value in zip(rows, (_digest(packed), ids[text], prints[text], start)):
                    column.append(value)
            table = pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(rows, _PLACE_ARROW)], schema=_PLACE_ARROW)
            yield from table.to_batches(20_000)

    return places


_RANGE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("print", T.LongType()),
        T.StructField("first", T.IntegerType()),
        T.StructField("windows", T.IntegerType()),
    ]
)
_RANGE_ARROW = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("first", pa.int32()), ("windows", pa.int32())])


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows of one super-k-mer that a smaller doc_id holds too."""
    for batch in batches:
        rows: list[list] = [[], [], [], []]
        for doc_id, text_print, start, least in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "print", "start", "least"))):
            hit = np.frombuffer(least, np.int64) < (LAST if doc_id is None else doc_id)
            edge = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False]))))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                for column, value in zip(rows, (doc_id, text_print, start + a, b - a)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, _RANGE_ARROW)], schema=_RANGE_ARROW)


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for raw, ranges in zip(c.as_bytes(batch.column("text")), batch.column("_ranges").to_pylist()):
                words = raw.split()
                counts.append(len(words))
                if ranges:
                    gone = np.zeros(len(words) + 1, np.int32)
                    for r in ranges:
                        gone[r["first"]] += 1
                        gone[min(len(words), r["first"] + r["windows"] + window - 1)] -= 1
                    stay = np.cumsum(gone[:-1]) == 0
                    words = [w for w, s in zip(words, stay.tolist()) if s]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            extra = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            own = [n for n in batch.schema.names if n not in ("text", "_ranges")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in own), *extra], names=[*own, "n_words", "n_removed", "kept_text"])

    return cut



def least_holders(docs: DataFrame, dealt: Deal, window: int = WINDOW, minimiser: int = MINIMISER, pass_words: int = PASS_WORDS) -> DataFrame:
    """Answers: digest of a super-k-mer, and for each of its windows the smallest doc_id that holds it."""
    buckets = dealt.buckets + (dealt.more if dealt.hot else 0)
    blobs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_deal(window, minimiser, dealt), _BLOB)
    met = blobs.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(_count(window, pass_words), _ANSWER)


def without_repeats(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, pass_words: int = PASS_WORDS) -> DataFrame:
    """Every row of `docs` without its text, plus n_words, n_removed and kept_text (kept words joined by one space)."""
    own = c.others(docs, "n_words", "n_removed", "kept_text")
    rows = docs.select(*own, F.xxhash64("text").alias("_print"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), "text")
    dealt = dealing(docs, window, minimiser)
    places = slim.mapInArrow(_places(window, minimiser, dealt), _PLACE).distinct()
    found = places.join(least_holders(docs, dealt, window, minimiser, pass_words), "kmer")
    ranges = found.select("doc_id", "print", "start", "least").mapInArrow(_ranges, _RANGE)
    grouped = written(ranges.groupBy("doc_id", "print").agg(F.collect_list(F.struct("first", "windows")).alias("_ranges")), "ranges")
    count = grouped.agg(F.coalesce(F.sum(F.size("_ranges")), F.lit(0))).first()[0]
    side = grouped.select(F.col("doc_id").alias("_id"), F.col("print").alias("_its_print"), "_ranges")
    keys = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_print") == F.col("_its_print"))
    marked = rows.join(F.broadcast(side) if count <= SMALL_RANGES else side, keys, "left").select(*own, "_ranges")
    rest = [f for f in docs.schema.fields if f"`{f.name}`" in own and f.name != "text"]
    schema = T.StructType(
        [*rest, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    )
    return marked.mapInArrow(_cut(window), schema)
