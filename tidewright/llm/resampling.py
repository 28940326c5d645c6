"""Importance resampling towards a target corpus, with a head-tail vocabulary.

Features are all words and all pairs of consecutive words; a feature's bucket is its CRC-32 modulo `BUCKETS`. Buckets are counted over the
whole corpus and the whole target; a bucket's gain is a thousand times the logarithm of the smoothed ratio of both shares, a document's
weight the floored mean of its features' gains. A Gumbel noise drawn from the doc_id makes the highest scores a sample without replacement.

Head: the frequent words. Their CRC states (of the word, and of the word with a space behind it) and the buckets of all pairs of them are computed
once and broadcast, HEAD**2 small numbers. Tail: every other word or pair takes its CRC from its bytes, a column of bytes at a
time; a pair goes on from its first word's state. Which words are in the head changes the time, never a bucket.

The head comes from a sample (about HEAD_DOCS documents of up to HEAD_BYTES bytes, chosen by a hash of the doc_id). All counts cover all documents.

Null and empty texts have no features and weight 0. A null doc_id is drawn like an empty one. Rows with the same doc_id and text get the same
score; they are ranked one after the other in any order. An empty corpus gives no rows; an empty target has no features, which is defined by the
smoothing. A text longer than a block is worked on block by block. Columns named like the results are replaced, others are carried along.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c
from tidewright.session import written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing A-Z
BUCKETS, SCALE = 10_000, 1000
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
HEAD, HEAD_DOCS, HEAD_BYTES = 1024, 2_000, 16 << 10
ROWS_A_RANGE = 500_000
RESULTS = ("n_features", "weight", "score", "rank")

_SHORT = 8  # bytes of a head word at most: they fit one 64-bit number, and words hold no zero byte
_COLUMNS = 24  # longer words are not taken byte by byte
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_IN_WORD[128:] = True
_GAPS = bytes(np.flatnonzero(~_IN_WORD[_LOWER]).tolist())
_GAP = re.compile(b"[" + re.escape(_GAPS) + b"]")
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(_SHORT + 1)], np.uint64)


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> 1) ^ np.where(out & 1, np.uint32(0xEDB88320), np.uint32(0))
    return out


_TABLE = _crc_table()


def crc_on(states: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 values carried on over data[start : start + length] of each."""
    out = states.astype(np.uint32)
    for i in np.flatnonzero(lengths > _COLUMNS).tolist():
        out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]], int(out[i]))
    short = np.where(lengths > _COLUMNS, 0, lengths).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]
    longer = len(order) - np.cumsum(np.bincount(short, minlength=_COLUMNS + 1))  # how many have more than k bytes
    now, at = ~out[order], starts[order]
    for k in range(_COLUMNS):
        n = int(longer[k])
        if not n:
            break
        now[:n] = _TABLE[(now[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (now[:n] >> np.uint32(8))
    out[order] = ~now
    return out


class Vocabulary:
    """Head words with their CRC states and the buckets of their pairs; finds the buckets of all features of texts."""

    def __init__(self, head: Sequence[bytes], buckets: int = BUCKETS):
        words = sorted({w for w in head if 0 < len(w) <= _SHORT}, key=lambda w: int.from_bytes(w, "little"))
        self.buckets, self.n = buckets, len(words)
        self.keys = np.array([int.from_bytes(w, "little") for w in words], np.uint64)
        self.states = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.spaced = np.array([zlib.crc32(b" ", zlib.crc32(w)) for w in words], np.uint32)
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths) - lengths
        pairs = [crc_on(np.full(self.n, s, np.uint32), data, starts, lengths) % np.uint32(buckets) for s in self.spaced]
        self.pairs = np.array(pairs, np.uint16 if buckets <= 1 << 16 else np.uint32).reshape(self.n * self.n)

    def places(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Position of each word in the head, -1 for those of the tail; `data` has _SHORT bytes to spare at its end."""
        if not self.n:
            return np.full(len(starts), -1)
        keys = np.lib.stride_tricks.sliding_window_view(data, _SHORT)[starts].view("<u8")[:, 0] & _KEEP[np.minimum(lengths, _SHORT)]
        place = np.minimum(np.searchsorted(self.keys, keys), self.n - 1)
        return np.where((self.keys[place] == keys) & (lengths <= _SHORT), place, -1)

    def features(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all words, the text of each; buckets of all pairs, the text of each."""
        joined, begins = c.joined(texts)
        data = np.concatenate([_LOWER[joined], np.zeros(_SHORT, np.uint8)])
        step = np.diff(np.concatenate([[False], _IN_WORD[data[: -_SHORT]], [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        lengths, owner = ends - starts, np.searchsorted(begins, starts, "right") - 1
        if not len(starts):
            return (np.zeros(0, np.int64),) * 4
        place = self.places(data, starts, lengths)
        known, tail = place >= 0, np.flatnonzero(place < 0)
        states, spaced = np.zeros(len(starts), np.uint32), np.zeros(len(starts), np.uint32)
        states[known], spaced[known] = self.states[place[known]], self.spaced[place[known]]
        states[tail] = crc_on(np.zeros(len(tail), np.uint32), data, starts[tail], lengths[tail])
        spaced[tail] = ~(_TABLE[(~states[tail] ^ np.uint32(32)) & np.uint32(255)] ^ (~states[tail] >> np.uint32(8)))

        first = np.flatnonzero(owner[1:] == owner[:-1])
        second = first + 1
        both = known[first] & known[second]
        pairs = np.zeros(len(first), np.int64)
        pairs[both] = self.pairs[place[first[both]] * self.n + place[second[both]]]
        rest_first, rest = first[~both], second[~both]
        pairs[~both] = crc_on(spaced[rest_first], data, starts[rest], lengths[rest]) % np.uint32(self.buckets)
        return (states % np.uint32(self.buckets)).astype(np.int64), owner, pairs, owner[first]


def blocks(text: bytes, limit: int = c.CHUNK_BYTES) -> Iterator[tuple[bytes, bool]]:
    """A long text in blocks cut between words; each begins with the last word before it, which the flag says."""
    at, carried = 0, b""
    while at < len(text):
        gap = _GAP.search(text, at + limit) if at + limit < len(text) else None
        end = gap.start() if gap else len(text)
        yield (carried + b" " + text[at:end] if carried else text[at:end]), bool(carried)
        tail = text[at:end].rstrip(_GAPS)
        carried = tail[1 + max(tail.rfind(_GAPS[i : i + 1]) for i in range(len(_GAPS))) :] or carried
        at = end


def _batches(vocabulary: Vocabulary, texts: list[bytes], limit: int = c.CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For ranges of texts, or blocks of a long one: first and last text, and features with the text they belong to."""
    for i, j in c.chunks(texts, limit):
        if j - i == 1 and len(texts[i]) > limit:
            for block, carried in blocks(texts[i], limit):
                words, owner, pairs, of = vocabulary.features([block])
                yield i, j, words[carried:], owner[carried:], pairs, of
        else:
            yield i, j, *vocabulary.features(texts[i:j])


_COUNTED = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])


def bucket_totals(docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How many features of all texts fall into each bucket; tasks count, their counts are summed, a number per bucket is returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary.buckets, np.int64)
        for batch in batches:
            for _, _, words, _, pairs, _ in _batches(vocabulary, c.as_bytes(batch.column("text"))):
                total += np.bincount(words, minlength=len(total)) + np.bincount(pairs, minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int32()), "n": pa.array(total[held], pa.int64())})

    counted = docs.select("text").mapInArrow(run, _COUNTED).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(vocabulary.buckets, np.int64)
    for row in counted.collect():  # BUCKETS rows at most
        out[row["bucket"]] = row["n"]
    return out


def frequent_words(docs: DataFrame) -> list[bytes]:
    """The most frequent short words of a sample; it is counted where it lies, HEAD words at most reach the driver."""
    share = HEAD_DOCS / max(1, docs.count())
    some = docs.filter((F.octet_length("text") <= HEAD_BYTES) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))))
    words = some.select(F.explode(F.regexp_extract_all(c.lowered(F.col("text")), F.lit(WORD), F.lit(0))).alias("word"))
    counts = words.filter(F.octet_length("word") <= _SHORT).groupBy("word").count()
    return [r["word"].encode() for r in counts.orderBy(F.desc("count"), "word").limit(HEAD).collect()]


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, from its counts in both."""
    s, t, n = corpus.astype(np.float64), target.astype(np.float64), float(len(corpus))
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighed(docs: DataFrame, vocabulary: Vocabulary, gain: np.ndarray) -> DataFrame:
    """doc_id and _row of `docs`, with n_features and weight of its text."""
    kept = [f for f in docs.schema.fields if f.name in ("doc_id", "_row")]
    schema = T.StructType([*kept, T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, j, words, owner, pairs, of in _batches(vocabulary, c.as_bytes(batch.column("text"))):
                for buckets, text in ((words, owner), (pairs, of)):
                    n[i:j] += np.bincount(text, minlength=j - i)
                    edge = np.concatenate([[0], np.cumsum(gain[buckets])])
                    bounds = np.searchsorted(text, np.arange(j - i + 1))
                    total[i:j] += edge[bounds[1:]] - edge[bounds[:-1]]
            weight = total // np.maximum(n, 1)  # rounds down, also below zero
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_row"), pa.array(n), pa.array(weight)], names=schema.names)

    return docs.select("doc_id", "_row", "text").mapInArrow(run, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((drawn + 0.5) / float(1 << 32)))).cast("long")


def _ranked(docs: DataFrame, target: DataFrame, percent: int, least_words: int, seed: int) -> DataFrame:
    """doc_id, _row and the results, from doc_id, _row and text."""
    vocabulary = Vocabulary(frequent_words(docs))
    gain = gains(bucket_totals(docs, vocabulary), bucket_totals(target, vocabulary))
    scored = weighed(docs, vocabulary, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    table = written(scored, "scored")
    able = F.col("n_features") >= 2 * least_words - 1  # n words and n - 1 pairs
    n = table.filter(able).count()
    draw = percent * n // 100
    order = [F.desc("score"), F.asc("doc_id")]
    placed = c.numbered(table.filter(able), order, n, ROWS_A_RANGE, "_number")
    ranked = placed.withColumn("rank", F.when(F.col("_number") < draw, F.col("_number") + 1)).drop("_number")
    return ranked.unionByName(table.filter(~able).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """`docs` without text, with n_features, weight, score, and rank for the drawn ones: `percent` of those with `least_words` words."""
    row = F.struct(*c.others(docs, "text", *RESULTS))
    found = _ranked(docs.select("doc_id", "text", row.alias("_row")), target, percent, least_words, seed)
    return found.select("_row.*", *RESULTS)


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The sample itself: the drawn documents, with the columns they came with."""
    row = F.struct(*c.others(docs))
    found = _ranked(docs.select("doc_id", "text", row.alias("_row")), target, percent, least_words, seed)
    return found.filter("rank IS NOT NULL").select("_row.*")
