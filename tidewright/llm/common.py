"""Helpers shared by the operators: words, fingerprints, scratch tables, joins that survive hot keys."""

from __future__ import annotations

import math
import os
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.session import written

WORD = r"[^\x20\x09-\x0D]+"  # bytes.split() in Python cuts at exactly these six bytes
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHUNK_BYTES = 1 << 20  # text worked on at a time in a Python task; its arrays take about 60 times as much
HOT_CLASSES = 10_000  # classes with over 1/10,000 of all rows: there are at most so many

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def importable(spark: SparkSession) -> None:
    """Python workers look for this library where the driver found it; an installed one is found anyway.

    Batches of texts are kept small, unless the session says how large they are to be: they are held twice, beside the arrays made of them.
    """
    if BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks_for(spark: SparkSession, measured: int, each: int) -> int:
    """Number of tasks for a measured amount of work, at least one wave of the cluster's cores."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(measured / each))


def others(docs: DataFrame, *names: str) -> list[str]:
    """Quoted columns of `docs` besides these; names are compared as Spark compares them, without case."""
    return [f"`{x}`" for x in docs.columns if x.lower() not in names]


def text_volume(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts; one number reaches the driver."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


# ---- words and fingerprints in numpy -----------------------------------------------------------------


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; lengths are rounded up, so that few are kept."""
    return _powers(base, 1 << max(10, (n - 1).bit_length()))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    edge = np.ones(len(data) + 2, np.int8)
    edge[1:-1] = _SPACE[data]
    step = np.diff(edge)
    return np.flatnonzero(step == -1), np.flatnonzero(step == 1)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of values[start:end] for every range, from one running sum."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(values) + 1)[:-1], out=total[1:])
    inverse = powers(_BASE_INVERSE, len(values) + 1)
    raw = (total[ends] - total[starts]) * inverse[starts]
    return mix(raw ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_FULL = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and fingerprint of every word of a byte array.

    Each block of eight bytes is scrambled with its number before it enters the word's sum: a plain polynomial in the bytes modulo 2**64
    has words of its own structure that collide whatever its base is.
    """
    starts, ends = spans(data)
    lengths = ends - starts
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    blocks = (lengths + 7) >> 3
    first = np.cumsum(blocks) - blocks
    nth = np.arange(first[-1] + blocks[-1]) - np.repeat(first, blocks)
    values = view[np.repeat(starts, blocks) + 8 * nth].view("<u8")[:, 0] & _FULL[np.minimum(8, np.repeat(lengths, blocks) - 8 * nth)]
    scrambled = mix(values ^ mix((nth + 1).astype(np.uint64) * np.uint64(_BASE)))
    return starts, ends, mix(np.add.reduceat(scrambled, first) ^ lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of n consecutive words, given the words' fingerprints."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for j in range(n):
        out = out * np.uint64(_BASE) + words[j : j + count]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of `width` values, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a text column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: Sequence[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes; a longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def joined(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts in one byte array, a line feed after each, and where each begins."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begins = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=begins[1:])
    return data, begins


def arrow_rows(batches: Iterable[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple]:
    """Rows of a stream of batches, one at a time."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


# ---- joins -------------------------------------------------------------------------------------------


def join_classes(members: DataFrame, classes: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """Left join of rows with the one row of their class, `size` rows being in each.

    At most HOT_CLASSES classes can hold more than total / HOT_CLASSES rows: those are broadcast, a proven bound.
    No other key can fill a task, so the rest meets in a plain join.
    """
    limit = max(1, total // HOT_CLASSES)
    hot = classes.filter(F.col(size) > limit)
    mark = "_is_hot"
    while mark in members.columns:
        mark += "_"
    marked = members.join(F.broadcast(hot.select(*keys, F.lit(True).alias(mark))), list(keys), "left")
    cold = marked.filter(F.col(mark).isNull()).drop(mark).join(classes.filter(F.col(size) <= limit), list(keys), "left")
    warm = marked.filter(F.col(mark)).drop(mark).join(F.broadcast(hot), list(keys), "inner")
    return cold.unionByName(warm)


# ---- numbers of rows in a global order -----------------------------------------------------------------

MOST_RANGES = 10_000  # ranges of a numbered table, and so rows of its offsets, at most
_ROW = 1 << 33  # monotonically_increasing_id counts the rows of a partition below this


def numbered(df: DataFrame, order: Sequence[Column], rows: int, each: int, name: str) -> DataFrame:
    """`df` with `name`: the row's number from 0 in this order, of all rows; `rows` of them were counted.

    Rows are sorted in ranges, and counted per range; only those counts, MOST_RANGES at most, meet in one task and are broadcast.
    The sorted table is written, so that a repeated task finds the same ranges again.
    """
    tasks = min(MOST_RANGES, tasks_for(df.sparkSession, rows, each))
    ranges = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = written(ranges.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.floor(F.col("_id") / _ROW)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    found = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return found.withColumn(name, F.col("_before") + F.col("_id") % _ROW).drop("_part", "_before", "_id")
