"""Grace hash deduplication.

Records are dealt into buckets by a hash; each bucket fills an open-addressing table that compares complete
contents. A table has a byte bound: records whose content found no room leave the bucket, are written to spill files in
the shared scratch folder and dealt anew by another hash, level by level, until every bucket fits. A content is in a table
from its first record or never, so all its copies go the same way.

Before the first deal every task folds the copies it holds itself, so a content that makes up a third of all rows arrives
once from each task. Only contents travel; rows find their class by the digest of their content.

Null texts count as empty. A null doc_id is smaller than any other. Rows that repeat the largest doc_id of their group: one
of them is kept. An empty table gives no rows. Other columns are carried along untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewright.llm.common import as_bytes, join_classes, lowered, others, tasks_for, text_volume
from tidewright.session import scratch_path

TABLE_BYTES = 96 << 20
FOLD_BYTES = 32 << 20
BUCKET_BYTES = 16 << 20
_NONE = -(1 << 63)  # stands for a null doc_id, below all others
_SCHEMA = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("largest", T.LongType()),
        T.StructField("at_largest", T.LongType()),
        T.StructField("copies", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
_NAMES = [f.name for f in _SCHEMA.fields]
_ARROW = pa.schema(
    [("digest", pa.binary()), ("largest", pa.int64()), ("at_largest", pa.int64()), ("copies", pa.int64()), ("content", pa.binary())]
)


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte. A full table refuses new contents."""

    def __init__(self, limit: int, digest_bytes: int = 8):
        self.limit, self.digest_bytes = limit, digest_bytes
        self.clear()

    def clear(self) -> None:
        self.used = 0
        self.slots = np.full(1 << 10, -1, np.int64)
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.largest: list[int] = []
        self.at_largest: list[int] = []
        self.copies: list[int] = []

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.digests):
            place = int.from_bytes(digest[: self.digest_bytes], "little") & mask
            while self.slots[place] >= 0:
                place = (place + 1) & mask
            self.slots[place] = entry

    def add(self, digest: bytes, content: bytes, largest: int, at_largest: int, copies: int) -> bool:
        """False if the content is new and there is no room for it."""
        mask = len(self.slots) - 1
        place = int.from_bytes(digest[: self.digest_bytes], "little") & mask
        while (entry := self.slots[place]) >= 0:
            if self.contents[entry] == content:
                if largest > self.largest[entry]:
                    self.largest[entry], self.at_largest[entry] = largest, at_largest
                elif largest == self.largest[entry]:
                    self.at_largest[entry] += at_largest
                self.copies[entry] += copies
                return True
            place = (place + 1) & mask
        if self.contents and self.used + len(content) > self.limit:
            return False
        self.slots[place] = len(self.contents)
        self.digests.append(digest)
        self.contents.append(content)
        self.largest.append(largest)
        self.at_largest.append(at_largest)
        self.copies.append(copies)
        self.used += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return True

    def rows(self, with_content: bool) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.contents), 1000):
            cut = slice(i, i + 1000)
            content = self.contents[cut] if with_content else [None] * len(self.contents[cut])
            yield _batch([self.digests[cut], self.largest[cut], self.at_largest[cut], self.copies[cut], content])


def _batch(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies inside one task become one record; the table is emptied when it is full."""
    table = ContentTable(FOLD_BYTES)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for doc_id, raw in zip(ids, as_bytes(batch.column("text"))):
            content = raw.lower()  # bytes: A-Z only
            digest = hashlib.sha256(content).digest()
            largest = _NONE if doc_id is None else doc_id
            if not table.add(digest, content, largest, 1, 1):
                yield from table.rows(True)
                table.clear()
                table.add(digest, content, largest, 1, 1)
    yield from table.rows(True)


def _settle(limit: int):
    """One bucket: classes leave without content; records that found no room leave with it, for the next level."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(limit)
        for batch in batches:
            left: list[list] = [[], [], [], [], []]
            for row in zip(*(batch.column(c).to_pylist() for c in _NAMES)):
                digest, largest, at_largest, copies, content = row
                if not table.add(digest, content, largest, at_largest, copies):
                    for column, value in zip(left, row):
                        column.append(value)
            if left[0]:
                yield _batch(left)
        yield from table.rows(False)

    return settle


def content_classes(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct content: digest, largest doc_id, how many rows have it, copies."""
    spark = docs.sparkSession
    records = docs.select("doc_id", "text").mapInArrow(_fold, _SCHEMA)
    volume, level, done = text_volume(docs), 0, None
    while True:
        # each level reads other bytes of the digest
        deal = F.substring("digest", 1 + 4 * (level % 8), 4)
        dealt = records.repartition(tasks_for(spark, volume, BUCKET_BYTES), deal, F.lit(level))
        path, seen = scratch_path(spark, f"grace-{level}"), Observation()
        spilled = F.col("content").isNotNull()
        dealt.mapInArrow(_settle(table_bytes), _SCHEMA).observe(
            seen, F.coalesce(F.sum(F.when(spilled, F.octet_length("content"))), F.lit(0)).alias("bytes"), F.count_if(spilled).alias("rows")
        ).write.parquet(path)
        written = spark.read.schema(_SCHEMA).parquet(path)
        classes = written.filter(~spilled).drop("content")
        done = classes if done is None else done.unionByName(classes)
        if not seen.get["rows"]:
            return done
        records, volume, level = written.filter(spilled), seen.get["bytes"], level + 1


SMALL_CLASSES = 1_000_000  # classes of several rows, about 60 bytes each, that may be broadcast; beyond, rows are shuffled to them


def _marked(docs: DataFrame, table_bytes: int) -> tuple[DataFrame, str]:
    """All columns of `docs` and digest, keep_id, group_size, kept, under names with a prefix that `docs` does not use."""
    pre = "_"
    while any(x.startswith(pre) for x in docs.columns):
        pre += "_"
    digest, keep_id, size, ties, kept = (pre + x for x in ("digest", "keep_id", "group_size", "ties", "kept"))
    classes = content_classes(docs, table_bytes)
    several = F.col("copies") > 1
    counted = classes.agg(F.sum("copies").alias("n"), F.max("at_largest").alias("ties"), F.count_if(several).alias("several")).first()
    # a content that one row has needs no class: only those of several rows are joined
    named = classes.filter(several).select(
        F.lower(F.hex("digest")).alias(digest),
        F.when(F.col("largest") != _NONE, F.col("largest")).alias(keep_id),
        F.col("copies").alias(size),
        F.col("at_largest").alias(ties),
    )
    rows = docs.withColumn(digest, F.sha2(lowered(F.col("text")), 256))
    if counted["several"] <= SMALL_CLASSES:
        found = rows.join(F.broadcast(named), digest, "left")
    else:
        found = join_classes(rows, named, [digest], size, counted["n"])
    alone = F.col(size).isNull()
    found = found.withColumns({keep_id: F.when(alone, F.col("doc_id")).otherwise(F.col(keep_id)), ties: F.coalesce(F.col(ties), F.lit(1)), size: F.coalesce(F.col(size), F.lit(1))})
    stays = F.col("doc_id").eqNullSafe(F.col(keep_id))
    if (counted["ties"] or 0) <= 1:
        return found.withColumn(kept, stays), pre
    # only rows that repeat the id of the row that stays are numbered
    tied = stays & (F.col(ties) > 1)
    order = Window.partitionBy(digest).orderBy("doc_id")
    first = found.filter(tied).withColumn(kept, F.row_number().over(order) == 1)
    return found.filter(~tied).withColumn(kept, stays).unionByName(first), pre


def exact_duplicates(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """All rows of `docs` with keep_id, group_size, kept and text_sha256; columns of these names are replaced."""
    own = others(docs, "keep_id", "group_size", "kept", "text_sha256")
    found, pre = _marked(docs, table_bytes)
    named = [F.col(pre + x).alias(x) for x in ("keep_id", "group_size", "kept")]
    return found.select(*own, *named, F.col(pre + "digest").alias("text_sha256"))


def deduplicated(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with the columns of the input."""
    found, pre = _marked(docs, table_bytes)
    return found.filter(F.col(pre + "kept")).select(*others(docs))
