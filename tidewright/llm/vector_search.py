"""Approximate nearest neighbours by adaptive dimension scan.

Vectors are scaled to length one and turned by a random rotation, after which any first d coordinates hold about d/D of a squared
distance. Rows are dealt to lists by their nearest centroid (k-means on a bounded sample); a list is cut into blocks of bounded size.
Each query visits its nearest lists. In a block, coordinates lie in column blocks: after each, a hypothesis test on the
partial distance drops candidates that cannot beat the best found so far, so most are never read to the end. Survivors are scored
again by the cosine of the original vectors in double precision.

The number of lists to visit is measured on the sample: the fewest that find RECALL of the true neighbours there.
Equal vectors are one entry with its smallest ids, as many as an answer can need. Null, zero, non-finite vectors and those of another
length than most take no part; rows without an id neither. Rows that repeat an id and vector count once. With fewer candidates than
asked for, all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewright.llm import common as c
from tidewright.session import written

LIST_ROWS = 1_600  # rows a list should hold
MOST_LISTS = 2_048
BLOCK_ROWS = 4_096
SAMPLE_A_LIST, LEAST_SAMPLE, MOST_SAMPLE = 32, 4_096, 65_536
RECALL = 0.96
SIGNIFICANCE = 2.1  # width of the test; larger drops fewer candidates
COLUMN_BLOCKS = 4


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # first by the largest component: no square overflows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def k_means(unit: np.ndarray, lists: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = unit[rng.choice(len(unit), lists, replace=False)].copy()
    for _ in range(rounds):
        nearest = (unit @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, unit)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return centroids


def lists_to_visit(unit: np.ndarray, centroids: np.ndarray, k: int, recall: float, seed: int) -> int:
    """Fewest lists that hold `recall` of the sample's true neighbours of some of its rows."""
    asked = np.random.default_rng(seed).choice(len(unit), min(300, len(unit)), replace=False)
    near = unit[asked] @ unit.T
    near[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-near, min(k, len(unit) - 1) - 1, axis=1)[:, :k] if len(unit) > 1 else np.zeros((len(asked), 1), int)
    owner = (unit @ centroids.T).argmax(axis=1)
    place = np.argsort(np.argsort(-(unit[asked] @ centroids.T), axis=1), axis=1)
    needed = np.sort(place[np.arange(len(asked))[:, None], owner[best]].ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


class ColumnScan:
    """One block of a list: rotated unit vectors by columns, scanned a few columns at a time."""

    def __init__(self, vectors: np.ndarray, rotation: np.ndarray):
        self.vectors, self.unit = vectors, _unit(vectors)
        self.columns = np.ascontiguousarray((self.unit @ rotation).T.astype(np.float32))
        size = len(self.columns)
        self.cuts = sorted({max(1, size * (i + 1) // COLUMN_BLOCKS) for i in range(COLUMN_BLOCKS)})
        self.read = 0

    def nearest(self, rotated: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the k nearest to a rotated unit query."""
        size, rows = self.columns.shape
        if rows <= 4 * k:
            return np.arange(rows)
        alive, partial, done, bound = np.arange(rows), np.zeros(rows, np.float32), 0, np.inf
        for cut in self.cuts:
            block = self.columns[:cut] if not done else self.columns[done:cut][:, alive]
            partial = partial + ((block - rotated[done:cut, None]) ** 2).sum(axis=0)
            self.read += block.size
            if not done:  # the most promising rows are read to the end: the k-th best of them bounds the rest
                first = np.argpartition(partial, 4 * k - 1)[: 4 * k]
                exact = ((self.columns[:, first] - rotated[:, None]) ** 2).sum(axis=0)
                bound = np.partition(exact, k - 1)[k - 1] * (1 + 1e-4)
                self.read += exact.size * size
            done = cut
            # a candidate goes if its share of the distance is too large to be chance
            slack = (1 + SIGNIFICANCE / np.sqrt(done)) ** 2 * done / size if done < size else 1.0
            stay = partial <= bound * slack
            alive, partial = alive[stay], partial[stay]
        return np.union1d(alive, first[exact <= bound])

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Cosine of the original vectors in double precision."""
        mine = self.vectors[rows]
        with np.errstate(over="ignore", invalid="ignore"):
            plain = mine @ query / (np.sqrt((mine * mine).sum(axis=1)) * np.sqrt((query * query).sum()))
        return np.where(np.isfinite(plain), plain, self.unit[rows] @ _unit(query[None])[0])


_DEALT = T.StructType(
    [
        T.StructField("list", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("asks", T.BooleanType()),
        T.StructField("key", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("vector", T.BinaryType()),
    ]
)
_DEALT_ARROW = pa.schema([("list", pa.int32()), ("block", pa.int32()), ("asks", pa.bool_()), ("key", pa.int64()), ("ids", pa.list_(pa.int64())), ("vector", pa.binary())])
_FOUND = T.StructType(
    [T.StructField("query", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("score", T.DoubleType())]
)
_FOUND_ARROW = pa.schema([("query", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("vector")
    return np.asarray(column.flatten().cast(pa.float64())).reshape(len(column), -1)


def _lists_of(centroids: np.ndarray):
    """Each entry's list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch)
            own = (_unit(rows) @ centroids.T).argmax(axis=1)
            n = len(own)
            columns = [own.tolist(), [0] * n, [False] * n, batch.column("key"), batch.column("ids"), [r.tobytes() for r in rows]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _DEALT_ARROW)], schema=_DEALT_ARROW)

    return run


def _visits(centroids: np.ndarray, probes: int, blocks: list[int]):
    """Each query once for every block of the lists that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rows = _matrix(part)
                near = np.argsort(-(_unit(rows) @ centroids.T), axis=1)[:, :probes]
                out: list[list] = [[] for _ in _DEALT_ARROW]
                for key, row, visited in zip(part.column("key").to_pylist(), rows, near.tolist()):
                    raw = row.tobytes()
                    for where in visited:
                        for block in range(blocks[where]):
                            for column, value in zip(out, (where, block, True, key, [], raw)):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, _DEALT_ARROW)], schema=_DEALT_ARROW)

    return run


def _scan(rotation: np.ndarray, keep: int):
    """Blocks in turn: first its entries, then the queries that visit it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vectors, scan = None, [], [], None
        out: list[list] = [[], [], []]
        for where, block, asks, key, own, raw in c.arrow_rows(batches, _DEALT.fieldNames()):
            if (where, block) != now:
                now, ids, vectors, scan = (where, block), [], [], None
            if not asks:
                ids.append(own)
                vectors.append(np.frombuffer(raw, np.float64))
                continue
            if not ids:
                continue
            if scan is None:
                scan = ColumnScan(np.stack(vectors), rotation)
            query = np.frombuffer(raw, np.float64)
            unit = _unit(query[None])[0]
            rows = scan.nearest((unit @ rotation).astype(np.float32), keep)
            scores = scan.scores(rows, query)
            best = sorted(zip((-scores).tolist(), (ids[r][0] for r in rows.tolist()), rows.tolist()))[:keep]
            for score, _, row in best:
                for column, value in zip(out, (key, ids[row], -score)):
                    column.append(value)
            if len(out[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, _FOUND_ARROW)], schema=_FOUND_ARROW)
                out = [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, _FOUND_ARROW)], schema=_FOUND_ARROW)

    return run


def _smallest_ids(rows: DataFrame, many: int) -> DataFrame:
    """One row per distinct vector: key (its smallest id) and its `many` smallest ids. The limit acts before the shuffle too."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= many)
    grouped = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("key"), "ids", "vector")


def nearest(vectors: DataFrame, queries: Column, k: int = 5, recall: float = RECALL, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found, for the rows of `vectors` (vec_id, vector) where `queries` is true."""
    spark = vectors.sparkSession
    valid = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
    sizes = valid.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    result = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], result)
    rows = valid.filter(F.size("vector") == sizes["n"]).distinct()
    entries = written(_smallest_ids(rows, k + 1), "entries")
    asked = written(rows.filter(queries), "asked")
    distinct = asked.groupBy("vector").agg(F.min("vec_id").alias("key"))

    total = entries.count()
    lists = int(np.clip(round(total / LIST_ROWS), 1, MOST_LISTS))
    sampled = int(np.clip(SAMPLE_A_LIST * lists, LEAST_SAMPLE, MOST_SAMPLE))
    sample = entries.orderBy(F.xxhash64("key"), "key").limit(sampled).select("vector").toArrow()
    unit = _unit(np.concatenate([_matrix(b) for b in sample.to_batches() if b.num_rows]))
    centroids = k_means(unit, lists, seed)
    probes = lists_to_visit(unit, centroids, k, recall, seed)
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((sizes["n"], sizes["n"])))[0]

    dealt = written(entries.mapInArrow(_lists_of(centroids), _DEALT), "lists")
    held = {r[0]: r[1] for r in dealt.groupBy("list").count().collect()}  # MOST_LISTS numbers at most
    blocks = [max(1, -(-held.get(i, 0) // BLOCK_ROWS)) for i in range(lists)]
    count = F.element_at(F.array(*[F.lit(b) for b in blocks]), F.col("list") + 1)
    homes = dealt.withColumn("block", F.pmod(F.xxhash64("key"), count).cast("int"))
    visits = distinct.select("key", "vector").mapInArrow(_visits(centroids, probes, blocks), _DEALT)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = homes.unionByName(visits).repartition(tasks, "list", "block").sortWithinPartitions("list", "block", "asks", "key")
    found = met.mapInArrow(_scan(rotation, k + 1), _FOUND)

    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    kept = found.withColumn("_nth", F.row_number().over(best)).filter(F.col("_nth") <= k + 1)
    answers = kept.select(F.col("query").alias("key"), F.explode("ids").alias("vec_id"), "score")
    named = asked.join(distinct, "vector").select(F.col("vec_id").alias("query_id"), "key")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    others = named.join(answers, "key").filter("query_id != vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = others.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
