"""Sharding by a k-d tree over metadata, with DataFrame functions only.

Every row weighs the UTF-8 bytes of its text plus one. A node of the tree that has to give n leaves is cut along its widest dimension where
n // 2 of its n parts of the weight lie below (the weighted median, if n is even), until every leaf holds the target bytes. Law: `bytes`.

Dimensions are the named text columns and the size. Names stand on a line by the bytes behind the prefix they all share, in code point order,
nulls before all; sizes stand on a logarithmic line. Each line has CELLS cells. The median is distributed: tasks sum the weight per node,
dimension and cell, the cell in which the cut falls is then summed by 16 bits of the text's hash. So a cut is exact up to 1/65,536 of one cell,
or a group of equal texts. What meets in one task are those sums: CELLS a dimension, or 65,536, for each node.

Equal texts stay together: they take the least of their names and one place among rows of the same cell. Only groups above `WHOLE` of a leaf are
dealt by doc_id, else leaves could not be of one size; rows that repeat text and doc_id stay together. With fewer or larger texts than leaves, leaves can be uneven or empty.

Null texts weigh one byte. Null ids and repeated rows are rows like others. An empty table gives no rows. Columns of `docs` are carried along;
those named like the results are replaced. The number of shards is a parameter of at most MOST_SHARDS.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.llm.common import join_classes, numbered, others
from tidewright.session import written

RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
NAMES = ("source", "lang")
CELLS = 4096
WHOLE = 0.1  # of a leaf: larger groups of equal texts are split
MOST_SHARDS = 10_000
LONGEST_PREFIX = 512  # bytes of names that are looked at for a common prefix
ROWS_A_RANGE = 500_000
_BYTES = 6


def _common_prefix(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _digest(text: Column) -> Column:
    """64 bits as hexadecimal digits; texts that share them are taken for one group, which only keeps them together."""
    return F.substring(F.md5(text), 1, 16)


def name_cell(name: Column, least: str | None, most: str | None) -> Column:
    """0 for null, else 1 to CELLS - 1 in code point order; `least` and `most` are the ends of the line."""
    if least is None:
        return F.lit(0)
    ends = [x.encode() for x in (least, most)]
    skip = _common_prefix(*ends)
    low, high = (int.from_bytes(x[skip : skip + _BYTES].ljust(_BYTES, b"\0"), "big") for x in ends)
    digits = F.rpad(F.hex(F.substring(name.cast("binary"), skip + 1, _BYTES)), 2 * _BYTES, "0")
    at = (F.conv(digits, 16, 10).cast("double") - float(low)) / float(max(1, high - low))
    return F.when(name.isNull(), 0).otherwise(F.greatest(F.lit(1), F.least(F.lit(CELLS - 1), 1 + F.floor(at * (CELLS - 2))))).cast("int")


def size_cell(size: Column, most: int) -> Column:
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(float(max(2, most)))) * (CELLS - 1)).cast("int")


def _cuts(rows: DataFrame, nodes: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Of every node that is to be cut: node, leaves, dim, and the last cell and place (16 bits) on its left side."""
    dim_cells = F.posexplode(F.array(*dims)).alias("dim", "cell")
    sums = written(rows.select("node", "size", dim_cells).groupBy("node", "dim", "cell").agg(F.sum("size").alias("weight")), "cells")
    spans = sums.groupBy("node", "dim").agg((F.max("cell") - F.min("cell")).alias("width"), F.sum("weight").alias("total"))
    widest = spans.groupBy("node", "total").agg(F.max_by("dim", F.struct("width", -F.col("dim"))).alias("dim"))
    goals = widest.join(F.broadcast(nodes.filter("leaves > 1")), "node")
    goals = goals.select("node", "leaves", "dim", (F.col("total") * F.floor(F.col("leaves") / 2) / F.col("leaves")).alias("goal"))
    upto = Window.partitionBy("node").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    below = sums.join(F.broadcast(goals), ["node", "dim"]).withColumn("upto", F.sum("weight").over(upto))
    met = below.filter("upto >= goal").groupBy("node", "leaves", "dim", "goal").agg(F.min_by(F.struct("cell", (F.col("upto") - F.col("weight")).alias("before")), "cell").alias("m"))
    met = written(met.select("node", "leaves", "dim", "goal", "m.*"), "met")

    inside = rows.join(F.broadcast(met), "node").filter(_along(dims) == F.col("cell"))
    places = inside.groupBy("node", "leaves", "dim", "goal", "cell", "before", "place").agg(F.sum("size").alias("weight"))
    upto = Window.partitionBy("node").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = places.withColumn("upto", F.col("before") + F.sum("weight").over(upto))
    first = summed.filter("upto >= goal").groupBy("node", "leaves", "dim", "goal", "cell").agg(F.min_by(F.struct("place", "weight", "upto"), "place").alias("m"))
    nearer = F.col("m.upto") - F.col("goal") <= F.col("goal") - F.col("m.upto") + F.col("m.weight")  # with that place, or without it
    return written(first.select("node", "leaves", "dim", "cell", F.when(nearer, F.col("m.place")).otherwise(F.col("m.place") - 1).alias("last")), "cuts")


def _along(dims: Sequence[str]) -> Column:
    return F.element_at(F.array(*dims), F.col("dim") + 1)


def _descended(rows: DataFrame, cuts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rows with the child of their node."""
    cut = cuts.select("node", "leaves", "dim", F.col("cell").alias("_cell"), "last")
    met = rows.join(F.broadcast(cut), "node", "left")
    right = F.col("leaves").isNotNull() & (F.struct(_along(dims), "place") > F.struct("_cell", "last"))  # no cut: a leaf
    child = F.col("node") + F.when(right, F.floor(F.col("leaves") / 2)).otherwise(0)
    return met.withColumn("node", child.cast("int")).drop("leaves", "dim", "_cell", "last")


def _children(nodes: DataFrame) -> DataFrame:
    half = F.floor(F.col("leaves") / 2).cast("int")
    left = F.struct("node", F.when(F.col("leaves") > 1, half).otherwise(F.col("leaves")).alias("leaves"))
    right = F.struct((F.col("node") + half).alias("node"), (F.col("leaves") - half).alias("leaves"))
    pair = F.when(F.col("leaves") > 1, F.array(left, right)).otherwise(F.array(left))
    return nodes.select(F.explode(pair).alias("n")).select("n.*")


def _located(docs: DataFrame, names: Sequence[str], shards: int | None, target_bytes: int | None) -> tuple[DataFrame, int, int]:
    """_row, doc_id, size, text_crc32, place and the cell of every dimension; rows and shards."""
    text = F.coalesce("text", F.lit(""))
    named = [F.col(f"`{n}`").cast("string").alias(f"name{i}") for i, n in enumerate(names)]
    measured = docs.select(
        "_row", "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), _digest(text).alias("text_hash"), *named,
    )
    table = written(measured, "measured")
    ends = [f(F.substring(n, 1, LONGEST_PREFIX)).alias(f"{n}_{f.__name__}") for i in range(len(names)) for n in [f"name{i}"] for f in (F.min, F.max)]
    seen = table.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.max("size").alias("most"), *ends).first()
    leaves = shards or max(1, math.ceil((seen["bytes"] or 0) / target_bytes))
    if not 1 <= leaves <= MOST_SHARDS:
        raise ValueError(f"{leaves} shards; from 1 to {MOST_SHARDS} are possible")

    least = [F.min(f"name{i}").alias(f"least{i}") for i in range(len(names))]
    groups = table.groupBy("text_hash").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), *least)
    same = written(groups.filter("rows > 1"), "same")
    met = join_classes(table, same, ["text_hash"], "rows", seen["rows"])
    alone = F.coalesce(F.col("bytes") > WHOLE * (seen["bytes"] or 0) / leaves, F.lit(False))
    spot = F.when(alone, _digest(F.concat_ws(":", "text_hash", F.col("doc_id").cast("string")))).otherwise(F.col("text_hash"))
    cells = []
    for i in range(len(names)):
        name = F.when(F.col("rows").isNull(), F.col(f"name{i}")).otherwise(F.col(f"least{i}"))
        cells.append(name_cell(name, seen[f"name{i}_min"], seen[f"name{i}_max"]).alias(f"dim{i}"))
    cells.append(size_cell(F.col("size"), seen["most"] or 1).alias(f"dim{len(names)}"))
    place = F.conv(F.substring(spot, 1, 4), 16, 10).cast("int")
    return written(met.select("_row", "doc_id", "size", "text_crc32", spot.alias("spot"), place.alias("place"), *cells), "located"), seen["rows"], leaves


def _sharded(docs: DataFrame, names: Sequence[str], shards: int | None, target_bytes: int | None) -> DataFrame:
    """_row and the results."""
    located, n_rows, leaves = _located(docs, names, shards, target_bytes)
    dims = [f"dim{i}" for i in range(len(names) + 1)]
    rows = located.withColumn("node", F.lit(0))
    nodes = docs.sparkSession.range(1).select(F.lit(0).alias("node"), F.lit(leaves).alias("leaves"))
    for _ in range(math.ceil(math.log2(leaves))):  # a level of the tree each
        rows = _descended(rows, _cuts(rows, nodes, dims), dims)
        nodes = written(_children(nodes), "nodes")
    placed = rows.withColumnRenamed("node", "shard").select("_row", "doc_id", "size", "text_crc32", "spot", "shard")
    order = [F.asc("shard"), F.asc("spot"), F.asc("doc_id")]
    counted = numbered(placed, order, n_rows, ROWS_A_RANGE, "number")
    firsts = counted.groupBy("shard").agg(F.min("number").alias("first"))
    slots = counted.join(F.broadcast(firsts), "shard")
    none = F.lit(None).cast("int")
    return slots.select("_row", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("number") - F.col("first")).alias("slot"), none.alias("grown_shard"))


def sharded(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, names: Sequence[str] = NAMES) -> DataFrame:
    """`docs` with size, text_crc32, law, shard and slot (from 0, gapless within its shard), for so many shards or shards of about so many bytes."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    return _sharded(_packed(docs, names, *RESULTS), names, shards, target_bytes).select("_row.*", *RESULTS)


def _packed(docs: DataFrame, names: Sequence[str], *without: str) -> DataFrame:
    return docs.select(F.struct(*others(docs, *without)).alias("_row"), "doc_id", "text", *[f"`{n}`" for n in names if n not in ("doc_id", "text")])


def placements(docs: DataFrame, shards: int, names: Sequence[str] = NAMES) -> DataFrame:
    """doc_id and the results alone: nothing wide is written or shuffled."""
    narrow = docs.select(F.struct("doc_id").alias("_row"), "doc_id", "text", *[f"`{n}`" for n in names])
    return _sharded(narrow, names, shards, None).select("_row.*", *RESULTS)
