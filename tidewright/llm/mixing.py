"""Mixing sources to target weights, with DataFrame functions only.

Tokens are counted per source. A source's target is its weight times a common level, but never more than `cap` times its
size; the level rises until the excess of capped sources is spread over the others. rate = target / size of the source;
each document is taken floor(rate) times, and once more if a hash of its doc_id falls below the fraction.

Sources take the weights in turn, in the order of their code points, a null source last. Null texts have no tokens. Rows without
doc_id draw by their text. Rows with the same doc_id draw alike. Sources without any token, and empty tables, take nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.llm.common import HOT_CLASSES, WORD, join_classes, others
from tidewright.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = "mix"
SOURCES_A_TASK = 100_000
_ROW = 1 << 33  # monotonically_increasing_id counts rows of a partition below this


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the row's doc_id and the seed alone."""
    name = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def _ranked(totals: DataFrame, sources: int) -> DataFrame:
    """Position of each source in code point order, counted in ranges: no task holds them all."""
    order = F.col("source").asc_nulls_last()
    tasks = max(1, math.ceil(sources / SOURCES_A_TASK))
    ranges = totals.repartitionByRange(tasks, order).sortWithinPartitions(order)
    placed = written(ranges.withColumn("_id", F.monotonically_increasing_id()), "sources")
    part = F.floor(F.col("_id") / _ROW)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn("_place", F.col("_before") + F.col("_id") % _ROW).drop("_part", "_before", "_id")


def source_targets(totals: DataFrame, sources: int, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """source, source_size, rows, target."""
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    weighed = written(_ranked(totals, sources).select("source", "source_size", "rows", pick.alias("weight")), "weights")
    most = F.lit(float(cap)) * F.col("source_size")
    first = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = share * (first["size"] or 0)
    level, capped = (total / first["weight"] if first["weight"] else 0.0), 0
    while True:  # numbers only; every round caps one source more at least
        above = most < F.lit(level) * F.col("weight")
        state = weighed.agg(
            F.count_if(above).alias("capped"),
            F.coalesce(F.sum(F.when(above, most)), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if state["capped"] == capped:
            break
        capped = state["capped"]
        level = (total - state["used"]) / state["weight"] if state["weight"] else math.inf
    target = F.when(most < F.lit(level) * F.col("weight"), most).otherwise(F.lit(level) * F.col("weight"))
    return weighed.select("source", "source_size", "rows", F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target"))


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED
) -> DataFrame:
    """All rows of `docs` plus size, source_size, target and copies; columns of these names are replaced."""
    names = ("size", "source_size", "target", "copies")
    found = _mixed(docs, weights, share, cap, seed)
    return found.select(*others(docs, *names), *[F.col("_" + x).alias(x) for x in names])


def emitted(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of the input."""
    chosen = _mixed(docs, weights, share, cap, seed).filter("_copies > 0")
    return chosen.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*others(docs))


def _mixed(docs: DataFrame, weights: Sequence[float], share: float, cap: float, seed: str) -> DataFrame:
    sized = docs.withColumn("_size", words_in(F.col("text")))
    counted = sized.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    totals = written(counted, "totals")
    seen = totals.agg(F.count(F.lit(1)).alias("sources"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    targets = source_targets(totals, seen["sources"], weights, share, cap)
    keys = ["_source", "_unnamed"]
    named = [F.coalesce("source", F.lit("")).alias(keys[0]), F.col("source").isNull().alias(keys[1])]
    side = targets.select(*named, F.col("source_size").alias("_source_size"), F.col("rows").alias("_rows"), F.col("target").alias("_target"))
    rows = sized.select("*", *named)
    if seen["sources"] <= HOT_CLASSES:
        found = rows.join(F.broadcast(side), keys, "left")
    else:
        found = join_classes(rows, side, keys, "_rows", seen["rows"])
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = (coin(F.col("doc_id"), F.col("text"), seed) < rate - whole).cast("long")
    return found.withColumn("_copies", whole + extra)
