"""Items that occur together in baskets (R11): exact pair counts above a minimum support, in two passes over the baskets.

Only frequent items can make frequent pairs, so lines of other items go first. Pass one counts hashed pairs: ``BUCKETS`` numbers, summed
map-side. Pass two makes pairs again and keeps those whose bucket reached the support: rare pairs, nearly all of them, are never
shuffled. What is left is counted exactly.

A basket of many items makes many pairs whatever one does; it is cut into blocks of about ``BASKET`` items, and each two blocks
meet in a row of their own, so that no task gets a whole basket's pairs. Lines are joined with nothing but the list of frequent items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.session import written

BUCKETS = 1 << 20  # the surviving ones are broadcast: a bound that does not grow with the data
BASKET = 512  # items that one row holds of a basket, on average
SMALL_ITEMS = 1_000_000  # frequent items are broadcast up to this number, else joined by a shuffle


def _bucket(left: Column, right: Column) -> Column:
    return F.pmod(F.xxhash64(left, right), F.lit(BUCKETS))


def frequent_items(lines: DataFrame, basket: str, item: str, min_support: int) -> DataFrame:
    """item, baskets: in how many baskets each item lies that lies in ``min_support`` of them."""
    once = lines.filter(F.col(basket).isNotNull() & F.col(item).isNotNull()).select(F.col(basket).alias("basket"), F.col(item).alias("item")).distinct()
    return once.groupBy("item").agg(F.count(F.lit(1)).alias("baskets")).filter(F.col("baskets") >= min_support)


def _tiles(once: DataFrame, basket_items: int) -> DataFrame:
    """left, right: two sorted lists of items of one basket whose cross pairs are to be made; the same list twice stands for the pairs inside it.

    A basket of up to ``basket_items`` is one list. A larger one has a list per block; every block meets each block from its own on.
    """
    sizes = once.groupBy("basket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = sizes.select("basket", F.ceil(F.col("n") / basket_items).cast("int").alias("blocks"))
    placed = once.join(blocks, "basket").withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    # an item goes to the tiles of its block with every other one; a plain basket has the tile (0, 0) alone
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = placed.select("basket", "item", "block", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tiles = spread.groupBy("basket", low.alias("low"), high.alias("high")).agg(
        F.array_sort(F.collect_set(F.when(F.col("block") == low, F.col("item")))).alias("left"),
        F.array_sort(F.collect_set(F.when(F.col("block") == high, F.col("item")))).alias("right"),
    )
    return tiles.select(F.col("low") == F.col("high"), "left", "right").toDF("inside", "left", "right")


def _pairs(tiles: DataFrame) -> DataFrame:
    each = tiles.select("inside", "right", F.explode("left").alias("a"))
    later = F.filter("right", lambda x: ~F.col("inside") | (x > F.col("a")))
    both = each.select("a", F.explode(later).alias("b"))
    return both.select(F.least("a", "b").alias("left_item"), F.greatest("a", "b").alias("right_item"))


def frequent_pairs(lines: DataFrame, basket: str, item: str, min_support: int, basket_items: int = BASKET) -> DataFrame:
    """left_item < right_item, orders (baskets that hold both), and how many hold each; pairs in at least ``min_support`` baskets.

    Repeated lines count once; NULL baskets and items make no pairs. The result is exact.
    """
    if min_support < 1:
        raise ValueError(f"min_support is {min_support}, from 1 on is possible")
    items = written(frequent_items(lines, basket, item, min_support), "items")
    known = items.select("item")
    if items.count() <= SMALL_ITEMS:
        known = F.broadcast(known)
    named = lines.filter(F.col(basket).isNotNull()).select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    once = written(named.join(known, "item", "left_semi").distinct(), "basket-items")
    tiles = written(_tiles(once, basket_items), "baskets")

    made = _pairs(tiles).withColumn("bucket", _bucket(F.col("left_item"), F.col("right_item")))
    counts = made.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_support)
    kept = made.join(F.broadcast(counts.select("bucket")), "bucket", "left_semi")  # BUCKETS rows at most
    pairs = kept.groupBy("left_item", "right_item").agg(F.count(F.lit(1)).alias("orders")).filter(F.col("orders") >= min_support)
    left = items.select(F.col("item").alias("left_item"), F.col("baskets").alias("left_orders"))
    right = items.select(F.col("item").alias("right_item"), F.col("baskets").alias("right_orders"))
    return pairs.join(left, "left_item").join(right, "right_item")
