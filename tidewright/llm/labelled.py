"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
LONGEST_TEXT = 64 << 10  # bytes; longer texts are scored like all others, only not learned from


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo FOLDS; 0 is held out."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % FOLDS).cast("int")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list[bytes], list[int], float]:
    """Texts and labels of at most `per_class` rows of either class, chosen by a hash, and the share of label 1.

    They reach the driver: 4 * per_class rows of LONGEST_TEXT bytes at most, 256 MB for the 1,000 a class of both classifiers.
    Held-out rows, null labels, null ids and conflicting repeats (the smaller label counts) are left out.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    once = usable.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    share = once.agg(F.avg("label")).first()[0]
    order = F.xxhash64("doc_id", F.lit(label))
    parts = [once.filter(F.col("label") == v).orderBy(order).limit(per_class) for v in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.filter(F.octet_length("text") <= LONGEST_TEXT).select("doc_id", "text")
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(4 * per_class).collect()
    return [r["text"].encode() for r in rows], [r["label"] for r in rows], share if share is not None else 0.5
