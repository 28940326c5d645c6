"""Resolution of not-modified revisits in web archives.

A revisit is a 304 answer without a body. It is tied to the latest earlier full response for the same canonical URL; its validators
must agree with that response's, and the headers a 304 may update replace the stored ones.

The as-of join works on ranges of (URL, time): a URL with a third of all records is spread over many tasks. Inside a range
the latest full response is carried forward; what crosses borders is one row per range, and a window over those rows carries it on.

Records: record_id, url, time, full (boolean), etag, last_modified, headers (map of text by lower-case name). Earlier means a smaller
(time, record_id), a null one being the smallest; of full responses with one time and record_id the one with the largest validators is
the latest. A null `full` counts as false: the row is resolved as a revisit. A null URL is an orphan. A revisit without validators agrees with any response. Repeated rows are
resolved alike. An empty table gives no rows. Bodies are not touched: the result points to the record that has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.llm.common import tasks_for
from tidewright.session import written

#: Headers of a 304 answer that replace those of the stored response (fixed values).
UPDATED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
RANGE_ROWS = 200_000
MOST_RANGES = 10_000

HOST = r"^(?i:https?://)?(?i:www\.)?([^/?#]*)"
PATH = r"^(?i:https?://)?[^/?#]*([^?#]*)"
TRACKING = r"(^|&)(?:utm_[a-z]+|ref)=[^&]*"


def canonical(url: Column) -> Column:
    """Host in lower case without www., path without a slash at the end, query without tracking, no scheme, no fragment."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    path = F.regexp_replace(F.regexp_extract(url, PATH, 1), "/+$", "")
    query = F.regexp_replace(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), TRACKING, "")
    query = F.regexp_replace(query, "^&", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _full() -> Column:
    return F.struct("time", "record_id", "etag", "last_modified", "headers")


def _rank() -> Column:
    """The order of the records of a URL; nulls come first in it, as in a window's ascending order."""
    return F.struct("time", "record_id", "full", "etag", "last_modified")


def agrees(revisit_etag: Column, etag: Column, revisit_modified: Column, modified: Column) -> Column:
    """The entity tag decides where the revisit has one (weak and strong alike), else the time of the last change."""
    plain = lambda tag: F.regexp_replace(tag, "^W/", "")
    by_tag = F.coalesce(plain(revisit_etag) == plain(etag), F.lit(False))
    by_time = F.when(revisit_modified.isNull(), F.lit(True)).otherwise(F.coalesce(revisit_modified == modified, F.lit(False)))
    return F.when(revisit_etag.isNotNull(), by_tag).otherwise(by_time)


def merged_headers(stored: Column, fresh: Column) -> Column:
    update = F.map_filter(F.coalesce(fresh, F.create_map().cast("map<string,string>")), lambda k, _: k.isin(UPDATED))
    kept = F.map_filter(F.coalesce(stored, F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(F.map_keys(update), k))
    return F.map_concat(kept, update)


def resolved(records: DataFrame) -> DataFrame:
    """Every revisit: record_id, url_key, outcome (resolved, changed, orphan), full_id, headers (null unless resolved)."""
    spark = records.sparkSession
    named = records.select("record_id", canonical(F.col("url")).alias("url_key"), "time", F.coalesce("full", F.lit(False)).alias("full"), "etag", "last_modified", "headers")
    known = named.filter("url_key IS NOT NULL")
    tasks = min(MOST_RANGES, tasks_for(spark, known.count(), RANGE_ROWS))
    ranges = written(known.repartitionByRange(tasks, "url_key", "time", "record_id").withColumn("part", F.spark_partition_id()), "records")

    # what crosses borders: of every range the latest full response for its last URL, handed to the next ranges that begin with that URL
    ends = ranges.groupBy("part").agg(F.min("url_key").alias("first"), F.xxhash64(F.max("url_key")).alias("last"))
    lasts = F.broadcast(ends.select(F.col("part").alias("of"), "last"))  # two numbers a range, MOST_RANGES at most
    latest = ranges.filter("full").join(lasts, (F.col("part") == F.col("of")) & (F.xxhash64("url_key") == F.col("last")))
    provided = latest.groupBy("part", "url_key").agg(F.max_by(_full(), _rank()).alias("carried")).withColumn("asked", F.lit(False))
    asked = ends.select("part", F.col("first").alias("url_key"), F.lit(None).cast(provided.schema["carried"].dataType).alias("carried"), F.lit(True).alias("asked"))
    earlier = Window.partitionBy("url_key").orderBy("part", F.desc("asked")).rowsBetween(Window.unboundedPreceding, -1)  # two rows a range at most
    handed = provided.unionByName(asked).withColumn("carried", F.last("carried", ignorenulls=True).over(earlier))
    carried = handed.filter(F.col("asked") & F.col("carried").isNotNull()).select("part", "url_key", "carried")

    before = Window.partitionBy("part", "url_key").orderBy(_rank()).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranges.withColumn("prior", F.last(F.when(F.col("full"), _full()), ignorenulls=True).over(before)).filter("NOT full")
    # dealt like the window before, so rows stay where they are
    found = inside.join(carried, ["part", "url_key"], "left").withColumn("prior", F.coalesce("prior", "carried"))
    ok = agrees(F.col("etag"), F.col("prior.etag"), F.col("last_modified"), F.col("prior.last_modified"))
    outcome = F.when(F.col("prior").isNull(), "orphan").when(ok, "resolved").otherwise("changed")
    settled = found.withColumn("outcome", outcome).select(
        "record_id",
        "url_key",
        "outcome",
        F.when(F.col("outcome") == "resolved", F.col("prior.record_id")).alias("full_id"),
        F.when(F.col("outcome") == "resolved", merged_headers(F.col("prior.headers"), F.col("headers"))).alias("headers"),
    )
    nothing = F.lit(None).cast("long"), F.lit(None).cast("map<string,string>")
    lost = named.filter("url_key IS NULL AND NOT full").select("record_id", "url_key", F.lit("orphan").alias("outcome"), nothing[0].alias("full_id"), nothing[1].alias("headers"))
    return settled.unionByName(lost)
