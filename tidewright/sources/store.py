"""Layer tables in the session catalog: snapshots under one root, switched by table location.

Data are written to a new folder first; the catalog moves only after the write is complete. A merge points each partition
that exists to its new folder in one step (``SET LOCATION``); a partition is dropped only if it is left
without rows, and last. A table written anew stands complete under another name; the old one is renamed away before the new one gets its
name, and whoever finds neither in place finishes that swap. So a job that dies at any point loses no row for good: what the batch does not
hold stays, a row of the batch that moves to another partition comes back when the load is run again. Superseded folders stay until
``superseded`` is asked for them and the caller deletes them.

Marks are an append-only log: each load adds a row of its own as a partition of its own, and the latest one of a table counts.
Loads that run side by side change nothing of one another.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators import profile
from tidewright.operators import watermark as wm
from tidewright.operators.upsert import ACTION, action_counts, check_source, merge_frame, merge_statement
from tidewright.operators.zorder import interleaved
from tidewright.session import scratch_path
from tidewright.sources.schema import plain_ddl

# A staged batch is broadcast to its target only below both measured bounds; the session may set others.
SMALL_ROWS = 2_000_000
SMALL_BYTES = 256 * 1024 * 1024
TRANSACTIONAL = ("delta", "iceberg", "hudi")  # providers that take MERGE INTO (fixed values)
INTERLEAVED = "_interleaved"
FRESH, OLD = "__fresh", "__old"  # names of a table while it is swapped
MARK_LOG, QUARANTINE, PROFILES = "water_mark", "quarantine", "column_profile"
QUARANTINE_DDL = "table_name string, load_time timestamp, source_key string, column_name string, raw_value string, reason string"
KEY_PART = "key_part"  # a partition column that readers of a table do not see
SMALL_ROWS_CONF, SMALL_BYTES_CONF = "spark.tidewright.merge.smallRows", "spark.tidewright.merge.smallBytes"
VALUE_BYTES = 16  # upper estimate of a fixed-width value or of the overhead of a text


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class TypeChange(ValueError):
    """A batch whose column has a type that the stored one cannot be widened to."""


def can_widen(old: T.DataType, new: T.DataType) -> bool:
    """Whether files written with ``old`` can be read as ``new``, every value keeping its meaning."""
    if old == new:
        return True
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return _WHOLE.index(type(old)) < _WHOLE.index(type(new))
    if isinstance(old, T.FloatType) and isinstance(new, T.DoubleType):
        return True
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return isinstance(old, T.DateType) and isinstance(new, T.TimestampNTZType)


@dataclass(frozen=True)
class Staged:
    """A batch written once: read back for the duplicate check, the merge and the next watermark."""

    frame: DataFrame
    rows: int
    text_bytes: int
    newest: dt.datetime | None
    path: str

    @property
    def small(self) -> bool:
        size = self.text_bytes + self.rows * VALUE_BYTES * len(self.frame.columns)
        conf = self.frame.sparkSession.conf
        rows, most = (int(conf.get(k, str(v))) for k, v in ((SMALL_ROWS_CONF, SMALL_ROWS), (SMALL_BYTES_CONF, SMALL_BYTES)))
        return self.rows <= rows and size <= most


@dataclass
class Store:
    """Tables below one root; ``prefix`` goes before the names of the databases, one per layer."""

    spark: SparkSession
    root: str
    prefix: str = ""

    def _plain(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def _database(self, layer: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}`")

    def name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}{layer}`.`{table}`"

    def _fresh_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}/{uuid.uuid4().hex}"

    def exists(self, layer: str, table: str) -> bool:
        """Whether there is such a table; one whose swap was interrupted gets its name back first."""
        if self._named(layer, table):
            return True
        fresh, old = (self._named(layer, table + end) for end in (FRESH, OLD))
        if not old:
            return False
        # the old table was renamed away: the fresh one is complete, if it is there
        self._rename(layer, table + (FRESH if fresh else OLD), table)
        return True

    def _named(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self._plain(layer, table))

    def _rename(self, layer: str, table: str, to: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(layer, table)} RENAME TO {self.name(layer, to)}")

    def read(self, layer: str, table: str) -> DataFrame:
        return self.stored(layer, table).drop(KEY_PART)

    def stored(self, layer: str, table: str) -> DataFrame:
        """The table with the columns that it is cut by."""
        self.exists(layer, table)  # finishes an interrupted swap
        return self.spark.table(self.name(layer, table))

    def partition_column(self, layer: str, table: str) -> str | None:
        return next((c.name for c in self.spark.catalog.listColumns(self._plain(layer, table)) if c.isPartition), None)

    def create(self, layer: str, table: str, ddl: str, partition_by: Sequence[str] = ()) -> None:
        """Empty table with a fixed layout; an existing one is dropped."""
        self._database(layer)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")
        parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        self.spark.sql(
            f"CREATE TABLE {self.name(layer, table)} ({plain_ddl(ddl)}) USING parquet {parts} "
            f"LOCATION '{self._fresh_path(layer, table)}'"
        )

    def _write(self, df: DataFrame, path: str, metrics: Sequence[Column], sort: Sequence[str] = (), interleave: bool = False) -> dict:
        if sort and interleave:
            tie = F.xxhash64(*[c for c in df.columns if c != ACTION])
            ranked = interleaved(df, sort, INTERLEAVED)
            df = ranked.repartitionByRange(INTERLEAVED, tie).sortWithinPartitions(INTERLEAVED).drop(INTERLEAVED)
        elif sort:
            # ranges are cut by the sort columns and a hash of the row: a value that holds a large share of the
            # rows is spread over several tasks, and files stay narrow in the sort columns
            tie = F.xxhash64(*[c for c in df.columns if c != ACTION])
            df = df.repartitionByRange(*sort, tie).sortWithinPartitions(*sort)
        seen = Observation()
        observed = df.observe(seen, F.count(F.lit(1)).alias("row_count_written"), *metrics)
        observed.drop(ACTION).write.mode("errorifexists").parquet(path)
        return seen.get

    def _write_parts(
        self, df: DataFrame, path: str, partition: str, metrics: Sequence[Column], sort: Sequence[str] = ()
    ) -> tuple[dict, set[str]]:
        """Files by partition value. The rebalance splits a value that outgrows a task and joins small ones."""
        seen = Observation()  # above the shuffle: a map stage that runs again must not count twice
        even = df.hint("rebalance", F.col(partition))
        observed = even.observe(seen, F.count(F.lit(1)).alias("row_count_written"), *metrics).drop(ACTION)
        if sort:
            observed = observed.sortWithinPartitions(partition, *sort)
        observed.write.partitionBy(partition).parquet(path)
        counts = seen.get
        if not counts["row_count_written"]:
            return counts, set()
        values = self.spark.read.schema(df.drop(ACTION).schema).parquet(path).select(partition).distinct()
        return counts, {r[0] for r in values.collect()}  # read from the folder names; months, not rows

    def replace(
        self, layer: str, table: str, df: DataFrame, metrics: Sequence[Column] = (), sort: Sequence[str] = (), interleave: bool = False
    ) -> dict:
        """New snapshot, then the location switch (S6, M5). Returns what was observed in the same pass.

        ``sort`` range-partitions the rows, so that min/max statistics let later scans skip files (O1): by the first column, or with
        ``interleave`` by any of them. ``df`` is then read twice, once for the ranks.
        """
        path = self._fresh_path(layer, table)
        self._database(layer)
        counts = self._write(df, path, metrics, sort, interleave)
        if self.exists(layer, table) and self._same_layout(layer, table, df.drop(ACTION), None):
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} SET LOCATION '{path}'")
        else:
            self._register(layer, table, df.drop(ACTION), path)
        self.spark.catalog.refreshTable(self.name(layer, table))
        return counts

    def _same_layout(self, layer: str, table: str, df: DataFrame, partition: str | None) -> bool:
        held = [c.name for c in self.spark.catalog.listColumns(self._plain(layer, table)) if c.isPartition]
        return self.stored(layer, table).dtypes == df.dtypes and held == ([partition] if partition else [])

    def _register(
        self, layer: str, table: str, df: DataFrame, path: str, partition: str | None = None, filled: bool = False, places: Mapping[str, str] | None = None
    ) -> None:
        """The files of ``path`` as the table: complete under another name, then the old one is renamed away and it is renamed in."""
        fresh = table + FRESH
        held = self.exists(layer, table)
        layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        parts = f"PARTITIONED BY (`{partition}`)" if partition else ""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, fresh)}")
        self.spark.sql(f"CREATE TABLE {self.name(layer, fresh)} ({layout}) USING parquet {parts} LOCATION '{path}'")
        if filled:
            self.spark.catalog.recoverPartitions(self.name(layer, fresh))
        for value, place in (places or {}).items():
            self.spark.sql(f"ALTER TABLE {self.name(layer, fresh)} ADD PARTITION ({partition}='{value}') LOCATION '{place}'")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table + OLD)}")
        if held:
            self._rename(layer, table, table + OLD)
        self._rename(layer, fresh, table)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table + OLD)}")

    def reload_partitioned(
        self, layer: str, table: str, df: DataFrame, partition: str, metrics: Sequence[Column] = (), sort: Sequence[str] = (), hidden: Sequence[str] = ()
    ) -> dict:
        """Whole table written anew in partitions (M5, D7); registered only when the files are complete.

        ``hidden`` columns are in the files, but not in the table: the caller may read them from ``path``, which is among the counts.
        """
        path = self._fresh_path(layer, table)
        self._database(layer)
        counts, filled = self._write_parts(df, path, partition, metrics, sort)
        self._register(layer, table, df.drop(ACTION, *hidden), path, partition, bool(filled))
        self.spark.catalog.refreshTable(self.name(layer, table))
        return {**counts, "path": path}

    def replace_partitions(
        self, layer: str, table: str, df: DataFrame, partition: str, touched: Sequence[str], metrics: Sequence[Column] = ()
    ) -> dict:
        """Only the touched partitions get a new folder (D7): the filled ones first, then those left empty are dropped.

        The list of touched partition values is short by nature (months, key ranges); rows never reach the driver.
        """
        path = self._fresh_path(layer, table)
        counts, filled = self._write_parts(df, path, partition, metrics)
        held = self.partitions(layer, table)
        name = self.name(layer, table)
        for value in sorted(filled):
            spec, place = f"PARTITION ({partition}='{value}')", f"'{path}/{partition}={value}'"
            change = f"{spec} SET LOCATION {place}" if value in held else f"ADD {spec} LOCATION {place}"
            self.spark.sql(f"ALTER TABLE {name} {change}")
        for value in sorted((set(touched) - filled) & held):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition}='{value}')")
        self.spark.catalog.refreshTable(name)
        return counts

    def partitions(self, layer: str, table: str) -> set[str]:
        """Values of the one partition column, from the catalog."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name(layer, table)}").collect()
        return {unquote(r[0].split("=", 1)[1]) for r in rows}

    def superseded(self, layer: str, table: str) -> list[str]:
        """Folders under the table's root that the catalog does not point to: what a retention job may delete."""
        held = {self._location(f"DESCRIBE FORMATTED {self.name(layer, table)}")}
        if column := self.partition_column(layer, table):
            for value in self.partitions(layer, table):
                held.add(self._location(f"DESCRIBE FORMATTED {self.name(layer, table)} PARTITION ({column}='{value}')").rsplit("/", 1)[0])
        jvm, top = self.spark._jvm, f"{self.root}/{layer}/{table}"
        folder = jvm.org.apache.hadoop.fs.Path(top)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [str(f.getPath().getName()) for f in system.listStatus(folder)] if system.exists(folder) else []
        names = {h.rsplit("/", 1)[-1] for h in held}
        return sorted(f"{top}/{name}" for name in found if name not in names)

    def _location(self, sql: str) -> str:
        rows = [r for r in self.spark.sql(sql).collect() if r[0] == "Location"]
        return rows[0][1].rstrip("/")

    def stage(self, batch: DataFrame, time_column: str | None, label: str) -> Staged:
        """The batch written to shared scratch; size and newest time are observed on the way (A4)."""
        path = scratch_path(self.spark, label)
        seen = Observation()
        newest = F.max(time_column) if time_column else F.max(F.lit(None))
        texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in batch.schema if isinstance(f.dataType, T.StringType)]
        text_bytes = F.coalesce(F.sum(reduce(add, texts)), F.lit(0)) if texts else F.sum(F.lit(0))
        observed = batch.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            text_bytes.cast("long").alias("text_bytes"),
            newest.cast("timestamp_ntz").alias("newest"),
        )
        observed.write.mode("errorifexists").parquet(path)
        counts = seen.get
        frame = self.spark.read.schema(batch.schema).parquet(path)
        return Staged(frame, counts["rows"], counts["text_bytes"] or 0, counts["newest"], path)

    def merge(
        self,
        layer: str,
        table: str,
        staged: Staged,
        keys: Sequence[str],
        *,
        partition: str | None = None,
        by_key: bool = False,
        **rules,
    ) -> dict:
        """Staged batch merged into a stored table; counts come from the write itself (M1-M8).

        With ``partition`` only the partitions that hold a matched row, or receive one, are rewritten. ``by_key`` says
        that the key decides the partition: then the batch alone tells which ones, and no other is read at all.
        """
        if self.transactional(layer, table):
            return self._delegated(layer, table, staged, keys, **rules)
        target = self._widened(layer, table, staged.frame)
        small = staged.small
        null_safe = rules.get("null_safe", False)
        metrics = [
            F.count_if(F.col(ACTION) == "insert").alias("inserted"),
            F.count_if(F.col(ACTION) == "update").alias("updated"),
        ]
        if partition is None:
            check_source(target, staged.frame, keys, null_safe)
            merged = merge_frame(target, staged.frame, keys, small_source=small, **rules)
            counts = self.replace(layer, table, merged, metrics)
        else:
            values = staged.frame.select(partition)
            if not by_key:
                batch_keys = staged.frame.select(*[F.col(k).alias(f"_{k}") for k in keys])
                on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) if null_safe else F.col(k) == F.col(f"_{k}") for k in keys])
                # the batch's ends of the first key reach the scan: mostly recent keys, whose row groups are few
                low, high = staged.frame.agg(F.min(keys[0]), F.max(keys[0])).first()
                near = F.col(keys[0]).between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
                near = near | F.col(keys[0]).isNull() if null_safe else near
                hit = target.select(*keys, partition).filter(near).join(F.broadcast(batch_keys) if small else batch_keys, on, "left_semi")
                values = values.union(hit.select(partition))
            touched = [r[0] for r in values.distinct().collect()]
            part = target.filter(F.col(partition).isin(touched)) if touched else target.limit(0)
            check_source(part, staged.frame, keys, null_safe)
            merged = merge_frame(part, staged.frame, keys, small_source=small, **rules)
            counts = self.replace_partitions(layer, table, merged, partition, touched, metrics)
        return {**counts, "rows_changed": counts["inserted"] + counts["updated"]}

    def transactional(self, layer: str, table: str) -> bool:
        """Whether the catalog itself can merge into the table."""
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name(layer, table)}").collect()
        return any(r[0] == "Provider" and r[1].lower() in TRANSACTIONAL for r in rows)

    def _delegated(self, layer: str, table: str, staged: Staged, keys: Sequence[str], **rules) -> dict:
        """The merge as one statement of the catalog; what changed is counted before, from the keys and the condition alone."""
        target, view = self.stored(layer, table), f"batch_{uuid.uuid4().hex}"
        check_source(target, staged.frame, keys, rules.get("null_safe", False))
        statement = merge_statement(self.name(layer, table), view, target.columns, staged.frame.columns, keys, **rules)
        seen = action_counts(merge_frame(target, staged.frame, keys, small_source=staged.small, **rules)).first()
        staged.frame.createOrReplaceTempView(view)
        try:
            self.spark.sql(statement)
        finally:
            self.spark.catalog.dropTempView(view)
        return {**seen.asDict(), "row_count_written": seen["inserted"] + seen["updated"] + seen["kept"]}

    def _widened(self, layer: str, table: str, batch: DataFrame) -> DataFrame:
        """The stored table with the columns and types that a merge of ``batch`` needs.

        A column that only the batch has is added to the table, NULL in all its rows. A type is widened where every value keeps its
        meaning: parts written before stay as they are and are read with the new layout. Other types are refused: a merge would cast them silently.
        """
        target = self.stored(layer, table)
        held = {f.name.lower(): f for f in target.schema.fields}
        added = [f for f in batch.schema.fields if f.name.lower() not in held]
        wider = []
        for field in batch.schema.fields:
            old = held.get(field.name.lower())
            if old is not None and old.dataType != field.dataType and not can_widen(field.dataType, old.dataType):
                if not can_widen(old.dataType, field.dataType):
                    raise TypeChange(f"{table}.{field.name}: {old.dataType.simpleString()} cannot become {field.dataType.simpleString()}")
                wider.append((old.name, field.dataType))
        if wider:
            self._relayout(layer, table, dict(wider))
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD COLUMNS ({columns})")
        if wider or added:
            self.spark.catalog.refreshTable(self.name(layer, table))
        return self.stored(layer, table)

    def _relayout(self, layer: str, table: str, kinds: dict[str, T.DataType]) -> None:
        """The same files under a table with other column types: no file is read or written, only the catalog's entry changes."""
        name, partition = self.name(layer, table), self.partition_column(layer, table)
        root = self._location(f"DESCRIBE FORMATTED {name}")
        places = {v: self._location(f"DESCRIBE FORMATTED {name} PARTITION ({partition}='{v}')") for v in self.partitions(layer, table)} if partition else {}
        frame = self.stored(layer, table)
        frame = frame.select(*[F.col(f"`{f.name}`").cast(kinds.get(f.name, f.dataType)).alias(f.name) for f in frame.schema.fields])
        self._register(layer, table, frame, root, partition, places=places)

    def discard(self, staged: Staged) -> None:
        """Delete a staged batch once its load is complete."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(staged.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    # ---- watermarks -------------------------------------------------------------------------------

    def marks(self, layer: str) -> DataFrame:
        """The latest row of every table in the log; a NULL mark keeps the one before."""
        if not self.exists(layer, MARK_LOG):
            return wm.empty_watermarks(self.spark)
        return wm.latest(self.spark.table(self.name(layer, MARK_LOG)))

    def mark(self, layer: str, table: str):
        return wm.last_mark(self.marks(layer), table, layer)

    def counted(self, layer: str, table: str) -> int | None:
        """Rows of the table after its last load, from the control table."""
        row = self.marks(layer).filter((F.col("table_name") == table) & (F.col("layer_type") == layer)).select("row_count").first()
        return row[0] if row else None

    def advance(self, layer: str, table: str, mark, load_ts, row_count, rows_changed) -> None:
        """A row more in the log of marks (I4). No row is read or replaced, so loads of other tables may do the same at any time."""
        self._append(layer, MARK_LOG, wm.WATERMARK_DDL, wm.mark_row(self.spark, table, layer, mark, load_ts, row_count, rows_changed).coalesce(1), self._run_number())

    def _run_number(self) -> str:
        """Later runs have larger numbers; two of the same instant differ, too."""
        return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def _append(self, layer: str, log: str, ddl: str, rows: DataFrame, run: str) -> None:
        """Rows of one run as a partition of their own of a log table; nothing that is there is read or changed."""
        self._database(layer)
        path, name = self._fresh_path(layer, log), self.name(layer, log)
        rows.write.mode("errorifexists").parquet(path)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, run string) USING parquet PARTITIONED BY (run) LOCATION '{self._fresh_path(layer, log)}'")
        self.spark.sql(f"ALTER TABLE {name} ADD PARTITION (run='{run}') LOCATION '{path}'")
        self.spark.catalog.refreshTable(name)

    def log(self, layer: str, log: str, ddl: str, rows: DataFrame) -> None:
        """Rows added to a log table, as the next run."""
        self._append(layer, log, ddl, rows, self._run_number())

    def keep_rejects(self, layer: str, table: str, load_ts: dt.datetime, rejects: DataFrame) -> None:
        """Rejected values of a load (S5), one row each: source_key, column_name, raw_value, reason."""
        named = [F.lit(table).alias("table_name"), F.lit(load_ts).cast("timestamp").alias("load_time")]
        self._append(layer, QUARANTINE, QUARANTINE_DDL, rejects.select(*named, "source_key", "column_name", "raw_value", "reason"), self._run_number())

    def rejects(self, layer: str, table: str) -> DataFrame:
        """All rejected values of a table's loads, with the load time."""
        if not self.exists(layer, QUARANTINE):
            return self.spark.createDataFrame([], QUARANTINE_DDL)
        return self.read(layer, QUARANTINE).filter(F.col("table_name") == table).drop("run")

    def keep_profile(self, layer: str, table: str, rows: DataFrame, columns: Sequence[str] | None = None) -> None:
        """The profile of what a load brought (D2), beside those of the loads before it."""
        state = profile.profile_state(rows, columns).withColumn("table_name", F.lit(table))
        self._append(layer, PROFILES, f"{profile.STATE_DDL}, table_name string", state.coalesce(1), self._run_number())

    def profile(self, layer: str, table: str) -> DataFrame:
        """The profile of all loads of a table together; no row of the table is read."""
        states = self.read(layer, PROFILES).filter(F.col("table_name") == table).drop("run", "table_name")
        return profile.described(profile.merged_profiles(states))

    def compact_marks(self, layer: str) -> int:
        """One row per table and layer in place of all rows logged so far; rows added meanwhile stay. Returns how many runs were folded."""
        runs = sorted(self.partitions(layer, MARK_LOG)) if self.exists(layer, MARK_LOG) else []
        if len(runs) < 2:
            return 0
        folded = wm.latest(self.spark.table(self.name(layer, MARK_LOG)).filter(F.col("run") <= runs[-1]))
        self._append(layer, MARK_LOG, wm.WATERMARK_DDL, folded.coalesce(1), f"{runs[-1]}-folded")  # sorts behind all of them and before any later one
        for run in runs:
            self.spark.sql(f"ALTER TABLE {self.name(layer, MARK_LOG)} DROP IF EXISTS PARTITION (run='{run}')")
        self.spark.catalog.refreshTable(self.name(layer, MARK_LOG))
        return len(runs)
