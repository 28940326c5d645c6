"""Table loads, layer by layer: full and incremental, each with its watermark (M, I, S6-S8, S12).

One load = one staged batch, one duplicate check on it, one write of the target with its counts observed
on the way, one control row. Data come first and the mark after them: a load that dies in between is
repeated and, being a keyed merge, changes nothing twice. The staged batch is deleted after the mark.

Loads are complete by default; ``Options.compatible()`` gives the narrower results of the system whose tables
these are (see README, Decisions).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.scalars import EPOCH_START
from tidewright.operators import ledger as ledger_ops
from tidewright.operators.calendar import DEFAULT_END, DEFAULT_START, calendar, refreshed_calendar
from tidewright.operators.upsert import Condition, date_differs, hash_differs
from tidewright.operators.watermark import next_mark
from tidewright.plans import conform, star
from tidewright.plans.layouts import CONFORMED, DIMENSION_KEYS, STAR_FACTS, star_layout
from tidewright.plans.sales import SALES_UPDATE, sales_changed, sales_full
from tidewright.sources.landing import full_extract, incremental_extract
from tidewright.sources.raw_tables import RAW_TABLES
from tidewright.sources.schema import REJECT_TYPE, REJECTS, length_checked, reject_metrics, reject_rows, rejected_values
from tidewright.sources.store import KEY_PART, Store

RAW, CONFORMED_LAYER, STAR = "raw", "conformed", "star"
SUCCESS, NO_NEW_DATA = "SUCCESS", "SUCCESS_NO_NEW_DATA"


class EmptySource(ValueError):
    """A full load found no rows at all."""


class LostTable(RuntimeError):
    """A table that has a mark, but cannot be found."""


@dataclass(frozen=True)
class LoadResult:
    """What a load did (M9): marks before and after, rows in the table, rows changed."""

    table: str
    layer: str
    status: str
    previous_mark: dt.datetime | None
    new_mark: dt.datetime | None
    row_count: int | None
    rows_changed: int
    rejected: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Options:
    """Choices of a load. The defaults lose no row and no change.

    ``lookback`` re-reads rows up to that long before the mark, so a row with the very time of the mark is not missed.
    """

    lookback: dt.timedelta = dt.timedelta(seconds=1)
    full_text_hash: bool = True  # survey: whole texts decide whether a row changed
    lead_digits: int | None = None  # customer: all digits at the end of a lead's id
    dedupe: bool = False  # customer: one mail, phone and lead each
    late_movements: bool = True  # ledger: back-dated movements and days stored before are computed anew
    attribution: str = "per_pair"
    anchor: str = "snapshot_day"
    whole_days: bool = False  # facts: date keys for times of day too

    @classmethod
    def compatible(cls) -> Options:
        return cls(lookback=dt.timedelta(0), full_text_hash=False, lead_digits=4, late_movements=False)


# Large tables are stored by month, so that a merge rewrites only the months it touches.
MONTH_PART = "month_part"
NO_MONTH = "none"
MONTH_OF = {
    "sales": "order_date",
    "transaction": "transaction_date",
    "product_inventory": "transaction_date",
    "fact_sales": "order_date",
    "fact_transaction": "transaction_date",
    "fact_product_inventory": "transaction_date",
    "fact_survey": "survey_date",
}
DAY_IN_KEY = {"product_inventory", "fact_product_inventory"}  # the key decides the month


def by_month(table: str, rows: DataFrame) -> DataFrame:
    """Rows with the month they are stored under; facts by their source's date, which every row has."""
    return rows.withColumn(MONTH_PART, F.coalesce(F.date_format(F.col(MONTH_OF[table]), "yyyy-MM"), F.lit(NO_MONTH)))


# All other tables are stored by ranges of their key: new and changed rows mostly have recent keys.
KEY_RANGE = 1_000_000
KEY_BUCKETS = 64


def by_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the part of their key: its million for a whole number, else a bucket of its hash."""
    if isinstance(rows.schema[keys[0]].dataType, T.IntegralType):
        part = F.floor(F.col(keys[0]).cast("long") / KEY_RANGE)
    else:
        part = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    return rows.withColumn(KEY_PART, F.coalesce(part.cast("string"), F.lit(NO_MONTH)))


# ---- raw layer ------------------------------------------------------------------------------------


def load_raw_full(store: Store, table: str, landed: DataFrame, load_ts: dt.datetime) -> LoadResult:
    """Snapshot of everything landed; an empty landing is an error, the old table stays."""
    config = RAW_TABLES[table]
    if not config.has_full:
        raise ValueError(f"{table} has no full load")
    if landed.isEmpty():
        raise EmptySource(table)
    rejects = Observation()  # counted in the pass that writes the table
    bad = rejected_values(landed, config.schema, config.keys)
    rows = full_extract(landed.observe(rejects, *reject_metrics(landed, config.schema)), config, *([bad] if config.keys else []))
    metrics = [F.max(config.time_column).cast("timestamp_ntz").alias("newest")] if config.time_column else []
    counts = (
        store.reload_partitioned(RAW, table, by_key(rows, config.keys), KEY_PART, metrics, hidden=[REJECTS])
        if config.keys
        else store.replace(RAW, table, rows, metrics)
    )
    mark = next_mark(counts.get("newest"), None, load_ts, "data_or_now")
    written = counts["row_count_written"]
    store.advance(RAW, table, mark, load_ts, written, written)
    rejected = {name.removeprefix("rejected_"): n for name, n in rejects.get.items() if n}
    if rejected and config.keys:
        _quarantine(store, table, store.spark.read.schema(f"{REJECTS} {REJECT_TYPE}").parquet(counts["path"]), load_ts)
    return LoadResult(table, RAW, SUCCESS, None, mark, written, written, rejected)


def _quarantine(store: Store, table: str, written: DataFrame, load_ts: dt.datetime) -> None:
    """Rejected values of a batch that is written with them; only they are read from it, the landing is not scanned again."""
    store.keep_rejects(RAW, table, load_ts, reject_rows(written))


def load_raw_incremental(
    store: Store,
    table: str,
    landed: DataFrame,
    load_ts: dt.datetime,
    lookback: dt.timedelta = dt.timedelta(0),
) -> LoadResult:
    """Rows newer than the mark merged by the table's keys; the first load creates the table."""
    config = RAW_TABLES[table]
    if not config.has_incremental:
        raise ValueError(f"{table} has no incremental load")
    mark = store.mark(RAW, table)
    rejects = Observation()  # counted on the whole landing, in the pass that stages the batch
    seen = landed.observe(rejects, *reject_metrics(landed, config.schema))
    bad = rejected_values(landed, config.schema, config.keys)
    batch = by_key(incremental_extract(seen, config, mark, lookback, bad), config.keys)
    staged = store.stage(batch, config.time_column, f"raw-{table}")
    rejected = {name.removeprefix("rejected_"): n for name, n in rejects.get.items() if n}
    if rejected:
        _quarantine(store, table, staged.frame, load_ts)
    staged = replace(staged, frame=staged.frame.drop(REJECTS))
    if staged.rows == 0:
        store.discard(staged)
        return LoadResult(table, RAW, NO_NEW_DATA, mark, mark, None, 0, rejected)
    if not store.exists(RAW, table) and mark is not None:
        # the batch holds only what is newer than the mark: a table made of it would lack all rows before
        store.discard(staged)
        raise LostTable(f"{RAW}.{table} is gone, but was loaded up to {mark}")
    if store.exists(RAW, table):
        counts = store.merge(RAW, table, staged, config.keys, **_parts(store, RAW, table, True))
        rows = _rows_after(store, RAW, table, counts)
    else:
        counts = store.reload_partitioned(RAW, table, staged.frame, KEY_PART)
        counts["rows_changed"] = rows = counts["row_count_written"]
    new_mark = next_mark(staged.newest, mark, load_ts, "data_or_now")
    store.advance(RAW, table, new_mark, load_ts, rows, counts["rows_changed"])
    store.discard(staged)
    return LoadResult(table, RAW, SUCCESS, mark, new_mark, rows, counts["rows_changed"], rejected)


def _parts(store: Store, layer: str, table: str, decided: bool) -> dict:
    """How a stored table is cut, for the merge; a table that is not cut is rewritten whole."""
    column = store.partition_column(layer, table)
    return {"partition": column, "by_key": decided or column == KEY_PART} if column else {}


def _rows_after(store: Store, layer: str, table: str, counts: Mapping[str, int]) -> int:
    """Rows of the table: those before and the inserted ones. Counted (from footers) only if no load has recorded them."""
    if not store.partition_column(layer, table):
        return counts["row_count_written"]
    before = store.counted(layer, table)
    return store.read(layer, table).count() if before is None else before + counts["inserted"]


# ---- conformed layer ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Entity:
    """How a conformed table is built and merged.

    ``build`` gets the store, the mark (None on a full load), the load time and the options. ``mark_rule`` says what the
    next mark is taken from; tables re-read whole are compared by hash and marked with the load time.
    """

    keys: tuple[str, ...]
    build: Callable[[Store, dt.datetime | None, dt.datetime, Options], DataFrame]
    update: tuple[str, ...] | None = None
    when: Condition | None = None
    null_safe: bool = False
    mark_rule: str = "data"


class RawTables(Mapping):
    """The raw layer as a mapping from table name to DataFrame."""

    def __init__(self, store: Store):
        self.store = store

    def __getitem__(self, table: str) -> DataFrame:
        return self.store.read(RAW, table)

    def __iter__(self):
        return iter(RAW_TABLES)

    def __len__(self):
        return len(RAW_TABLES)


def _copy(entity: str):
    return lambda store, mark, load_ts, options: conform.conform_copy(entity, store.read(RAW, entity), _back(mark, options))


def _back(mark: dt.datetime | None, options: Options) -> dt.datetime | None:
    return mark if mark is None or mark == EPOCH_START else mark - options.lookback


def _sales(store: Store, mark: dt.datetime | None, load_ts: dt.datetime, options: Options) -> DataFrame:
    raw = RawTables(store)
    tables = raw["sales_order_header"], raw["sales_order_detail"], raw["product"]
    return sales_full(*tables) if mark is None else sales_changed(*tables, _back(mark, options))


BALANCES = "product_balance"  # current balance per product and location, kept beside the ledger


def _ledger(store: Store, mark: dt.datetime | None, load_ts: dt.datetime, options: Options) -> DataFrame:
    raw = RawTables(store)
    stock, movements = raw["product_inventory"], raw["product_transaction_history"]
    count = {"attribution": options.attribution}
    if mark is None:
        return ledger_ops.ledger_full(stock, movements, anchor=options.anchor, **count)
    stored = store.read(CONFORMED_LAYER, "product_inventory")
    count["balances"] = store.read(CONFORMED_LAYER, BALANCES) if store.exists(CONFORMED_LAYER, BALANCES) else None
    if options.late_movements:
        return ledger_ops.ledger_batch(stock, movements, stored, mark, load_ts, anchor=options.anchor, **count)
    return ledger_ops.ledger_increment(stock, movements, stored, mark, load_ts, **count)


def _keep_balances(store: Store, batch: DataFrame | None) -> None:
    """After the ledger: balances of a full load anew, else those of the batch over the old ones.

    A batch that is merged again gives the same balances, so a repeated load is harmless here too.
    """
    before = None
    if batch is None:
        batch = store.read(CONFORMED_LAYER, "product_inventory")
    elif store.exists(CONFORMED_LAYER, BALANCES):
        before = store.read(CONFORMED_LAYER, BALANCES)
    else:
        batch = store.read(CONFORMED_LAYER, "product_inventory")
    store.replace(CONFORMED_LAYER, BALANCES, ledger_ops.current_balances(batch, before))


ENTITIES: dict[str, Entity] = {
    "account": Entity(("account_id",), _copy("account")),
    "class": Entity(("class_id",), _copy("class")),
    "department": Entity(("department_id",), _copy("department")),
    "location": Entity(("location_id",), _copy("location")),
    "sales_territory": Entity(("sales_territory_id",), _copy("sales_territory")),
    "customer": Entity(("customer_id",), lambda s, m, t, o: conform.conform_customer(RawTables(s), _back(m, o), o.dedupe, o.lead_digits)),
    "employee": Entity(("employee_id",), lambda s, m, t, o: conform.conform_employee(RawTables(s), _back(m, o))),
    "product": Entity(("product_id",), lambda s, m, t, o: conform.conform_product(RawTables(s), _back(m, o))),
    "product_inventory": Entity(("product_id", "location_id", "transaction_date"), _ledger),
    "sales": Entity(("sales_order_detail_id",), _sales, update=tuple(SALES_UPDATE), when=date_differs()),
    "transaction": Entity(
        ("transaction_id", "transaction_line_id"),
        _copy("transaction"),
        # the code is written at insert only
        update=tuple(
            c for c in [*conform.COPIES["transaction"], "modified_date"]
            if c not in ("transaction_id", "transaction_line_id", "transaction_code")
        ),
        when=date_differs(),
    ),
    "opportunity": Entity(
        ("opportunity_key",),
        lambda s, m, t, o: conform.conform_opportunity(
            s.read(RAW, "opportunity"), s.read(CONFORMED_LAYER, "customer"), t
        ),
        when=hash_differs(),
        mark_rule="load_time",
    ),
    "budget": Entity(
        ("account_id", "department_id", "budget_date"),
        lambda s, m, t, o: conform.conform_budget(s.read(RAW, "m_budget"), t),
        update=("budget", "row_hash", "modified_date"),
        when=hash_differs(),
        null_safe=True,
        mark_rule="load_time",
    ),
    "survey": Entity(
        ("survey_id",),
        lambda s, m, t, o: conform.conform_survey(s.read(RAW, "m_survey"), t, o.full_text_hash),
        when=hash_differs(),
        mark_rule="load_time",
    ),
}


def create_tables(store: Store) -> None:
    """Every conformed and star table, empty, with its fixed layout."""
    layouts = [(CONFORMED_LAYER, table, ddl) for table, ddl in CONFORMED.items()]
    layouts += [(STAR, table, star_layout(table)) for table in [*DIMENSION_KEYS, *STAR_FACTS]]
    for layer, table, ddl in layouts:
        column = MONTH_PART if table in MONTH_OF else KEY_PART
        store.create(layer, table, f"{ddl}, {column} VARCHAR(20)", partition_by=[column])
    store.replace(STAR, "dim_date", calendar(store.spark, DEFAULT_START, DEFAULT_START).limit(0))


def load_conformed_full(store: Store, table: str, load_ts: dt.datetime, options: Options = Options()) -> LoadResult:
    """Truncate and reload (M5); the mark is the newest time of the rows written."""
    entity = ENTITIES[table]
    rows = length_checked(entity.build(store, None, load_ts, options), CONFORMED[table])
    rows = by_month(table, rows) if table in MONTH_OF else by_key(rows, entity.keys)
    result = _reload(store, CONFORMED_LAYER, table, rows, load_ts, [entity.keys[0]])
    if table == "product_inventory":
        _keep_balances(store, None)
    return result


def _reload(store: Store, layer: str, table: str, rows: DataFrame, load_ts, sort) -> LoadResult:
    newest = F.max("modified_date").cast("timestamp_ntz").alias("newest")
    column = MONTH_PART if table in MONTH_OF else KEY_PART
    counts = store.reload_partitioned(layer, table, rows, column, [newest], sort)
    previous = store.mark(layer, table)
    mark = next_mark(counts["newest"], previous, load_ts)
    written = counts["row_count_written"]
    store.advance(layer, table, mark, load_ts, written, written)
    return LoadResult(table, layer, SUCCESS, previous, mark, written, written)


def load_conformed_incremental(store: Store, table: str, load_ts: dt.datetime, options: Options = Options()) -> LoadResult:
    entity = ENTITIES[table]
    previous = store.mark(CONFORMED_LAYER, table)
    batch = length_checked(entity.build(store, previous or EPOCH_START, load_ts, options), CONFORMED[table])
    batch = by_month(table, batch) if table in MONTH_OF else by_key(batch, entity.keys)
    rules = {"update": entity.update, "when": entity.when, "null_safe": entity.null_safe}
    after = (lambda frame: _keep_balances(store, frame)) if table == "product_inventory" else None
    return _merge(store, CONFORMED_LAYER, table, batch, entity.keys, previous, load_ts, entity.mark_rule, rules, after)


def _merge(store, layer, table, batch, keys, previous, load_ts, rule, rules, after=None) -> LoadResult:
    staged = store.stage(batch, "modified_date", f"{layer}-{table}")
    if rules.get("update") and table in MONTH_OF:
        rules = {**rules, "update": [*rules["update"], MONTH_PART]}
    mark = next_mark(staged.newest, previous, load_ts, rule)
    if staged.rows == 0:
        # nothing newer: the table stays as it is, the control row still records the run
        store.advance(layer, table, mark, load_ts, store.counted(layer, table), 0)
        store.discard(staged)
        return LoadResult(table, layer, NO_NEW_DATA, previous, mark, None, 0)
    counts = store.merge(layer, table, staged, list(keys), **_parts(store, layer, table, table in DAY_IN_KEY), **rules)
    if after:
        after(staged.frame)
    rows = _rows_after(store, layer, table, counts)
    store.advance(layer, table, mark, load_ts, rows, counts["rows_changed"])
    store.discard(staged)
    return LoadResult(table, layer, SUCCESS, previous, mark, rows, counts["rows_changed"])


# ---- star layer -----------------------------------------------------------------------------------


class StarTables(Mapping):
    """Dimensions of the star layer by name."""

    def __init__(self, store: Store):
        self.store = store

    def __getitem__(self, table: str) -> DataFrame:
        return self.store.read(STAR, table)

    def __iter__(self):
        return iter([*DIMENSION_KEYS, "dim_date"])

    def __len__(self):
        return len(DIMENSION_KEYS) + 1


def _star_rows(store: Store, table: str, mark: dt.datetime | None, options: Options) -> DataFrame:
    mark = _back(mark, options)
    if table not in star.FACTS:
        rows = star.dimension_load(table, store.read(CONFORMED_LAYER, DIMENSION_KEYS[table][0]), mark)
        return by_key(length_checked(rows, star_layout(table)), _star_keys(table))
    source = store.read(CONFORMED_LAYER, star.FACTS[table].source)
    return _fact_rows(store, table, source, mark, options)


def _fact_rows(store: Store, table: str, source: DataFrame, mark: dt.datetime | None, options: Options) -> DataFrame:
    if table not in MONTH_OF:
        rows = star.fact_load(table, source, StarTables(store), mark, whole_days=options.whole_days)
        return by_key(length_checked(rows, star_layout(table)), _star_keys(table))
    rows = star.fact_load(table, by_month(table, source), StarTables(store), mark, whole_days=options.whole_days, keep=[MONTH_PART])
    return length_checked(rows, f"{star_layout(table)}, {MONTH_PART} VARCHAR(20)")


def _star_keys(table: str) -> list[str]:
    return list(star.FACTS[table].keys) if table in star.FACTS else [DIMENSION_KEYS[table][2]]


def load_star_full(store: Store, table: str, load_ts: dt.datetime, options: Options = Options()) -> LoadResult:
    return _reload(store, STAR, table, _star_rows(store, table, None, options), load_ts, [_star_keys(table)[0]])


def load_star_incremental(store: Store, table: str, load_ts: dt.datetime, options: Options = Options()) -> LoadResult:
    previous = store.mark(STAR, table)
    batch = _star_rows(store, table, previous or EPOCH_START, options)
    return _merge(store, STAR, table, batch, _star_keys(table), previous, load_ts, "data", {})


def repair_keys(store: Store, table: str, load_ts: dt.datetime, options: Options = Options()) -> LoadResult:
    """Facts whose dimension rows came late, looked up again and merged by the fact's key; the mark stays."""
    source = star.late_rows(table, store.read(STAR, table), store.read(CONFORMED_LAYER, star.FACTS[table].source))
    batch = _fact_rows(store, table, source, None, options)
    return _merge(store, STAR, table, batch, _star_keys(table), store.mark(STAR, table), load_ts, "data", {})


def load_calendar(store: Store, start: dt.date = DEFAULT_START, end: dt.date = DEFAULT_END) -> int:
    """Days in [start, end] generated anew, all others kept."""
    if store.exists(STAR, "dim_date"):
        rows = refreshed_calendar(store.read(STAR, "dim_date"), start, end)
    else:
        rows = calendar(store.spark, start, end)
    return store.replace(STAR, "dim_date", rows.coalesce(4))["row_count_written"]


CONFORMED_ORDER = [t for t in ENTITIES if t != "opportunity"] + ["opportunity"]  # needs conformed customers
STAR_ORDER = [*DIMENSION_KEYS, *STAR_FACTS]  # dimensions before facts


def preview(store: Store, layer: str, table: str, rows: int = 5) -> DataFrame:
    """First rows of a loaded table."""
    return store.read(layer, table).limit(rows)
