"""Incremental ingestion of landed API responses.

Per entity: the items of the responses are appended to raw staging and committed; then they are
read back, mapped to typed rows, checked, and upserted into the entity's tables. All tables of an
entity and its high-water mark change in one commit. A failure leaves them as they were, keeps
the raw items, and is written to the run log. Responses that are not JSON are kept as rejects.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from tallyweave.functions import variants
from tallyweave.functions.times import instant_literal, mark_text, utc_datetime
from tallyweave.operators import checks, envelope
from tallyweave.operators.mapping import ITEM, VIOLATIONS
from tallyweave.operators.purchase_orders import order_worklist, require_rows, site_directory
from tallyweave.operators.upsert import BUCKET, MOST_BUCKETS, NEW, bucket_of, buckets_in, merged, stamped
from tallyweave.plans.entities import GROUPS, EntitySpec, TargetSpec
from tallyweave.sources.staging import stage
from tallyweave.sources.versioned import Change, VersionedStore

log = logging.getLogger(__name__)

BUCKETS = 64
# What came later, from the outside in: pull, landing, page, item, item of a child array.
ARRIVAL = ("pulled_at", "landed", "page", "position", "child_position")
# Raw tables lie in folders by the day of the pull (UTC).
PULLED_ON = "pulled_on"
RUN_LOG = "run_log"
RUN_LOG_SCHEMA = (
    "endpoint_name string, started_at timestamp, ended_at timestamp, rows_pulled long, rows_upserted long, "
    "status string, error_message string"
)
# The states of a high-water mark and of a run.
NEVER_RUN, SUCCESS, FAILED = "never_run", "success", "failed"


@dataclass(frozen=True)
class LoadOptions:
    """``buckets`` is fixed for the life of a store; choose it so that a bucket is a few files, for some targets
    apart from the others in ``target_buckets``. Keys are random, so a batch of a few hundred rows already falls in most
    buckets: an upsert costs about a rewrite of its target. Buckets larger than ``task_rows`` are cut over several tasks."""

    buckets: int = BUCKETS
    on_duplicate: str = "error"
    now: dt.datetime | None = None
    target_buckets: Mapping[str, int] = field(default_factory=dict)
    task_rows: int = 5_000_000

    def buckets_of(self, table: str) -> int:
        buckets = self.target_buckets.get(table, self.buckets)
        if not 0 < buckets <= MOST_BUCKETS:
            raise ValueError(f"{table}: between 1 and {MOST_BUCKETS} buckets, not {buckets}")
        return buckets

    def time(self) -> dt.datetime:
        return utc_datetime(self.now or dt.datetime.now(dt.timezone.utc))


@dataclass(frozen=True)
class EntityResult:
    name: str
    status: str
    rows_pulled: int
    rows_upserted: int
    error: str | None = None
    responses_rejected: int = 0


def rejects_table(entity: str) -> str:
    return f"rejects/{entity}"


def responses_table(entity: str) -> str:
    """The responses as they came, to the letter."""
    return f"responses/{entity}"


def staging_table(entity: str) -> str:
    return f"staging/{entity}"


def _pulled(options: LoadOptions) -> list[Column]:
    return [instant_literal(options.time()).alias("pulled_at"), F.lit(options.time().date()).alias(PULLED_ON)]


def raw_items(pages: DataFrame, spec: EntitySpec, endpoint: str, options: LoadOptions,
              observed: Observation | None = None) -> DataFrame:
    """One staging row per item, with where it stood. ``landed`` orders the responses where the caller gives such a column;
    ``page`` is the order in which they are read. The item's text has its numbers, keys and their order as they came;
    white space and escapes are written in one way. ``responses_table`` has the whole response."""
    items = envelope.unnest(pages.withColumn("page", F.monotonically_increasing_id()), items_key=spec.items_key, single_orders=spec.single_orders,
                            observed=observed, text="raw_json")
    landed = F.col("landed").cast("string") if "landed" in pages.columns else F.lit("")
    return items.select(*_pulled(options), "raw_json", F.lit(endpoint).alias("source_endpoint"), landed.alias("landed"), "page", "position")


def land(change: Change, spec: EntitySpec, pages: DataFrame, endpoint: str, options: LoadOptions) -> tuple[int, int]:
    """Append the responses and their items to raw staging, and responses that are not JSON to the rejects. Returns the counts
    of items and rejects."""
    def kept(rows: DataFrame) -> DataFrame:
        return rows.select(*_pulled(options), F.col("body").alias("response"), F.lit(endpoint).alias("source_endpoint"))

    change.append(responses_table(spec.name), kept(pages), [PULLED_ON])
    observed = Observation()
    pulled = change.append(staging_table(spec.name), raw_items(pages, spec, endpoint, options, observed), [PULLED_ON])
    rejected = observed.get["malformed"]
    if rejected:
        change.append(rejects_table(spec.name), kept(envelope.malformed_pages(pages)), [PULLED_ON])
    return pulled, rejected


def staged_since(store: VersionedStore, spec: EntitySpec, since: dt.datetime | None = None) -> DataFrame:
    """The raw items pulled at or after a time. The folders of earlier days are not read."""
    rows = store.read(staging_table(spec.name))
    if since is None:
        return rows
    start = utc_datetime(since)
    return rows.filter((F.col(PULLED_ON) >= F.lit(start.date())) & (F.col("pulled_at") >= instant_literal(start)))


def read_mark(store: VersionedStore, endpoint: str) -> dt.datetime | None:
    """The high-water mark; an endpoint seen for the first time gets an empty one."""
    marks = store.manifest().marks
    if endpoint not in marks:
        with store.commit() as change:
            change.set_mark(endpoint, {"value": None, "status": NEVER_RUN, "last_run_at": None})
        return None
    value = marks[endpoint]["value"]
    return dt.datetime.fromisoformat(value) if value else None


def marks_table(store: VersionedStore) -> DataFrame:
    rows = [
        (name, mark["value"] and dt.datetime.fromisoformat(mark["value"]), mark["status"],
         mark["last_run_at"] and dt.datetime.fromisoformat(mark["last_run_at"]))
        for name, mark in sorted(store.manifest().marks.items())
    ]
    return store.spark.createDataFrame(
        rows, "endpoint_name string, last_watermark timestamp, last_run_status string, last_run_at timestamp",
    )


def since(rows: DataFrame, column: str, mark: dt.datetime | None) -> DataFrame:
    """Rows at or after the mark; all rows when there is no mark yet."""
    return rows if mark is None else rows.filter(F.col(column) >= instant_literal(mark))


def later_mark(high_micros: int | None, mark: dt.datetime | None) -> dt.datetime | None:
    """The new mark: the highest value seen, unless there is none or the old mark is later."""
    if high_micros is None:
        return mark
    high = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=high_micros)
    return high if mark is None else max(high, utc_datetime(mark))


def _in_buckets(key: str, buckets: int) -> list[Column]:
    """What an upsert must know of its source: how many rows it has, and in which buckets."""
    return [F.count("*").alias("rows"), F.bitmap_construct_agg(bucket_of(key, buckets).cast("long")).alias("buckets")]


def upsert_target(change: Change, target: TargetSpec, rows: DataFrame, options: LoadOptions, counted: Mapping | None = None) -> int:
    """Upsert into the buckets that the rows fall in; the files of all other buckets stay. ``counted`` has the values of
    ``_in_buckets`` where the caller has seen them."""
    buckets = options.buckets_of(target.table)
    counted = counted or rows.agg(*_in_buckets(target.key, buckets)).first().asDict()
    touched = buckets_in(counted["buckets"])
    if not touched and change.has(target.table):
        return 0
    current = change.read(target.table, [str(number) for number in touched]) if change.has(target.table) else None
    arrival = [name for name in ARRIVAL if name in rows.columns]
    source = stamped(rows.select(*target.columns, *arrival), instant_literal(options.time()))
    splits = -(-max(change.rows_of(target.table), counted["rows"]) // (buckets * options.task_rows)) or 1
    observed = Observation()
    changed = merged(current, source, target.key, buckets, splits=splits, arrival=arrival, on_duplicate=options.on_duplicate, what=target.table)
    written = changed.observe(observed, F.count_if(NEW).alias("new")).drop(NEW)
    change.replace_buckets(target.table, written, BUCKET, touched, buckets)
    return observed.get["new"]


def load_items(change: Change, spec: EntitySpec, staged: DataFrame, mark: dt.datetime | None,
               options: LoadOptions, floor: dt.datetime | None = None) -> int:
    """Map, check and upsert the staged items of one entity; move its mark. Returns rows upserted.

    Rows before ``mark`` are left out. The new mark is never before ``mark`` or ``floor``.

    Items are parsed once; where several targets read them, they are staged as VARIANT. Violations, the highest mark and the
    buckets are observed while the typed rows are staged, not in passes of their own.
    """
    arrival = [name for name in ARRIVAL if name in staged.columns]
    items = variants.with_parsed(staged.select("raw_json", *arrival), "raw_json", ITEM).drop("raw_json")
    if len(spec.targets) > 1:
        items = stage(items, f"{spec.name}-items")
    upserted = 0
    for target in spec.targets:
        rows = spec.map(items, target, arrival)
        seen = [F.count_if(F.size(VIOLATIONS) > 0).alias("bad"), *_in_buckets(target.key, options.buckets_of(target.table))]
        marked = spec.mark_column and not target.child_of
        if marked:
            rows = since(rows, spec.mark_column, mark)
            seen.append(F.max(F.unix_micros(spec.mark_column)).alias("high"))
        observed = Observation()
        rows = stage(rows.observe(observed, *seen), target.table)
        if observed.get["bad"]:
            checks.assert_rows(rows, F.col(VIOLATIONS), what=target.table)
        upserted += upsert_target(change, target, rows, options, observed.get)
        if marked:
            new_mark = later_mark(observed.get["high"], mark if floor is None else max(floor, mark or floor))
            change.set_mark(spec.name, {
                "value": new_mark and mark_text(new_mark), "status": SUCCESS, "last_run_at": mark_text(options.time()),
            })
    return upserted


def replay(store: VersionedStore, spec: EntitySpec, pulled_since: dt.datetime | None = None, options: LoadOptions = LoadOptions(),
           into: VersionedStore | None = None) -> int:
    """Map again what was pulled at or after a time, for a mapping that has changed since, and upsert it ``into`` this or another
    store. Of an item pulled several times the last one counts. Returns rows upserted."""
    with (into or store).commit() as change:
        return load_items(change, spec, staged_since(store, spec, pulled_since), None, replace(options, on_duplicate="last"))


def ingest_entity(store: VersionedStore, spec: EntitySpec, pages: DataFrame, *, endpoint: str | None = None,
                  options: LoadOptions = LoadOptions()) -> EntityResult:
    """One run for one entity. Never raises for bad data; the result says what happened."""
    pulled = rejected = 0
    try:
        mark = read_mark(store, spec.name) if spec.mark_column else None
        with store.commit() as landing:
            pulled, rejected = land(landing, spec, pages, endpoint or spec.name, options)
        staged = landing.written(staging_table(spec.name))
        with store.commit() as change:
            upserted = load_items(change, spec, staged, mark, options)
    except Exception as error:
        log.exception("load of %s failed", spec.name)
        return EntityResult(spec.name, FAILED, pulled, 0, str(error), rejected)
    return EntityResult(spec.name, SUCCESS, pulled, upserted, responses_rejected=rejected)


Run = tuple[EntityResult, dt.datetime, dt.datetime]


def write_run_log(store: VersionedStore, *runs: Run) -> None:
    """Append the runs, given with their start and end, in one commit."""
    rows = [(result.name, started, ended, result.rows_pulled, result.rows_upserted, result.status, result.error)
            for result, started, ended in runs]
    with store.commit() as change:
        change.append(RUN_LOG, store.spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1))


def select_entities(selection: str | Iterable[str] = "all") -> Sequence[EntitySpec]:
    """A group name (all, fast, slow) or entity names. An unknown name is an error."""
    if isinstance(selection, str):
        if selection in GROUPS:
            return GROUPS[selection]
        selection = [name.strip() for name in selection.split(",")]
    wanted = set(selection)
    unknown = wanted - {spec.name for spec in GROUPS["all"]}
    if unknown:
        raise ValueError(f"unknown entities: {', '.join(sorted(unknown))}")
    return [spec for spec in GROUPS["all"] if spec.name in wanted]


@dataclass(frozen=True)
class RunSummary:
    results: tuple[EntityResult, ...]

    @property
    def ok(self) -> bool:
        return all(result.status == SUCCESS for result in self.results)


def run_entities(store: VersionedStore, pages: Mapping[str, DataFrame], selection: str | Iterable[str] = "all",
                 options: LoadOptions = LoadOptions(), side_by_side: int = 1) -> RunSummary:
    """Ingest the selected entities, so many ``side_by_side``. A failing entity does not stop the others, and a log that cannot be
    written does not undo what was loaded.

    Entities change different tables, so each commits for itself and is carried over to what the others have committed
    meanwhile. Each runs in a pool of its own name, which shares the cluster evenly where ``spark.scheduler.mode`` is FAIR. Results and log
    are in the order of the entities, whichever ends first.
    """
    def run(spec: EntitySpec) -> Run:
        started = dt.datetime.now(dt.timezone.utc)
        store.spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name if side_by_side > 1 else None)
        if spec.name in pages:
            result = ingest_entity(store, spec, pages[spec.name], options=options)
        else:
            result = EntityResult(spec.name, FAILED, 0, 0, "nothing was landed for this entity")
        return result, started, dt.datetime.now(dt.timezone.utc)

    specs = select_entities(selection)
    if side_by_side > 1:
        with ThreadPoolExecutor(side_by_side) as threads:  # a thread takes over the caller's job group and properties
            runs = [future.result() for future in [threads.submit(inheritable_thread_target(store.spark)(run), spec) for spec in specs]]
    else:
        runs = [run(spec) for spec in specs]
    try:
        if runs:
            write_run_log(store, *runs)
    except Exception:
        log.exception("the run log could not be written; what was loaded stays")
    return RunSummary(tuple(result for result, _, _ in runs))


def order_pull_list(store: VersionedStore, discovered: DataFrame | None = None) -> DataFrame:
    """Sorted (site_code, order_number) pairs to pull: orders landed before and orders discovered now.

    ``discovered`` has site_code, order_number and raw_json; its rows are staged for audit only,
    and a failure to stage them does not stop the run. Without any site, or any order, there is
    nothing to work from, which is an error.
    """
    sites = site_directory(store.read("work_centers")) if store.has("work_centers") else None
    if sites is None or sites.isEmpty():
        raise ValueError("no sites known - ingest work_centers first")
    if discovered is not None:
        try:
            with store.commit() as change:
                change.append(staging_table("discovered_orders"), discovered)
        except Exception:
            log.exception("discovered orders could not be staged; continuing")
    known = (
        store.read("purchase_orders") if store.has("purchase_orders")
        else store.spark.createDataFrame([], StructType.fromDDL("site_code string, order_number string"))
    )
    pairs = require_rows(order_worklist(known, discovered, sites), "no purchase orders known and none discovered")
    return pairs.orderBy("site_code", "order_number")


