"""Jobs C and D: snapshot copy and API ingestion."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from driver import item_fixtures
from driver.views import BASE_TABLES, base_table, load, reads, with_views
from tallyweave.functions import variants
from tallyweave.functions.times import instant_literal, safe_date
from tallyweave.operators import checks, envelope, mapping, purchase_orders, upsert as upsert_ops
from tallyweave.operators.mapping import AMOUNT, AUDIT_TIME, INT, Field, first, nested, plain, text
from tallyweave.plans.entities import GROUPS, EntitySpec, target
from tallyweave.plans.ingest import (
    RUN_LOG, EntityResult, LoadOptions, ingest_entity, land, marks_table, order_pull_list, replay, run_entities, since, upsert_target, write_run_log,
)
from tallyweave.sources.snapshot import probe, snapshot_copy
from tallyweave.sources.staging import new_path
from tallyweave.sources.versioned import VersionedStore
from tallyweave.streaming.ingest import ingest_stream

NOW = dt.datetime(1998, 6, 1, tzinfo=dt.timezone.utc)
OPTIONS = LoadOptions(buckets=8, now=NOW)
MARK = dt.datetime(2024, 1, 15)

EVENTS = EntitySpec("events", (
    target(
        "events",
        first("event_id", text(50), "id", "eventId"),
        nested("status", id=INT, description=text(100)),
        plain("updated_on", AUDIT_TIME),
    ),
    target(
        "event_records",
        plain("record_id", text(50), "id"),
        Field("event_id", text(50), of_parent="event_id", required=True),
        plain("quantity", AMOUNT),
        plain("unit_cost", AMOUNT),
        child_of=("records",),
    ),
), mark_column="updated_on")


def _plain_times(df: DataFrame) -> DataFrame:
    """Times as microseconds, which mean the same in every session zone."""
    times = [field.name for field in df.schema.fields if isinstance(field.dataType, TimestampType)]
    return df.withColumns({name: F.unix_micros(name) for name in times}) if times else df


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    (pages,) = load(spark, sf_dir, "f_pages")
    return envelope.unnest(pages.select("event_id", "body").withColumnRenamed("event_id", "page_id"))


def q_json_entity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(EVENTS.map(_events(spark, sf_dir), EVENTS.targets[0]).drop(mapping.VIOLATIONS))


def q_json_child_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EVENTS.map(_events(spark, sf_dir), EVENTS.targets[1]).drop(mapping.VIOLATIONS)


def q_envelope_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per order response when the responses come in all shapes."""
    base_table(spark, sf_dir, "events").createOrReplaceTempView("events")
    pages = spark.sql(f"select event_id, {_SHAPES} as body from events")
    items = envelope.unnest(pages, single_orders=True)
    bad = envelope.malformed_pages(pages).select("event_id", F.lit(-1).cast("long").alias("items"))
    return items.groupBy("event_id").agg(F.count("*").alias("items")).unionByName(bad)


def q_incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = EVENTS.map(_events(spark, sf_dir), EVENTS.targets[0]).drop(mapping.VIOLATIONS)
    return _plain_times(since(rows, "updated_on", MARK))


def q_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark after loading the rows since the old one, and how many rows those are."""
    rows = since(EVENTS.map(_events(spark, sf_dir), EVENTS.targets[0]), "updated_on", MARK)
    return rows.agg(
        F.count("*").alias("rows"),
        F.greatest(F.max(F.unix_micros("updated_on")), F.unix_micros(instant_literal(MARK))).alias("mark"),
    )


def q_order_line_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lines,) = load(spark, sf_dir, "f_order_lines")
    return purchase_orders.with_line_amount(lines).select("line_id", "line_amount")


def q_po_totals_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, lines = load(spark, sf_dir, "f_order_headers", "f_order_lines")
    amounts = purchase_orders.with_line_amount(lines).withColumnRenamed("l_orderkey", "purchase_order_id")
    return purchase_orders.totals_by_currency(headers, amounts)


def q_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchase_orders.order_worklist(*load(spark, sf_dir, "f_known_orders", "f_found_orders"))


def q_site_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    (centers,) = load(spark, sf_dir, "f_work_centers")
    return purchase_orders.site_directory(centers)


def q_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = load(spark, sf_dir, "f_upsert_target", "f_upsert_source")
    return upsert_ops.upsert(old, new, "o_orderkey")


def q_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert into a stored table, bucket by bucket."""
    store = VersionedStore(spark, new_path(spark, "upsert"))
    orders = target("orders", plain("o_orderkey", INT), plain("o_orderstatus", text()), plain("price", AMOUNT))
    for rows in load(spark, sf_dir, "f_upsert_target", "f_upsert_source"):
        with store.commit() as change:
            upsert_target(change, orders, rows, OPTIONS)
    return store.read("orders").drop("synced_at")


def _ingested(spark: SparkSession, sf_dir: str) -> VersionedStore:
    store = VersionedStore(spark, new_path(spark, "ingest"))
    (pages,) = load(spark, sf_dir, "f_pages")
    _require(ingest_entity(store, EVENTS, pages.select("body"), options=OPTIONS))
    return store


def _require(result: EntityResult) -> EntityResult:
    if result.error:
        raise RuntimeError(result.error)
    return result


def q_ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(_ingested(spark, sf_dir).read("events").drop("synced_at"))


def q_ingest_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir).read("event_records").drop("synced_at")


def q_ingest_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw items that were staged, per status of the item."""
    staged = _ingested(spark, sf_dir).read("staging/events")
    return staged.groupBy(
        F.get_json_object("raw_json", "$.status.description").alias("event_type"), "source_endpoint",
    ).agg(F.count("*").alias("items"))


def q_ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events first; then the odd ones, of which only those since the mark are taken."""
    store = VersionedStore(spark, new_path(spark, "incremental"))
    (pages,) = load(spark, sf_dir, "f_pages")
    for half in (0, 1):
        _require(ingest_entity(store, EVENTS, pages.filter(F.col("event_id") % 2 == half).select("body"), options=OPTIONS))
    return _plain_times(store.read("events").drop("synced_at"))


def q_staging_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged text of items whose numbers, order of keys and repeated keys must stay as they came, and what they load as."""
    store = VersionedStore(spark, new_path(spark, "texts"))
    base_table(spark, sf_dir, "events").createOrReplaceTempView("events")
    pages = spark.sql(f"select concat('{{\"items\" : [ ', {_SPELLED}, ' , {{}}], \"hasNext\":false}}') as body from events")
    with store.commit() as change:
        land(change, EVENTS, pages, "events", OPTIONS)
    staged = store.read("staging/events").filter("position = 0").select("raw_json")
    return EVENTS.map(variants.with_parsed(staged, "raw_json", "item"), EVENTS.targets[0], ["raw_json"]).select("event_id", "status_id", "raw_json")


def q_ingest_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items pulled on three days; those of the last two are mapped again into an empty store."""
    store, other = VersionedStore(spark, new_path(spark, "days")), VersionedStore(spark, new_path(spark, "replayed"))
    (pages,) = load(spark, sf_dir, "f_pages")
    for day in range(3):
        with store.commit() as change:
            land(change, EVENTS, pages.filter(F.col("event_id") % 3 == day).select("body"), "events", replace(OPTIONS, now=NOW + dt.timedelta(days=day)))
    replay(store, EVENTS, NOW + dt.timedelta(days=1), OPTIONS, other)
    return _plain_times(other.read("events").drop("synced_at"))


def q_upsert_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with repeated keys upserted into a stored table: the last copy of each key stays, new keys are added."""
    store = VersionedStore(spark, new_path(spark, "once"))
    orders = target("orders", plain("o_orderkey", INT), plain("o_orderstatus", text()), plain("price", AMOUNT))
    old, new = load(spark, sf_dir, "f_upsert_target", "f_upsert_source")
    twice = new.withColumn("page", F.lit(1)).unionByName(new.withColumns({"o_orderstatus": F.lit("second"), "page": F.lit(2)}).filter("o_orderkey % 4 = 0"))
    for rows in (old, twice):
        with store.commit() as change:
            upsert_target(change, orders, rows, replace(OPTIONS, on_duplicate="last", task_rows=2000))
    return store.read("orders").drop("synced_at")


def q_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run log says about a good run and about one that fails on a missing key, next to the mark."""
    store = VersionedStore(spark, new_path(spark, "runs"))
    (pages,) = load(spark, sf_dir, "f_pages")
    good = pages.select("body")
    bad = good.select(F.regexp_replace("body", '"(id|eventId)":"e', '"other":"e').alias("body"))
    for given in (good, bad):
        write_run_log(store, (ingest_entity(store, EVENTS, given, options=OPTIONS), NOW, NOW))
    runs = store.read(RUN_LOG).select("endpoint_name", "rows_pulled", "rows_upserted", "status")
    marks = marks_table(store).select("endpoint_name", F.unix_micros("last_watermark").alias("mark"))
    return runs.join(F.broadcast(marks), "endpoint_name", "left")


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response files processed as a stream, in two rounds; the second round finds only the new files."""
    (pages,) = load(spark, sf_dir, "f_pages")
    folder = new_path(spark, "landed")
    store = VersionedStore(spark, new_path(spark, "stream"))
    checkpoint = new_path(spark, "stream-checkpoint")
    for half in (0, 1):
        pages.filter(F.col("event_id") % 2 == half).select("body").write.mode("append").text(folder)
        query = ingest_stream(store, EVENTS, folder, checkpoint, options=LoadOptions(buckets=8, now=NOW, on_duplicate="last"))
        query.awaitTermination()
    return _plain_times(store.read("events").drop("synced_at"))


def q_snapshot_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two relations copied twice, the first one read back."""
    return _copied(spark, sf_dir).read("events")


def _copied(spark: SparkSession, sf_dir: str) -> VersionedStore:
    store = VersionedStore(spark, new_path(spark, "snapshot"))
    first_copy, second = load(spark, sf_dir, "f_snapshot", "f_order_headers")
    for _ in range(2):
        snapshot_copy(store, {"events": first_copy, "orders": second}, {"events": ["seen_at"]})
    return store


def q_snapshot_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other relation of the same copy."""
    return _copied(spark, sf_dir).read("orders")


def q_snapshot_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times late in the day with an offset, landed as text: their day is the local one."""
    store = VersionedStore(spark, new_path(spark, "snapshot"))
    base_table(spark, sf_dir, "events").createOrReplaceTempView("events")
    snapshot_copy(store, {"events": spark.sql(f"select event_id, {_LATE} as due_text from events")}, {"events": ["due_text"]})
    landed = store.read("events")
    return landed.select("event_id", "due_text", safe_date(F.col("due_text")).alias("due_on"))


def q_stream_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of a batch run after a stream has brought older items, and then none."""
    store = _ingested(spark, sf_dir)
    (pages,) = load(spark, sf_dir, "f_pages")
    folder, checkpoint = new_path(spark, "landed"), new_path(spark, "stream-checkpoint")
    older = pages.select(F.regexp_replace("body", r'"(\d{4})-(\d\d-\d\dT)', '"1990-$2').alias("body"))
    for bodies in (older, older.limit(0).union(spark.createDataFrame([("[]",)], "body string"))):
        bodies.write.mode("append").text(folder)
        ingest_stream(store, EVENTS, folder, checkpoint, options=LoadOptions(buckets=8, now=NOW, on_duplicate="last")).awaitTermination()
    return marks_table(store).select("endpoint_name", F.unix_micros("last_watermark").alias("mark"))


def q_upsert_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item is in its page twice and comes again on a later page; the last copy stays."""
    store = VersionedStore(spark, new_path(spark, "last"))
    base_table(spark, sf_dir, "events").createOrReplaceTempView("events")
    pages = spark.sql(f"select {_TWICE} as body, '1' as landed from events union all select {_AGAIN}, '2' from events where event_id % 3 = 0")
    _require(ingest_entity(store, EVENTS, pages, options=LoadOptions(buckets=8, now=NOW, on_duplicate="last")))
    return store.read("events").select("event_id", "status_id", "status_description")


def q_stream_bad_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run log says about a batch without keys and about the next one, next to the raw items kept."""
    (pages,) = load(spark, sf_dir, "f_pages")
    folder, checkpoint = new_path(spark, "landed"), new_path(spark, "stream-checkpoint")
    store = VersionedStore(spark, new_path(spark, "stream"))
    bad = pages.filter("event_id % 2 = 0").select(F.regexp_replace("body", '"(id|eventId)":"e', '"other":"e').alias("body"))
    for bodies in (bad, pages.filter("event_id % 2 = 1").select("body")):
        bodies.write.mode("append").text(folder)
        ingest_stream(store, EVENTS, folder, checkpoint, options=LoadOptions(buckets=8, now=NOW, on_duplicate="last")).awaitTermination()
    kept = store.read("staging/events").agg(F.count("*").alias("items"))
    return store.read(RUN_LOG).select("status", "rows_pulled", "rows_upserted").join(F.broadcast(kept))


def q_pull_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sorted list of orders to pull, from stored tables and discovered orders."""
    store = VersionedStore(spark, new_path(spark, "pull"))
    known, found, centers = load(spark, sf_dir, "f_known_orders", "f_found_orders", "f_work_centers")
    with store.commit() as change:
        change.replace("work_centers", centers)
        change.replace("purchase_orders", known)
    return order_pull_list(store, found.withColumn("raw_json", F.lit("{}")))


def q_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    (lines,) = load(spark, sf_dir, "f_planning")
    return checks.key_violations(lines, "product_id", "due_at")


def q_row_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    (products,) = load(spark, sf_dir, "f_products")
    given = products.select(F.expr(_ODD_CODE).alias("code"), "is_buy")
    rules = checks.row_violations(["code", "is_buy"], {"code": 40})
    return given.select(F.explode(rules).alias("rule")).groupBy("rule").agg(F.count("*").alias("rows"))


def q_mapping_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose numbers do not fit, whose texts are too long, and whose keys are missing."""
    base_table(spark, sf_dir, "events").createOrReplaceTempView("events")
    items = envelope.unnest(spark.sql(f"select {_UNFIT} as body from events"))
    rules = EVENTS.map(items, EVENTS.targets[0]).select(F.explode(mapping.VIOLATIONS).alias("rule"))
    return rules.groupBy("rule").agg(F.count("*").alias("rows"))


def q_probe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that a snapshot copy would land of three relations, and how many rows they have."""
    found = None
    for name in ("orders", "events", "documents"):
        relation = base_table(spark, sf_dir, name)
        listed = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c.name).alias("name"), F.lit(c.type).alias("type"))
                           for i, c in enumerate(probe(relation, name, ["ts"] if name == "events" else []), 1)])
        own = relation.agg(F.count("*").alias("rows")).select(F.lit(name).alias("relation"), "rows", F.explode(listed).alias("c"))
        found = own if found is None else found.unionByName(own)
    return found.select("relation", "rows", "c.*")


def q_run_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three entities ingested side by side, one of which fails: what the log says of each, and what its table holds."""
    store = VersionedStore(spark, new_path(spark, "entities"))
    given = {}
    for name in ("skills", "users", "work_centers"):
        spec = next(spec for spec in GROUPS["all"] if spec.name == name)
        sql = item_fixtures.items_sql(spec)
        for read in set(reads(sql)) & set(BASE_TABLES):
            base_table(spark, sf_dir, read).createOrReplaceTempView(read)
        given[name] = spark.sql(sql).select("body")
    given["users"] = given["users"].union(given["users"])  # every key twice
    run_entities(store, given, list(given), OPTIONS, side_by_side=3)
    held = spark.createDataFrame([(name, store.read(name).count() if store.has(name) else 0) for name in given], "endpoint_name string, held long")
    return store.read(RUN_LOG).select("endpoint_name", "rows_pulled", "rows_upserted", "status").join(F.broadcast(held), "endpoint_name")


def _map_query(table: str):
    spec, declared = item_fixtures.TARGETS[table]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql = item_fixtures.items_sql(spec)
        for name in set(reads(sql)) & set(BASE_TABLES):
            base_table(spark, sf_dir, name).createOrReplaceTempView(name)
        items = envelope.unnest(spark.sql(sql), items_key=spec.items_key, single_orders=spec.single_orders)
        return _plain_times(spec.map(items, declared).drop(mapping.VIOLATIONS))

    return query


QUERIES = {
    name.removeprefix("q_"): function for name, function in list(globals().items()) if name.startswith("q_")
} | {f"map_{table}": _map_query(table) for table in item_fixtures.TARGETS}


_SHAPES = """case event_id % 8
    when 0 then '{"guid":null,"items":[1,2]}' when 1 then '[{"guid":"a"},{"guid":"b"},{"guid":"c"}]'
    when 2 then concat('{"items":[{"n":', cast(event_id as string), '},{}],"hasNext":true}') when 3 then '{"items":null}'
    when 4 then '{"other":1}' when 5 then '17' when 6 then '[]' else '{broken' end"""

_EVENTS = """
    select 'e' || event_id as event_id, case when event_id % 5 = 0 then null else cast(user_id as integer) end as status_id,
           case when event_id % 5 = 0 then null else event_type end as status_description,
           epoch_us(case event_id % 3 when 0 then cast(cast(ts as date) as timestamp)
                    when 1 then cast(cast(ts as date) as timestamp) + interval '10 hours 30 minutes' end) as updated_on
    from events
"""
_RECORDS = """
    select 'e' || event_id || '-' || c as record_id, 'e' || event_id as event_id,
           cast(case when c = 1 then cast(user_id as integer) end as decimal(18,4)) as quantity,
           cast(case when c = 1 then 2.5 else 1 end as decimal(18,4)) as unit_cost
    from events cross join (values (1), (2)) v(c) where event_id % 6 <> 0
"""
_MARK = "epoch_us(timestamp '2024-01-15 00:00:00')"
_AMOUNTS = "select l_orderkey, line_id, currency_code, cast(quantity_ordered * unit_cost as decimal(18,4)) as line_amount from f_order_lines"
_MERGED = """
    select * from f_upsert_target t where not exists (select 1 from f_upsert_source s where s.o_orderkey = t.o_orderkey)
    union all select * from f_upsert_source
"""

_SPELLED = """concat('{"z":1.50,"eventId":"wrong","n":{"k":1e3,"k":-0.0},"a":12345678901234567890.10,"eventId":"e', cast(event_id as string),
    '","status":{"id":', cast(cast(user_id as int) as string), '},"note":"x 1.0: [2.50,"}')"""
_ODD_CODE = "case when product_id % 7 = 0 then null when product_id % 5 = 0 then concat(code, repeat('x', 40)) else code end"
_UNFIT = """concat('[{"id":', case when event_id % 4 = 0 then 'null' else concat('"', case when event_id % 4 = 2 then repeat('k', 51) else 'k' end, '"') end,
    ',"status":{"id":', case when event_id % 4 = 1 then '3000000000' else '7' end, ',"description":"', case when event_id % 4 = 2 then repeat('d', 101) else 'd' end, '"}}]')"""
_LATE = "concat(cast(cast(ts as date) as string), ' 23:30:00.0000000 -05:00')"
_ITEM = """concat('{{"id":"e', cast(event_id as string), '","status":{{"id":{0},"description":"{1}"}}}}')"""
_TWICE = f"concat('[', {_ITEM.format(1, 'first')}, ',', {_ITEM.format(2, 'second')}, ']')"
_AGAIN = f"concat('[', {_ITEM.format(3, 'third')}, ']')"

ORACLES = {
    "snapshot_second": with_views("select * from f_order_headers"),
    "snapshot_offsets": f"select event_id, {_LATE} as due_text, cast(ts as date) as due_on from events",
    "stream_mark": f"select 'events' as endpoint_name, max(updated_on) as mark from ({_EVENTS})",
    "upsert_last": """
        select 'e' || event_id as event_id, cast(case when event_id % 3 = 0 then 3 else 2 end as integer) as status_id,
               case when event_id % 3 = 0 then 'third' else 'second' end as status_description from events
    """,
    "stream_bad_row": """
        with given as (select count(*) filter (event_id % 2 = 0) as bad, count(*) filter (event_id % 2 = 1) as good from events)
        select 'failed' as status, bad as rows_pulled, 0 as rows_upserted, bad + good as items from given
        union all select 'success', good, 3 * good, bad + good from given
    """,
    "pull_list": with_views("""
        select site_code, order_number from f_known_orders where site_code is not null and order_number is not null
        union select site_code, order_number from f_found_orders where order_number <> ''
              and site_code in (select site_code from f_work_centers where site_code is not null and site_id is not null)
    """),
    "key_violations": with_views("""
        select product_id, due_at, count(*) as rows from f_planning group by all having count(*) > 1 or product_id is null or due_at is null
    """),
    "row_violations": with_views(f"""
        with given as (select {_ODD_CODE} as code, is_buy from f_products)
        select rule, count(*) as rows from (
          select 'code is null' as rule from given where code is null union all
          select 'is_buy is null' from given where is_buy is null union all
          select 'code is longer than 40' from given where length(code) > 40) group by rule
    """),
    "mapping_violations": """
        select unnest(rules) as rule, count(*) as rows from (
          select case event_id % 4 when 0 then ['event_id is null'] when 1 then ['status_id is not a int']
                      when 2 then ['event_id is longer than 50', 'status_description is longer than 100'] else [] end as rules from events)
        group by rule
    """,
    "probe_columns": """
        with sizes as (select 'orders' as relation, count(*) as rows from orders union all select 'events', count(*) from events
                       union all select 'documents', count(*) from documents)
        select relation, rows, cast(column_index as integer) as position, column_name as name,
               case when column_name = 'ts' then 'varchar(50)' when data_type = 'VARCHAR' then 'string' when data_type = 'INTEGER' then 'int'
                    when data_type = 'TIMESTAMP' then 'timestamp_ntz' else lower(data_type) end as type
        from duckdb_columns() join sizes on relation = table_name
    """,
    "run_entities": """
        select name as endpoint_name, n * copies as rows_pulled, case when copies = 1 then n else 0 end as rows_upserted,
               case when copies = 1 then 'success' else 'failed' end as status, case when copies = 1 then n else 0 end as held
        from (select count(*) as n from orders) cross join (values ('skills', 1), ('users', 2), ('work_centers', 1)) v(name, copies)
    """,
    "json_entity_map": _EVENTS,
    "json_child_explode": _RECORDS,
    "envelope_shapes": """
        select event_id, case event_id % 8 when 0 then 1 when 1 then 3 when 2 then 2 when 7 then -1 end as items
        from events where event_id % 8 in (0, 1, 2, 7)
    """,
    "incremental_filter": f"select * from ({_EVENTS}) where updated_on >= {_MARK}",
    "high_water_mark": f"""
        select count(*) as rows, greatest(coalesce(max(updated_on), {_MARK}), {_MARK}) as mark
        from ({_EVENTS}) where updated_on >= {_MARK}
    """,
    "order_line_amounts": with_views(f"with amounts as ({_AMOUNTS}) select line_id, line_amount from amounts"),
    "po_totals_by_currency": with_views(f"""
        with amounts as ({_AMOUNTS})
        select h.purchase_order_id, h.order_number, h.site_code, h.partner_code, h.partner_name, a.currency_code,
               cast(sum(a.line_amount) as decimal(28,4)) as total_amount, count(*) as line_count
        from f_order_headers h join amounts a on a.l_orderkey = h.purchase_order_id group by all
    """),
    "worklist": with_views("""
        select site_code, order_number from f_known_orders where site_code is not null and order_number is not null
        union select site_code, order_number from f_found_orders where order_number <> ''
    """),
    "site_directory": with_views("""
        select distinct site_code, site_id from f_work_centers where site_code is not null and site_id is not null
    """),
    "upsert_merge": with_views(_MERGED),
    "upsert_buckets": with_views(_MERGED),
    "ingest_batch": _EVENTS,
    "ingest_children": _RECORDS,
    "ingest_staging": f"""
        select status_description as event_type, 'events' as source_endpoint, count(*) as items from ({_EVENTS}) group by all
    """,
    "ingest_incremental": f"""
        with rows_in as ({_EVENTS}), numbered as (select *, cast(substr(event_id, 2) as bigint) % 2 as half from rows_in)
        select * exclude (half) from numbered
        where half = 0 or updated_on >= (select max(updated_on) from numbered where half = 0)
    """,
    "staging_text": f"select 'e' || event_id as event_id, cast(user_id as integer) as status_id, {_SPELLED} as raw_json from events",
    "ingest_pruned": f"select * from ({_EVENTS}) where cast(substr(event_id, 2) as bigint) % 3 <> 0",
    "upsert_once": with_views("""
        select o_orderkey, o_orderstatus, price from f_upsert_target t where not exists (select 1 from f_upsert_source s where s.o_orderkey = t.o_orderkey)
        union all select o_orderkey, case when o_orderkey % 4 = 0 then 'second' else o_orderstatus end, price from f_upsert_source
    """),
    "run_log": f"""
        with given as (select count(*) as n, max(updated_on) as mark from ({_EVENTS})),
             children as (select count(*) as c from ({_RECORDS}))
        select 'events' as endpoint_name, n as rows_pulled, n + c as rows_upserted, 'success' as status, mark from given, children
        union all select 'events', n, 0, 'failed', mark from given
    """,
    "stream_upsert": _EVENTS,
    "snapshot_copy": with_views("""
        select event_id, event_type, value, strftime(local_at, '%Y-%m-%d %H:%M:%S.%f') || '0 +00:00' as seen_at, local_at
        from f_snapshot
    """),
} | {f"map_{table}": item_fixtures.expected_sql(spec, declared) for table, (spec, declared) in item_fixtures.TARGETS.items()}
