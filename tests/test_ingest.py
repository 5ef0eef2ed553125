from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import values
from tallyweave.operators import checks, envelope, mapping, upsert as upsert_ops
from tallyweave.operators.mapping import BOOL, INT, Field, first, map_items, plain, text
from tallyweave.operators.purchase_orders import order_worklist, site_directory
from tallyweave.plans import entities, ingest
from tallyweave.plans.ingest import LoadOptions, ingest_entity, marks_table, order_pull_list, read_mark, run_entities, select_entities
from tallyweave.sources.snapshot import EmptyRelation, LandedColumn, jdbc_relation, probe, select_list, snapshot_copy
from tallyweave.sources.versioned import Change, StoreConflict, VersionedStore
from tallyweave.streaming.ingest import apply_batch, ingest_stream

BY_NAME = {spec.name: spec for spec in entities.GROUPS["all"]}
OPTIONS = LoadOptions(buckets=4)


def guid(n):
    return f"00000000-0000-0000-0000-{n:012d}"


def at(text):
    return dt.datetime.fromisoformat(text)


def pages(spark, *bodies):
    return spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "body string")


def nc(n, modified=None, number="N", **more):
    return {"id": guid(n), "number": number, "lastModified": {"date": modified}, **more}


def items(spark, *bodies):
    return envelope.unnest(pages(spark, list(bodies)))


# Envelopes

@pytest.mark.parametrize("body, count", [
    ('[{"a":1},{"a":2}]', 2), ('{"items":[1,2,3],"hasNext":true}', 3), ('{"items":null}', 0), ('{"other":[1]}', 0),
    ("5", 0), ("[]", 0), ('"text"', 0), ("{broken", 0), (None, 0),
])
def test_envelope(spark, body, count):
    df = spark.createDataFrame([(body,)], "body string")
    assert envelope.unnest(df).count() == count
    assert envelope.malformed_pages(df).count() == (body == "{broken")


@pytest.mark.parametrize("body, count", [
    ('{"guid":"x","items":[1,2]}', 1), ('{"guid":null}', 1), ('[1,2]', 2), ('{"items":[1]}', 1), ('{"orders":[1]}', 0), ("7", 0),
])
def test_order_response(spark, body, count):
    assert envelope.unnest(spark.createDataFrame([(body,)], "body string"), single_orders=True).count() == count


def test_other_items_key(spark):
    assert envelope.unnest(pages(spark, {"rows": [1, 2]}), items_key="rows").count() == 2


# Mapping

def test_first_takes_the_first_present_key(spark):
    fields = [first("k", text(), "a", "b")]
    got = map_items(items(spark, {"a": False, "b": "x"}, {"a": 0, "b": "x"}, {"a": "", "b": "x"}, {"a": None, "b": "x"}, {"b": "x"}, {}), fields)
    assert [row["k"] for row in got.collect()] == ["false", "0", "", "x", "x", None]


def test_violations(spark):
    fields = [plain("id", mapping.GUID).needed(), plain("n", INT), plain("flag", BOOL), plain("name", text(3))]
    got = map_items(items(
        spark, {"id": guid(1).upper(), "n": 5, "flag": True, "name": "abc"}, {"id": "x", "n": "many", "flag": "maybe", "name": "abcd"},
        {"n": 3_000_000_000}, {"id": guid(2), "n": "7", "name": {"not": "text"}},
    ), fields)
    rows = got.collect()
    assert [row["violations"] for row in rows] == [
        [], ["id is not a guid", "n is not a int", "flag is not a boolean", "name is longer than 3"],
        ["id is null", "n is not a int"], [],
    ]
    assert rows[0]["id"] == guid(1) and rows[3]["n"] == 7 and rows[3]["name"] is None


def test_plan_product_keys(spark):
    plans = BY_NAME["process_plans"]
    item = {"id": guid(1), "products": [{"guid": "", "id": guid(2)}, {"guid": guid(3), "id": guid(4)}, {}, {"guid": None, "id": None}]}
    rows = plans.map(items(spark, item, {"id": guid(9), "products": None}), plans.targets[1])
    assert values(rows, "process_plan_product_key", "product_guid") == [
        (f"{guid(1)}:{guid(2)}", guid(2)), (f"{guid(1)}:{guid(3)}", guid(3)), (f"{guid(1)}:None", None), (f"{guid(1)}:None", None)]


def test_order_lines(spark):
    orders = BY_NAME["purchase_orders"]
    item = {"guid": guid(1), "orderNumber": "A", "orderLines": [
        {"guid": guid(2), "quantityOrdered": 3, "unitCost": 1.25, "dueDate": "2024-01-05", "status": {"id": 4}, "product": {"uomCode": "EA"}},
        {"guid": guid(3), "quantityOrdered": None, "unitCost": 1}]}
    rows = orders.map(items(spark, item), orders.targets[1])
    assert values(rows, "line_id", "purchase_order_id", "line_amount", "status_id", "product_uom_code") == [
        (guid(2), guid(1), Decimal("3.7500"), 4, "EA"), (guid(3), guid(1), None, None, None)]


def test_every_entity_has_its_columns():
    counts = {t.table: len(t.columns) for spec in entities.GROUPS["all"] for t in spec.targets}
    # Columns per table, without synced_at.
    assert counts == {
        "nonconformances": 12, "nc_conditions": 15, "nc_dispositions": 19, "equipment": 16, "process_plans": 18,
        "process_plan_products": 6, "execution_operations": 21, "execution_components": 10, "execution_component_records": 5,
        "wip_traces": 14, "users": 6, "skills": 6, "work_centers": 10, "products": 11, "product_revisions": 9,
        "inspection_codes": 2, "purchase_orders": 7, "purchase_order_lines": 26,
    }


# Upsert

def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, synced_at string")
    new = spark.createDataFrame([("b", None), ("c", 3)], "k string, v int")
    merged = upsert_ops.upsert(old, upsert_ops.stamped(new, F.lit("new")), "k")
    assert values(merged, "k", "v", "synced_at") == [("a", 1, "old"), ("b", None, "new"), ("c", 3, "new")]


def merge(old, new, **options):
    return upsert_ops.merged(old, new, "k", 4, what="t", **options)


def test_merge_refuses_missing_and_repeated_keys_as_it_runs(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for rows in ([("a", 1), ("a", 2)], [(None, 1)], [("c", 1), ("c", 1)]):
        plan = merge(old, spark.createDataFrame(rows, "k string, v int"))  # no job yet
        with pytest.raises(Exception, match=r"t: key \(k\) is NULL or not unique"):
            plan.collect()
    with pytest.raises(Exception, match="NULL"):
        merge(None, spark.createDataFrame([(None, 1)], "k string, v int"), on_duplicate="last").collect()
    with pytest.raises(ValueError, match="error or last"):
        merge(old, old, on_duplicate="first")


@pytest.mark.parametrize("splits", [1, 3])
def test_merge_keeps_the_last_copy_and_its_buckets(spark, splits):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, synced_at string")
    new = spark.createDataFrame([("b", 5, 1, 9), ("b", 6, 2, 0), ("b", 7, 1, 10), ("c", None, 0, 0)], "k string, v int, page int, position int")
    got = merge(old, upsert_ops.stamped(new, F.lit("new")), splits=splits, arrival=["page", "position"], on_duplicate="last")
    assert values(got, "k", "v", "synced_at", "is_new") == [("a", 1, "old", False), ("b", 6, "new", True), ("c", None, "new", True)]
    assert got.filter(F.col("bucket") != upsert_ops.bucket_of("k", 4)).count() == 0 and set(got.columns) == {"k", "v", "synced_at", "is_new", "bucket"}


def test_merge_is_one_exchange(spark, tmp_path):
    """Also with the write by bucket, which needs no sort of its own."""
    for name, rows in (("old", spark.range(1000)), ("new", spark.range(500, 1500))):
        rows.withColumn("v", F.lit(name)).write.parquet(f"{tmp_path}/{name}")
    old, new = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("old", "new"))
    plan = upsert_ops.merged(old, new, "id", 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_buckets_are_seen_in_a_bitmap(spark):
    numbers = [0, 7, 8, 63, 64, 32767]
    bitmap = spark.createDataFrame([(n,) for n in numbers * 2], "n long").agg(F.bitmap_construct_agg("n")).first()[0]
    assert upsert_ops.buckets_in(bitmap) == numbers


def test_catalogs_with_row_level_operations_merge_by_themselves(spark):
    """A Parquet table has none and says so: the statement reaches the catalog."""
    spark.sql("create table if not exists merge_target (k string, v int) using parquet")
    try:
        with pytest.raises(Exception, match="(?i)merge"):
            upsert_ops.merge_into(spark.createDataFrame([("a", 1)], "k string, v int"), "merge_target", "k")
    finally:
        spark.sql("drop table merge_target")


# Items to the letter

@pytest.mark.parametrize("body, texts", [
    ('[{"b": 1.50, "a": 1e3, "s": "x \\" 3.0: [4.50,", "b": 2.50}]', ['{"b":1.50,"a":1e3,"s":"x \\" 3.0: [4.50,","b":2.50}']),
    ('{"items": [{"n": {"k": 1.0, "k": -0.0}, "big": 12345678901234567890.1230}, 5.0, "t 1.0", "{}", null, true, [1, 2.0]], "hasNext": true}',
     ['{"n":{"k":1.0,"k":-0.0},"big":12345678901234567890.1230}', "5.0", '"t 1.0"', '"{}"', "null", "true", "[1,2.0]"]),
    ('{"items":[1],"items":[2.0,3]}', ["2.0", "3"]), ("[]", []), ('[{"u": "\ue000 7.0", "n": 1.0}]', ['{"u":"\ue000 7.0","n":1.0}']),
    ('{"other": 1.0}', []), ("{broken", []), (' [ { } ]', ["{}"]),
])
def test_items_keep_numbers_and_keys_as_they_came(spark, body, texts):
    items = envelope.unnest(pages(spark, body), text="raw").orderBy("position")
    assert [row["raw"] for row in items.collect()] == texts


def test_a_single_order_keeps_its_text(spark):
    got = envelope.unnest(pages(spark, '{"guid": "x", "z": 1.50, "guid": "y"}', '{"items": [{"a": 2.0}]}'), single_orders=True, text="raw")
    assert values(got, "raw") == [('{"a":2.0}',), ('{"guid":"x","z":1.50,"guid":"y"}',)]


def test_of_a_repeated_key_the_last_value_loads(spark, store):
    body = '{"items":[{"id":"%s","number":"first","number":"last"}],"items":[{"id":"%s","number":"a","number":"b"}]}' % (guid(1), guid(2))
    result = ingest_entity(store, BY_NAME["nonconformances"], pages(spark, body), options=OPTIONS)
    assert (result.status, result.rows_upserted, result.responses_rejected) == ("success", 1, 0)
    assert values(store.read("nonconformances"), "nonconformance_id", "number") == [(guid(2), "b")]


# Raw tables by day, and replay

def test_replay_reads_only_the_days_it_needs(spark, store, tmp_path):
    spec = BY_NAME["nonconformances"]
    for day in (1, 2, 3):
        at_day = LoadOptions(buckets=4, now=dt.datetime(2024, 5, day, 12, tzinfo=dt.timezone.utc))
        assert not ingest_entity(store, spec, pages(spark, [nc(day, number=f"day {day}"), nc(9, number=f"nine {day}")]), options=at_day).error
    since = dt.datetime(2024, 5, 2, tzinfo=dt.timezone.utc)
    rows = ingest.staged_since(store, spec, since)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pulled_on" in plan and "pulled_on#" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert rows.count() == 4
    assert ingest.staged_since(store, spec, dt.datetime(2024, 5, 2, 13, tzinfo=dt.timezone.utc)).count() == 2
    other = VersionedStore(spark, str(tmp_path / "other"))
    assert ingest.replay(store, spec, since, OPTIONS, other) == 3
    assert values(other.read("nonconformances"), "nonconformance_id", "number") == [(guid(2), "day 2"), (guid(3), "day 3"), (guid(9), "nine 3")]


def test_items_of_two_targets_are_parsed_once(spark, store, monkeypatch):
    spec, parsed = BY_NAME["products"], []
    seen = ingest.variants.with_parsed
    monkeypatch.setattr(ingest.variants, "with_parsed", lambda df, text, name: parsed.append(name) or seen(df, text, name))
    mapped, original = [], type(spec).map
    monkeypatch.setattr(type(spec), "map", lambda self, items, *more: mapped.append(items) or original(self, items, *more))
    ingest_entity(store, spec, pages(spark, [{"id": guid(1), "revisions": {"items": [{"id": guid(2), "code": "R"}]}}]), options=OPTIONS)
    assert parsed.count("item") == 1 and len(mapped) == 2
    assert all("parse_json" not in items._jdf.queryExecution().optimizedPlan().toString() for items in mapped)


def test_manifests_stay_small_over_many_appends(spark, store, monkeypatch):
    sizes, rows, write = [], spark.range(1).coalesce(1), Change._write
    for n in range(200):
        monkeypatch.setattr(Change, "_write", write if n % 50 == 0 else lambda *given: 0)  # most of them without rows
        with store.commit() as change:
            change.append("log", rows)
        sizes.append(len(json.dumps(store.manifest().__dict__)))
    assert max(sizes) - min(sizes) <= 2 and store.read("log").count() == 4 and len(store._names("_appends")) == 200


def test_appends_of_failed_commits_are_not_seen(spark, store):
    def append(change, n):
        change.append("log", spark.range(n).withColumn("day", F.lit("d")), ["day"])
        return change

    with store.commit() as change:
        append(change, 2)
    with pytest.raises(RuntimeError):
        with store.commit() as change:
            append(change, 3)
            assert change.read("log").count() == 5 and change.written("log").count() == 3
            raise RuntimeError("stop")
    assert store.read("log").count() == 2
    with store.commit() as change:
        append(change, 4)
    assert store.read("log").count() == 6
    folder = store._path(f"{store.root}/_appends")
    newest = max(store._names("_appends"))
    store._fs.delete(store._path(f"{store.root}/_appends/{newest}"), False)  # as if the writer had died before it wrote it
    assert store.read("log").count() == 6
    with store.commit() as change:
        change.set_batch("x", 1)
    assert store.read("log").count() == 6 and newest in store._names("_appends") and folder


# Runs

def test_run_is_incremental_and_idempotent(spark, store):
    spec = BY_NAME["nonconformances"]
    one = pages(spark, {"items": [nc(1, "2024-01-02T00:00:00Z"), nc(2, None)]}, [nc(3, "2024-01-05T00:00:00+02:00")])
    result = ingest_entity(store, spec, one, options=OPTIONS)
    assert (result.status, result.rows_pulled, result.rows_upserted) == ("success", 3, 3)
    assert read_mark(store, spec.name) == at("2024-01-04T22:00:00+00:00")
    before = values(store.read("nonconformances"), "nonconformance_id", "number")

    two = pages(spark, [nc(1, "2024-01-02T00:00:00Z", "stale"), nc(3, "2024-01-04T22:00:00Z", "same time"), nc(4, "2024-01-03T00:00:00Z")])
    assert ingest_entity(store, spec, two, options=OPTIONS).rows_upserted == 1
    assert read_mark(store, spec.name) == at("2024-01-04T22:00:00+00:00")
    assert values(store.read("nonconformances"), "nonconformance_id", "number") == [*before[:2], (guid(3), "same time")]
    assert store.read("staging/nonconformances").count() == 6

    users = BY_NAME["users"]
    for _ in range(2):
        assert ingest_entity(store, users, pages(spark, [{"personId": guid(1), "active": True}]), options=OPTIONS).rows_upserted == 1
    assert values(store.read("users"), "user_id", "is_active") == [(guid(1), True)]


LATER = "2024-01-02"


@pytest.mark.parametrize("bad, message", [
    ([nc(1, LATER), nc(1, LATER)], "not unique"), ([{"number": "N", "lastModified": {"date": LATER}}], "nonconformance_id is null"),
    ([nc(5, LATER, number=None)], "number is null"), ([nc(5, LATER, number="x" * 51)], "number is longer than 50"),
    ([nc(5, LATER, siteId="bad")], "site_id is not a guid"),
])
def test_a_failed_load_changes_nothing_but_staging(spark, store, bad, message):
    spec = BY_NAME["nonconformances"]
    ingest_entity(store, spec, pages(spark, [nc(9, "2024-01-01")]), options=OPTIONS)
    result = ingest_entity(store, spec, pages(spark, bad), options=OPTIONS)
    assert (result.status, result.rows_pulled, result.rows_upserted) == ("failed", len(bad), 0) and message in result.error
    assert values(store.read("nonconformances"), "nonconformance_id") == [(guid(9),)]
    assert read_mark(store, spec.name) == at("2024-01-01T00:00:00+00:00")
    assert store.read("staging/nonconformances").count() == 1 + len(bad)


def test_parent_and_child_change_together(spark, store):
    spec = BY_NAME["products"]
    good = {"id": guid(1), "details": {"code": "A"}, "revisions": {"items": [{"id": guid(2), "code": "R"}]}}
    assert ingest_entity(store, spec, pages(spark, [good]), options=OPTIONS).rows_upserted == 2
    broken = {"id": guid(1), "details": {"code": "B"}, "revisions": {"items": [{"id": "bad"}]}}
    assert ingest_entity(store, spec, pages(spark, [broken]), options=OPTIONS).status == "failed"
    assert values(store.read("products"), "product_id", "part_number") == [(guid(1), "A")]


def test_unreadable_responses_are_kept_as_rejects(spark, store):
    result = ingest_entity(store, BY_NAME["users"], pages(spark, "{broken", [{"id": guid(1)}]), options=OPTIONS)
    assert (result.status, result.rows_pulled, result.rows_upserted, result.responses_rejected) == ("success", 1, 1, 1)
    assert values(store.read("rejects/users"), "response") == [("{broken",)]


def test_empty_pull(spark, store):
    spec = BY_NAME["process_plans"]
    result = ingest_entity(store, spec, pages(spark, {"items": []}), options=OPTIONS)
    assert (result.status, result.rows_pulled, result.rows_upserted) == ("success", 0, 0)
    assert store.read("process_plans").count() == 0
    conditions = BY_NAME["conditions"]
    ingest_entity(store, conditions, pages(spark, []), options=OPTIONS)
    assert read_mark(store, "conditions") is None
    assert values(marks_table(store), "endpoint_name", "last_run_status") == [("conditions", "success")]


def test_one_failing_entity_does_not_stop_the_others(spark, store):
    given = {"users": pages(spark, [{"id": "bad"}]), "skills": pages(spark, [{"id": guid(1), "siteId": guid(2)}])}
    summary = run_entities(store, given, ["users", "skills", "inspection_codes"], OPTIONS)
    assert not summary.ok and {r.name: r.status for r in summary.results} == {
        "users": "failed", "skills": "success", "inspection_codes": "failed"}
    assert values(store.read(ingest.RUN_LOG), "endpoint_name", "rows_pulled", "rows_upserted", "status") == [
        ("inspection_codes", 0, 0, "failed"), ("skills", 1, 1, "success"), ("users", 1, 0, "failed")]


@pytest.mark.parametrize("order", [["users", "skills", "work_centers"], ["work_centers", "skills", "users"]])
def test_entities_side_by_side_give_what_they_give_in_turn(spark, store, tmp_path, order):
    given = {"users": pages(spark, [{"id": "bad"}]), "skills": pages(spark, [{"id": guid(1), "siteId": guid(2)}]),
             "work_centers": pages(spark, [{"id": guid(n), "site": {"id": guid(9), "code": "S"}} for n in (1, 2)])}
    in_turn = VersionedStore(spark, str(tmp_path / "turn"))
    assert [r.name for r in run_entities(in_turn, given, order, OPTIONS).results] == [s.name for s in select_entities(order)]
    summary = run_entities(store, {name: given[name] for name in order}, order, OPTIONS, side_by_side=3)
    assert [(r.name, r.status) for r in summary.results] == [(r.name, r.status) for r in run_entities(in_turn, given, order, OPTIONS).results]
    for name in ("skills", "work_centers", "staging/users"):
        columns = [c for c in store.read(name).columns if c not in ("synced_at", "pulled_at", "pulled_on")]
        assert values(store.read(name).select(*columns).distinct(), *columns) == values(in_turn.read(name).select(*columns).distinct(), *columns)
    assert not store.has("users") and store.read(ingest.RUN_LOG).count() == 3


def test_selection():
    assert [s.name for s in select_entities("fast")] == ["nonconformances", "conditions"]
    assert len(select_entities("slow")) == 12 and len(select_entities()) == 14
    assert [s.name for s in select_entities("users, equipment")] == ["equipment", "users"]
    with pytest.raises(ValueError, match="nothing"):
        select_entities(["users", "nothing"])


def test_marks_start_empty(spark, store):
    assert read_mark(store, "conditions") is None
    assert values(marks_table(store), "endpoint_name", "last_watermark", "last_run_status") == [("conditions", None, "never_run")]


def test_worklist(spark, store):
    known = spark.createDataFrame([("S", "1"), ("S", None), (None, "2"), ("S", "3")], "site_code string, order_number string")
    found = spark.createDataFrame([("S", "1", "{}"), ("T", ""), ("T", None), ("T", "4", "{}")][0:1] + [("T", "", "{}"), ("T", None, "{}"), ("T", "4", "{}")],
                                  "site_code string, order_number string, raw_json string")
    assert values(order_worklist(known, found), "site_code", "order_number") == [("S", "1"), ("S", "3"), ("T", "4")]
    with pytest.raises(ValueError, match="no sites known"):
        order_pull_list(store)
    ingest_entity(store, BY_NAME["work_centers"], pages(spark, [
        {"id": guid(1), "site": {"id": guid(2), "code": "S"}}, {"id": guid(3), "site": {"id": guid(2), "code": "S"}}, {"id": guid(4)}]), options=OPTIONS)
    assert values(site_directory(store.read("work_centers")), "site_code", "site_id") == [("S", guid(2))]
    with pytest.raises(ValueError, match="no purchase orders"):
        order_pull_list(store)
    assert [tuple(r) for r in order_pull_list(store, found).collect()] == [("S", "1")]
    assert store.read("staging/discovered_orders").count() == 4


# Streams

def test_stream_takes_new_files_and_each_batch_once(spark, store, tmp_path):
    spec = BY_NAME["nonconformances"]
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    options = LoadOptions(buckets=4, on_duplicate="last")

    def arrive(*bodies):
        pages(spark, *bodies).coalesce(1).write.mode("append").text(landing)
        ingest_stream(store, spec, landing, checkpoint, options=options).awaitTermination()

    arrive([nc(1, "2024-01-01")], [nc(2, "2024-01-01")])
    arrive([nc(1, "2023-01-01", "again"), nc(3, "2024-01-01")])
    assert values(store.read("nonconformances"), "nonconformance_id", "number") == [(guid(1), "again"), (guid(2), "N"), (guid(3), "N")]
    assert store.read("staging/nonconformances").count() == 4
    version = store.manifest().version
    last = store.manifest().batches["nonconformances"]
    assert not apply_batch(store, spec, pages(spark, [nc(7)]), last, options)
    assert store.manifest().version == version


# Store and snapshot

def test_commit_is_all_or_nothing(spark, store):
    df = spark.range(3)
    with store.commit() as change:
        change.replace("a", df)
        assert change.read("a").count() == 3 and not store.has("a")
    with pytest.raises(RuntimeError):
        with store.commit() as change:
            change.replace("a", spark.range(9))
            change.replace("b", df)
            raise RuntimeError("stop")
    assert store.read("a").count() == 3 and not store.has("b")
    with pytest.raises(KeyError):
        store.read("b")


def test_two_writers_conflict(spark, store):
    with pytest.raises(StoreConflict):
        with store.commit() as mine:
            with store.commit() as theirs:
                theirs.set_batch("x", 1)
            mine.set_batch("x", 2)
    assert store.manifest().batches == {"x": 1}


def test_bucket_count_is_fixed(spark, store):
    spec = BY_NAME["users"]
    ingest_entity(store, spec, pages(spark, [{"id": guid(1)}]), options=LoadOptions(buckets=4))
    result = ingest_entity(store, spec, pages(spark, [{"id": guid(2)}]), options=LoadOptions(buckets=8))
    assert result.status == "failed" and "4 buckets" in result.error


def test_snapshot(spark, store):
    source = spark.sql("select cast('ab' as string) as s, cast(1 as decimal(9,2)) as d, timestamp '2024-01-05 10:00:00' as t, timestamp_ntz '2024-01-05 10:00:00' as n")
    assert probe(source, "x") == [LandedColumn("s", "string"), LandedColumn("d", "decimal(9,2)"), LandedColumn("t", "timestamp"), LandedColumn("n", "timestamp_ntz")]
    assert probe(source, "x", ["t"])[2] == LandedColumn("t", "varchar(50)")
    assert snapshot_copy(store, {"one": source, "two": spark.range(4)}, {"one": ["t"]}) == {"one": 1, "two": 4}
    assert store.read("one").select("t", "n").first() == ("2024-01-05 10:00:00.0000000 +00:00", dt.datetime(2024, 1, 5, 10))
    assert select_list("a.b", ["id", "t"], ["t"]) == "(SELECT id, CAST(t AS varchar(50)) AS t FROM a.b) landed"
    with pytest.raises(EmptyRelation, match="three"):
        snapshot_copy(store, {"two": spark.range(1), "three": spark.createDataFrame([()], "struct<>"), "four": spark.range(1)})
    assert store.read("two").count() == 1 and not store.has("four")


def test_jdbc_reads_are_partitioned():
    class Reader:
        def __init__(self): self.given = {}
        def format(self, name): self.given["format"] = name; return self
        def options(self, **options): self.given |= options; return self
        def load(self): return self.given

    class Session:
        read = Reader()

    given = jdbc_relation(Session, "jdbc:x", "a.b", partition_column="id", lower=1, upper=9, partitions=4, properties={"user": "u"})
    assert given == {"format": "jdbc", "url": "jdbc:x", "dbtable": "a.b", "fetchsize": "10000", "user": "u", "preferTimestampNTZ": "true",
                     "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
    with pytest.raises(ValueError):
        jdbc_relation(Session, "jdbc:x", "a.b", partition_column="id")


# Streams over marks and bad rows, order of arrival, writers side by side

def stream_round(spark, store, folder, checkpoint, *bodies):
    spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "body string").coalesce(1).write.mode("append").text(folder)
    ingest_stream(store, BY_NAME["nonconformances"], folder, checkpoint, options=LoadOptions(buckets=4, on_duplicate="last")).awaitTermination()


def test_a_stream_never_moves_the_mark_back(spark, store, tmp_path):
    assert not ingest_entity(store, BY_NAME["nonconformances"], pages(spark, [nc(1, "2024-05-01T00:00:00Z")]), options=OPTIONS).error
    mark = read_mark(store, "nonconformances")
    for bodies in ([[nc(2, "2023-01-01T00:00:00Z")]], [[]]):
        stream_round(spark, store, str(tmp_path / "in"), str(tmp_path / "cp"), *bodies)
        assert read_mark(store, "nonconformances") == mark
    assert store.read("nonconformances").count() == 2


def test_a_bad_batch_keeps_its_items_and_later_ones_load(spark, store, tmp_path):
    stream_round(spark, store, str(tmp_path / "in"), str(tmp_path / "cp"), [nc(1), {"number": "no id"}])
    assert store.read("staging/nonconformances").count() == 2 and not store.has("nonconformances")
    stream_round(spark, store, str(tmp_path / "in"), str(tmp_path / "cp"), [nc(3)])
    assert store.read("nonconformances").count() == 1
    assert values(store.read("run_log"), "status", "rows_pulled", "rows_upserted") == [("failed", 2, 0), ("success", 1, 1)]


def test_the_last_copy_wins_wherever_it_stands(spark, store):
    options = LoadOptions(buckets=4, on_duplicate="last")
    given = pages(spark, [nc(1, number="a"), nc(1, number="b")], [nc(2, number="c"), nc(1, number="d")], [nc(2, number="e"), nc(2, number="f")]).coalesce(1)
    assert not ingest_entity(store, BY_NAME["nonconformances"], given, options=options).error
    names = [f.name for f in store.read("nonconformances").schema.fields]
    column = next(name for name in names if name.endswith("number"))
    assert values(store.read("nonconformances"), column) == [("d",), ("f",)]


def test_responses_are_kept_to_the_letter(spark, store):
    body = '{"items": [ {"id":"' + guid(1) + '", "number": "1.50"} ]}'
    ingest_entity(store, BY_NAME["nonconformances"], pages(spark, body), options=OPTIONS)
    assert values(store.read("responses/nonconformances"), "response") == [(body,)]


def test_writers_of_different_tables_do_not_conflict(spark, store):
    with store.commit() as mine:
        with store.commit() as theirs:
            theirs.replace("b", spark.range(2))
        mine.replace("a", spark.range(3))
    assert store.read("a").count() == 3 and store.read("b").count() == 2
    assert store.manifest().version == 2


def test_a_cluster_without_a_shared_folder_is_refused():
    from tallyweave.sources import staging

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self): return None

    class Conf:
        def get(self, key, default=None): return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(staging.NoSharedFolder):
        staging.checkpoint_folder(Session)
    Context.getCheckpointDir = lambda self: "hdfs:///shared/"
    assert staging.checkpoint_folder(Session) == "hdfs:///shared"


# Cost of reading items


def test_an_item_is_walked_once(spark):
    """Fields are read from one walk over the item; no path has a look-up of its own except where that walk found nothing."""
    lines = BY_NAME["purchase_orders"].targets[1]
    rows = map_items(items(spark, {"guid": guid(1), "quantityOrdered": 2, "unitCost": 1.5}).withColumn("purchase_order_id", F.lit("p")), lines.fields)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "StringType, false" not in plan and plan.count("try_variant_get(item") > 0
    assert values(rows, "line_id", "line_amount") == [(guid(1), Decimal("3.0000"))]


def test_one_walk_gives_what_each_path_gives(spark):
    """Paths that begin other paths, a path read as two types, values that do not fit, and objects and arrays where texts are declared."""
    fields = [plain("n", INT), plain("as_text", text(), "n"), plain("whole", text(), "a"), plain("part", INT, "a", "b"), plain("flag", BOOL, "a", "c"),
              Field("on", mapping.AUDIT_TIME, (("on",),)), Field("either", INT, (("x",), ("y",)))]
    given = [{"n": 7, "a": {"b": "5", "c": True}, "on": {"date": "2020-01-02"}, "x": None, "y": 3}, {"n": 1.5e30, "a": "{", "on": "20200103", "x": "z", "y": {"k": 1}},
             {"n": [1], "a": [2], "on": {"date": {"d": 1}}}, 17, "text", None]
    rows = map_items(items(spark, *given).withColumn("place", F.col("position")), fields, ["place"]).orderBy("place").collect()
    empty = (None,) * 7
    assert [tuple(row)[1:-1] for row in rows] == [
        (7, "7", None, 5, True, dt.datetime(2020, 1, 2), 3), (None, "1.5E30", "{", None, None, dt.datetime(2020, 1, 3), None), empty, empty, empty, empty]
    assert [row["violations"] for row in rows[:3]] == [[], ["n is not a int", "either is not a int"], ["n is not a int"]]


def test_items_as_text_with_and_without_marks(spark):
    """Numbers are marked only where some are spelled in more ways than one; the staged text is the same."""
    bodies = ['[{"b":12,"a":[1,-5]},7,"x",null]', '[ {"b" : -0 , "a":[1.50,1e3,-0.0]}, 1.0 ]', '[{"id":"10:30.5 -0","n":123456789012345678901234567890}]']
    given = spark.createDataFrame([(body,) for body in bodies], "body string")
    assert [row[0] for row in given.select(envelope.variants.can_mark(F.col("body"))).collect()] == [False, True, True]
    texts = [row["raw"] for row in envelope.unnest(given.coalesce(1), text="raw").collect()]
    assert texts == ['{"b":12,"a":[1,-5]}', "7", '"x"', "null", '{"b":-0,"a":[1.50,1e3,-0.0]}', "1.0", '{"id":"10:30.5 -0","n":123456789012345678901234567890}']


@pytest.mark.parametrize("given, expected", [
    ("2020-01-02T10:30:00+02:00", "2020-01-02T08:30:00"), ("2020-01-02 10:30:00.1234567Z", "2020-01-02T10:30:00.123456"), ("2020-01-02T10:30:00+0230", "2020-01-02T08:00:00"),
    ("2020-13-02T10:30:00Z", None), ("2020-01-02T10:30Z", "2020-01-02T10:30:00"), ("2020-01-02T10:30:00,5Z", "2020-01-02T10:30:00.500000"), ("2020-01-02T10:30:00+02", None),
])
def test_complete_times_are_cast_as_they_are(spark, given, expected):
    from tallyweave.functions.times import parse_iso
    assert spark.createDataFrame([(given,)], "t string").select(parse_iso(F.col("t"))).first()[0] == (expected and at(expected))
