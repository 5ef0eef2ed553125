from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import values
from tallyweave.operators import hot_keys as hot_keys_module
from tallyweave.operators.hot_keys import hot_keys
from tallyweave.operators.ordered import positions
from tallyweave.operators import allocation, ordered, parts
from tallyweave.plans.part_demand import PartInputs, UnknownPart, part_demand_status, single_part_status

TODAY = dt.date(2024, 6, 1)
DEMAND = "product_id string, demand_id string, due_at timestamp_ntz, need_date date, qty decimal(18,5)"
SUPPLY = ("product_id string, supply_id string, source_rank int, ecd_date date, supply_rev string, source_type string, "
          "reference string, pedigree string, qty decimal(18,5)")


def pool(spark, demands, supplies):
    """Demands and supplies as (product, id, day or None, qty)."""
    def day(n):
        return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)

    def number(q):
        return None if q is None else Decimal(str(q))

    demand = [(p, i, None if d is None else dt.datetime.combine(day(d), dt.time()), day(d), number(q)) for p, i, d, q in demands]
    supply = [(p, i, 0, day(d), "R", "Inventory", i, "P", number(q)) for p, i, d, q in supplies]
    return allocation.allocation_pool(spark.createDataFrame(demand, DEMAND), spark.createDataFrame(supply, SUPPLY))


def results(segments):
    allocated = values(allocation.allocations(segments), "product_id", "demand_id", "supply_id", "demand_qty", "allocated_qty")
    left = values(allocation.excess(segments), "product_id", "supply_id", "excess_qty")
    return allocated, left


def greedy(demands, supplies):
    """The plain way: one demand after the other takes from one supply after the other."""
    def in_order(rows):
        rows = [row for row in rows if row[3] is not None and row[3] > 0]
        return sorted(rows, key=lambda row: (row[2] is not None, row[2] or 0, row[1]))

    allocated, left = [], []
    for product in {row[0] for row in demands + supplies}:
        open_supply = [[i, Decimal(str(q))] for p, i, _, q in in_order(supplies) if p == product]
        for p, demand, _, wanted in in_order(demands):
            remaining = Decimal(str(wanted)) if p == product else Decimal(0)
            while remaining > 0:
                if not open_supply:
                    allocated.append((product, demand, None, remaining, Decimal(0)))
                    break
                taken = min(remaining, open_supply[0][1])
                allocated.append((product, demand, open_supply[0][0], taken, taken))
                remaining -= taken
                open_supply[0][1] -= taken
                if open_supply[0][1] == 0:
                    open_supply.pop(0)
        left += [(product, i, q) for i, q in open_supply]
    return sorted(allocated, key=repr), sorted(left, key=repr)


def quantize(rows):
    return sorted((tuple(v.quantize(Decimal("0.00001")) if isinstance(v, Decimal) else v for v in row) for row in rows), key=repr)


def test_hand_made_allocations(spark):
    demands = [("a", "d1", 1, 10), ("a", "d2", 2, 5), ("b", "d1", 1, 10), ("c", "d1", 1, 5), ("c", "d2", 2, 5), ("e", "d1", 1, 3),
               ("f", "d1", 1, 0), ("f", "d2", 2, -4), ("f", "d3", 3, None)]
    supplies = [("a", "s1", 1, 4), ("a", "s2", 2, 20), ("b", "s1", 1, 4), ("c", "s1", 1, 5), ("c", "s2", 2, 5), ("g", "s1", 1, 2),
                ("f", "s0", 1, 0), ("f", "s1", 2, 7), ("f", "s2", 1, None)]
    allocated, left = results(allocation.allocate(pool(spark, demands, supplies)))
    assert sorted([(p, d, s, int(q), int(a)) for p, d, s, q, a in allocated], key=lambda r: (r[0], r[1], r[2] or "~")) == [
        ("a", "d1", "s1", 4, 4), ("a", "d1", "s2", 6, 6), ("a", "d2", "s2", 5, 5),
        ("b", "d1", "s1", 4, 4), ("b", "d1", None, 6, 0),
        ("c", "d1", "s1", 5, 5), ("c", "d2", "s2", 5, 5), ("e", "d1", None, 3, 0),
    ]
    assert [(p, s, int(q)) for p, s, q in left] == [("a", "s2", 9), ("f", "s1", 7), ("g", "s1", 2)]


@pytest.mark.parametrize("options", [{}, {"hot_rows": 1, "chunks": 7}, {"hot_rows": 12, "chunks": 3}], ids=str)
def test_allocation_equals_the_greedy_loop(spark, options):
    rng = random.Random(7)
    def rows(prefix, products, most):
        return [
            (f"p{p}", f"{prefix}{i:03d}", rng.choice([None, *range(6)]), rng.choice([-1, 0, 1, 2, 2.5, 3, 5, 0.00001]))
            for p in range(products) for i in range(rng.randrange(most))
        ]
    demands = rows("d", 120, 8) + [("hot", f"d{i:04d}", rng.randrange(9), rng.choice([1, 2, 3])) for i in range(300)]
    supplies = rows("s", 120, 8) + [("hot", f"s{i:04d}", rng.randrange(9), rng.choice([1, 2, 3])) for i in range(280)]
    allocated, left = results(allocation.allocate(pool(spark, demands, supplies), **options))
    wanted, wanted_left = greedy(demands, supplies)
    assert allocated == quantize(wanted) and left == quantize(wanted_left)

    asked = sum(Decimal(str(q)) for *_, q in demands if q > 0)
    given = sum(Decimal(str(q)) for *_, q in supplies if q > 0)
    assert sum(row[3] for row in allocated) == asked
    assert sum(row[4] for row in allocated) + sum(row[2] for row in left) == given


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_sequence(spark, hot_rows):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), F.col("id"))
    rows = ordered.sequence(df, ["g"], [F.desc("id")], "n", hot_rows=hot_rows, chunks=5).collect()
    for group in range(3):
        own = sorted((row for row in rows if row["g"] == group), key=lambda row: -row["id"])
        assert [row["n"] for row in own] == list(range(1, len(own) + 1))


def part_inputs(spark, **given):
    schemas = {
        "products": "product_id string, code string, is_make boolean, is_buy boolean, active boolean, is_serial_tracked boolean, "
                    "is_lot_tracked boolean, is_inspection_required boolean, lead_time int",
        "product_names": "product_id string, name string",
        "product_revisions": "product_id string, revision string, is_default boolean, active boolean",
        "planning": "product_id string, line_id string, type string, due_at timestamp_ntz, qty decimal(18,5)",
        "stock": "inventory_id string, product_id string, status string, serial string, lot string, tag string, revision string, pedigree string, qty decimal(18,5)",
        "po_details": "line_id string, product_id string, status string, qty_remaining decimal(18,5)",
        "po_lines": "line_id string, header_number string, line_number int, due_text string, revision string, pedigree string",
        "nonconformances": "nc_number string, product_id string, revision string, status string, created_at timestamp_ntz, reject_category string",
    }
    return PartInputs(**{name: spark.createDataFrame(given.get(name, []), schema) for name, schema in schemas.items()})


def product(id, code, make=None, buy=None):
    return (id, code, make, buy, True, True, False, None, 5)


def plan(product, id, qty, day=1, kind="MasterSchedule"):
    return (product, id, kind, dt.datetime(2024, 6, day, 8), Decimal(qty))


def test_code_on_two_sites(spark):
    given = part_inputs(spark, products=[product("p2", "A"), product("p1", "A"), product("p4", "B"), product("p3", "B"), product("p5", None)],
                        planning=[plan("p2", "1", 1), plan("p2", "2", 1, kind="Inventory"), plan("p2", "3", 1)])
    assert values(parts.resolve_codes(given.products, given.planning), "code", "product_id", "planning_rows") == [("A", "p2", 3), ("B", "p3", 0)]


def test_header(spark):
    given = part_inputs(
        spark, products=[product("p1", "A", True, True), product("p2", "B", True, None), product("p3", "C", False, True), product("p4", "D", None, None)],
        product_names=[("p1", "Part A")],
        product_revisions=[("p1", "B", True, True), ("p1", "A", True, True), ("p1", "0", True, False), ("p2", "A", False, True), ("p3", "A", None, True)],
    )
    headers = parts.part_headers(parts.resolve_codes(given.products, given.planning), given.product_names, given.product_revisions)
    assert values(headers, "part_number", "description", "make_buy", "default_revision", "serial_tracked", "lead_time_days") == [
        ("A", "Part A", "Make/Buy", "A", True, 5), ("B", None, "Make", None, True, 5), ("C", None, "Buy", None, True, 5), ("D", None, "Neither", None, True, 5)]


def test_supply_order_and_filters(spark):
    given = part_inputs(
        spark,
        stock=[("i1", "p", "AVAILABLE", None, "LOT", "TAG", "R", "P", Decimal(1)), ("i2", "p", "SCRAPPED", None, None, None, "R", "P", Decimal(1)),
               ("i3", "p", None, None, None, None, "R", "P", Decimal(1))],
        po_details=[("l1", "p", "OPEN", Decimal(1)), ("l2", "p", "OPEN", Decimal(1)), ("l3", "p", "CANCELLED", Decimal(1)),
                    ("l4", "p", None, Decimal(1)), ("l5", "p", "OPEN", Decimal(0)), ("l6", "p", "OPEN", Decimal(1))],
        po_lines=[(f"l{i}", "PO7", i, due, "R", "P") for i, due in
                  enumerate(["2024-05-01 23:30:00 -05:00", "05/09/2024", "2024-06-03", "2024-06-03", "2024-06-03", "2024-06-01"], start=1)],
    )
    supply = parts.numbered_supply(parts.supply_pool(given.stock, given.po_details, given.po_lines, TODAY))
    assert [(row["reference"], row["ecd_date"]) for row in supply.orderBy("supply_seq").collect()] == [
        ("PO7 / line 2", None), ("PO7 / line 1", dt.date(2024, 5, 1)), ("LOT", TODAY), ("PO7 / line 6", TODAY)]


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_newest_fitting_nonconformance(spark, hot_rows):
    def nc(number, product, revision, day):
        return (number, product, revision, "OPEN", None if day is None else dt.datetime(2024, 1, day), "Cat")

    given = part_inputs(
        spark,
        stock=[(f"i{n}", p, s, None, None, None, r, "P", Decimal(1)) for n, (p, r, s) in enumerate([
            ("a", "R1", "BLOCKED"), ("b", "R1", "ON_HOLD"), ("c", "R1", "BLOCKED"), ("d", None, "BLOCKED"), ("e", "R1", "AVAILABLE"), ("f", "R1", "BLOCKED")])],
        nonconformances=[
            nc("a1", "a", "R1", 1), nc("a2", "a", "R1", 2), nc("a3", "a", None, 1), nc("a4", "a", "R2", 9), nc("a5", "a", "R1", None),
            nc("b1", "b", "R1", 1), nc("b2", "b", None, 2), nc("c1", "c", "R2", 5), nc("d1", "d", "R1", 5), nc("d2", "d", None, 1), nc("d3", "d", None, 1)],
    )
    rows = values(parts.blocked_stock(given.stock, given.nonconformances, "product_id", hot_rows=hot_rows), "inventory_id", "nc_number", "nc_status", "reject_category")
    assert rows == [("i0", "a2", "OPEN", "Cat"), ("i1", "b2", "OPEN", "Cat"), ("i2", None, None, None), ("i3", "d3", "OPEN", "Cat"), ("i5", None, None, None)]


def report_inputs(spark):
    return part_inputs(
        spark, products=[product("p1", "A"), product("p2", "B"), product("p9", "A")], product_revisions=[("p1", "C", True, True)],
        planning=[plan("p1", "d1", 6, 2), plan("p1", "d0", 3, 1), plan("p1", "x", 9, 1, "PlannedPurchaseOrder"), plan("p2", "d9", 1)],
        stock=[("i1", "p1", "AVAILABLE", "SN", None, None, "R", "P", Decimal(5)), ("i2", "p1", "BLOCKED", None, None, None, "R", "P", Decimal(4)),
               ("i3", "p9", "AVAILABLE", None, None, None, "R", "P", Decimal(5))],
        po_details=[("l1", "p1", "OPEN", Decimal(7))], po_lines=[("l1", "PO1", 1, "2024-07-01", "R2", "P2")],
    )


def test_report_for_one_part(spark):
    report = single_part_status(report_inputs(spark), "A", as_of=TODAY, nonconformance_key="product_id")
    note = "C (best-effort - not tracked per demand line)"
    got = [(r["demand_id"], r["supply_id"], int(r["allocated_qty"]), r["demand_rev"]) for r in report.allocation.collect()]
    assert got == [("d0", "i1", 3, note), ("d1", "i1", 2, note), ("d1", "l1", 4, note)]
    assert [(r["reference"], int(r["excess_qty"]), r["rev"]) for r in report.excess.collect()] == [("PO1 / line 1", 3, "R2")]
    assert values(report.blocked, "inventory_id", "reference", "nc_number") == [("i2", None, None)]
    assert values(report.headers, "part_number", "product_id") == [("A", "p1")]


def test_unknown_parts(spark):
    with pytest.raises(UnknownPart, match="nope"):
        single_part_status(report_inputs(spark), "nope", as_of=TODAY)
    report = part_demand_status(report_inputs(spark), ["B", "nope"], as_of=TODAY)
    assert values(report.unknown, "code") == [("nope",)]
    assert values(report.allocation, "part_number", "source_type", "allocated_qty") == [("B", allocation.SHORTAGE, Decimal("0.00000"))]


@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_report_for_all_parts(spark, hot_rows):
    report = part_demand_status(report_inputs(spark), as_of=TODAY, hot_rows=hot_rows, nonconformance_key="product_id")
    assert values(report.allocation, "part_number", "demand_id") == [("A", "d0"), ("A", "d1"), ("A", "d1"), ("B", "d9")]
    assert values(report.excess, "part_number", "supply_id") == [("A", "l1")]
    assert report.unknown.isEmpty()


def test_case_insensitive_report(spark):
    given = part_inputs(
        spark, products=[product("p1", "abc ")], planning=[plan("p1", "d1", 6, kind="MASTERschedule")],
        stock=[("i1", "p1", "Available ", "SN", None, None, "R", "P", Decimal(5)), ("i2", "p1", "on_hold", None, None, None, "r", "P", Decimal(4))],
        po_details=[("l1", "p1", "completed", Decimal(7))], po_lines=[("l1", "PO1", 1, "2024-07-01", "R2", "P2")],
        nonconformances=[("n1", "p1", "R ", "OPEN", dt.datetime(2024, 1, 1), "Cat")],
    )
    report = part_demand_status(given, ["ABc"], as_of=TODAY, case_insensitive=True, nonconformance_key="product_id")
    assert values(report.allocation, "part_number", "supply_id", "allocated_qty") == [
        ("abc ", "i1", Decimal("5.00000")), ("abc ", None, Decimal("0.00000"))]
    assert values(report.blocked, "status", "rev") == [("on_hold", "r")]
    assert values(report.blocked, "inventory_id", "nc_number") == [("i2", "n1")]
    assert values(part_demand_status(given, ["ABc"], as_of=TODAY).unknown, "code") == [("ABc",)]


def test_nonconformances_are_found_by_code_on_every_site(spark):
    stock = spark.createDataFrame(
        [("i1", "p1", "X", "BLOCKED", "R"), ("i2", "p2", "X", "ON_HOLD", "R"), ("i3", "p3", None, "BLOCKED", "R")],
        "inventory_id string, product_id string, product_code string, status string, revision string").selectExpr(
            "*", "cast(null as string) serial", "cast(null as string) lot", "cast(null as string) tag", "'P' pedigree", "cast(1 as decimal(18,5)) qty")
    found = spark.createDataFrame([("n1", "p1", "X", "R", "OPEN", dt.datetime(2024, 1, 1)), ("n2", "p3", None, "R", "OPEN", dt.datetime(2024, 1, 1))],
                                  "nc_number string, product_id string, product_code string, revision string, status string, created_at timestamp")
    assert values(parts.blocked_stock(stock, found), "inventory_id", "nc_number") == [("i1", "n1"), ("i2", "n1"), ("i3", None)]


def test_a_report_computes_only_what_is_asked_for(spark, monkeypatch):
    report = part_demand_status(report_inputs(spark), ["A", "zz"], as_of=TODAY)
    monkeypatch.setattr(allocation, "allocate", None)  # headers and unknown codes need no allocation
    assert values(report.headers, "part_number", "product_id") == [("A", "p1")]
    assert values(report.unknown, "code") == [("zz",)]


def test_chunks_follow_the_rows(spark):
    assert ordered.chunk_count(spark.range(4_000), 1_000) == 8
    assert ordered.chunk_count(spark.range(40_000), 1_000) == 80
    assert ordered.chunk_count(spark.range(10), 1_000) == 2


def test_small_hot_groups_make_few_chunks(spark):
    assert ordered.chunk_count(spark.range(4_000_000), 500) == ordered.MANY_CHUNKS


def test_base_tables_are_dealt_only_where_their_files_leave_cores_idle(spark, tmp_path):
    from driver import views

    many = spark.range(80_000).withColumn("text", F.sha2(F.col("id").cast("string"), 512)).repartition(16)
    many.write.parquet(str(tmp_path / "many.parquet"))
    many.coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    tables = {name: views.base_table(spark, str(tmp_path), name) for name in ("many", "one")}
    exchanged = {name: "Exchange" in df._jdf.queryExecution().executedPlan().toString() for name, df in tables.items()}
    assert exchanged == {"many": False, "one": True}
    assert [df.distinct().count() for df in tables.values()] == [80_000, 80_000]


def test_no_hot_key_is_left_whole(spark):
    from tallyweave.operators.hot_keys import hot_keys

    rows = spark.range(30_000).selectExpr("id % 15000 as k")
    assert hot_keys(rows, ["k"], 2).count() == 15_000 and hot_keys(rows, ["k"], 3).count() == 0


# Hot keys by sketch, and positions

@pytest.mark.parametrize("kind", ["string", "long", "int", "decimal(9,0)"])
def test_hot_keys_are_found_without_shuffling_keys(spark, kind):
    spread = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).when(F.col("id") % 50 == 2, 8).otherwise(F.col("id") + 100).cast(kind).alias("k"))
    keys = hot_keys(spread.repartition(5), ["k"], 1_000)
    assert keys.schema["k"].dataType == spread.schema["k"].dataType
    assert sorted((row["k"] for row in keys.collect()), key=repr) == sorted((row["k"] for row in spread.groupBy("k").count().filter("count >= 1000").collect()), key=repr)
    assert "hashpartitioning" not in keys._jdf.queryExecution().executedPlan().toString()
    assert hot_keys(spread, ["k"], 30_000).collect() == [] and hot_keys(spread.limit(0), ["k"], 1).collect() == []


def test_every_key_over_the_bound_of_the_sketch_is_found(spark, monkeypatch):
    """Far more keys than the sketch keeps; each key with more than one of TRACKED / 7 rows must come out."""
    monkeypatch.setattr(hot_keys_module, "TRACKED", 1024)
    rows = spark.range(40_000).select(F.when(F.col("id") % 40 < 4, F.col("id") % 40 % 4).otherwise(F.col("id") + 100).alias("k")).repartition(7)
    assert sorted(row["k"] for row in hot_keys(rows, ["k"], 900).collect()) == [0, 1, 2, 3]


def test_positions_number_a_total_order(spark):
    rows = [(n % 5 if n % 7 else None, n) for n in range(500)]
    df = spark.createDataFrame(rows, "a int, n int").repartition(6)
    placed = positions(df, [F.asc_nulls_first("a"), F.desc("n")])
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert [tuple(r) for r in placed.orderBy("position").select("a", "n").collect()] == expected
    assert [r["position"] for r in placed.orderBy("position").collect()] == list(range(1, 501))
    assert positions(df.limit(0), [F.asc("n")]).collect() == []
