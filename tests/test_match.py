from __future__ import annotations

import dataclasses
import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import values
from tallyweave.operators import bills as bill_ops, checks
from tallyweave.operators.purchase_orders import approvals_by_po, receipt_summary, totals_by_currency
from tallyweave.plans.three_way_match import (
    COLUMNS, Match, MatchInputs, MatchOptions, publish, refresh_match_results, status_rollup, three_way_match,
)
from tallyweave.sources.versioned import VersionedStore

NOW = dt.datetime(2024, 5, 1, 12, 0, 0, 600_000)
BILL = "bill_key string, bill_id string, bill_type string, amount decimal(18,2), status string, submitted_at timestamp_ntz, ingested_at timestamp_ntz, raw_json string"
LINE = ("header_id long, header_number string, partner_name string, line_id string, status string, is_suspended boolean, "
        "unit_cost decimal(18,4), qty_ordered decimal(18,5), qty_completed decimal(18,5)")


def po(n):
    return f"PO_{n:010d}"


def bill(id, amount, memo=None, status="APPROVED", key="1", kind="BILLPAY", hour=0, vendor="v1", raw=None):
    raw = raw if raw is not None else json.dumps({"memo": memo, "vendor_id": vendor, "payment_status": "OPEN"})
    when = dt.datetime(2024, 1, 1, hour)
    return (key, id, kind, None if amount is None else Decimal(str(amount)), status, when, when, raw)


def line(n, ordered, completed, status="OPEN", suspended=False, cost=1, header=None):
    as_decimal = lambda x: None if x is None else Decimal(str(x))
    return (header or n, po(n), f"Supplier {n}", f"{n}-{ordered}-{completed}-{status}", status, suspended,
            as_decimal(cost), as_decimal(ordered), as_decimal(completed))


def inputs(spark, bills=(), approvals=(), lines=(), headers=None, vendors=(("v1", "Vendor 1"),), issues=None):
    approvals = list(approvals)
    if issues is None:
        issues = [(row[0], "Approved") for row in approvals]
    if headers is None:
        headers = [(h, "OPEN") for h in {row[0] for row in lines}]
    return MatchInputs(
        spark.createDataFrame(list(bills), BILL),
        spark.createDataFrame(list(vendors), "vendor_id string, vendor_name string"),
        spark.createDataFrame([(i, p, None if a is None else Decimal(str(a))) for i, p, a in approvals],
                              "issue_id long, po_number string, total_cost decimal(18,2)"),
        spark.createDataFrame(issues, "issue_id long, status string"),
        spark.createDataFrame(list(lines), LINE),
        spark.createDataFrame(headers, "header_id long, status string"),
    )


def buckets(spark, given, **options):
    result = three_way_match(given, MatchOptions(as_of=NOW, **options))
    return {row["bill_id"]: row["status_bucket"] for row in result.collect()}


def test_cap_boundaries(spark):
    amounts = {1: (100, "101.00"), 2: (100, "101.01"), 3: (100, "110.00"), 4: (100, "110.01"), 5: (5, "6.00"), 6: (5, "6.01")}
    given = inputs(
        spark,
        bills=[bill(f"b{n}", billed, po(n)) for n, (_, billed) in amounts.items()],
        approvals=[(n, po(n), auth) for n, (auth, _) in amounts.items()],
        lines=[line(n, 1, 1) for n in amounts],
    )
    assert buckets(spark, given) == {
        "b1": "Fully validated", "b2": "Within 10% of approved amount", "b3": "Within 10% of approved amount",
        "b4": "Over Authorized Amount", "b5": "Fully validated", "b6": "Over Authorized Amount",
    }


def test_priorities_and_missing_sides(spark):
    given = inputs(
        spark,
        bills=[bill("none", 1, "no token"), bill("unapproved", 1, po(1)), bill("unreceived", 1, po(2)),
               bill("no order", 1, po(3)), bill("over", 500, po(2 + 2)), bill("null auth", 1, po(5))],
        approvals=[(2, po(2), 10), (3, po(3), 10), (4, po(4), 10), (5, po(5), None)],
        lines=[line(2, 5, 4), line(4, 5, 0)],
    )
    assert buckets(spark, given) == {
        "none": "No PO in memo", "unapproved": "No approval found", "unreceived": "Not yet received",
        "no order": "Not yet received", "over": "Over Authorized Amount", "null auth": "No approval found",
    }


def test_void_bills(spark):
    given = inputs(
        spark,
        bills=[bill("void only", 70, po(1), "VOID"), bill("twin", "20649.51", po(2)), bill("twin void", "20649.51", po(2), "VOID"),
               bill("no status", 10, po(3), None), bill("no amount", None, po(4))],
        approvals=[(1, po(1), 50), (2, po(2), "20649.51"), (3, po(3), 1), (4, po(4), 1)],
        lines=[line(n, 1, 1) for n in (1, 2, 3, 4)],
    )
    rows = {row["bill_id"]: row for row in three_way_match(given, MatchOptions(as_of=NOW)).collect()}
    assert (rows["void only"]["status_bucket"], rows["void only"]["amount_variance"]) == ("Fully validated", None)
    assert {rows[k]["status_bucket"] for k in ("twin", "twin void")} == {"Fully validated"}
    assert rows["twin"]["amount_variance"] == Decimal("0.00")
    assert (rows["no status"]["status_bucket"], rows["no status"]["amount_variance"]) == ("Over Authorized Amount", Decimal("9.00"))
    assert rows["no amount"]["status_bucket"] == "Fully validated"
    assert rows["no amount"]["match_flag"] == "Match" and rows["no status"]["match_flag"] == "Mismatch"


def test_partial_bills_are_capped_together(spark):
    given = inputs(spark, bills=[bill("a", 60, po(1)), bill("b", 60, po(1))], approvals=[(1, po(1), 100)], lines=[line(1, 1, 1)])
    assert set(buckets(spark, given).values()) == {"Over Authorized Amount"}


def test_awaiting_invoice(spark):
    given = inputs(
        spark,
        bills=[bill("void", 1, po(1), "VOID")],
        approvals=[(1, po(1), 5), (2, po(2), 7), (3, po(3), None)],
        lines=[line(2, 3, 1, suspended=True)],
    )
    rows = {row["bill_id"]: row for row in three_way_match(given, MatchOptions(as_of=NOW)).collect()}
    assert set(rows) == {"void", f"NOINVOICE:{po(2)}", f"NOINVOICE:{po(3)}"}
    waiting = rows[f"NOINVOICE:{po(2)}"]
    assert (waiting["match_flag"], waiting["status_bucket"], waiting["supplier"]) == ("Pending", "Awaiting Invoice", "Supplier 2")
    assert (waiting["is_fully_received"], waiting["has_suspended_line"]) == (False, True)
    assert rows[f"NOINVOICE:{po(3)}"]["authorized_amount"] is None
    assert list(waiting.asDict()) == list(COLUMNS)
    assert {row["matched_at"] for row in rows.values()} == {dt.datetime(2024, 5, 1, 12, 0, 1)}
    with_amount = three_way_match(given, MatchOptions(as_of=NOW, require_amount=True))
    assert {row["bill_id"] for row in with_amount.collect()} == {"void", f"NOINVOICE:{po(2)}"}


def test_latest_record(spark):
    bills = spark.createDataFrame([
        bill("a", 1, hour=1), bill("a", 2, hour=2), bill("b", 1, hour=1), bill("b", 2, kind="CARD", hour=2),
        bill("c", 1, key="1"), bill("c", 2, key="2"),
    ], BILL)
    assert values(bill_ops.latest(bill_ops.only_bills(bills)), "bill_id", "amount") == [
        ("a", Decimal("2.00")), ("b", Decimal("1.00")), ("c", Decimal("2.00")),
    ]


def test_bill_fields(spark):
    bills = spark.createDataFrame([
        bill("object", 1, raw='{"memo":{"t":"PO_0000000001"}}'), bill("null", 1, raw='{"memo":null}'),
        bill("bad", 1, raw="{memo"), bill("deep", 1, raw='{"memo":"x","bill_extension":{"invoice_number":"I1"},"vendor_id":7}'),
    ], BILL)
    fields = bill_ops.read_fields(bills)
    assert values(fields, "bill_id", "memo", "po_number", "invoice_number", "vendor_id", "is_malformed") == [
        ("bad", None, None, None, None, True), ("deep", "x", None, "I1", "7", False),
        ("null", None, None, None, None, False), ("object", None, None, None, None, False),
    ]
    assert values(bill_ops.malformed(fields), "bill_id") == [("bad",)]


def test_receipts(spark):
    lines = spark.createDataFrame([
        line(1, 5, 0, "CANCELLED"),
        line(2, 5, 10), line(2, 10, 5),
        line(3, 5, 0, None), line(3, 5, 5),
        line(4, None, 1),
        line(5, 1, 1),
        line(6, 1, 0, cost=None), line(6, 2, 0, cost=3, suspended=None),
    ], LINE)
    headers = spark.createDataFrame([(1, "OPEN"), (2, "OPEN"), (3, "OPEN"), (4, "OPEN"), (5, None), (6, "OPEN")], "header_id long, status string")
    rows = values(receipt_summary(lines, headers).withColumn("total", F.col("total_amount").cast("int")),
                  "po_number", "is_fully_received", "has_suspended_line", "total")
    assert rows == [(po(1), True, False, 0), (po(2), True, False, 15), (po(3), True, False, 5), (po(4), False, False, None),
                    (po(6), False, False, 6)]


def test_an_order_split_over_headers_is_summed(spark):
    lines = spark.createDataFrame([line(1, 5, 0, header=10), line(1, 5, 10, header=11), line(1, 9, 0, header=12)], LINE)
    headers = spark.createDataFrame([(10, "OPEN"), (11, "OPEN"), (12, "CANCELLED")], "header_id long, status string")
    assert values(receipt_summary(lines, headers), "po_number", "is_fully_received") == [(po(1), True)]


def test_two_approvals(spark):
    given = inputs(spark, approvals=[(1, po(1), 60), (2, po(1), 60), (3, None, 5), (4, po(2), None)],
                   issues=[(1, "A"), (2, "B"), (3, "C"), (4, None)])
    for hot_rows in (1, 1000):
        assert values(approvals_by_po(given.approvals, given.issues, hot_rows=hot_rows),
                      "po_number", "authorized_amount", "approval_status") == [
            (po(1), Decimal("120.00"), "B"), (po(2), None, None),
        ]


def test_case_insensitive(spark):
    given = inputs(spark, bills=[bill("a", 1, "po_abcdefghij", status="Void "), bill("b", 2, "PO_ABCDEFGHIJ", kind="billpay ", vendor="V1 ")],
                   approvals=[(1, "Po_abcDEFghij ", 2)],
                   lines=[(1, "po_ABCDEFGHIJ", "S", "l", "open", False, Decimal(1), Decimal(1), Decimal(1))])
    rows = {row["bill_id"]: row for row in three_way_match(given, MatchOptions(as_of=NOW, case_insensitive=True)).collect()}
    assert {r["status_bucket"] for r in rows.values()} == {"Fully validated"}
    assert rows["a"]["bill_status"] == "Void " and rows["a"]["po_number"] == "po_abcdefghij" and rows["b"]["po_number"] == "PO_ABCDEFGHIJ"
    assert rows["b"]["supplier"] == "Vendor 1" and rows["b"]["amount_variance"] == Decimal("0.00")
    assert buckets(spark, given) == {"a": "No PO in memo", "NOINVOICE:Po_abcDEFghij ": "Awaiting Invoice"}


@pytest.mark.parametrize("hot_rows", [1, 3, 1_000_000])
def test_hot_orders_and_vendors_give_the_same_rows(spark, hot_rows):
    bills = [bill(f"h{i}", 1, po(1), vendor="v1") for i in range(12)]
    bills += [bill(f"n{i}", 1, "none", vendor=None) for i in range(6)] + [bill(f"u{i}", 1, po(9), vendor="gone") for i in range(6)]
    bills += [bill("x", 1, po(2), vendor="v2")]
    given = inputs(spark, bills=bills, approvals=[(1, po(1), 12), (2, po(2), 5), (3, po(3), 5)], lines=[line(1, 1, 1)],
                   vendors=[("v1", "Vendor 1"), ("v2", "Vendor 2")])
    rows = three_way_match(given, MatchOptions(as_of=NOW, hot_rows=hot_rows))
    counted = {tuple(r): n for *r, n in values(rows.groupBy("status_bucket", "supplier").count(), "status_bucket", "supplier", "count")}
    assert counted == {
        ("Fully validated", "Vendor 1"): 12, ("No PO in memo", None): 6, ("No approval found", None): 6,
        ("Not yet received", "Vendor 2"): 1, ("Awaiting Invoice", None): 1,
    }


def test_refresh_and_publish(spark, store, tmp_path):
    good = inputs(spark, bills=[bill("a", 1, po(1))], approvals=[(1, po(1), 1)])
    assert refresh_match_results(store, good, MatchOptions(as_of=NOW)) == 1
    assert store.read("match_results_rejects").count() == 0
    reports = VersionedStore(spark, str(tmp_path / "reports"))
    assert publish(store, reports) == 1
    assert reports.read("match_results").columns == list(COLUMNS)

    twice = inputs(spark, bills=[bill("a", 1, po(1)), bill("b", 1)], vendors=[("v1", "one"), ("v1", "two")])
    with pytest.raises(Exception, match="vendors: key"):
        refresh_match_results(store, twice, MatchOptions(as_of=NOW))
    long_memo = inputs(spark, bills=[bill("a", 1, "m" * 501)])
    with pytest.raises(checks.IntegrityError, match="memo is longer than 500"):
        refresh_match_results(store, long_memo, MatchOptions(as_of=NOW))
    assert values(store.read("match_results"), "bill_id") == [("a",)]
    unreadable = inputs(spark, bills=[bill("a", 1, po(1)), bill("bad", 1, raw="{")])
    assert refresh_match_results(store, unreadable, MatchOptions(as_of=NOW)) == 2
    assert values(store.read("match_results_rejects"), "bill_id") == [("bad",)]


def test_totals_by_currency(spark):
    orders = spark.createDataFrame([(1, "PO1", "S", "P", "Partner"), (2, "PO2", "S", "P", "Partner")],
                                   "purchase_order_id int, order_number string, site_code string, partner_code string, partner_name string")
    lines = spark.createDataFrame([(1, "USD", Decimal(1)), (1, "EUR", Decimal(2)), (1, None, Decimal(3)), (1, None, None), (3, "USD", Decimal(9))],
                                  "purchase_order_id int, currency_code string, line_amount decimal(18,4)")
    assert values(totals_by_currency(orders, lines), "order_number", "currency_code", "total_amount", "line_count") == sorted([
        ("PO1", "USD", Decimal("1.0000"), 1), ("PO1", "EUR", Decimal("2.0000"), 1), ("PO1", None, Decimal("3.0000"), 2)], key=repr)


@pytest.mark.parametrize("what", ["vendors", "issues", "headers"])
def test_repeated_right_sides_are_refused(spark, what):
    given = inputs(spark, bills=[bill("a", 1, po(1))], approvals=[(1, po(1), 1)], lines=[(1, po(1), "S", "l", "open", False, Decimal(1), Decimal(1), Decimal(1))])
    field = {"vendors": "vendors", "issues": "issues", "headers": "po_headers"}[what]
    twice = getattr(given, field)
    twice = dataclasses.replace(given, **{field: twice.union(twice)})
    with pytest.raises(Exception, match="not unique"):
        three_way_match(twice, MatchOptions(as_of=NOW)).collect()


def test_building_a_match_runs_no_checks_and_a_rollup_reads_no_vendors(spark, monkeypatch, tmp_path):
    given = inputs(spark, bills=[bill("a", 1, po(1)), bill("b", 1)], approvals=[(1, po(1), 1), (2, po(2), 3)], lines=[line(1, 1, 1)])
    given.vendors.write.parquet(f"{tmp_path}/vendors_table")
    given = dataclasses.replace(given, vendors=spark.read.parquet(f"{tmp_path}/vendors_table"))
    monkeypatch.setattr(checks, "assert_key", lambda *_, **__: pytest.fail("a job to check keys"))
    with Match(given, MatchOptions(as_of=NOW)) as match:
        by_rows = values(status_rollup(match.rows), "status_bucket", "match_flag", "rows", "bill_amount")
        assert values(match.rollup, "status_bucket", "match_flag", "rows", "bill_amount") == by_rows
        assert any("vendors_table" in path for path in match.rows.inputFiles())
        assert not any("vendors_table" in path for path in match.rollup.inputFiles())
        paths = [path for _, path in match._stages._own]
    assert len(paths) == 2 and not any(Path(path.removeprefix("file://")).exists() for path in paths)


def test_bills_without_an_order_pass_no_lookup_of_facts(spark):
    from tallyweave.plans import three_way_match as plan

    bills = spark.createDataFrame([bill("a", 5, po(1)), bill("b", 7, "none"), bill("c", 9, None), bill(None, 1, po(1)), bill("d", 2, raw="{broken")], BILL)
    parsed = bill_ops.matched_columns(plan.parsed_bills(bills))
    facts = spark.createDataFrame([(po(1), 2, Decimal("6.00"), Decimal("6.00"), "ok", True, False), (None, 3, Decimal("1.00"), None, None, None, None)],
                                  "po_number string, bills long, billed_amount decimal(18,2), authorized_amount decimal(18,2), approval_status string, "
                                  "is_fully_received boolean, has_suspended_line boolean")
    statuses = plan.bill_statuses(parsed, facts)
    assert values(statuses, "bill_id", "po_number", "approval_status", "status_bucket") == values(spark.createDataFrame([
        ("a", po(1), "ok", "Fully validated"), (None, po(1), "ok", "Fully validated"), ("b", None, None, "No PO in memo"),
        ("c", None, None, "No PO in memo"), ("d", None, None, "No PO in memo")], "a string, b string, c string, d string"), "a", "b", "c", "d")
    assert "Union" in statuses._jdf.queryExecution().optimizedPlan().toString()
    assert values(parsed, "bill_id", "bill_key") == values(spark.createDataFrame(
        [("a", None), ("b", None), ("c", None), (None, None), ("d", "1")], "a string, b string"), "a", "b")


def test_busy_vendors_are_counted_in_the_bills(spark, monkeypatch):
    from tallyweave.plans import three_way_match as plan

    counted = []
    monkeypatch.setattr(plan, "hot_keys", lambda df, on, rows: counted.append((df, on)) or df.select(*on).limit(0), raising=False)
    parsed = plan.parsed_bills(spark.createDataFrame([bill("a", 5, po(1))], BILL))
    facts = spark.createDataFrame([], "po_number string, bills long, billed_amount decimal(18,2), authorized_amount decimal(18,2), approval_status string, "
                                      "is_fully_received boolean, has_suspended_line boolean")
    plan.billed_rows(parsed, facts, spark.createDataFrame([("v1", "V")], "vendor_id string, vendor_name string"))
    assert [(df is parsed, on) for df, on in counted] == [(True, ["vendor_id"])]


def test_keys_with_one_hash_each_are_not_counted_again(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    with pytest.raises(checks.IntegrityError, match="x2"):
        checks.assert_key(rows.union(rows), "k")
    with pytest.raises(checks.IntegrityError):
        checks.assert_key(rows.union(spark.createDataFrame([(None, 3)], rows.schema)), "k")
    monkeypatch.setattr(checks, "key_violations", None)
    assert checks.assert_key(rows, "k") is rows


def test_a_store_writes_with_its_compression(spark, tmp_path):
    with VersionedStore(spark, str(tmp_path / "z"), "zstd").commit() as change:
        change.replace("t", spark.range(3))
    assert list(tmp_path.glob("z/t/**/*.zstd.parquet"))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_order_number_is_read_after_the_newest_records_are_found(spark):
    from tallyweave.plans import three_way_match as plan

    parsed = plan.parsed_bills(spark.createDataFrame([bill("a", 5, po(1), key="1"), bill("a", 6, po(2), key="2")], BILL))
    lines = plan_of(bill_ops.matched_columns(parsed)).splitlines()
    where = [i for i, text in enumerate(lines) if po(0)[:3] in text]
    assert where and max(where) < next(i for i, text in enumerate(lines) if "Window" in text)
    assert values(parsed, "bill_id", "po_number") == [("a", po(2))]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("busy", [["h", "g"], []])
def test_rows_read_again_are_shuffled_only_for_ordinary_keys(spark, how, busy):
    from tallyweave.operators.hot_keys import lookup

    left = spark.createDataFrame([(k, i) for i, k in enumerate(["h"] * 5 + ["g"] * 3 + ["a", "b", "b", None, None])], "k string, i int")
    right = spark.createDataFrame([("h", 1, None), ("a", 2, "x"), ("c", 3, "y")], "k string, n int, t string")
    hot = spark.createDataFrame([(k,) for k in busy], "k string")
    rows = lookup(left, right, ["k"], ["i"], how=how, hot=hot, read_again=True)
    assert rows.columns == ["k", "i", "n", "t"]
    assert values(rows, "k", "i", "n", "t") == values(lookup(left, right, ["k"], ["i"], how=how, hot=hot), "k", "i", "n", "t") == values(
        left.join(right, "k", how), "k", "i", "n", "t")
    text = plan_of(rows)
    assert "xxhash64" not in text and ("LeftAnti" in text) == bool(busy)


def test_few_vendors_are_sent_to_the_bills_and_many_are_not(spark, monkeypatch):
    from tallyweave.operators import hot_keys as hot

    given = inputs(spark, bills=[bill("a", 1, po(1)), bill("b", 2, po(1), vendor="gone"), bill("c", 3, vendor=None), bill("d", 3, po(2), vendor="v2")],
                   vendors=[("v1", "Vendor 1"), ("v2", None), (None, "nobody")])
    assert hot.is_small(given.vendors) and hot.is_small(given.vendors.limit(0))
    few = three_way_match(given, MatchOptions(as_of=NOW))
    text = few._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in text
    monkeypatch.setattr(hot, "SMALL_BYTES", 3 * 32 + 2 + 8 + 2 + 6 - 1)
    assert not hot.is_small(given.vendors)
    many = three_way_match(given, MatchOptions(as_of=NOW))
    assert "strategy=broadcast" not in plan_of(many)
    assert values(few, *COLUMNS) == values(many, *COLUMNS)
    assert values(few, "bill_id", "supplier") == [("a", "Vendor 1"), ("b", None), ("c", None), ("d", None)]


def test_checked_rows_keep_their_partitions(spark):
    rows = spark.createDataFrame([(1, "A"), (2, "B"), (None, "C"), (None, "D")], "k long, s string")
    more = spark.createDataFrame([(1, 5), (2, 6), (2, 7)], "k long, n int")
    joined = checks.unique_rows(rows, "k", "s").hint("merge").join(more, "k")
    text = joined._jdf.queryExecution().sparkPlan().toString()
    assert text.count("raise_error") == 1 and "Filter" in next(part for part in text.splitlines() if "raise_error" in part)
    assert values(joined, "k", "s", "n") == [(1, "A", 5), (2, "B", 6), (2, "B", 7)]
    with pytest.raises(Exception, match="things: key .k. is not unique, e.g. 2"):
        checks.unique_rows(rows.union(spark.createDataFrame([(2, "E")], rows.schema)), "k", "s", what="things").collect()


def test_staging_leaves_no_shuffle_files(spark):
    import time
    from threading import Barrier, Thread

    from tallyweave.sources import staging

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {path.name for top in folders for path in Path(top).glob("*/shuffle_*")}
    before = files()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    staged = staging.stage(rows, "freed")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and staged.count() == 7 and rows.count() == 7
    assert spark.conf.get(staging.FREE_SHUFFLES) == "false"

    both, seen = Barrier(2), []

    def inside(first):
        with staging.shuffles_freed(spark):
            both.wait(20)
            if first:
                return
            time.sleep(1)
            seen.append(spark.conf.get(staging.FREE_SHUFFLES))

    threads = [Thread(target=inside, args=(first,)) for first in (True, False)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert seen == ["true"] and spark.conf.get(staging.FREE_SHUFFLES) == "false" and not staging._freeing
