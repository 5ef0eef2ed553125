"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the cores, BENCH_QUERIES (optional) the queries.
A query's time covers building it, with the tables it stages, and computing all of its rows.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from driver.registry import QUERIES
from tallyweave.session import local_session
from tallyweave.sources.staging import release

HEADLINE = (
    "po_receipt_summary", "approval_by_po", "bill_latest", "bill_parsed", "supply_pool", "fifo_allocation",
    "excess_supply", "blocked_stock", "po_totals_by_currency", "json_entity_map", "json_child_explode",
    "map_purchase_order_lines", "three_way_match", "status_rollup", "part_report_allocation",
    "three_way_match_hot_order", "fifo_allocation_hot_part", "upsert_merge", "upsert_buckets", "ingest_batch",
    "stream_upsert", "snapshot_copy",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus})
    QUERIES["po_receipt_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        release()
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
