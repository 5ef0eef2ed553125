"""Inputs derived from the test tables, as SQL that Spark and DuckDB both run unchanged."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

BASE_TABLES = ("customer", "events", "lineitem", "orders", "part", "supplier")

VIEWS: dict[str, str] = {
    "f_line": """
        select l.*, concat_ws('-', cast(l_orderkey as string), cast(l_partkey as string), cast(l_suppkey as string),
               cast(l_linenumber as string), cast(cast(l_shipdate as date) as string)) as line_id,
               concat('PO_', lpad(cast(l_orderkey as string), 10, '0')) as po_number,
               cast(l_extendedprice as decimal(18,2)) as amount
        from lineitem l
    """,
    "f_bills": """
        select concat(line_id, '#1') as bill_key, line_id as bill_id, 'BILLPAY' as bill_type,
               case when l_linenumber = 5 and l_suppkey % 5 = 2 then null else amount end as amount,
               case when l_returnflag = 'R' then 'VOID' when l_tax = 0 then null else 'APPROVED' end as status,
               l_shipdate as submitted_at, l_shipdate as ingested_at,
               concat('{"memo":',
                 case when l_linenumber = 7 then '"no reference"'
                      when l_linenumber = 6 and l_suppkey % 3 = 0 then 'null'
                      when l_linenumber = 6 then concat('{"t":"', po_number, '"}')
                      else concat('"Down pay ', po_number, 'X part PO_9999999999"') end,
                 ',"payment_status":"', case when l_linestatus = 'F' then 'CLEARED' else 'OPEN' end,
                 '","bill_extension":{"invoice_number":"INV-', line_id, '"},"vendor_id":"', cast(l_suppkey as string), '"}') as raw_json
        from f_line
        union all
        select concat(line_id, '#0'), line_id, 'BILLPAY', cast(amount + 100.00 as decimal(18,2)), 'DRAFT', l_shipdate,
               l_shipdate - interval 1 day, '{"memo":"stale"}' from f_line where l_suppkey % 10 = 0
        union all
        select concat(line_id, '#2'), line_id, 'CARD', amount, 'APPROVED', l_shipdate,
               l_shipdate + interval 1 day, '{"memo":"card"}' from f_line where l_suppkey % 10 = 1
    """,
    "f_vendors": """
        select cast(s_suppkey as string) as vendor_id, s_name as vendor_name from supplier where s_suppkey % 17 <> 3
    """,
    "f_approval_base": """
        select o_orderkey, o_orderstatus, concat('PO_', lpad(cast(o_orderkey as string), 10, '0')) as po_number,
               coalesce(t.billed, cast(o_totalprice as decimal(18,2))) as base
        from orders left join (select l_orderkey, cast(sum(amount) as decimal(18,2)) as billed from f_line
                               where l_returnflag <> 'R' and l_linenumber < 6 group by l_orderkey) t on t.l_orderkey = o_orderkey
    """,
    "f_approvals": """
        select o_orderkey as issue_id, po_number,
               cast(case o_orderkey % 7 when 1 then null when 2 then base when 3 then base * 1.05 when 4 then base * 0.95
                    when 5 then base * 0.80 else base * 0.50 end as decimal(18,2)) as total_cost
        from f_approval_base where o_orderkey % 7 <> 0
        union all
        select o_orderkey + 1000000000, po_number, cast(base * 0.60 as decimal(18,2)) from f_approval_base where o_orderkey % 7 = 6
    """,
    "f_issues": """
        select issue_id, case when issue_id % 2 = 0 then 'Order Placed' else 'Approved' end as status from f_approvals
    """,
    "f_po_headers": """
        select o_orderkey as header_id, case when o_orderstatus = 'P' then 'CANCELLED' when o_orderkey % 11 = 0 then null else 'OPEN' end as status from orders
    """,
    "f_po_lines": """
        select l_orderkey as header_id, po_number as header_number, concat('Supplier#', cast(l_suppkey as string)) as partner_name,
               line_id, cast(l_linenumber as string) as line_number, l_partkey as product_id,
               case when l_returnflag = 'R' then 'CANCELLED' when l_linenumber = 4 and l_tax = 0 then null else 'OPEN' end as status,
               l_discount = 0 as is_suspended,
               case when l_tax = 0.01 then null else cast(floor(l_extendedprice / l_quantity) as decimal(18,4)) end as unit_cost,
               cast(l_quantity as decimal(18,5)) as qty_ordered,
               cast(case when l_linestatus = 'F' or l_orderkey % 2 = 0 then l_quantity else l_quantity - 1 end as decimal(18,5)) as qty_completed,
               case when l_linenumber = 3 then 'not a date' else concat(cast(cast(l_shipdate as date) as string), ' 00:00:00.0000000 +00:00') end as due_text,
               concat('R', cast(l_linenumber % 3 as string)) as revision, concat('P', cast(l_suppkey % 4 as string)) as pedigree
        from f_line
    """,
    "f_products": """
        select p_partkey as product_id, concat(p_name, ' ', p_brand) as code, p_size % 2 = 0 as is_make,
               case when p_size % 5 = 0 then null else p_size % 3 = 0 end as is_buy, p_size as lead_time, p_size <> 13 as active,
               p_size % 7 = 0 as is_serial_tracked, case when p_size % 4 <> 1 then p_size % 3 = 1 end as is_lot_tracked,
               p_size > 25 as is_inspection_required from part
    """,
    "f_product_names": """
        select p_partkey as product_id, p_name as name from part where p_partkey % 9 <> 4
    """,
    "f_product_revisions": """
        select p_partkey as product_id, 'A' as revision, p_size % 4 = 0 as is_default, true as active from part
        union all select p_partkey, 'B', true, p_size % 6 <> 0 from part
    """,
    "f_planning": """
        select l_partkey as product_id, line_id, case when l_tax < 0.04 then 'MasterSchedule' when l_tax < 0.07 then 'PlannedWorkOrder' else 'PlannedPurchaseOrder' end as type,
               case when l_linenumber = 7 then null else l_shipdate end as due_at, cast(l_quantity / 4 as decimal(18,5)) as qty
        from f_line where l_linestatus = 'O' and l_returnflag <> 'R'
    """,
    "f_stock": """
        select line_id as inventory_id, l_partkey as product_id, concat('C', cast(l_partkey - l_partkey % 3 as string)) as product_code,
               case when l_returnflag = 'A' then 'AVAILABLE' when l_linenumber % 2 = 0 then 'BLOCKED' else 'ON_HOLD' end as status,
               case when l_linenumber = 1 then concat('SN', line_id) end as serial, case when l_linenumber <= 2 then concat('LOT', line_id) end as lot,
               case when l_linenumber <= 3 then concat('TAG', line_id) end as tag,
               case when l_linenumber = 6 then null else concat('R', cast(l_linenumber % 3 as string)) end as revision,
               concat('P', cast(l_suppkey % 4 as string)) as pedigree,
               cast(case when l_linenumber = 5 then 0 else l_quantity / 4 end as decimal(18,5)) as qty
        from f_line where l_linestatus = 'F' and l_returnflag <> 'N'
    """,
    "f_po_details": """
        select line_id, l_partkey as product_id, case when l_tax = 0.08 then 'COMPLETED' when l_tax = 0.07 then 'CANCELLED' when l_tax = 0.06 then null else 'OPEN' end as status,
               cast(case when l_linenumber = 2 then 0 else l_quantity / 2 end as decimal(18,5)) as qty_remaining
        from f_line where l_linestatus = 'F' and l_returnflag = 'N'
    """,
    "f_nonconformances": """
        select line_id as nc_number, l_partkey as product_id, concat('C', cast(l_partkey - l_partkey % 3 as string)) as product_code, case when l_linenumber = 1 then null else concat('R', cast(l_linenumber % 3 as string)) end as revision,
               case when l_tax < 0.04 then 'OPEN' else 'CLOSED' end as status, l_shipdate as created_at
        from f_line where l_linestatus = 'O' and l_returnflag = 'R'
    """,
    "f_pages": """
        select event_id, 'events' as endpoint,
               concat('{"items":[{', case when event_id % 4 = 0 then '"eventId"' else '"id"' end, ':"e', cast(event_id as string),
                 '","status":', case when event_id % 5 = 0 then 'null' else concat('{"id":', cast(user_id as string), ',"description":"', event_type, '"}') end,
                 ',"updatedOn":', case when event_id % 3 = 0 then concat('"', cast(cast(ts as date) as string), 'T00:00:00Z"')
                                       when event_id % 3 = 1 then concat('{"personId":1,"date":"', cast(cast(ts as date) as string), 'T12:30:00+02:00"}')
                                       else '"bad"' end,
                 ',"records":', case when event_id % 6 = 0 then 'null' else concat('[{"id":"e', cast(event_id as string), '-1","quantity":', cast(cast(user_id as int) as string), ',"unitCost":2.5},{"id":"e', cast(event_id as string), '-2","quantity":null,"unitCost":1}]') end,
                 '}],"hasNext":false}') as body
        from events
    """,
    "f_order_lines": """
        select l_orderkey, line_id, case l_suppkey % 3 when 0 then 'USD' when 1 then 'EUR' end as currency_code,
               case when l_linenumber = 6 then null else l_quantity end as quantity_ordered, floor(l_extendedprice / l_quantity) + 0.25 as unit_cost
        from f_line
    """,
    "f_upsert_target": """
        select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as price from orders where o_orderkey % 3 <> 0
    """,
    "f_upsert_source": """
        select o_orderkey, case when o_orderkey % 10 = 0 then null else 'U' end as o_orderstatus, cast(o_totalprice + 1 as decimal(18,2)) as price from orders where o_orderkey % 2 = 0
    """,
    "h_bills": """
        select b.bill_key, b.bill_id, b.bill_type, b.amount, b.status, b.submitted_at, b.ingested_at,
               case when ascii(substr(md5(b.bill_id), 1, 1)) % 3 = 0
                    then '{"memo":"Down pay PO_HOTORDER01","payment_status":"OPEN","vendor_id":"1"}'
                    else b.raw_json end as raw_json
        from f_bills b
    """,
    "h_approvals": """
        select issue_id, case when issue_id % 3 = 0 then 'PO_HOTORDER01' else po_number end as po_number, total_cost
        from f_approvals
    """,
    "h_planning": """
        select case when ascii(substr(md5(line_id), 1, 1)) % 3 = 0 then 1 else product_id end as product_id,
               line_id, type, due_at, qty
        from f_planning
    """,
    "h_stock": """
        select inventory_id, case when ascii(substr(md5(inventory_id), 1, 1)) % 3 = 0 then 1 else product_id end as product_id,
               product_code, status, serial, lot, tag, revision, pedigree, qty
        from f_stock
    """,
    "h_po_details": """
        select line_id, case when ascii(substr(md5(line_id), 1, 1)) % 3 = 0 then 1 else product_id end as product_id,
               status, qty_remaining
        from f_po_details
    """,
    "h_nonconformances": """
        select nc_number, case when ascii(substr(md5(nc_number), 1, 1)) % 3 = 0 then 1 else product_id end as product_id,
               product_code, revision, status, created_at
        from f_nonconformances
    """,
    "f_order_headers": """
        select o_orderkey as purchase_order_id, concat('PO_', lpad(cast(o_orderkey as string), 10, '0')) as order_number,
               concat('S', cast(o_custkey % 7 as string)) as site_code, cast(o_custkey as string) as partner_code,
               concat('Partner#', cast(o_custkey as string)) as partner_name
        from orders
    """,
    "f_known_orders": """
        select case when o_orderkey % 11 = 0 then null else concat('S', cast(o_custkey % 7 as string)) end as site_code,
               case when o_orderkey % 13 = 0 then null else concat('PO_', cast(o_orderkey as string)) end as order_number
        from orders where o_orderkey % 3 <> 0
    """,
    "f_found_orders": """
        select concat('S', cast(o_custkey % 7 as string)) as site_code,
               case when o_orderkey % 13 = 0 then null when o_orderkey % 17 = 0 then ''
                    else concat('PO_', cast(o_orderkey as string)) end as order_number
        from orders where o_orderkey % 2 = 0
    """,
    "f_work_centers": """
        select case when o_custkey % 5 = 0 then null else concat('S', cast(o_custkey % 70 as string)) end as site_code,
               case when o_custkey % 7 = 0 then null else concat('id-', cast(o_custkey % 70 as string)) end as site_id
        from orders
    """,
    "f_snapshot": """
        select event_id, event_type, cast(value as decimal(18,4)) as value, cast(ts as timestamp) as seen_at, ts as local_at
        from events
    """,
}


def reads(sql: str) -> list[str]:
    """Names after FROM or JOIN."""
    return re.findall(r"\b(?:from|join)\s+(\w+)", sql, flags=re.IGNORECASE)


def needed(*names: str) -> list[str]:
    """The given views and all they read, each after what it reads."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for source in reads(VIEWS[name]):
                visit(source)
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


ROWS_DEALT = 1 << 20  # rows of a task, at most, where rows are dealt out
# Under a million rows: these tables take some 12 bytes a row, what is derived of a row takes hundreds, and tasks sort that.
SPLIT, SPLIT_SIZE = "spark.sql.files.maxPartitionBytes", "8m"


def base_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table over all cores. Files whose row groups occupy every core are read as they are, in splits of ``SPLIT_SIZE`` unless the session sets another; the few row groups of a small
    file, which few tasks would read and derive everything from, are dealt over all cores."""
    if spark.conf.get(SPLIT, None) is None:
        spark.conf.set(SPLIT, SPLIT_SIZE)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    cores = spark.sparkContext.defaultParallelism
    read = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows")).agg(F.count("*").alias("tasks"), F.sum("rows").alias("rows")).first()
    return df if read["tasks"] >= cores else df.repartition(max(cores, -(-(read["rows"] or 0) // ROWS_DEALT)))


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The given views as DataFrames over the Parquet files in ``sf_dir``."""
    chain = needed(*names)
    for table in sorted({source for name in chain for source in reads(VIEWS[name])} & set(BASE_TABLES)):
        base_table(spark, sf_dir, table).createOrReplaceTempView(table)
    for name in chain:
        spark.sql(VIEWS[name]).createOrReplaceTempView(name)
    return [spark.table(name) for name in names]


def with_views(sql: str) -> str:
    """A query preceded by the views it reads, as one statement."""
    chain = needed(*reads(sql))
    clauses = [f"{name} as ({VIEWS[name]})" for name in chain]
    body = sql.strip()
    if body.lower().startswith("with "):
        clauses.append(body[5:])
        return "with " + ",\n".join(clauses)
    return ("with " + ",\n".join(clauses) + "\n" if clauses else "") + body
