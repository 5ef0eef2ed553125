"""Job B: part demand status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from driver.views import load, with_views
from tallyweave.operators import allocation, parts
from tallyweave.plans.part_demand import PartInputs, part_demand_status

AS_OF = dt.date(1998, 6, 1)
SMALL_GROUP = 500


def inputs(spark: SparkSession, sf_dir: str) -> PartInputs:
    return PartInputs(*load(
        spark, sf_dir, "f_products", "f_product_names", "f_product_revisions", "f_planning", "f_stock",
        "f_po_details", "f_po_lines", "f_nonconformances",
    ))


def q_part_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, planning = load(spark, sf_dir, "f_products", "f_planning")
    return parts.resolve_codes(products, planning).select("code", "product_id", "planning_rows")


def q_default_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    (revisions,) = load(spark, sf_dir, "f_product_revisions")
    return parts.default_revisions(revisions)


def q_part_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs(spark, sf_dir)
    resolved = parts.resolve_codes(given.products, given.planning)
    return parts.part_headers(resolved, given.product_names, given.product_revisions)


def q_demand_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    planning, revisions = load(spark, sf_dir, "f_planning", "f_product_revisions")
    labelled = parts.label_demand(parts.demand_pool(planning), revisions)
    return parts.numbered_demand(labelled)


def q_demand_pool_hot_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    planning, revisions = load(spark, sf_dir, "h_planning", "f_product_revisions")
    labelled = parts.label_demand(parts.demand_pool(planning), revisions, hot_rows=SMALL_GROUP)
    return parts.numbered_demand(labelled, hot_rows=SMALL_GROUP)


def q_supply_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.numbered_supply(parts.supply_pool(*load(spark, sf_dir, "f_stock", "f_po_details", "f_po_lines"), AS_OF))


def _segments(spark: SparkSession, sf_dir: str, prefix: str, **options) -> DataFrame:
    planning, stock, details, lines = load(
        spark, sf_dir, f"{prefix}_planning", f"{prefix}_stock", f"{prefix}_po_details", "f_po_lines",
    )
    supply = parts.supply_pool(stock, details, lines, AS_OF)
    pool = allocation.allocation_pool(parts.demand_pool(planning), supply)
    return allocation.allocate(pool, counted=parts.pool_products(planning, stock, details), **options)


def q_fifo_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation.allocations(_segments(spark, sf_dir, "f"))


def q_excess_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation.excess(_segments(spark, sf_dir, "f"))


def q_fifo_allocation_hot_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same allocation after a third of all rows moved to one part."""
    return allocation.allocations(_segments(spark, sf_dir, "h", hot_rows=SMALL_GROUP))


def q_excess_supply_hot_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allocation.excess(_segments(spark, sf_dir, "h", hot_rows=SMALL_GROUP))


def q_blocked_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.blocked_stock(*load(spark, sf_dir, "f_stock", "f_nonconformances"), "product_id")


def q_blocked_stock_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by product code; every code is on three products."""
    return parts.blocked_stock(*load(spark, sf_dir, "f_stock", "f_nonconformances"))


def q_blocked_stock_hot_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.blocked_stock(*load(spark, sf_dir, "h_stock", "h_nonconformances"), "product_id", hot_rows=SMALL_GROUP)


def _report(spark: SparkSession, sf_dir: str):
    return part_demand_status(inputs(spark, sf_dir), as_of=AS_OF)


def q_part_report_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).headers


def q_part_report_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).allocation


def q_part_report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each row of the allocation stands in reading order."""
    return _report(spark, sf_dir).in_order("allocation").select("part_number", "demand_id", "supply_id", "position")


def q_excess_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).in_order("excess").select("part_number", "supply_id", "position")


def q_part_report_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).excess


def q_part_report_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).blocked


def _selected(spark: SparkSession, sf_dir: str):
    """The report for every fifth part code, and for codes that mean no product."""
    given = inputs(spark, sf_dir)
    asked = given.products.filter("product_id % 5 = 0").select("code").unionByName(
        given.products.filter("product_id % 9 = 0").select(F.concat(F.lit("no "), "code").alias("code")))
    return part_demand_status(given, asked, as_of=AS_OF)


def q_part_report_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir).allocation


def q_part_report_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir).unknown


def q_part_report_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of parts whose codes are asked for in other letters, shown as the products have them."""
    given = inputs(spark, sf_dir)
    asked = given.products.filter("product_id % 5 = 0").select(F.concat(F.upper("code"), F.lit(" ")).alias("code"))
    return part_demand_status(given, asked, as_of=AS_OF, case_insensitive=True).headers


QUERIES = {
    name.removeprefix("q_"): function for name, function in list(globals().items()) if name.startswith("q_")
}


_RESOLVED = """resolved as (
      select * exclude (rn) from (
        select p.*, coalesce(c.n, 0) as planning_rows,
               row_number() over (partition by p.code order by coalesce(c.n, 0) desc, p.product_id) as rn
        from f_products p left join (select product_id, count(*) as n from f_planning group by product_id) c
          on c.product_id = p.product_id
        where p.code is not null) where rn = 1
    ), revisions as (
      select product_id, min(revision) as default_revision from f_product_revisions
      where is_default and active group by product_id
    )"""

_HEADERS = """
        select r.product_id, r.code as part_number, n.name as description,
               case when r.is_make and r.is_buy then 'Make/Buy' when r.is_make then 'Make' when r.is_buy then 'Buy'
                    else 'Neither' end as make_buy,
               r.active, r.is_serial_tracked as serial_tracked, r.is_lot_tracked as lot_tracked,
               r.is_inspection_required as inspection_required, r.lead_time as lead_time_days, v.default_revision
        from resolved r left join f_product_names n on n.product_id = r.product_id
        left join revisions v on v.product_id = r.product_id
"""


def _demand(planning: str) -> str:
    return f"""demand as (
      select product_id, line_id as demand_id, due_at, cast(due_at as date) as need_date, qty
      from {planning} where type in ('MasterSchedule', 'PlannedWorkOrder') and product_id is not null
    )"""


def _supply(stock: str, details: str) -> str:
    return f"""supply as (
      select product_id, inventory_id as supply_id, 0 as source_rank, date '1998-06-01' as ecd_date,
             revision as supply_rev, 'Inventory' as source_type, coalesce(serial, lot, tag, inventory_id) as reference,
             pedigree, qty
      from {stock} where status = 'AVAILABLE' and product_id is not null
      union all
      select d.product_id, d.line_id, 1, try_cast(substr(l.due_text, 1, 10) as date), l.revision, 'Open PO',
             l.header_number || ' / line ' || l.line_number, l.pedigree, d.qty_remaining
      from {details} d join f_po_lines l on l.line_id = d.line_id
      where d.status not in ('CANCELLED', 'COMPLETED') and d.qty_remaining > 0 and d.product_id is not null
    )"""


def _overlaps(prefix: str) -> str:
    """Allocation as an overlap join of quantity intervals, the other way to compute it."""
    return f"""{_demand(prefix + "_planning")}, {_supply(prefix + "_stock", prefix + "_po_details")},
    demand_from as (
      select *, sum(qty) over w as hi, sum(qty) over w - qty as lo from demand where qty > 0
      window w as (partition by product_id order by need_date nulls first, due_at nulls first, demand_id
                   rows unbounded preceding)
    ), supply_from as (
      select *, sum(qty) over w as hi, sum(qty) over w - qty as lo from supply where qty > 0
      window w as (partition by product_id order by ecd_date nulls first, source_rank, reference nulls first, supply_id
                   rows unbounded preceding)
    ), met as (
      select d.product_id, d.demand_id, d.need_date, s.supply_id, s.ecd_date, s.supply_rev, s.source_type,
             s.reference, s.pedigree, least(d.hi, s.hi) - greatest(d.lo, s.lo) as q
      from demand_from d join supply_from s on s.product_id = d.product_id and s.lo < d.hi and s.hi > d.lo
    ), supplied as (select product_id, max(hi) as total from supply_from group by product_id
    ), demanded as (select product_id, max(hi) as total from demand_from group by product_id
    ), allocation as (
      select product_id, demand_id, need_date, cast(q as decimal(18,5)) as demand_qty, supply_id, ecd_date,
             supply_rev, source_type, reference, pedigree, cast(q as decimal(18,5)) as allocated_qty
      from met
      union all
      select d.product_id, d.demand_id, d.need_date,
             cast(d.hi - greatest(d.lo, coalesce(t.total, 0)) as decimal(18,5)), null, null, null,
             'SHORTAGE - no supply available', null, null, cast(0 as decimal(18,5))
      from demand_from d left join supplied t on t.product_id = d.product_id where d.hi > coalesce(t.total, 0)
    ), excess as (
      select s.product_id, s.supply_id, s.ecd_date, s.supply_rev as rev, s.source_type, s.reference, s.pedigree,
             cast(s.hi - greatest(s.lo, coalesce(t.total, 0)) as decimal(18,5)) as excess_qty
      from supply_from s left join demanded t on t.product_id = s.product_id where s.hi > coalesce(t.total, 0)
    )"""


def _blocked(stock: str, nonconformances: str, key: str = "product_id") -> str:
    return f"""blocked as (
      select i.inventory_id, i.product_id, i.status, i.revision as rev, coalesce(i.serial, i.lot, i.tag) as reference,
             i.pedigree, i.qty, n.nc_number, n.status as nc_status,
             row_number() over (partition by i.inventory_id
                                order by n.created_at desc nulls last, n.nc_number desc nulls last) as rn
      from {stock} i left join {nonconformances} n
        on n.{key} = i.{key} and (n.revision = i.revision or n.revision is null)
      where i.status in ('BLOCKED', 'ON_HOLD')
    )"""


_SEQUENCED_DEMAND = """
    select d.*, case when r.default_revision is not null
                     then r.default_revision || ' (best-effort - not tracked per demand line)' end as demand_rev,
           row_number() over (partition by d.product_id
                              order by d.need_date nulls first, d.due_at nulls first, d.demand_id) as demand_seq
    from demand d left join revisions r on r.product_id = d.product_id
"""

ORACLES = {
    "part_resolution": with_views(f"with {_RESOLVED} select code, product_id, planning_rows from resolved"),
    "default_revision": with_views(f"with {_RESOLVED} select product_id, default_revision from revisions"),
    "part_header": with_views(f"with {_RESOLVED} {_HEADERS}"),
    "demand_pool": with_views(f"with {_RESOLVED}, {_demand('f_planning')} {_SEQUENCED_DEMAND}"),
    "demand_pool_hot_part": with_views(f"with {_RESOLVED}, {_demand('h_planning')} {_SEQUENCED_DEMAND}"),
    "supply_pool": with_views(f"""with {_supply('f_stock', 'f_po_details')}
        select *, row_number() over (partition by product_id order by ecd_date nulls first, source_rank,
                                     reference nulls first, supply_id) as supply_seq from supply"""),
    "fifo_allocation": with_views(f"with {_overlaps('f')} select * from allocation"),
    "excess_supply": with_views(f"with {_overlaps('f')} select * from excess"),
    "fifo_allocation_hot_part": with_views(f"with {_overlaps('h')} select * from allocation"),
    "excess_supply_hot_part": with_views(f"with {_overlaps('h')} select * from excess"),
    "blocked_stock": with_views(
        f"with {_blocked('f_stock', 'f_nonconformances')} select * exclude (rn) from blocked where rn = 1"),
    "blocked_stock_hot_part": with_views(
        f"with {_blocked('h_stock', 'h_nonconformances')} select * exclude (rn) from blocked where rn = 1"),
    "blocked_stock_by_code": with_views(
        f"with {_blocked('f_stock', 'f_nonconformances', 'product_code')} select * exclude (rn) from blocked where rn = 1"),
    "part_report_selected": with_views(f"""with {_RESOLVED}, {_overlaps('f')}
        select a.*, r.code as part_number,
               case when v.default_revision is not null
                    then v.default_revision || ' (best-effort - not tracked per demand line)' end as demand_rev
        from allocation a join resolved r on r.product_id = a.product_id
        left join revisions v on v.product_id = a.product_id
        where r.code in (select code from f_products where product_id % 5 = 0)"""),
    "part_report_unknown": with_views(
        "select distinct 'no ' || code as code from f_products where product_id % 9 = 0 and code is not null"),
    "part_report_case": with_views(f"with {_RESOLVED} {_HEADERS} where r.code in (select code from f_products where product_id % 5 = 0)"),
    "part_report_headers": with_views(f"with {_RESOLVED} {_HEADERS}"),
    "part_report_allocation": with_views(f"""with {_RESOLVED}, {_overlaps('f')}
        select a.*, r.code as part_number,
               case when v.default_revision is not null
                    then v.default_revision || ' (best-effort - not tracked per demand line)' end as demand_rev
        from allocation a join resolved r on r.product_id = a.product_id
        left join revisions v on v.product_id = a.product_id"""),
    "part_report_excess": with_views(f"""with {_RESOLVED}, {_overlaps('f')}
        select e.*, r.code as part_number from excess e join resolved r on r.product_id = e.product_id"""),
    "part_report_blocked": with_views(f"""with {_RESOLVED}, {_blocked('f_stock', 'f_nonconformances', 'product_code')}
        select b.* exclude (rn), r.code as part_number
        from blocked b join resolved r on r.product_id = b.product_id where b.rn = 1"""),
}

ORACLES |= {
    "part_report_order": f"""
        select part_number, demand_id, supply_id,
               row_number() over (order by need_date nulls first, demand_id nulls first, ecd_date nulls first, supply_id nulls first) as position
        from ({ORACLES["part_report_allocation"]})
    """,
    "excess_order": f"""
        select part_number, supply_id, row_number() over (order by ecd_date nulls first, supply_id nulls first) as position
        from ({ORACLES["part_report_excess"]})
    """,
}
