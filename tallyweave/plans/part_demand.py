"""Part demand status: header, allocation, left-over supply and blocked stock, for any number of parts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions import texts
from tallyweave.operators import allocation, parts
from tallyweave.operators.hot_keys import HOT_ROWS, hot_keys, lookup
from tallyweave.operators.ordered import positions
from tallyweave.sources.staging import stage


@dataclass(frozen=True)
class PartInputs:
    products: DataFrame
    product_names: DataFrame
    product_revisions: DataFrame
    planning: DataFrame
    stock: DataFrame
    po_details: DataFrame
    po_lines: DataFrame
    nonconformances: DataFrame

    def folded(self) -> PartInputs:
        """The same inputs with part codes, types and statuses made comparable without case and trailing blanks."""
        return replace(
            self,
            products=texts.fold_case(self.products, "code"),
            planning=texts.canonical(self.planning, "type", *parts.DEMAND_TYPES),
            stock=texts.canonical(texts.fold_case(self.stock, "product_code", "revision"), "status", parts.AVAILABLE, *parts.BLOCKED),
            po_details=texts.canonical(self.po_details, "status", *parts.CLOSED_LINES),
            nonconformances=texts.fold_case(self.nonconformances, "product_code", "revision"),
        )


# The reading order of the two lists of a report.
READING_ORDER = {
    "allocation": ("need_date", "demand_id", "ecd_date", "supply_id"),
    "excess": ("ecd_date", "supply_id"),
}


class PartReport:
    """The report for the given part codes (a list, or a frame with the column ``code`` if they are many), or for all parts. Each part of it is computed when it is first asked for;
    what several of them need, the resolved parts and the segments of the allocation, is computed once.

    ``headers``, ``allocation``, ``excess``, ``blocked``, and ``unknown``: the given codes that mean no product.
    """

    def __init__(self, inputs: PartInputs, part_codes: Sequence[str] | DataFrame | None = None, *, as_of: dt.date | None = None,
                 nonconformance_key: str = "product_code", case_insensitive: bool = False, hot_rows: int = HOT_ROWS,
                 reading_order: bool = False) -> None:
        self.inputs = inputs.folded() if case_insensitive else inputs
        self.all_parts, self.as_of, self.nonconformance_key = part_codes is None, as_of, nonconformance_key
        self.hot_rows, self.reading_order = hot_rows, reading_order
        if not isinstance(part_codes, DataFrame):
            part_codes = inputs.products.sparkSession.createDataFrame([(code,) for code in part_codes or ()], "code string")
        written = part_codes.select(F.col("code").alias("written")).distinct()
        self.requested = written.withColumn("code", F.upper(F.rtrim("written")) if case_insensitive else F.col("written"))

    @cached_property
    def resolved(self) -> DataFrame:
        """One product per code. Planning rows are counted for the products that have a requested code only."""
        products, planning = self.inputs.products, self.inputs.planning
        if not self.all_parts:
            products = products.join(self.requested, "code", "left_semi")
            planning = planning.join(products.select("product_id"), "product_id", "left_semi")
        return stage(parts.resolve_codes(products, planning), "resolved-parts")

    @cached_property
    def codes(self) -> DataFrame:
        return self.resolved.select("product_id", texts.shown(self.resolved, "code").alias("part_number"))

    def wanted(self, df: DataFrame) -> DataFrame:
        return df if self.all_parts else df.join(self.codes, "product_id", "left_semi")

    @cached_property
    def headers(self) -> DataFrame:
        return parts.part_headers(self.resolved, self.inputs.product_names, self.inputs.product_revisions)

    @cached_property
    def hot_products(self) -> DataFrame:
        """Products with very many rows in the pools, counted once and without the joins that describe the rows."""
        given = self.inputs
        pools = self.wanted(parts.pool_products(given.planning, given.stock, given.po_details))
        return stage(hot_keys(pools, ["product_id"], self.hot_rows), "hot-products")

    @cached_property
    def segments(self) -> DataFrame:
        given = self.inputs
        pool = allocation.allocation_pool(
            self.wanted(parts.demand_pool(given.planning)),
            self.wanted(parts.supply_pool(given.stock, given.po_details, given.po_lines, self.as_of)))
        return stage(allocation.allocate(pool, hot_rows=self.hot_rows, keys=self.hot_products), "allocation")

    def _named(self, df: DataFrame, right: DataFrame, hot: DataFrame, *spread: str) -> DataFrame:
        return lookup(df, right, ["product_id"], spread, how="inner", hot=hot)

    @cached_property
    def allocation(self) -> DataFrame:
        labels = self.codes.join(parts.default_revisions(self.inputs.product_revisions), "product_id", "left").select(
            "product_id", "part_number", parts.revision_label(F.col("default_revision")).alias("demand_rev"))
        rows = self._named(allocation.allocations(self.segments), labels, self.hot_products, "demand_id", "supply_id")
        return rows.orderBy(*self._order("allocation")) if self.reading_order else rows

    @cached_property
    def excess(self) -> DataFrame:
        rows = self._named(allocation.excess(self.segments), self.codes, self.hot_products, "supply_id")
        return rows.orderBy(*self._order("excess")) if self.reading_order else rows

    @staticmethod
    def _order(part: str) -> list[Column]:
        return [F.asc_nulls_first(name) for name in READING_ORDER[part]]

    def in_order(self, part: str) -> DataFrame:
        """``allocation`` or ``excess`` with ``position``, the place of each row in reading order, which unlike the order of rows
        outlives writing and joining."""
        return positions(getattr(self, part), self._order(part))

    @cached_property
    def blocked(self) -> DataFrame:
        stock = self.wanted(self.inputs.stock)
        rows = parts.blocked_stock(stock, self.inputs.nonconformances, self.nonconformance_key, hot_rows=self.hot_rows)
        held = hot_keys(stock.filter(F.col("status").isin(*parts.BLOCKED)), ["product_id"], self.hot_rows)
        return self._named(rows, self.codes, held, "inventory_id")

    @cached_property
    def unknown(self) -> DataFrame:
        return self.requested.join(self.resolved, "code", "left_anti").select(F.col("written").alias("code"))


def part_demand_status(inputs: PartInputs, part_codes: Sequence[str] | DataFrame | None = None, **options) -> PartReport:
    """The report; nothing is computed before a part of it is asked for."""
    return PartReport(inputs, part_codes, **options)


class UnknownPart(LookupError):
    """No product has the given code."""


def single_part_status(inputs: PartInputs, part_code: str, **options) -> PartReport:
    """The report for one part, in reading order; an unknown code is an error."""
    report = PartReport(inputs, [part_code], reading_order=True, **options)
    if not report.unknown.isEmpty():
        raise UnknownPart(f'Part code "{part_code}" not found')
    return report
