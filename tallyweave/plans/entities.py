"""The ingested entities: where their items come from and how they become typed tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyweave.operators.envelope import ITEMS_KEY
from tallyweave.operators.mapping import (
    AMOUNT, AUDIT_TIME, BOOL, GUID, INT, ISO_TIME, LINE_AMOUNT, PLAN_PRODUCT_KEY, TOLERANCE_AMOUNT,
    Field, explode_children, first, map_items, nested, parent_key, plain, text,
)


@dataclass(frozen=True)
class TargetSpec:
    """A typed table. The first field is its key. ``child_of`` leads to the array its rows come from."""

    table: str
    fields: tuple[Field, ...]
    child_of: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return self.fields[0].name

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]


@dataclass(frozen=True)
class EntitySpec:
    """An entity with one table, or with a parent and a child table.

    ``mark_column`` is the column whose highest value is the high-water mark; without one the
    entity is always taken in full.
    """

    name: str
    targets: tuple[TargetSpec, ...]
    mark_column: str | None = None
    items_key: str = ITEMS_KEY
    single_orders: bool = False

    def map(self, items: DataFrame, target: TargetSpec, keep: Sequence[str] = ()) -> DataFrame:
        """Typed rows of one target from the entity's items."""
        if target.child_of:
            items = explode_children(items, self.targets[0].fields[0], *target.child_of, keep=keep)
            keep = [*keep, "child_position"] if keep else keep
        return map_items(items, target.fields, keep)


def target(table: str, *fields: Field | Iterable[Field], child_of: tuple[str, ...] = ()) -> TargetSpec:
    flat: list[Field] = []
    for entry in fields:
        flat.extend([entry] if isinstance(entry, Field) else entry)
    flat[0] = flat[0].needed()
    return TargetSpec(table, tuple(flat), child_of)


# The tables, their columns, types and lengths, and where each value is in an item.
# A column without a path is found under the camel-case form of its name.
NONCONFORMANCES = target(
    "nonconformances",
    first("nonconformance_id", GUID, "id", "nonconformanceId"),
    plain("number", text(50)).needed(),
    plain("site_id", GUID),
    nested("status", id=INT, description=text(100)),
    nested("assignee", id=GUID, login=text(200)),
    nested("owner", id=GUID, login=text(200)),
    plain("reported_on", AUDIT_TIME, "reported", "date"),
    plain("last_modified_on", AUDIT_TIME, "lastModified", "date"),
    plain("completed_on", AUDIT_TIME, "completed"),
)
NC_CONDITIONS = target(
    "nc_conditions",
    first("condition_id", GUID, "id", "conditionId"),
    nested("nonconformance", id=GUID),
    plain("site_id", GUID),
    plain("sequence_number", INT),
    plain("summary", text()),
    nested("status", id=INT, description=text(100)),
    nested("reject_category", id=GUID, code=text(100)),
    nested("reject_code", id=GUID, code=text(100)),
    plain("where_found", text(200)),
    plain("is_further_action_required", BOOL),
    plain("last_modified_on", AUDIT_TIME, "lastModified", "date"),
    plain("completed_on", AUDIT_TIME, "completed"),
)
NC_DISPOSITIONS = target(
    "nc_dispositions",
    first("disposition_id", GUID, "id", "dispositionId"),
    nested("nonconformance", id=GUID),
    plain("sequence_number", INT),
    nested("type", id=INT, code=text(100), description=text(200)),
    nested("status", id=INT, description=text(100)),
    nested("assignee", id=GUID),
    [plain(name, text()) for name in ("instruction", "execution_note", "verification_note", "rationale", "summary")],
    [plain(name, BOOL) for name in ("require_verification", "is_repair", "is_customer_approval_required", "is_flexible")],
    plain("last_modified_on", AUDIT_TIME, "lastModified", "date"),
)
EQUIPMENT = target(
    "equipment",
    first("equipment_id", GUID, "equipmentId", "id"),
    plain("external_id", text(100)),
    plain("itag_code", text(100), "iTagCode"),
    plain("is_active", BOOL),
    plain("calibration_vendor_id", GUID),
    plain("calibration_vendor_code", text(100)),
    plain("calibration_vendor_name", text(200)),
    [plain(f"{unit}_unit_{member}", type) for unit in ("tolerance", "accuracy", "range")
     for member, type in (("id", GUID), ("code", text(50)), ("name", text(100)))],
)
PROCESS_PLANS = target(
    "process_plans",
    first("process_plan_id", GUID, "id", "processPlanId"),
    plain("name", text(200)),
    plain("revision", text(50)),
    plain("is_latest", BOOL),
    nested("type", id=INT, description=text(100)),
    nested("status", id=INT, description=text(100)),
    nested("bom", id=GUID, name=text(200), revision=text(50)),
    nested("pedigree", id=INT, description=text(100)),
    nested("process_family", id=GUID, number=text(100)),
    [plain(name, AUDIT_TIME) for name in ("created_on", "updated_on", "released_on")],
)
PROCESS_PLAN_PRODUCTS = target(
    "process_plan_products",
    Field("process_plan_product_key", PLAN_PRODUCT_KEY, (("guid",), ("id",)), of_parent="process_plan_id", skip_empty=True),
    parent_key("process_plan_id"),
    first("product_guid", GUID, "guid", "id", skip_empty=True),
    plain("product_code", text(100), "code"),
    plain("product_revision", text(50), "revision"),
    plain("product_description", text(500), "description"),
    child_of=("products",),
)
EXECUTION_OPERATIONS = target(
    "execution_operations",
    first("operation_id", GUID, "id", "operationId"),
    plain("wip_trace_id", GUID),
    plain("wip_order_operation_id", GUID),
    plain("code_number", INT),
    plain("priority", INT),
    plain("serial_number", text(100)),
    plain("lot_number", text(100)),
    plain("description", text(500)),
    nested("status", id=INT, description=text(100)),
    nested("redline_status", id=INT, description=text(100)),
    nested("work_center", id=GUID, code=text(100)),
    plain("order_id", GUID, "wipOrder", "id"),
    plain("order_number", text(50), "wipOrder", "orderNumber"),
    nested("product", id=GUID, code=text(100), revision=text(50)),
    [plain(name, AUDIT_TIME) for name in ("created_on", "updated_on")],
)
EXECUTION_COMPONENTS = target(
    "execution_components",
    first("component_id", GUID, "id", "componentId"),
    nested("step", id=GUID),
    plain("planned_quantity", AMOUNT),
    plain("activity_type_code", text(50)),
    plain("consumption_type_code", text(50)),
    plain("product_id", GUID, "plannedProductRevision", "productId"),
    plain("product_code", text(100), "plannedProductRevision", "productCode"),
    plain("product_name", text(200), "plannedProductRevision", "productName"),
    plain("product_revision_id", GUID, "plannedProductRevision", "id"),
    plain("product_revision_code", text(50), "plannedProductRevision", "revisionCode"),
)
EXECUTION_COMPONENT_RECORDS = target(
    "execution_component_records",
    plain("record_id", GUID, "id"),
    parent_key("component_id"),
    plain("quantity", AMOUNT),
    plain("removed_quantity", AMOUNT),
    plain("reference_designator", text(200)),
    child_of=("records",),
)
WIP_TRACES = target(
    "wip_traces",
    first("wip_trace_id", GUID, "id", "wipTraceId"),
    plain("serial_number", text(100)),
    plain("lot_number", text(100)),
    nested("status", id=INT, description=text(100)),
    nested("redline_status", id=INT, description=text(100)),
    plain("order_id", GUID, "wipOrder", "id"),
    plain("order_number", text(50), "wipOrder", "orderNumber"),
    nested("product", id=GUID, code=text(100), revision=text(50)),
    [plain(name, AUDIT_TIME) for name in ("created_on", "updated_on")],
)
USERS = target(
    "users",
    first("user_id", GUID, "id", "personId", "userId"),
    plain("code", text(200)),
    plain("login", text(200)),
    plain("first_name", text(100)),
    plain("last_name", text(100)),
    plain("is_active", BOOL, "active"),
)
SKILLS = target(
    "skills",
    first("skill_id", GUID, "id", "skillId"),
    plain("code", text(100)),
    plain("name", text(200)),
    plain("is_active", BOOL, "active"),
    plain("site_id", GUID),
    plain("expiration_date_tracked", BOOL),
)
WORK_CENTERS = target(
    "work_centers",
    first("work_center_id", GUID, "id", "workCenterId"),
    plain("code", text(100)),
    plain("name", text(200)),
    plain("work_center_type", INT, "type"),
    plain("is_active", BOOL),
    nested("site", id=GUID, code=text(100), name=text(200)),
    nested("production_line", id=GUID, code=text(100)),
)
PRODUCTS = target(
    "products",
    first("product_id", GUID, "id", "productId"),
    nested("site", id=GUID),
    plain("part_number", text(100), "details", "code"),
    plain("description", text(500), "details", "name"),
    plain("is_active", BOOL, "details", "active"),
    plain("product_type", text(100), "details", "type"),
    plain("uom_code", text(50), "details", "defaultUom", "code"),
    plain("tracking", text(50), "details", "tracking"),
    plain("is_equipment", BOOL, "details", "isEquipment"),
    [plain(name, ISO_TIME) for name in ("created_on", "updated_on")],
)
PRODUCT_REVISIONS = target(
    "product_revisions",
    plain("product_revision_id", GUID, "id"),
    parent_key("product_id"),
    plain("code", text(50)),
    plain("is_active", BOOL, "active"),
    plain("is_default", BOOL),
    plain("inspection_code_id", GUID),
    plain("status", text(100), "customAttributes", "values", "status"),
    [plain(name, ISO_TIME) for name in ("created_on", "updated_on")],
    child_of=("revisions", "items"),
)
INSPECTION_CODES = target(
    "inspection_codes",
    first("inspection_code_id", GUID, "id", "inspectionCodeId"),
    plain("code", text(100)),
)
PURCHASE_ORDERS = target(
    "purchase_orders",
    plain("purchase_order_id", GUID, "guid"),
    plain("order_number", text(100)).needed(),
    plain("site_code", text(100)),
    plain("transit_site_code", text(100)),
    nested("partner", code=text(100), name=text(200)),
    plain("area_code", text(100)),
)
PURCHASE_ORDER_LINES = target(
    "purchase_order_lines",
    plain("line_id", GUID, "guid"),
    parent_key("purchase_order_id"),
    plain("order_detail_number", text(100)),
    plain("product_id", GUID, "product", "guid"),
    nested("product", code=text(100), description=text(500), revision=text(50), uom_code=text(50)),
    plain("quantity_ordered", AMOUNT),
    plain("quantity_completed", AMOUNT),
    plain("uom_code", text(50)),
    plain("due_date", ISO_TIME),
    plain("delivery_date", ISO_TIME),
    nested("status", id=INT, description=text(100)),
    plain("comment", text()),
    plain("pedigree_code", text(100)),
    plain("project_code", text(100)),
    plain("inspection_code", text(100)),
    nested("inventory_status", id=INT, description=text(100)),
    plain("under_tolerance", TOLERANCE_AMOUNT),
    plain("over_tolerance", TOLERANCE_AMOUNT),
    plain("unit_cost", AMOUNT),
    plain("currency_code", text(10), "currencyAlphabeticCode"),
    Field("line_amount", LINE_AMOUNT),
    child_of=("orderLines",),
)

# The entities in their groups. The fast ones are cheap enough to run often.
FAST = (
    EntitySpec("nonconformances", (NONCONFORMANCES,), mark_column="last_modified_on"),
    EntitySpec("conditions", (NC_CONDITIONS,), mark_column="last_modified_on"),
)
SLOW = (
    EntitySpec("dispositions", (NC_DISPOSITIONS,)),
    EntitySpec("equipment", (EQUIPMENT,)),
    EntitySpec("process_plans", (PROCESS_PLANS, PROCESS_PLAN_PRODUCTS)),
    EntitySpec("execution_operations", (EXECUTION_OPERATIONS,)),
    EntitySpec("execution_components", (EXECUTION_COMPONENTS, EXECUTION_COMPONENT_RECORDS)),
    EntitySpec("wip_traces", (WIP_TRACES,)),
    EntitySpec("users", (USERS,)),
    EntitySpec("skills", (SKILLS,)),
    EntitySpec("work_centers", (WORK_CENTERS,)),
    EntitySpec("products", (PRODUCTS, PRODUCT_REVISIONS)),
    EntitySpec("inspection_codes", (INSPECTION_CODES,)),
    EntitySpec("purchase_orders", (PURCHASE_ORDERS, PURCHASE_ORDER_LINES), single_orders=True),
)
GROUPS = {"fast": FAST, "slow": SLOW, "all": FAST + SLOW}
