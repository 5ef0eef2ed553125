"""Typed rows from JSON items, driven by a declaration of fields."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions import texts, times, variants
from tallyweave.functions.amounts import API_AMOUNT, TOLERANCE, line_amount
from tallyweave.operators.checks import out_of_range

ITEM = "item"
VIOLATIONS = "violations"
READ = "_read"


@dataclass(frozen=True)
class FieldType:
    """``kind`` says how the value is read, ``sql`` is the column type, ``limit`` the longest text."""

    kind: str
    sql: str
    limit: int | None = None


def text(limit: int | None = None) -> FieldType:
    return FieldType("text", "string", limit)


GUID = FieldType("guid", "string")
INT = FieldType("number", "int")
AMOUNT = FieldType("number", API_AMOUNT)
TOLERANCE_AMOUNT = FieldType("number", TOLERANCE)
BOOL = FieldType("number", "boolean")
ISO_TIME = FieldType("iso", "timestamp")
AUDIT_TIME = FieldType("audit", "timestamp")
PLAN_PRODUCT_KEY = FieldType("composite", "string", 160)
LINE_AMOUNT = FieldType("line_amount", API_AMOUNT)
AMOUNT_FACTORS = ("quantity_ordered", "unit_cost")


def camel(name: str) -> str:
    """``last_modified_on`` to ``lastModifiedOn``."""
    head, *rest = name.split("_")
    return head + "".join(word.capitalize() for word in rest)


@dataclass(frozen=True)
class Field:
    """A target column and the paths that may hold it; the first path that is not null wins.

    ``of_parent`` fields are copied from the parent row. ``skip_empty`` lets an empty text count
    as missing when choosing between paths.
    """

    name: str
    type: FieldType
    paths: tuple[tuple[str, ...], ...] = ()
    required: bool = False
    of_parent: str | None = None
    skip_empty: bool = False

    def needed(self) -> Field:
        return replace(self, required=True)


def plain(name: str, type: FieldType, *path: str) -> Field:
    """A field at ``path``; without one, at the camel-case form of its name."""
    return Field(name, type, (path or (camel(name),),))


def first(name: str, type: FieldType, *keys: str, skip_empty: bool = False) -> Field:
    return Field(name, type, tuple((key,) for key in keys), skip_empty=skip_empty)


def nested(parent: str, **members: FieldType) -> list[Field]:
    """Members of an object: ``status`` with ``id`` gives ``status_id`` at ``status.id``."""
    return [Field(f"{parent}_{name}", type, ((camel(parent), camel(name)),)) for name, type in members.items()]


def parent_key(name: str) -> Field:
    """The key of the parent row; every child has one."""
    return Field(name, GUID, of_parent=name, required=True)


def map_items(items: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """Rows with the declared columns, ``keep``, and the array ``violations``.

    A violation names a column whose value does not fit its type or length, or is missing
    although required. Rows are never dropped here. The item is walked once; what a path needs besides is looked up only where the walk found nothing.
    """
    item = F.col(ITEM)
    texts_at: dict[str, tuple[str, ...]] = {}
    wanted: dict[tuple[str, ...], str] = {}  # read in one walk over the item
    for field in fields:
        for i, path in enumerate(field.paths):
            if field.type.kind != "number":
                texts_at[f"_{field.name}_{i}"] = path
                if field.type.kind == "audit":
                    texts_at[f"_{field.name}_{i}_date"] = (*path, "date")
            elif wanted.setdefault(path, field.type.sql) != field.type.sql:
                wanted[path] = ""
    for path in texts_at.values():
        wanted[path] = "string" if wanted.get(path, "string") == "string" else ""
    begun = {path[:n] for path in wanted for n in range(1, len(path))}
    wanted = {path: dtype for path, dtype in wanted.items() if dtype and path not in begun}
    walk, at = variants.read_once(item, wanted) if wanted else (F.lit(None).cast("string"), None)

    def read(path: tuple[str, ...], dtype: str) -> Column:
        return at(F.col(READ), path) if wanted.get(path) == dtype else variants.typed(item, dtype, *path)

    parents = [F.col(field.of_parent).alias(f"_parent_{field.name}") for field in fields if field.of_parent]
    rows = items.select(*dict.fromkeys([ITEM, *keep]), *parents, walk.alias(READ))
    found: dict[str, Column] = {}
    for name, path in texts_at.items():
        dated = (*path, "date")  # what has a date is an object, which is no text: it is not written as one
        found[name] = (F.when(read(dated, "string").isNull(), variants.text_at(item, *path))
                       if wanted.get(path) != "string" and wanted.get(dated) == "string" else read(path, "string"))
    for field in fields:
        for i, path in enumerate(field.paths):
            if field.type.kind == "number":
                found[f"_{field.name}_{i}"] = read(path, field.type.sql)
    if any(field.type is LINE_AMOUNT for field in fields):
        found |= {f"_factor_{name}": read((camel(name),), "double") for name in AMOUNT_FACTORS}
    rows = rows.withColumns(found) if found else rows
    rows = rows.withColumns({name: variants.scalar_only(F.col(name), item, *path) for name, path in texts_at.items()}) if texts_at else rows

    columns, rules = [], []
    for field in fields:
        value, given = _value(field)
        columns.append(value.alias(field.name))
        rules += _rules(field, value, given)
    violations = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    return rows.select(*keep, *columns, violations.alias(VIOLATIONS))


def _value(field: Field) -> tuple[Column, Column]:
    """The typed value, and a column that is NULL only where nothing was given."""
    kind = field.type.kind
    if kind == "composite":
        value = texts.composite_key(F.col(f"_parent_{field.name}"), texts.guid(_chosen(field)))
        return value, value
    if field.of_parent:
        value = F.col(f"_parent_{field.name}")
        return value, value
    if kind == "line_amount":
        factors = [F.col(f"_factor_{name}") for name in AMOUNT_FACTORS]
        return line_amount(*factors), factors[0] * factors[1]
    if kind == "number":
        value = F.coalesce(*[F.col(f"_{field.name}_{i}") for i in range(len(field.paths))])
        given = F.lit(False)  # looked up only where there is no value
        for path in field.paths:
            given = given | variants.has_value(F.col(ITEM), *path)
        return value, F.when(value.isNotNull() | given, F.lit(True))
    chosen = _chosen(field)
    if kind == "guid":
        return texts.guid(chosen), chosen
    if kind == "iso":
        return times.parse_iso(chosen), chosen
    if kind == "audit":
        return times.parse_iso(F.coalesce(chosen, F.col(f"_{field.name}_0_date"))), chosen
    return chosen, chosen


def _chosen(field: Field) -> Column:
    candidates = [F.col(f"_{field.name}_{i}") for i in range(len(field.paths))]
    if field.skip_empty:
        candidates = [F.when(c != "", c) for c in candidates[:-1]] + candidates[-1:]
    return F.coalesce(*candidates)


def _rules(field: Field, value: Column, given: Column) -> list[Column]:
    rules = []
    if field.required:
        rules.append(F.when(value.isNull(), F.lit(f"{field.name} is null")))
    if field.type.kind == "guid" and not field.of_parent:
        rules.append(F.when(~value.rlike(texts.GUID_SHAPE), F.lit(f"{field.name} is not a guid")))
    if field.type.kind in ("number", "line_amount"):
        rules.append(F.when(out_of_range(given, value), F.lit(f"{field.name} is not a {field.type.sql}")))
    if field.type.limit:
        rules.append(F.when(F.length(value) > field.type.limit, F.lit(f"{field.name} is longer than {field.type.limit}")))
    return rules


def explode_children(parents: DataFrame, key: Field, *path: str, keep: Sequence[str] = ()) -> DataFrame:
    """The items of a child array, each with its ``child_position``, ``keep``, and the key of its parent in the column ``key.name``."""
    keyed = map_items(parents, [key], keep=[ITEM, *keep])
    return keyed.select(
        key.name, *keep, F.posexplode(variants.elements(F.col(ITEM), *path)).alias("child_position", ITEM),
    )
