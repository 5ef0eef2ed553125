"""JSON items for every ingested entity, derived from the orders table, and the rows they must become.

Each field of a target gets a value expression over the order. The items are those values
written as JSON at the field's path; the expected row is the values themselves, so the oracle
never reads JSON. One in seven optional values is null, times alternate between the two audit
forms and between offsets, and keys move between their alternative names.
"""

from __future__ import annotations

import zlib

from tallyweave.operators.mapping import Field
from tallyweave.plans.entities import GROUPS, EntitySpec, TargetSpec

BASE = "(select o_orderkey as n, cast(cast(o_orderdate as date) as string) as d from orders)"
CHILDREN = (1, 2)


def _guid(n: str, name: str) -> str:
    return f"concat('{zlib.crc32(name.encode()):08x}-abcd-ef00-0000-', lpad(cast({n} as string), 12, '0'))"


def _value(field: Field, i: int, n: str) -> str:
    """The value as text, without nulls."""
    kind, sql = field.type.kind, field.type.sql
    if kind in ("guid", "composite"):
        return _guid(n, "guid" if field.name.startswith(("process_plan_product_key", "product_guid")) else field.name)
    if sql == "int":
        return f"cast({n} % 1000 + {i} as string)"
    if sql == "boolean":
        return f"case when ({n} + {i}) % 2 = 0 then 'true' else 'false' end"
    if kind == "number":
        return f"concat(cast({n} % 1000 as string), '.25')"
    if kind in ("iso", "audit"):
        return f"concat(d, case when ({n} + {i}) % 3 = 0 then 'T08:30:00Z' else 'T10:30:00+02:00' end)"
    return f"concat('value {i} of ', cast({n} as string))"


def _is_null(field: Field, i: int, n: str) -> str:
    return "false" if field.required or field.of_parent or field.name == "product_guid" else f"({n} + {i}) % 7 = 0"


def _json(field: Field, i: int, n: str, choice: int) -> str:
    """The value as a JSON token."""
    value = _value(field, i, n)
    if field.type.kind == "guid":
        value = f"upper({value})"
    token = value if field.type.kind == "number" else f"concat('\"', {value}, '\"')"
    if field.type.kind == "audit":
        token = f"case when {n} % 2 = 0 then concat('{{\"personId\":1,\"date\":', {token}, '}}') else {token} end"
    chosen = f"{n} % {len(field.paths)} = {choice}"
    return f"case when ({_is_null(field, i, n)}) or not ({chosen}) then 'null' else {token} end"


def _write(tree: dict | str) -> str:
    if isinstance(tree, str):
        return tree
    members = [f"'{',' if i else ''}\"{key}\":', {_write(value)}" for i, (key, value) in enumerate(tree.items())]
    return "concat('{', " + ", ".join(members) + ", '}')"


def _tree(target: TargetSpec, n: str) -> dict:
    tree: dict = {}
    for i, field in enumerate(target.fields):
        for choice, path in enumerate(field.paths):
            place = tree
            for step in path[:-1]:
                place = place.setdefault(step, {})
            if path[-1] not in place:
                place[path[-1]] = _json(field, i, n, choice)
    return tree


def items_sql(spec: EntitySpec) -> str:
    """Landed responses, one item each, as (n, body)."""
    tree = _tree(spec.targets[0], "n")
    for child in spec.targets[1:]:
        place = tree
        for step in child.child_of[:-1]:
            place = place.setdefault(step, {})
        elements = ", ',', ".join(_write(_tree(child, f"(n * 10 + {c})")) for c in CHILDREN)
        place[child.child_of[-1]] = f"concat('[', {elements}, ']')"
    return f"select n, concat('{{\"items\":[', {_write(tree)}, '],\"hasNext\":false}}') as body from {BASE} b"


def _expected(field: Field, i: int, n: str, parent: TargetSpec, target: TargetSpec) -> str:
    key = _guid("parent_n", parent.fields[0].name)
    if field.type.kind == "composite":
        return f"concat({key}, ':', {_value(field, i, n)})"
    if field.of_parent:
        return key
    if field.type.kind == "line_amount":
        factors = [(f, j) for j, f in enumerate(target.fields) if f.name in ("quantity_ordered", "unit_cost")]
        amount = " * ".join(f"(case when {_is_null(f, j, n)} then null else cast({n} % 1000 + 0.25 as double) end)"
                            for f, j in factors)
        return f"cast({amount} as decimal(18,4))"
    value = _value(field, i, n)
    if field.type.kind in ("iso", "audit"):
        value = "epoch_us(cast(concat(d, ' 08:30:00') as timestamp))"
    elif field.type.kind == "number":
        value = f"cast({value} as {field.type.sql})"
    return f"case when {_is_null(field, i, n)} then null else {value} end"


def expected_sql(spec: EntitySpec, target: TargetSpec) -> str:
    """The typed rows of a target; times as microseconds since 1970."""
    columns = ", ".join(f"{_expected(field, i, 'n', spec.targets[0], target)} as {field.name}"
                        for i, field in enumerate(target.fields))
    if target.child_of:
        return f"select {columns} from (select n as parent_n, n * 10 + c as n, d from {BASE} b cross join (values (1), (2)) v(c)) x"
    return f"select {columns} from (select n, n as parent_n, d from {BASE} b) x"


TARGETS = {target.table: (spec, target) for spec in GROUPS["all"] for target in spec.targets}
