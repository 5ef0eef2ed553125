"""One item per entity, written by hand, and the rows that it must become. Nothing here reads the declarations under test."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import envelope
from tallyweave.plans.entities import GROUPS

BY_NAME = {spec.name: spec for spec in GROUPS["all"]}


def g(n):
    return f"abcdef00-0000-4000-8000-{n:012d}"


def at(text):
    return dt.datetime.fromisoformat(text)


ITEMS = {
    "nonconformances": {
        "id": g(1).upper(), "nonconformanceId": g(2), "number": "NC-1", "siteId": g(3), "status": {"id": 4, "description": "Open"},
        "assignee": {"id": g(5), "login": "ann"}, "owner": {"id": g(6), "login": "bob"}, "reported": {"date": "2024-01-02T03:04:05Z", "personId": g(7)},
        "lastModified": {"date": "2024-01-03T00:00:00+02:00"}, "completed": {"personId": g(7), "date": "2024-01-04"}},
    "conditions": {
        "conditionId": g(1), "nonconformance": {"id": g(2)}, "siteId": g(3), "sequenceNumber": 4, "summary": "bent", "status": {"id": 5, "description": "New"},
        "rejectCategory": {"id": g(6), "code": "CAT"}, "rejectCode": {"id": g(7), "code": "RC"}, "whereFound": "dock", "isFurtherActionRequired": True,
        "lastModified": {"date": "2024-01-02T03:04:05Z"}, "completed": "2024-01-03T00:00:00Z"},
    "dispositions": {
        "id": None, "dispositionId": g(1), "nonconformance": {"id": g(2)}, "sequenceNumber": 3, "type": {"id": 4, "code": "T", "description": "Type"},
        "status": {"id": 5, "description": "Done"}, "assignee": {"id": g(6), "login": "not read"}, "instruction": "cut", "executionNote": "e", "verificationNote": "v",
        "rationale": "r", "summary": "s", "requireVerification": False, "isRepair": True, "isCustomerApprovalRequired": False, "isFlexible": True,
        "lastModified": {"date": "2024-01-02T03:04:05Z"}},
    "equipment": {
        "equipmentId": g(1), "id": g(2), "externalId": "EX", "iTagCode": "TAG", "isActive": True, "calibrationVendorId": g(3), "calibrationVendorCode": "CV",
        "calibrationVendorName": "Vendor", "toleranceUnitId": g(4), "toleranceUnitCode": "tu", "toleranceUnitName": "tol", "accuracyUnitId": g(5),
        "accuracyUnitCode": "au", "accuracyUnitName": "acc", "rangeUnitId": g(6), "rangeUnitCode": "ru", "rangeUnitName": "ran"},
    "process_plans": {
        "id": g(1), "name": "Plan", "revision": "B", "isLatest": True, "type": {"id": 2, "description": "Make"}, "status": {"id": 3, "description": "Live"},
        "bom": {"id": g(4), "name": "Bom", "revision": "A"}, "pedigree": {"id": 5, "description": "Flight"}, "processFamily": {"id": g(6), "number": "PF"},
        "createdOn": {"date": "2024-01-02T03:04:05Z"}, "updatedOn": "2024-01-03T00:00:00Z", "releasedOn": "no date",
        "products": [{"guid": g(7), "id": g(8), "code": "P", "revision": "R", "description": "D"}, {"guid": "", "id": g(9)}]},
    "execution_operations": {
        "operationId": g(1), "wipTraceId": g(2), "wipOrderOperationId": g(3), "codeNumber": 10, "priority": 2, "serialNumber": "SN", "lotNumber": "LOT",
        "description": "drill", "status": {"id": 4, "description": "Run"}, "redlineStatus": {"id": 5, "description": "None"}, "workCenter": {"id": g(6), "code": "WC"},
        "wipOrder": {"id": g(7), "orderNumber": "WO"}, "product": {"id": g(8), "code": "P", "revision": "R"}, "createdOn": "2024-01-02T03:04:05Z", "updatedOn": None},
    "execution_components": {
        "id": g(1), "step": {"id": g(2)}, "plannedQuantity": 1.5, "activityTypeCode": "ACT", "consumptionTypeCode": "CON",
        "plannedProductRevision": {"productId": g(3), "productCode": "PC", "productName": "PN", "id": g(4), "revisionCode": "RV"},
        "records": [{"id": g(5), "quantity": 2, "removedQuantity": 0.25, "referenceDesignator": "R1"}]},
    "wip_traces": {
        "wipTraceId": g(1), "serialNumber": "SN", "lotNumber": "LOT", "status": {"id": 2, "description": "Run"}, "redlineStatus": {"id": 3, "description": "None"},
        "wipOrder": {"id": g(4), "orderNumber": "WO"}, "product": {"id": g(5), "code": "P", "revision": "R"}, "createdOn": {"date": "2024-01-02T03:04:05Z"},
        "updatedOn": "2024-01-03T00:00:00Z"},
    "users": {"userId": g(3), "personId": g(2), "code": "C", "login": "ann", "firstName": "Ann", "lastName": "Lee", "active": True, "isActive": False},
    "skills": {"skillId": g(1), "code": "C", "name": "N", "active": False, "siteId": g(2), "expirationDateTracked": True},
    "work_centers": {
        "workCenterId": g(1), "code": "C", "name": "N", "type": 7, "isActive": True, "site": {"id": g(2), "code": "SC", "name": "SN"},
        "productionLine": {"id": g(3), "code": "PL"}},
    "products": {
        "productId": g(1), "site": {"id": g(2)}, "details": {"code": "PN", "name": "Desc", "active": True, "type": "Make", "defaultUom": {"code": "EA"}, "tracking": "Serial",
                                                             "isEquipment": False},
        "createdOn": "2024-01-02T03:04:05Z", "updatedOn": {"date": "2024-01-03T00:00:00Z"},
        "revisions": {"items": [{"id": g(3), "code": "A", "active": True, "isDefault": False, "inspectionCodeId": g(4), "customAttributes": {"values": {"status": "Released"}},
                                 "createdOn": "2024-01-02T03:04:05Z", "updatedOn": None}]}},
    "inspection_codes": {"inspectionCodeId": g(1), "code": "IC"},
    "purchase_orders": {
        "guid": g(1), "orderNumber": "PO", "siteCode": "S", "transitSiteCode": "TS", "partner": {"code": "PC", "name": "PN"}, "areaCode": "AR",
        "orderLines": [{
            "guid": g(2), "orderDetailNumber": "1", "product": {"guid": g(3), "code": "C", "description": "D", "revision": "R", "uomCode": "EA"}, "quantityOrdered": 3,
            "quantityCompleted": 1, "uomCode": "BX", "dueDate": "2024-01-02", "deliveryDate": "2024-01-03T00:00:00Z", "status": {"id": 4, "description": "Open"},
            "comment": "x", "pedigreeCode": "PE", "projectCode": "PR", "inspectionCode": "IN", "inventoryStatus": {"id": 5, "description": "OK"}, "underTolerance": 0.5,
            "overTolerance": 1, "unitCost": 1.25, "currencyAlphabeticCode": "EUR"}]},
}

SECOND, MIDNIGHT = at("2024-01-02T03:04:05+00:00"), at("2024-01-03T00:00:00+00:00")
ROWS = {
    "nonconformances": [(g(1), "NC-1", g(3), 4, "Open", g(5), "ann", g(6), "bob", SECOND, at("2024-01-02T22:00:00+00:00"), at("2024-01-04T00:00:00+00:00"))],
    "nc_conditions": [(g(1), g(2), g(3), 4, "bent", 5, "New", g(6), "CAT", g(7), "RC", "dock", True, SECOND, MIDNIGHT)],
    "nc_dispositions": [(g(1), g(2), 3, 4, "T", "Type", 5, "Done", g(6), "cut", "e", "v", "r", "s", False, True, False, True, SECOND)],
    "equipment": [(g(1), "EX", "TAG", True, g(3), "CV", "Vendor", g(4), "tu", "tol", g(5), "au", "acc", g(6), "ru", "ran")],
    "process_plans": [(g(1), "Plan", "B", True, 2, "Make", 3, "Live", g(4), "Bom", "A", 5, "Flight", g(6), "PF", SECOND, MIDNIGHT, None)],
    "process_plan_products": [(f"{g(1)}:{g(7)}", g(1), g(7), "P", "R", "D"), (f"{g(1)}:{g(9)}", g(1), g(9), None, None, None)],
    "execution_operations": [(g(1), g(2), g(3), 10, 2, "SN", "LOT", "drill", 4, "Run", 5, "None", g(6), "WC", g(7), "WO", g(8), "P", "R", SECOND, None)],
    "execution_components": [(g(1), g(2), Decimal("1.5000"), "ACT", "CON", g(3), "PC", "PN", g(4), "RV")],
    "execution_component_records": [(g(5), g(1), Decimal("2.0000"), Decimal("0.2500"), "R1")],
    "wip_traces": [(g(1), "SN", "LOT", 2, "Run", 3, "None", g(4), "WO", g(5), "P", "R", SECOND, MIDNIGHT)],
    "users": [(g(2), "C", "ann", "Ann", "Lee", True)],
    "skills": [(g(1), "C", "N", False, g(2), True)],
    "work_centers": [(g(1), "C", "N", 7, True, g(2), "SC", "SN", g(3), "PL")],
    "products": [(g(1), g(2), "PN", "Desc", True, "Make", "EA", "Serial", False, SECOND, None)],
    "product_revisions": [(g(3), g(1), "A", True, False, g(4), "Released", SECOND, None)],
    "inspection_codes": [(g(1), "IC")],
    "purchase_orders": [(g(1), "PO", "S", "TS", "PC", "PN", "AR")],
    "purchase_order_lines": [(g(2), g(1), "1", g(3), "C", "D", "R", "EA", Decimal("3.0000"), Decimal("1.0000"), "BX", at("2024-01-02T00:00:00+00:00"), MIDNIGHT, 4, "Open",
                              "x", "PE", "PR", "IN", 5, "OK", Decimal("0.5"), Decimal("1"), Decimal("1.2500"), "EUR", Decimal("3.7500"))],
}



@pytest.mark.parametrize("name", sorted(ITEMS))
def test_item_becomes_its_rows(spark, name):
    spec = BY_NAME[name]
    body = json.dumps(ITEMS[name] if spec.single_orders else {"items": [ITEMS[name]], "hasNext": False})
    items = envelope.unnest(spark.createDataFrame([(body,)], "body string"), items_key=spec.items_key, single_orders=spec.single_orders)
    for target in spec.targets:
        mapped = spec.map(items, target)
        assert [row["violations"] for row in mapped.collect()] == [[]] * len(ROWS[target.table])
        times = {c: F.unix_micros(c) for c, kind in mapped.dtypes if kind == "timestamp"}
        got = [tuple(row) for row in mapped.withColumns(times).drop("violations").collect()]
        expected = [tuple(int(v.timestamp() * 1_000_000) if isinstance(v, dt.datetime) else v for v in row) for row in ROWS[target.table]]
        assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_every_entity_and_target_has_an_item():
    assert set(ITEMS) == set(BY_NAME) and set(ROWS) == {target.table for spec in BY_NAME.values() for target in spec.targets}
