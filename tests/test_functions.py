from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave.functions import texts, times, variants
from tallyweave.functions.amounts import line_amount


def one(spark, column, **given):
    fields = ", ".join(f"{name} string" for name in given)
    return spark.createDataFrame([tuple(given.values())], fields).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("memo, expected", [
    ("pay PO_0000000001 and PO_0000000002", "PO_0000000001"),
    ("PO_123456789", None),
    ("xPO_123456789012", "PO_1234567890"),
    ("nothing", None),
    ("", None),
    (None, None),
    ("po_0000000001", None),
    ("PO_12345-7890", None),
])
def test_reference_token(spark, memo, expected):
    assert one(spark, texts.reference_token(F.col("m")), m=memo) == expected


def test_reference_token_options(spark):
    assert one(spark, texts.reference_token(F.col("m"), case_insensitive=True), m="po_abcdefghij") == "PO_ABCDEFGHIJ"
    assert one(spark, texts.reference_token(F.col("m"), prefix="A+B", length=2), m="A+B12") == "A+B12"


@pytest.mark.parametrize("text, expected", [
    ("2024-01-05T10:00:00Z", "2024-01-05T10:00:00"),
    ("2024-01-05T10:00:00+02:00", "2024-01-05T08:00:00"),
    ("2024-01-05T10:00:00-0530", "2024-01-05T15:30:00"),
    ("2024-01-05T10:00Z", "2024-01-05T10:00:00"),
    ("2024-01-05 10:00", "2024-01-05T10:00:00"),
    ("2024-01-05T10:00:00,5Z", "2024-01-05T10:00:00.500000"),
    ("2024-01-05T10:00:00.1234567Z", "2024-01-05T10:00:00.123456"),
    (" 2024-01-05 ", "2024-01-05T00:00:00"),
    ("20240105", "2024-01-05T00:00:00"),
    ("2024", None), ("2024-01", None), ("T10:00", None), ("10:00", None), ("", None), ("junk", None),
    ("2024-13-05", None), ("2024-02-30T00:00:00Z", None), (None, None),
])
def test_parse_iso(spark, text, expected):
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            micros = one(spark, F.unix_micros(times.parse_iso(F.col("t"))), t=text)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        wanted = None if expected is None else (
            dt.datetime.fromisoformat(expected) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert micros == wanted


def test_audit_text_takes_text_or_object(spark):
    for body, expected in [
        ('{"x":"2024-01-05"}', "2024-01-05"), ('{"x":{"personId":1,"date":"2024-01-06"}}', "2024-01-06"),
        ('{"x":{"personId":1}}', None), ('{"x":null}', None), ("{}", None),
    ]:
        df = spark.createDataFrame([(body,)], "body string").select(variants.parse(F.col("body")).alias("v"))
        read = variants.read_scalars(df, "v", {"plain": ("x",), "inner": ("x", "date")})
        assert read.select(F.coalesce("plain", "inner")).first()[0] == expected


def test_scalars_only(spark):
    body = '{"o":{"a":1},"l":[1],"t":"{not json","n":1.5,"b":false,"e":"","z":null,"s":{"i":7}}'
    df = spark.createDataFrame([(body,)], "body string").select(variants.parse(F.col("body")).alias("v"))
    paths = {name: (name,) for name in "oltnbez"} | {"si": ("s", "i"), "ti": ("t", "i"), "missing": ("q",)}
    row = variants.read_scalars(df, "v", paths).drop("v").first().asDict()
    assert row == {"o": None, "l": None, "t": "{not json", "n": "1.5", "b": "false", "e": "", "z": None,
                   "si": "7", "ti": None, "missing": None}


def test_malformed_and_presence(spark):
    df = spark.createDataFrame([("{",), (None,), ("{}",), ('{"guid":null}',)], "body string")
    v = variants.parse(F.col("body"))
    rows = df.select(variants.is_malformed(F.col("body"), v), variants.has_key(v, "guid"), variants.has_value(v, "guid")).collect()
    assert [tuple(row) for row in rows] == [
        (True, False, False), (False, False, False), (False, False, False), (False, True, False),
    ]


def test_keys_and_concat(spark):
    assert one(spark, texts.composite_key(F.col("a"), F.col("b")), a="p", b=None) == "p:None"
    assert one(spark, texts.concat_empty(F.lit("X:"), F.col("a")), a=None) == "X:"
    assert one(spark, texts.guid(F.col("a")), a=" AB ") == "ab"


def test_dates_and_offsets(spark):
    assert one(spark, times.safe_date(F.col("t")), t="2024-01-05 23:30:00.0000000 -05:00") == dt.date(2024, 1, 5)
    assert one(spark, times.safe_date(F.col("t")), t="01/05/2024") is None
    text = one(spark, times.offset_text(F.col("t").cast("timestamp")), t="2024-01-05T10:00:00.123456Z")
    assert text == "2024-01-05 10:00:00.1234560 +00:00"
    assert times.mark_text(dt.datetime(2024, 1, 5)) == "2024-01-05T00:00:00+00:00"
    aware = dt.datetime(2024, 1, 5, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert times.mark_text(aware) == "2024-01-05T00:00:00+00:00"


def test_line_amount(spark):
    df = spark.createDataFrame([(2.0, 1.00005), (None, 1.0), (1.0, None)], "q double, c double")
    assert [row[0] for row in df.select(line_amount(F.col("q"), F.col("c"))).collect()] == [Decimal("2.0001"), None, None]


@pytest.mark.parametrize("given, expected", [
    ("10:00:00.0014999", "10:00:00.001"), ("10:00:00.0015", "10:00:00.002"), ("10:00:59.9996", "10:01:00"), ("10:00:00", "10:00:00"),
])
def test_to_millis(spark, given, expected):
    row = spark.range(1).select(times.to_millis(F.lit(f"2024-01-05 {given}").cast("timestamp_ntz"))).first()
    assert row[0] == dt.datetime.fromisoformat(f"2024-01-05T{expected}")
