"""Time parsing and formatting. Times without an offset are UTC whatever the session zone is."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, functions as F

_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
_ISO_BASIC_DATE = r"^\d{8}$"
_ISO_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
_WITHOUT_SECONDS = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(Z|[+-].*)?$"
# What a plain cast reads as it is: seconds, a point and an offset.
_COMPLETE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})$"
_HAS_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def parse_iso(text: Column) -> Column:
    """ISO text to a timestamp; empty or unreadable text is NULL, a missing offset means UTC.

    The shape is checked first because a plain cast also accepts bare years, year-months and
    times of day. Week dates and hours without minutes are read as NULL.
    """
    value = F.trim(text)
    dashed = F.regexp_replace(value, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    instant = F.translate(F.regexp_replace(value, _WITHOUT_SECONDS, "$1:00$2"), ",", ".")
    zoned = F.when(instant.rlike(_HAS_OFFSET), instant).otherwise(F.concat(instant, F.lit("Z")))
    return (
        F.when(value.rlike(_COMPLETE), value.try_cast("timestamp"))
        .when(value.rlike(_ISO_TIME), zoned.try_cast("timestamp"))
        .when(value.rlike(_ISO_DATE) | value.rlike(_ISO_BASIC_DATE),
              F.concat(dashed, F.lit("T00:00:00Z")).try_cast("timestamp"))
    )


def safe_date(text: Column) -> Column:
    """Text to a date, ignoring any time and offset; unreadable text is NULL."""
    return text.try_cast("date")


def offset_text(instant: Column) -> Column:
    """A zoned time as ``yyyy-MM-dd HH:mm:ss.fffffff ±hh:mm`` text."""
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS'0' xxx")


def to_millis(time: Column) -> Column:
    """A time rounded (not cut) to the millisecond. Plain arithmetic, so the session zone plays no part."""
    shifted = time + F.expr("interval 500 microseconds")
    return shifted - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), shifted) % F.lit(Decimal("0.001")))


def utc_datetime(value: dt.datetime) -> dt.datetime:
    """A Python time in UTC; times without a zone are taken as UTC already."""
    if value.tzinfo is None:
        return value.replace(tzinfo=dt.timezone.utc)
    return value.astimezone(dt.timezone.utc)


def mark_text(value: dt.datetime) -> str:
    """The text form of a high-water mark, always UTC."""
    return utc_datetime(value).isoformat()


def instant_literal(value: dt.datetime) -> Column:
    """A timestamp literal that does not depend on the session or the host zone."""
    micros = (utc_datetime(value) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def as_date(value: dt.date | None) -> Column:
    """The ``as_of`` parameter of a report as a date column; None means today."""
    return F.current_date() if value is None else F.lit(value).cast("date")
