"""Text helpers: reference tokens, composite keys, comparison keys, identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

GUID_SHAPE = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def reference_token(text: Column, prefix: str = "PO_", length: int = 10, case_insensitive: bool = False) -> Column:
    """The first ``prefix`` followed by exactly ``length`` alphanumerics, or NULL."""
    token = written_token(text, prefix, length, case_insensitive)
    return F.upper(token) if case_insensitive else token


def written_token(text: Column, prefix: str = "PO_", length: int = 10, case_insensitive: bool = False) -> Column:
    """The token as the text has it."""
    flag = "(?i)" if case_insensitive else ""
    return F.regexp_substr(text, F.lit(f"{flag}{re.escape(prefix)}[0-9A-Za-z]{{{length}}}"))


def concat_empty(*parts: Column) -> Column:
    """Concatenation where NULL counts as empty text (``concat`` alone would give NULL)."""
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def composite_key(*parts: Column) -> Column:
    """``a:b`` key text; a missing part is written as the word None."""
    return F.concat_ws(":", *[F.coalesce(part, F.lit("None")) for part in parts])


def guid(text: Column) -> Column:
    """Identifiers compare without case, so they are stored lower-case."""
    return F.lower(F.trim(text))


SHOWN = "_shown"


def fold_case(df: DataFrame, *columns: str) -> DataFrame:
    """Upper-case and right-trim the named columns so they compare without case and trailing blanks. The original values
    stay in columns of their own, for ``shown``."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({f"{name}{SHOWN}": F.col(name) for name in present}).withColumns(
        {name: F.upper(F.rtrim(F.col(name))) for name in present})


def shown(df: DataFrame, column: str) -> Column:
    """A column as it was before it was folded."""
    return F.col(f"{column}{SHOWN}" if f"{column}{SHOWN}" in df.columns else column)


def canonical(df: DataFrame, column: str, *listed: str) -> DataFrame:
    """Values that differ from a listed one only in case or trailing blanks, as listed; ``shown`` gives the originals."""
    df = df.withColumn(f"{column}{SHOWN}", F.col(column))
    folded = F.upper(F.rtrim(F.col(column)))
    value = F.col(column)
    for known in listed:
        value = F.when(folded == known.upper(), known).otherwise(value)
    return df.withColumn(column, value)
