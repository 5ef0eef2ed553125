"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import string
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder. Python workers are told where this library lies, in case they do not have it installed."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Text of ASCII alone takes the quick path of lower()."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def total_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column over all rows."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def numbered(docs: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """The same rows with their columns named c0, c1, ..., so that no name clashes with an operator's own, and the new
    names of the wanted columns. ``toDF(*docs.columns)`` names them back."""
    names = docs.columns
    return docs.toDF(*[f"c{i}" for i in range(len(names))]), [f"c{names.index(name)}" for name in wanted]


def with_results(docs: DataFrame, done: DataFrame, results: list[str]) -> DataFrame:
    """The columns of ``docs`` under their names, out of ``done`` that has them numbered, and the results. A column of
    ``docs`` with the name of a result gives way to it."""
    return done.select(*[done[f"c{i}"].alias(name) for i, name in enumerate(docs.columns) if name not in results], *results)


def byte_steps(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that end with the text in which they reach ``most`` bytes."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
