"""Full copies of source relations, with their types kept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from tallyweave.functions.times import offset_text
from tallyweave.sources.versioned import VersionedStore

OFFSET_TEXT_TYPE = "varchar(50)"
_CHAR_TYPE = "__CHAR_VARCHAR_TYPE_STRING"


class EmptyRelation(ValueError):
    """A relation without columns: a wrong name, or no permission to see it."""


@dataclass(frozen=True)
class LandedColumn:
    name: str
    type: str


def probe(df: DataFrame, name: str, offset_columns: Sequence[str] = ()) -> list[LandedColumn]:
    """The ordered columns and their landed types. Text keeps its length and decimals their
    precision; the columns named as times with an offset land as text; all others keep their own type."""
    columns = []
    for field in df.schema.fields:
        if field.name in offset_columns:
            landed = OFFSET_TEXT_TYPE
        else:
            landed = (field.metadata or {}).get(_CHAR_TYPE) or field.dataType.simpleString()
        columns.append(LandedColumn(field.name, landed))
    if not columns:
        raise EmptyRelation(f"no columns found for {name} - check the name and the permissions")
    return columns


def land_types(df: DataFrame, offset_columns: Sequence[str] = ()) -> DataFrame:
    """The columns as they are stored. A time with an offset should come as text, cast in the source's select list, and
    keeps its offset then; one that comes as an instant has lost it and is written in UTC."""
    instants = [f.name for f in df.schema.fields if f.name in offset_columns and isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: offset_text(F.col(f"`{name}`")) for name in instants}) if instants else df


def snapshot_copy(store: VersionedStore, sources: Mapping[str, DataFrame],
                  offset_columns: Mapping[str, Sequence[str]] | None = None) -> dict[str, int]:
    """Replace each target by its source, one commit per relation. An error stops the rest, but
    the failing relation keeps its previous content. ``offset_columns`` names each relation's times with an offset."""
    counts = {}
    for name, source in sources.items():
        own = (offset_columns or {}).get(name, ())
        probe(source, name, own)
        with store.commit() as change:
            counts[name] = change.replace(name, land_types(source, own))
    return counts


def select_list(relation: str, columns: Sequence[str], offset_columns: Sequence[str] = ()) -> str:
    """A subquery for ``jdbc_relation`` that reads times with an offset as text, so that the offset survives."""
    chosen = [f"CAST({name} AS {OFFSET_TEXT_TYPE}) AS {name}" if name in offset_columns else name for name in columns]
    return f"(SELECT {', '.join(chosen)} FROM {relation}) landed"


def jdbc_relation(spark: SparkSession, url: str, relation: str, *, properties: Mapping[str, str] | None = None,
                  partition_column: str | None = None, lower: object = None, upper: object = None,
                  partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """A reader of a database relation. With a partition column and its bounds, the executors read
    ranges of it side by side; rows outside the bounds go to the first and last range. Times without an offset are read as
    such and not as instants."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=relation, fetchsize=str(fetch_size), preferTimestampNTZ="true", **(properties or {}))
    if partition_column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned read needs lower, upper and partitions")
        reader = reader.options(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                                numPartitions=str(partitions))
    return reader.load()
