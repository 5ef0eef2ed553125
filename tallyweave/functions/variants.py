"""Reading scalars, objects and arrays out of VARIANT columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

PathStep = str


def json_path(*steps: PathStep) -> str:
    return "$" + "".join(f".{step}" for step in steps)


# The setting by which Spark reads an object that repeats a key, as most readers do: the last value counts.
LAST_KEY_WINS = "spark.sql.variant.allowDuplicateKeys"
# A number outside texts; each match begins where the one before ended, so quotes are always seen in pairs.
_NUMBER = r'\G((?:[^"0-9\-]++|"(?:[^"\\]++|\\.)*+")*+)(-?[0-9][0-9.eE+\-]*+)'
_MARK = "\ue000"


def parse(text: Column) -> Column:
    """JSON text to VARIANT; NULL where the text is not JSON."""
    return F.try_parse_json(text)


def with_parsed(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the VARIANT of a JSON text. Of a repeated key the last value counts: a session setting that Spark reads when the
    column is resolved, and which stays on."""
    df.sparkSession.conf.set(LAST_KEY_WINS, "true")
    return df.withColumn(name, parse(F.col(text)))


# How a number may begin that is spelled in more ways than one: with a point, an exponent or a negative zero. Texts may match as well.
_SPELLING = r"(?:^|[:,\[])\s*+(?:-0|-?[0-9]++[.eE])"


def can_mark(text: Column) -> Column:
    """Whether numbers are to be marked: some may be spelled in more ways than one, and the mark does not occur in the text itself."""
    return text.rlike(_SPELLING) & ~text.contains(_MARK) & ~F.lower(text).contains(r"\ue000")


def marked_numbers(text: Column, marked: Column) -> Column:
    """JSON text with its numbers as marked texts, which Spark's JSON functions copy as they are spelled, where ``marked``."""
    return F.when(marked, F.regexp_replace(text, _NUMBER, f'$1"{_MARK}$2"')).otherwise(text)


def unmarked_numbers(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, f'"{_MARK}([^"]*)"', "$1"), f"^{_MARK}", "")


def element_texts(marked: Column, key: str | None = None) -> Column:
    """The items of a JSON array, or of the array under ``key``, as texts with marked numbers: repeated keys, the order of keys
    and the spelling of numbers are kept; white space and escapes are written in one way. NULL for anything else."""
    if key is None:
        return F.from_json(marked, "array<string>")
    return F.from_json(marked, StructType().add(key, ArrayType(StringType())))[key]


def spelled(value: Column, text: Column, marked: Column) -> Column:
    """The JSON text of an item: as it was written, or for a text in quotes. ``marked``: whether its numbers are marked."""
    own = F.to_json(value)  # costly: only for what is no object, or has no text
    written = F.coalesce(F.when(marked, unmarked_numbers(text)).otherwise(text), own)
    return F.when(is_object(value), written).when(own.startswith('"'), own).otherwise(written)


def is_malformed(text: Column, parsed: Column) -> Column:
    """True for text that is present but is not JSON, so it can go to a reject output."""
    return text.isNotNull() & parsed.isNull()


def node(value: Column, *steps: PathStep) -> Column:
    """The VARIANT under a path. A missing step is NULL, a JSON null is a (non-NULL) variant null."""
    return F.try_variant_get(value, json_path(*steps), "variant")


def has_value(value: Column, *steps: PathStep) -> Column:
    """True when the path leads to anything but a JSON null."""
    found = node(value, *steps)
    return found.isNotNull() & ~F.coalesce(F.is_variant_null(found), F.lit(True))


def has_key(value: Column, key: PathStep) -> Column:
    """True when the key is present, even if its value is null."""
    return node(value, key).isNotNull()


def text_at(value: Column, *steps: PathStep) -> Column:
    """The text under a path. Objects and arrays give their JSON text; see ``scalar_only``."""
    return F.try_variant_get(value, json_path(*steps), "string")


def scalar_only(text: Column, value: Column, *steps: PathStep) -> Column:
    """``text``, unless it is the JSON text of an object or array found at the path; then NULL.

    The type is looked up only for text that could be such JSON.
    """
    container = F.schema_of_variant(node(value, *steps)).rlike("^(OBJECT|ARRAY)")
    return F.when(text.startswith("{") | text.startswith("["), F.when(~container, text)).otherwise(text)


def read_scalars(df: DataFrame, value: str, paths: Mapping[str, Sequence[PathStep]]) -> DataFrame:
    """Add a column with the scalar text of each path.

    Two projections, so that each path is read once although the check refers to it twice:
    Spark keeps a projection apart when a later one uses its costly columns repeatedly.
    """
    texts = df.select("*", *[text_at(F.col(value), *steps).alias(name) for name, steps in paths.items()])
    return texts.withColumns({
        name: scalar_only(F.col(name), F.col(value), *steps) for name, steps in paths.items()
    })


def typed(value: Column, dtype: str, *steps: PathStep) -> Column:
    """A scalar read as ``dtype``; NULL when the path is missing or the value does not fit."""
    return F.try_variant_get(value, json_path(*steps), dtype)


def read_once(value: Column, types: Mapping[tuple[PathStep, ...], str]) -> tuple[Column, Callable[[Column, tuple[PathStep, ...]], Column]]:
    """The values under many paths in one walk over the VARIANT: a struct, and a function from that struct (as a column) and a path to the path's
    value. Each value is what ``typed`` gives, and NULL where it does not fit. A path that begins another one cannot be read in the same walk."""
    if len({*types} | {path[:n] for path in types for n in range(1, len(path))}) != len(types) + len({path[:n] for path in types for n in range(1, len(path))}):
        raise ValueError("a path begins another one")
    tree: dict = {}
    for path, dtype in types.items():
        place = tree
        for step in path[:-1]:
            place = place.setdefault(step, {})
        place[path[-1]] = dtype

    def spelled_type(part: dict | str) -> str:
        return part if isinstance(part, str) else "struct<" + ",".join(f"`{key}`:{spelled_type(own)}" for key, own in part.items()) + ">"

    def at(struct: Column, path: tuple[PathStep, ...]) -> Column:
        for step in path:
            struct = struct.getField(step)
        return struct

    return F.try_variant_get(value, "$", spelled_type(tree)), at


def is_object(value: Column) -> Column:
    """Whether the VARIANT is a JSON object, without writing it as text."""
    return F.try_variant_get(value, "$", "struct<`_`:boolean>").isNotNull()


def elements(value: Column, *steps: PathStep) -> Column:
    """The items of an array as ``array<variant>``; NULL for anything that is not an array."""
    return F.try_variant_get(value, json_path(*steps), "array<variant>")
