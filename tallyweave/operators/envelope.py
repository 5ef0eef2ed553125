"""Landed response bodies to items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tallyweave.functions import variants

ITEMS_KEY = "items"


def with_body(pages: DataFrame, body: str = "body") -> DataFrame:
    """Parse the response text once, into the column ``_body``."""
    return variants.with_parsed(pages, body, "_body")


def malformed_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Responses that are not JSON."""
    return with_body(pages, body).filter(variants.is_malformed(F.col(body), F.col("_body"))).drop("_body")


def envelope_items(body: Column, items_key: str = ITEMS_KEY) -> Column:
    """A list is its items; an object holds them under ``items_key``; anything else has none."""
    return F.coalesce(variants.elements(body), variants.elements(body, items_key))


def order_items(body: Column, items_key: str = ITEMS_KEY) -> Column:
    """An object with a ``guid`` key, even a null one, is a single item; otherwise as any envelope."""
    return F.when(variants.has_key(body, "guid"), F.array(body)).otherwise(envelope_items(body, items_key))


def item_texts(body: str, items_key: str = ITEMS_KEY, single_orders: bool = False) -> Column:
    """The texts of the items that ``envelope_items`` or ``order_items`` find, with marked numbers where ``_marked``; see ``variants.spelled``."""
    marked = variants.marked_numbers(F.col(body), F.col("_marked"))
    texts = F.when(F.ltrim(body).startswith("["), variants.element_texts(marked)).otherwise(variants.element_texts(marked, items_key))
    if not single_orders:
        return texts
    return F.when(variants.has_key(F.col("_body"), "guid"), variants.element_texts(F.concat(F.lit("["), marked, F.lit("]")))).otherwise(texts)


def unnest(pages: DataFrame, *, body: str = "body", items_key: str = ITEMS_KEY, single_orders: bool = False,
           observed: Observation | None = None, text: str | None = None) -> DataFrame:
    """One row per item, in the VARIANT column ``item``, with its ``position`` in the page; the other columns of the page are kept.
    ``text`` names a column for the item as it was written.

    Of a key that an object repeats, the last value counts in ``item``; the text has both.

    ``observed`` receives the number of responses that are not JSON (``malformed``) as the rows pass by.
    """
    items = order_items if single_orders else envelope_items
    kept = [name for name in pages.columns if name != body]
    parsed = with_body(pages, body)
    if observed is not None:
        parsed = parsed.observe(observed, F.count_if(variants.is_malformed(F.col(body), F.col("_body"))).alias("malformed"))
    if text is None:
        return parsed.select(*kept, F.posexplode(items(F.col("_body"), items_key)).alias("position", "item"))
    both = F.arrays_zip(items(F.col("_body"), items_key).alias("value"), item_texts(body, items_key, single_orders).alias("text"))
    rows = parsed.withColumn("_marked", variants.can_mark(F.col(body))).select(*kept, "_marked", F.posexplode(both).alias("position", "_both"))
    spelled = variants.spelled(F.col("_both.value"), F.col("_both.text"), F.col("_marked"))
    return rows.select(*kept, "position", F.col("_both.value").alias("item"), spelled.alias(text))
