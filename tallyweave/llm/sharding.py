"""Histogram sort: even shards in one exchange.

Documents are ordered by (hash of the text, id). The borders between shards are found by counting
the exact bytes below candidate keys over all rows, again and again, with the candidates drawn
closer around each border until the bytes below it meet the tolerance. A border that falls inside
one text with very many copies is refined further over the ids, and one inside rows that repeat id and text over the copies, so
such groups are split. The rows then move once. Candidates and counts are the only things the driver sees; their number follows the
shards, not the rows.

Rows are numbered in cells, ranges of equal width of the hash, as many as the rows ask for; a table says how many rows lie before each. A cell with
too many rows for one task, which has a text with very many copies, is dealt further by a hash of the id. Slots follow the order of cells, and the order of
(hash of the text, id) within what is numbered together.

Size of a row: UTF-8 bytes of its text plus a fixed number. NULL text has no bytes. A NULL id sorts
first. Only where a border falls inside rows that repeat id and text are the rows written out first, to number them. No rows
give no rows. Further columns are kept, but for those with the name of a result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.llm.common import numbered, text_or_empty, with_results
from tallyweave.sources.staging import stage

ROW_BYTES = 16
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _below(rows: DataFrame, key: str, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows whose key is under each probe (sorted)."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            slot = np.searchsorted(probes, batch[key].to_numpy(np.int64), side="right")
            np.add.at(sums, slot, batch["_size"].to_numpy(np.int64))
            np.add.at(counts, slot, 1)
        full = np.flatnonzero(counts)
        yield pd.DataFrame({"slot": full, "size": sums[full], "n": counts[full]})

    found = (rows.select(key, "_size").mapInPandas(count, "slot long, size long, n long")
             .groupBy("slot").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect())  # at most one row per probe
    sums, counts = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for slot, size, n in found:
        sums[slot], counts[slot] = size, n
    return np.cumsum(sums)[:-1], np.cumsum(counts)[:-1]


def refine(rows: DataFrame, key: str, targets: list[float], total: int, n_rows: int, tolerance: float,
           probes_each: int = 32) -> list[tuple[int, int, int]]:
    """For each target a key, the bytes below it, and the bytes below the next key: the bytes below the
    key are within ``tolerance`` of the target, or no key is nearer than this or the next one."""
    low = [(LOWEST, 0, 0)] * len(targets)  # key, bytes and rows below it
    high = [(HIGHEST, total, n_rows)] * len(targets)
    chosen: list[tuple[int, int, int] | None] = [None] * len(targets)
    while True:
        wanted = {}
        for i, target in enumerate(targets):
            if chosen[i]:
                continue
            near = min(low[i], high[i], key=lambda x: abs(x[1] - target))
            if abs(near[1] - target) <= tolerance:
                chosen[i] = (near[0], near[1], near[1])
            elif high[i][0] - low[i][0] <= 1:
                chosen[i] = (low[i][0], low[i][1], high[i][1])
            elif high[i][2] - low[i][2] <= 1:  # one row: either side of it
                chosen[i] = (near[0], near[1], near[1])
            else:
                step = max(1, (high[i][0] - low[i][0]) // (probes_each + 1))
                wanted[i] = range(low[i][0] + step, high[i][0], step)
        if not wanted:
            return chosen
        probes = np.array(sorted({p for each in wanted.values() for p in each}), np.int64)
        sums, counts = _below(rows, key, probes)
        for i, own in wanted.items():
            at = np.searchsorted(probes, np.array(own, np.int64))
            for probe, size, n in zip(own, sums[at].tolist(), counts[at].tolist()):
                if size <= targets[i]:
                    low[i] = (probe, size, n)
                else:
                    high[i] = (probe, size, n)
                    break


def _cut_in(own: DataFrame, key: str, offsets: list[float], slack: float) -> list[tuple[int, int, int]]:
    size, n = own.agg(F.sum("_size"), F.count("*")).first()
    return refine(own, key, offsets, size, n, slack)


def borders(keys: DataFrame, parts: int, tolerance: float) -> tuple[list[tuple[int, int, int]], dict[tuple[int, int], list[float]], float]:
    """Keys (hash, id, copy) that cut the rows into ``parts`` of near equal size, each the first of its part; for borders that fall
    inside rows that repeat id and text, by hash and id the bytes of that group in front of the border; and the slack in bytes."""
    total, n_rows = keys.agg(F.sum("_size"), F.count("*")).first()
    total = total or 0
    if not n_rows:
        return [], {}, 0.0
    targets, slack = [total * i / parts for i in range(1, parts)], tolerance * total / parts
    cuts: list[tuple[int, int, int]] = []
    inside: dict[int, list[float]] = {}
    tied: dict[tuple[int, int], list[float]] = {}
    for target, (key, below, after) in zip(targets, refine(keys, "_key", targets, total, n_rows, slack)):
        if after == below:
            cuts.append((key, LOWEST, LOWEST))
        else:
            inside.setdefault(key, []).append(target - below)
    for key, offsets in inside.items():  # at most one text per border
        own = stage(keys.filter(F.col("_key") == F.lit(key)), "shard-text")
        for offset, (cut, below, after) in zip(offsets, _cut_in(own, "_order", offsets, slack)):
            if min(offset - below, after - offset) <= slack:
                cuts.append((key, cut if offset - below <= after - offset else cut + 1, LOWEST))
            else:
                tied.setdefault((key, cut), []).append(offset - below)
    return cuts, tied, slack


def _part(cuts: list[tuple[int, int, int]], copy: Column) -> Column:
    """How many of the sorted borders are at or below a row."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        key, order, nth = cuts[middle]
        within = F.col("_order") > F.lit(order)
        within = F.col("_order") >= F.lit(order) if nth == LOWEST else within | ((F.col("_order") == F.lit(order)) & (copy >= F.lit(nth)))
        reached = (F.col("_key") > F.lit(key)) | ((F.col("_key") == F.lit(key)) & within)
        return F.when(reached, search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(cuts)).cast("int")


def _cell(n_rows: int, rows_per_task: int) -> Column:
    """The leading bits of the text's hash, in its order; more bits for more rows."""
    bits = min(32, max(0, -(-n_rows // rows_per_task) - 1).bit_length())
    return F.shiftrightunsigned(F.col("_key").bitwiseXOR(F.lit(LOWEST)), 64 - bits) if bits else F.lit(0).cast("long")


def shard_documents(docs: DataFrame, shards: int = 40, tolerance: float = 0.001, rows_per_task: int = 1_000_000,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with ``_size``, ``_shard`` and ``_slot`` (gapless from 0 within the shard)."""
    inner, (id_column, text_column) = numbered(docs, id_column, text_column)
    text = text_or_empty(text_column)
    keyed = inner.withColumns({
        "_size": (F.octet_length(text) + ROW_BYTES).cast("long"), "_key": F.xxhash64(text),
        "_order": F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST)),
    })
    keys = stage(keyed.select("_size", "_key", "_order"), "shard-keys")
    cuts, tied, slack = borders(keys, shards, tolerance)
    copy = F.lit(0)
    if tied:  # many rows with one id and text: numbered as they are written, so that every reader sees the same numbers
        keyed = stage(keyed.withColumn("_copy", F.monotonically_increasing_id()), "shard-rows")
        keys, copy = keyed.select("_size", "_key", "_order", "_copy"), F.col("_copy")
        for (key, order), offsets in tied.items():
            own = stage(keys.filter((F.col("_key") == F.lit(key)) & (F.col("_order") == F.lit(order))), "shard-copies")
            for offset, (cut, below, after) in zip(offsets, _cut_in(own, "_copy", offsets, slack)):
                cuts.append((key, order, cut if offset - below <= after - offset else cut + 1))
    placed = {"_shard": _part(sorted(cuts), copy), "_cell": _cell(keys.count(), rows_per_task)}
    cells = stage(keys.withColumns(placed).groupBy("_shard", "_cell").agg(F.count("*").alias("_n")), "shard-cells")
    large = cells.filter(F.col("_n") > 2 * rows_per_task).select(
        F.col("_shard").alias("_shard_l"), F.col("_cell").alias("_cell_l"), F.ceil(F.col("_n") / rows_per_task).alias("_deals"))
    nothing_large = large.isEmpty()

    def dealt(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns(placed)
        if nothing_large:
            return rows.withColumn("_deal", F.lit(0).cast("long"))
        return rows.join(large, (F.col("_shard") == F.col("_shard_l")) & (F.col("_cell") == F.col("_cell_l")), "left").withColumn(
            "_deal", F.coalesce(F.pmod(F.xxhash64("_order", copy), "_deals"), F.lit(0).cast("long")))

    piece = ["_shard", "_cell", "_deal"]
    counted = cells.withColumn("_deal", F.lit(0).cast("long")) if nothing_large else dealt(keys).groupBy(*piece).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_cell", "_deal").rowsBetween(Window.unboundedPreceding, -1)  # a row per piece
    first = counted.select(*[F.col(name).alias(f"{name}_f") for name in piece], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    moved = dealt(keyed).withColumn("_nth", F.row_number().over(Window.partitionBy(*piece).orderBy("_key", "_order")) - 1)
    same = (F.col("_shard") == F.col("_shard_f")) & (F.col("_cell") == F.col("_cell_f")) & (F.col("_deal") == F.col("_deal_f"))
    done = moved.join(first, same).withColumn("_slot", (F.col("_first") + F.col("_nth")).cast("long"))
    return with_results(docs, done, ["_size", "_shard", "_slot"])
