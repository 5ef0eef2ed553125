"""SimHash near-duplicates by bit-sliced comparison.

A document's fingerprint has a bit set where more than half of the XXH64 hashes of its word shingles, repeats included, have it.
Documents link when their fingerprints differ in at most ``radius`` bits; equal fingerprints are one node from the start.

*Candidates.* The 64 bits are cut into blocks. With ``radius`` + s blocks, two linked fingerprints agree in s of them at least, so
they meet in one of the tables that each stand for a choice of s blocks, under the bits of those blocks. The number of blocks follows from the
number of fingerprints, so that a key owns about ``KEY_ROWS`` of them at most if bits are spread evenly. Every choice finds all links.

*Comparison.* The fingerprints of a task are stored as 64 bit planes: word w of plane p has bit p of 64 fingerprints. One
fingerprint is held against a word of 64 others by an XOR a plane, and the 64 distances are counted in carry-save counters, a few bitwise
operations a plane. A word is abandoned when all its distances exceed the radius. Links are merged into components inside
the task at once; words that are in the component of the fingerprint already are not compared, so a group of near copies costs a
few passes and gives one link per member, not its pairs. Keys with more than ``HOT`` rows are met in blocks of pairs of salts.

NULL text is empty; a text without words has fingerprint zero, and links like any other. One with fewer words than a shingle has
one shingle, the whole sequence. Rows that repeat an id or a text give a row each; NULL ids count for a component only if it has no other;
no rows give no rows; further columns may have any names and are left out. Texts are read whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import text_or_empty
from tallyweave.llm.components import components, merged_labels
from tallyweave.operators.hot_keys import lookup
from tallyweave.sources.staging import stage

BITS = 64
KEY_ROWS = 1024
HOT = 32_768
BUCKET_ROWS = 100_000
PAIRS = 1 << 15  # of a fingerprint and a word, at a time
ABANDON_EVERY = 8
_ALL = np.uint64((1 << 64) - 1)


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    own = text.lower().split()  # on bytes: A-Z alone, and ASCII white space
    if not own:
        return 0
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    last = max(len(own) - words + 1, 1)
    first, final = starts[:last].tolist(), (ends[words - 1:] if len(own) >= words else ends[-1:]).tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, last, 1 << 14):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(first[at:at + (1 << 14)], final[at:at + (1 << 14)])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(text, words) for text in batch.column(1).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("t")).mapInArrow(sign, "doc_id long, fp long")


def tables_for(n: int, radius: int) -> list[int]:
    """One mask of 64 bits for each table, so that few of n evenly spread fingerprints share a key."""
    kept = 1
    while BITS * kept // (radius + kept) < BITS and n >> (BITS * kept // (radius + kept)) > KEY_ROWS:
        kept += 1
    borders = [BITS * i // (radius + kept) for i in range(radius + kept + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(borders, borders[1:])]
    return [sum(choice) for choice in combinations(blocks, kept)]


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Plane p, word w: bit p of the fingerprints 64 w to 64 w + 63."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = np.concatenate([bits, np.zeros((-len(bits) % 64, BITS), np.uint8)])
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """The lanes whose count is larger than the radius, or has left the counters."""
    more, same = over.copy(), np.full_like(over, _ALL)
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            same &= counters[i]
        else:
            more |= same & counters[i]
            same &= ~counters[i]
    return more


def within(planes: np.ndarray, fps: np.ndarray, probe: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a probe and a word of lanes; those of the given lanes within the radius, as pairs of row numbers."""
    counters = [np.zeros(len(probe), np.uint64) for _ in range(radius.bit_length())]
    over, own = ~lanes, fps[probe]
    for plane in range(BITS):
        carry = planes[plane][word] ^ (np.uint64(0) - (own >> np.uint64(plane) & np.uint64(1)))  # where the bits differ
        for i, counter in enumerate(counters):
            counters[i], carry = counter ^ carry, counter & carry
        over = over | carry
        if plane % ABANDON_EVERY == ABANDON_EVERY - 1:
            alive = _beyond(counters, over, radius) != _ALL
            if not alive.all():
                probe, word, own, over = probe[alive], word[alive], own[alive], over[alive]
                counters = [c[alive] for c in counters]
            if not len(probe):
                break
    hits = np.unpackbits((~_beyond(counters, over, radius)).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pair, lane = np.nonzero(hits) if len(probe) else (np.zeros(0, np.int64),) * 2
    return probe[pair], word[pair] * 64 + lane


def linked_rows(fps: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int) -> np.ndarray:
    """The label of each row, after it was held against the rows from ``first`` to before ``last``."""
    n = len(fps)
    planes, labels = bit_planes(fps), np.arange(n)
    many = np.where(last > first, (last - 1) // 64 - first // 64 + 1, 0)
    ends, at, edges = np.cumsum(many), 0, np.arange(0, n, 64)
    while at < n:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        each = many[at:upto]
        probe = np.repeat(np.arange(at, upto), each)
        word = np.repeat(first[at:upto] // 64, each) + np.arange(len(probe)) - np.repeat(np.cumsum(each) - each, each)
        low, high = np.minimum.reduceat(labels, edges), np.maximum.reduceat(labels, edges)
        new = (low[word] != labels[probe]) | (high[word] != labels[probe])
        probe, word = probe[new], word[new]
        from_lane, to_lane = np.maximum(first[probe] - word * 64, 0), np.minimum(last[probe] - word * 64, 64)
        lanes = (_ALL << from_lane.astype(np.uint64)) & (_ALL >> (64 - to_lane).astype(np.uint64))
        for step in range(0, len(probe), PAIRS):
            part = slice(step, step + PAIRS)
            labels = merged_labels(labels, *within(planes, fps, probe[part], word[part], lanes[part], radius))
        at = upto
    return labels


def near_links(nodes: DataFrame, radius: int, hot: int = HOT) -> DataFrame:
    """Links ``a``, ``b`` that connect what is within the radius, out of distinct fingerprints ``fp``."""
    n = nodes.count()
    masks = tables_for(n, radius)
    buckets = max(1, len(masks) * n // BUCKET_ROWS)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64)))) for i, m in enumerate(masks)])
    keyed = nodes.select("fp", F.explode(keys).alias("key"))
    crowded = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select(
        F.col("key").alias("_key"), F.ceil(F.col("n") / hot).cast("int").alias("_salts")), "simhash-crowded")
    if crowded.isEmpty():
        dealt = keyed.withColumns({"low": F.lit(0), "high": F.lit(0), "salt": F.lit(0)})
    else:
        own = F.pmod(F.xxhash64("fp", F.lit("salt")), F.coalesce("_salts", F.lit(1))).cast("int")
        marked = keyed.join(crowded, F.col("key") == F.col("_key"), "left").withColumn("salt", own)
        spread = marked.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        dealt = spread.select("fp", "key", F.least("salt", "other").alias("low"), F.greatest("salt", "other").alias("high"), "salt")

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        own = {name: table.column(name).to_numpy() for name in ("key", "low", "high", "salt", "fp")}
        order = np.lexsort(tuple(own[name] for name in ("fp", "salt", "high", "low", "key")))
        own = {name: values[order] for name, values in own.items()}

        def runs(*names: str) -> np.ndarray:
            return np.flatnonzero(np.append(True, np.any([own[name][1:] != own[name][:-1] for name in names], axis=0)))

        def ends(starts: np.ndarray) -> np.ndarray:
            sizes = np.diff(np.append(starts, len(order)))
            return np.repeat(starts + sizes, sizes)

        last, part = ends(runs("key", "low", "high")), ends(runs("key", "low", "high", "salt"))
        # rows of one salt meet in that salt's own block, rows of two salts in the block of both
        first = np.where(own["low"] == own["high"], np.arange(len(order)) + 1, part)
        fps = own["fp"].view(np.uint64)
        labels = linked_rows(fps, first, last, radius)
        found = np.flatnonzero(labels != np.arange(len(labels)))
        pairs = np.unique(np.stack([own["fp"][found], own["fp"][labels[found]]]), axis=1)
        if pairs.size:
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    bucket = F.pmod(F.xxhash64("key", "low", "high"), F.lit(buckets)).alias("bucket")
    return dealt.select(bucket, *dealt.columns).groupBy("bucket").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id that it is connected with."""
    rows = stage(fingerprints(docs, words, id_column, text_column), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    links = stage(near_links(nodes.select("fp"), radius), "simhash-links")
    found = components(links.select("a", "b")).select(F.col("node").alias("_node"), "component")
    labelled = stage(nodes.join(found, F.col("fp") == F.col("_node"), "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")), "simhash-labelled")
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_node = lookup(labelled.select("fp", "component"), least, ["component"], ["fp"]).select("fp", "component_id")
    out = lookup(rows.withColumn("_row", F.monotonically_increasing_id()), by_node, ["fp"], ["_row"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
