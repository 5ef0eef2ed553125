"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their shingle sets is at least ``num / den``. Documents with equal sets are
one node from the start. Then:

1. *Stars.* Of the nodes that share a min-hash, the one with the fewest rare shingles is their hub; the others are compared with it,
   and what is linked becomes a component. This is linear, and a large group of near copies is one component from here on. A node that
   shares half its shingles with a hub is kept as its differences from the hub, and the nodes around one hub are held against each other
   by them: what two sets have in common follows from what each shares with the hub and from the differences they share.
2. *Prefixes.* Shingles are ordered from rare to frequent by counts over all documents. If two sets have t shingles
   in common, the first n - t + l of either share at least l. Every document chooses its l from the estimated cost of
   its candidates: the more rows its prefix would meet, the longer it makes the prefix and the more shared shingles it asks
   for. The larger document of a pair decides.
3. *Counting.* Prefix shingles meet by hash. Those that one node alone has are dropped at once; of the rest, pairs in different
   components and around different hubs are counted, and pairs with too few shared prefix shingles are dropped. Pairs within a component
   need no further proof, so a group of copies never makes all its pairs, and pairs around one hub have been decided before.
4. *Verification* of what is left, on the whole sets, and connected components.

The counts of step 2 are kept in a table of fixed size (``CELLS``), which is the only thing besides bit fields of bounded size
that the driver sees; sharing a cell makes a shingle seem more frequent, which changes costs and not results.
A shingle of very many documents is met in blocks of pairs of salts, each of about ``HOT`` rows, and so are the nodes of a hub, of
about ``HUB_NODES`` each; such a block gives one link per merged component.

A document without words has an empty set and is linked with nothing. NULL text is empty; rows with a NULL id are grouped
like others and count only if a group has no other id. Rows that repeat an id and text are one node; no rows give no rows; further columns are
ignored. Shingles are compared by 64-bit hashes, nodes by the hash of their set.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.bits import bit_field, log2_bits_for, merged, segments
from tallyweave.llm.common import numbered, text_or_empty
from tallyweave.llm.components import components, merged_labels
from tallyweave.llm.shingles import mixed, shingle_sets
from tallyweave.sources.staging import stage

LOG2_CELLS = 22
CELLS = 1 << LOG2_CELLS
STARS = 4
HUB_SHARE = 2  # a node has a hub if it shares one of HUB_SHARE of their shingles with it
MATCHES = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)  # shared prefix shingles that a document may ask for
PER_MATCH = 8  # at most one of them for so many shingles of the document
POST, SCAN, VERIFY = 1.0, 0.2, 20.0  # costs of a prefix entry, of a row that it meets, of a candidate
HOT = 20_000
BUCKET_ROWS = 400_000
HUB_NODES, HUB_BUCKET_NODES = 4096, 8192
FEW = 64  # nodes that share a difference, up to which their pairs are counted one by one
STRIP = 512


def text_hash(text_column: str) -> Column:
    return F.xxhash64(text_or_empty(text_column))


def node_of(shingles: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes())[:8], np.int64)[0])


def _ceil(a, b):
    return -(-a // b)


class Threshold:
    """The numbers that follow from a similarity of num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, n, m):
        """Shingles that sets of n and m must have in common."""
        return _ceil(self.num * (n + m), self.num + self.den)

    def holds(self, common, n, m):
        return self.den * common >= self.num * (n + m - common)

    def longest(self, n: int) -> int:
        """The largest set that can link with one of n."""
        return n * self.den // self.num

    def probe(self, n: int, matches: int) -> int:
        """Prefix of the larger document of a pair, whatever the smaller one's size."""
        return min(n, n - _ceil(self.num * n, self.den) + matches)

    def index(self, n: int, matches: int) -> int:
        """Prefix of the smaller document."""
        return min(n, n - self.overlap(n, n) + matches)


def most_matches(n: int) -> int:
    return max(1, min(MATCHES[-1], n // PER_MATCH))


def chosen_matches(frequency: np.ndarray, threshold: Threshold) -> int:
    """How many shared prefix shingles a document asks for; ``frequency``: how many other documents have each of its
    shingles, rarest first."""
    n, most = len(frequency), most_matches(len(frequency))
    met = np.cumsum(frequency)
    best, least = 1, None
    for matches in MATCHES:
        if matches > most:
            break
        length = threshold.probe(n, matches)
        rows = float(met[length - 1])
        cost = POST * length + SCAN * rows + VERIFY * rows / matches
        if least is None or cost < least:
            best, least = matches, cost
    return best


def _texts(batch: pa.RecordBatch, at: int = 0) -> list[bytes]:
    return batch.column(at).cast(pa.binary()).to_pylist()


def signatures(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """For each document the hash of its text, its node, set size and min-hashes; and the counts of shingles by cell, in segments."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.uint32)
        seeds = [np.uint64((i + 1) * 0xA0761D6478BD642F & (1 << 64) - 1) for i in range(STARS)]
        names = ["doc_id", "text_hash", "node", "n", *[f"star{i}" for i in range(STARS)], "seg", "blob"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), *[pa.int64()] * STARS, pa.int32(), pa.binary()]
        for batch in batches:
            rows = []
            for doc_id, hashed, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), shingle_sets(_texts(batch, 1), words)):
                if len(own):
                    cells = (own & np.uint64(CELLS - 1)).astype(np.int64)
                    counts[cells] += 1  # a document once per cell
                    stars = [int(mixed(own ^ seed).min().view(np.int64)) for seed in seeds]
                    rows.append((doc_id, hashed, node_of(own), len(own), *stars, None, None))
                else:
                    rows.append((doc_id, hashed, None, 0, *[None] * STARS, None, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        rows = [(*[None] * (4 + STARS), seg, blob) for seg, blob in segments(counts)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = ", ".join(["doc_id long, text_hash long, node long, n long", *[f"star{i} long" for i in range(STARS)], "seg int, blob binary"])
    return docs.select(F.col(id_column).cast("long"), text_or_empty(text_column), text_hash(text_column)).mapInArrow(sign, schema)


def shingle_counts(signed: DataFrame) -> np.ndarray:
    """How many documents have a shingle of each cell, over all tasks."""
    return merged(signed.filter("seg is not null"), CELLS, "u4", np.zeros(CELLS, np.uint32), np.add)


def star_members(nodes: DataFrame) -> DataFrame:
    """The nodes that share a min-hash with others: ``star``, ``node``."""
    found = None
    for i in range(STARS):
        star = F.xxhash64(F.lit(i), F.col(f"star{i}"))
        several = nodes.groupBy(star.alias("_star")).agg(F.count("*").alias("_n")).filter("_n > 1")
        own = nodes.join(several, star == F.col("_star")).select(F.col("_star").alias("star"), "node")
        found = own if found is None else found.union(own)
    return found


def star_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Each node with its hub, the node of the star with the fewest rare shingles: ``a`` (hub), ``b``."""
    told = members.join(sets.select(F.col("node").alias("_node"), "rare", "n"), F.col("node") == F.col("_node")).drop("_node")
    hubs = told.groupBy(F.col("star").alias("_star")).agg(F.min(F.struct("rare", "n", "node")).alias("hub"))
    pairs = told.join(hubs, F.col("star") == F.col("_star")).filter(F.col("node") != F.col("hub.node"))
    close = F.least("n", "hub.n") * HUB_SHARE >= F.greatest("n", "hub.n")
    return pairs.filter(close).select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()


def with_parents(pairs: DataFrame) -> DataFrame:
    """The pairs ``a`` (hub), ``b``, and each node also with the most popular hub that its own hub is a node of, so that a large group
    of near copies has one hub and not one for each of its stars."""
    popular = pairs.groupBy(F.col("a").alias("_hub")).agg(F.count("*").alias("_members"))
    known = pairs.join(popular, F.col("a") == F.col("_hub")).drop("_hub")
    own = popular.select(F.col("_hub").alias("_own"), F.col("_members").alias("_own_members"))
    parents = known.join(own, F.col("b") == F.col("_own")).filter("_members > _own_members").groupBy(F.col("b").alias("_child")).agg(
        F.max(F.struct("_members", "a")).alias("_parent"))
    more = pairs.join(parents, F.col("a") == F.col("_child")).select(F.col("_parent.a").alias("a"), "b").filter("a <> b")
    return pairs.union(more).distinct()


def sets_of(docs: DataFrame, wanted: DataFrame, counts: Broadcast, words: int, text_column: str) -> DataFrame:
    """``node``, ``n``, ``shingles`` and ``rare``, how many shingles few documents seem to have, for the wanted nodes (and few others)."""
    field = docs.sparkSession.sparkContext.broadcast(bit_field(wanted, "node", log2_bits_for(wanted.count())))
    noise = float(counts.value.mean())
    seldom = noise + 3 * noise ** 0.5 + 2

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            rows: list[tuple] = []
            for own in shingle_sets(_texts(batch), words):
                if len(own):
                    node = node_of(own)
                    if node not in given and field.value.has(np.array([node], np.int64).view(np.uint64))[0]:
                        given.add(node)
                        seen = counts.value[(own & np.uint64(CELLS - 1)).astype(np.int64)]
                        rows.append((node, len(own), own.tobytes(), int((seen <= seldom).sum())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.int64()))],
                                                 ["node", "n", "shingles", "rare"])

    made = docs.select(text_or_empty(text_column)).mapInArrow(spell, "node long, n long, shingles binary, rare long")
    return stage(made, "jaccard-sets").dropDuplicates(["node"])


def compared(pairs: DataFrame, sets: DataFrame, deltas: bool = False) -> DataFrame:
    """The pairs with what their whole sets have in common: ``a``, ``b``, ``common``, ``na``, ``nb``; on request also ``delta``, the shingles
    that one of them alone has, where they share one of HUB_SHARE."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                both = x[at] == y
                common, delta = int(both.sum()), None
                if deltas and common * HUB_SHARE >= len(x) + len(y) - common:
                    own = np.ones(len(x), bool)
                    own[at[both]] = False
                    delta = np.concatenate([x[own], y[~both]]).tobytes()
                rows.append((common, len(x), len(y), delta))
            made = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *made], ["a", "b", "common", "na", "nb", "delta"])

    one = sets.select("node", "shingles")
    left = pairs.join(one.select(F.col("node").alias("_a"), F.col("shingles").alias("sa")).hint("merge"), F.col("a") == F.col("_a"))
    both = left.join(one.select(F.col("node").alias("_b"), F.col("shingles").alias("sb")).hint("merge"), F.col("b") == F.col("_b"))
    return both.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long, common long, na long, nb long, delta binary")


def linked(compared_pairs: DataFrame, threshold: Threshold) -> DataFrame:
    holds = F.col("common") * threshold.den >= (F.col("na") + F.col("nb") - F.col("common")) * threshold.num
    return compared_pairs.filter(holds).select("a", "b")


def hubs_of(compared_pairs: DataFrame) -> DataFrame:
    """For each node the hub of most nodes among those it is close to, a hub being close to itself: ``node``, ``hub``, ``hub_n``,
    ``shared``, ``n``, ``delta``."""
    near = compared_pairs.filter("delta is not null")
    popular = near.groupBy(F.col("a").alias("_hub")).agg(F.count("*").alias("_members"), F.first("na").alias("_n"))
    own = popular.select(F.col("_hub").alias("node"), "_members", F.col("_n").alias("shared"), F.col("_hub").alias("hub"), F.col("_n").alias("hub_n"),
                         F.col("_n").alias("n"), F.lit(b"").alias("delta"))
    others = near.join(popular, F.col("a") == F.col("_hub")).select(
        F.col("b").alias("node"), "_members", F.col("common").alias("shared"), F.col("a").alias("hub"), F.col("na").alias("hub_n"), F.col("nb").alias("n"), "delta")
    best = own.unionByName(others).groupBy("node").agg(F.max(F.struct("_members", "shared", "hub", "hub_n", "n", "delta")).alias("m"))
    return best.select("node", *[F.col(f"m.{name}").alias(name) for name in ("hub", "hub_n", "shared", "n", "delta")])


def shared_differences(deltas: list[np.ndarray], rows: int) -> Iterator[tuple[int, np.ndarray]]:
    """For strips of the first ``rows`` deltas, how many elements each has in common with each delta: ``(first row, counts)``. An element
    that few have is counted pair by pair, one that many have by a product of matrices."""
    sizes = np.array([len(d) for d in deltas])
    tokens, of = np.unique(np.concatenate(deltas), return_inverse=True)
    node = np.repeat(np.arange(len(deltas)), sizes)
    held = np.bincount(of, minlength=len(tokens))
    order = np.argsort(of, kind="stable")
    of, node = of[order], node[order]
    few = (held[of] > 1) & (held[of] <= FEW)
    many = np.flatnonzero(held > FEW)
    place = np.full(len(tokens), -1)
    place[many] = np.arange(len(many))
    thick_token, thick_node = place[of[held[of] > FEW]], node[held[of] > FEW]
    of, node = of[few], node[few]
    begin = np.searchsorted(of, of, "left")
    group = np.searchsorted(of, of, "right") - begin
    for first in range(0, rows, STRIP):
        last = min(first + STRIP, rows)
        counts = np.zeros((last - first, len(deltas)), np.float32)
        own = np.flatnonzero((node >= first) & (node < last))
        for step in range(0, len(own), 20_000):
            part = own[step:step + 20_000]
            each = group[part]
            other = np.repeat(begin[part], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            np.add.at(counts, (np.repeat(node[part], each) - first, node[other]), 1)
        for chunk in range(0, len(many), STRIP):
            inside = (thick_token >= chunk) & (thick_token < chunk + STRIP)
            table = np.zeros((STRIP, len(deltas)), np.float32)
            table[thick_token[inside] - chunk, thick_node[inside]] = 1
            counts += table[:, first:last].T @ table
        yield first, counts


def links_around(nodes: np.ndarray, component: np.ndarray, n: np.ndarray, shared: np.ndarray, hub_n: int, deltas: list[np.ndarray], rows: int,
                 threshold: Threshold) -> list[tuple[int, int]]:
    """Links that connect the components of nodes around one hub, the first ``rows`` held against all."""
    start, component = np.unique(component, return_inverse=True)
    if len(start) < 2:
        return []
    labels, of = np.arange(len(start)), np.full(len(start), -1)
    of[component] = np.arange(len(nodes))  # a node of each component
    for first, counts in shared_differences(deltas, rows):
        own = slice(first, first + len(counts))
        common = shared[own, None] + shared[None, :] - hub_n + counts.astype(np.int64)
        x, y = np.nonzero(threshold.holds(common, n[own, None], n[None, :]) & (component[own, None] != component[None, :]))
        labels = merged_labels(labels, component[x + first], component[y])
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    return list(zip(nodes[of[moved]].tolist(), nodes[of[labels[moved]]].tolist()))


def hub_links(hubs: DataFrame, early: DataFrame, threshold: Threshold) -> DataFrame:
    """Links ``a``, ``b`` among the nodes around each hub, exact on whole sets. Large hubs are met in blocks of pairs of salts."""
    placed = hubs.join(early.select(F.col("node").alias("_node"), "component"), F.col("node") == F.col("_node"), "left").drop("_node")
    sizes = hubs.groupBy(F.col("hub").alias("_hub")).agg(F.count("*").alias("_n")).filter("_n > 1")
    large = F.broadcast(sizes.filter(F.col("_n") > HUB_NODES))  # one row for so many nodes at least
    known = placed.join(large, F.col("hub") == F.col("_hub"), "left")
    salts = F.coalesce(F.ceil(F.col("_n") / HUB_NODES), F.lit(1)).cast("int")
    own = known.withColumns({"_salts": salts, "component": F.coalesce("component", "node")}).withColumn(
        "salt", F.pmod(F.xxhash64("node"), F.col("_salts")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    buckets = max(1, (sizes.agg(F.sum("_n")).first()[0] or 0) // HUB_BUCKET_NODES)
    dealt = own.select("hub", F.least("salt", "_other").alias("low"), F.greatest("salt", "_other").alias("high"), "salt", "node", "component", "n", "shared", "hub_n", "delta")

    def link(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        f = {name: table.column(name).to_numpy() for name in table.column_names if name != "delta"}
        delta = table.column("delta").combine_chunks()
        order = np.lexsort((f["node"], f["component"], f["salt"], f["high"], f["low"], f["hub"]))
        f = {name: values[order] for name, values in f.items()}
        new = np.flatnonzero(np.append(True, (f["hub"][1:] != f["hub"][:-1]) | (f["low"][1:] != f["low"][:-1]) | (f["high"][1:] != f["high"][:-1])))
        found: list[tuple[int, int]] = []
        for a, b in zip(new, np.append(new[1:], len(order))):
            group = slice(a, b)
            if b - a > 1 and f["component"][group].min() != f["component"][group].max():
                # rows of one salt meet in that salt's own block, rows of two salts in the block of both
                rows = b - a if f["low"][a] == f["high"][a] else int((f["salt"][group] == f["low"][a]).sum())
                deltas = [np.frombuffer(delta[int(i)].as_buffer(), np.uint64) for i in order[group]]
                found += links_around(*(f[name][group] for name in ("node", "component", "n", "shared")), int(f["hub_n"][a]), deltas, rows, threshold)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    bucket = F.pmod(F.xxhash64("hub", "low", "high"), F.lit(buckets)).alias("bucket")
    return dealt.select(bucket, *dealt.columns).groupBy("bucket").applyInArrow(link, "a long, b long")


_POSTING = [("token", "<u8"), ("node", "<i8"), ("n", "<u4"), ("at", "<u4"), ("asks", "<u2"), ("block", "<u4"), ("salt", "<u2")]


def prefix_entries(docs: DataFrame, counts: Broadcast, words: int, threshold: Threshold, buckets: int, text_column: str) -> DataFrame:
    """Prefix shingles of all nodes, packed by bucket: ``bucket``, and one array of bytes for each field."""
    noise = float(counts.value.mean())

    def prefix(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        n = len(own)
        seen = counts.value[(own & np.uint64(CELLS - 1)).astype(np.int64)]
        order = np.lexsort((own, seen))
        own, seen = own[order], seen[order]
        asks = chosen_matches(np.maximum(seen - noise - 1, 0), threshold)
        reach = max(threshold.probe(n, asks), threshold.index(n, most_matches(threshold.longest(n))))
        return own[:reach], seen[:reach], np.arange(reach), asks

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        held: list[np.ndarray] = []
        size = 0
        kind = np.dtype(_POSTING)

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            bucket = (mixed(rows["token"] + rows["block"]) % np.uint64(buckets)).astype(np.int64)
            rows = rows[np.lexsort((rows["token"], bucket))]
            bucket = np.sort(bucket)
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            last = np.append(first[1:], len(rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[first], pa.int32()),
                 *[pa.array([np.ascontiguousarray(rows[name][a:b]).tobytes() for a, b in zip(first, last)], pa.binary()) for name, _ in _POSTING]],
                ["bucket", *[name for name, _ in _POSTING]])

        for batch in batches:
            for own in shingle_sets(_texts(batch), words):
                if not len(own):
                    continue
                node = node_of(own)
                if node in given:
                    continue
                given.add(node)
                n = len(own)
                own, seen, at, asks = prefix(own)
                salts = (seen // HOT + 1).astype(np.int64)  # of a shingle that very many documents may have
                if salts.max() == 1:
                    rows = np.empty(len(own), kind)
                    rows["token"], rows["at"], rows["block"], rows["salt"] = own, at, 0, 0
                else:
                    own_salt = int(mixed(np.array([node], np.int64).view(np.uint64))[0] >> np.uint64(1)) % salts
                    take = np.repeat(np.arange(len(own)), salts)
                    other = np.arange(len(take)) - np.repeat(np.cumsum(salts) - salts, salts)
                    low, high = np.minimum(own_salt[take], other), np.maximum(own_salt[take], other)
                    rows = np.empty(len(take), kind)
                    rows["token"], rows["at"] = own[take], at[take]
                    rows["block"] = np.where(salts[take] == 1, 0, 1 + (low << 16 | high))
                    rows["salt"] = own_salt[take]
                rows["node"], rows["n"], rows["asks"] = node, n, asks
                held.append(rows)
                size += len(rows)
                if size > 500_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    schema = "bucket int, " + ", ".join(f"{name} binary" for name, _ in _POSTING)
    return docs.select(text_or_empty(text_column)).mapInArrow(emit, schema)


def _sorted_groups(f: dict[str, np.ndarray], by: tuple[str, ...]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The fields ordered by shingle, block and ``by``, and where a new shingle or block begins."""
    order = np.lexsort(tuple(f[name] for name in (*reversed(by), "block", "token")))
    f = {name: v[order] for name, v in f.items()}
    return f, np.append(True, (f["token"][1:] != f["token"][:-1]) | (f["block"][1:] != f["block"][:-1]))


def shared_entries(entries: DataFrame) -> DataFrame:
    """The entries whose shingle is in the prefix of more than one node, as rows."""

    def share(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[np.ndarray]] = {name: [] for name, _ in _POSTING}
        for batch in batches:
            for name, kind in _POSTING:
                parts[name] += [np.frombuffer(x.as_buffer(), kind) for x in batch.column(name)]
        f, new = _sorted_groups({name: np.concatenate(own) for name, own in parts.items()}, ("node",))
        kept = np.flatnonzero(new | np.append(True, f["node"][1:] != f["node"][:-1]))  # a node once, from however many tasks
        f, new = {name: v[kept] for name, v in f.items()}, new[kept]
        group = np.cumsum(new) - 1
        more = np.bincount(group)[group] > 1
        f = {name: v[more].view(np.int64) if name == "token" else v[more].astype(np.int64) for name, v in f.items()}
        for at in range(0, len(f["token"]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(v[at:at + 50_000]) for v in f.values()], list(f))

    return entries.groupBy("bucket").applyInArrow(share, ", ".join(f"{name} long" for name, _ in _POSTING))


def counted_pairs(shared: DataFrame, buckets: int, threshold: Threshold) -> DataFrame:
    """Pairs of nodes of different components and hubs that share as many prefix shingles as the larger one asks for."""

    def pair(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        columns = {name: table.column(name).to_numpy() for name in ("token", "block", "node", "n", "at", "asks", "salt", "component", "hub")}
        f, new = _sorted_groups(columns, ("n", "node"))  # the larger one of a pair comes later
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(new)))
        # a group around one hub, or of one component, has no pairs to offer
        useful = (np.minimum.reduceat(f["hub"], starts) != np.maximum.reduceat(f["hub"], starts)) & (
            np.minimum.reduceat(f["component"], starts) != np.maximum.reduceat(f["component"], starts))
        kept_rows = np.repeat(useful, sizes)
        f, starts = {name: values[kept_rows] for name, values in f.items()}, np.append(0, np.cumsum(sizes[useful]))[:-1].tolist()
        n, low = f["n"], np.empty(int(kept_rows.sum()), np.int64)
        for a, b in zip(starts, [*starts[1:], len(n)]):  # the first row of the group that is large enough for each
            low[a:b] = a + np.searchsorted(n[a:b], _ceil(n[a:b] * threshold.num, threshold.den), "left")
        many = np.arange(len(n)) - low
        ends = np.cumsum(many)
        kept: dict[str, list[np.ndarray]] = {"a": [], "b": [], "asks": [], "n": []}
        at = 0
        while at < len(n):  # some hundred thousand pairs at a time
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 250_000, "right")))
            each = many[at:upto]
            x = np.repeat(np.arange(at, upto), each)
            y = np.repeat(low[at:upto], each) + np.arange(len(x)) - np.repeat(np.cumsum(each) - each, each)
            apart = (f["component"][x] != f["component"][y]) & (f["hub"][x] != f["hub"][y])
            x, y = x[apart], y[apart]
            need, asks, block = threshold.overlap(n[x], n[y]), f["asks"][x], f["block"][x] - 1
            keep = (f["at"][x] < n[x] - need + asks) & (f["at"][y] < n[y] - need + asks)
            # rows of one salt meet in that salt's own block alone, rows of two salts in the block of both
            keep &= (block < 0) | (block >> 16 == block & 0xFFFF) | (f["salt"][x] != f["salt"][y])
            if keep.any():
                x, y, asks = x[keep], y[keep], asks[keep]
                order = np.lexsort((f["node"][y], f["node"][x]))
                x, y, asks = x[order], y[order], asks[order]
                first = np.flatnonzero(np.append(True, (f["node"][x][1:] != f["node"][x][:-1]) | (f["node"][y][1:] != f["node"][y][:-1])))
                for name, values in (("a", f["node"][x[first]]), ("b", f["node"][y[first]]), ("asks", asks[first]),
                                     ("n", np.diff(np.append(first, len(x))))):
                    kept[name].append(values)
            at = upto
        if kept["a"]:  # a pair that several steps have met is one row
            a, b, asks, n = (np.concatenate(v) for v in kept.values())
            order = np.lexsort((b, a))
            a, b, asks, n = a[order], b[order], asks[order], n[order]
            first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[first]), pa.array(b[first]), pa.array(asks[first]), pa.array(np.add.reduceat(n, first))], list(kept))

    keyed = shared.withColumn("bucket", F.pmod(F.xxhash64("token", "block"), F.lit(buckets)))
    counted = keyed.groupBy("bucket").applyInArrow(pair, "a long, b long, asks long, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("asks").alias("asks")).filter("n >= asks").select("a", "b")


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, id_column: str = "doc_id",
                       text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id of those that it is connected with."""
    return labelled(docs, words, num, den, id_column, text_column).drop("text_hash")


def labelled(docs: DataFrame, words: int, num: int, den: int, id_column: str, text_column: str) -> DataFrame:
    """``jaccard_components`` with the ``text_hash`` of each document, which tells apart rows that repeat an id or have none."""
    threshold = Threshold(num, den)
    signed = stage(signatures(docs, words, id_column, text_column), "jaccard-signatures")
    rows = signed.filter("n is not null").select("doc_id", "text_hash", "node", "n")
    nodes = stage(signed.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.max("n").alias("n"), *[F.max(f"star{i}").alias(f"star{i}") for i in range(STARS)]), "jaccard-nodes")
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(signed))  # one for all steps: Python workers keep what they were sent

    members = stage(star_members(nodes), "jaccard-stars")
    sets = sets_of(docs, members.select("node").distinct(), counts, words, text_column)
    stars = stage(compared(stage(with_parents(stage(star_pairs(members, sets), "jaccard-pairs")), "jaccard-pairs"), sets, deltas=True), "jaccard-stars")
    early = stage(components(linked(stars, threshold)), "jaccard-components")
    hubs = stage(hubs_of(stars), "jaccard-hubs")
    around = stage(hub_links(hubs, early, threshold), "jaccard-around")

    size = nodes.agg(F.sum(F.col("n") * (den - num) / den + MATCHES[-1])).first()[0] or 0
    buckets = max(1, int(size // BUCKET_ROWS))
    entries = prefix_entries(docs, counts, words, threshold, buckets, text_column)
    shared = (shared_entries(entries)
              .join(early.select(F.col("node").alias("_node"), "component"), F.col("node") == F.col("_node"), "left").drop("_node")
              .join(hubs.select(F.col("node").alias("_node"), "hub"), F.col("node") == F.col("_node"), "left").drop("_node")
              .withColumns({"component": F.coalesce("component", "node"), "hub": F.coalesce("hub", "node")}))
    pairs = stage(counted_pairs(shared, buckets, threshold), "jaccard-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    more = linked(compared(pairs, sets_of(docs, wanted, counts, words, text_column)), threshold)
    edges = early.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(more).union(around)
    final = components(stage(edges, "jaccard-links"))

    grouped = stage(nodes.select("node", "first_id").join(final.select(F.col("node").alias("_node"), "component"), F.col("node") == F.col("_node"), "left")
                    .select("node", "first_id", F.coalesce("component", "node").alias("component")), "jaccard-groups")
    least = grouped.groupBy(F.col("component").alias("_component")).agg(F.min("first_id").alias("component_id"))
    labels = grouped.join(least, F.col("component") == F.col("_component")).select(F.col("node").alias("_node"), "component_id")
    return rows.join(labels, F.col("node") == F.col("_node"), "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_component(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """The documents whose id is the smallest of their component, with the columns they came with. Rows without words stay,
    and so do rows of a component that repeat the id of one that stays. Rows are told apart by id and text, so what happens to a row says
    nothing of another text with the same id or none."""
    groups = labelled(docs, words, num, den, id_column, text_column)
    leave = groups.filter("not (doc_id <=> component_id)").select(F.col("doc_id").alias("_leaves"), F.col("text_hash").alias("_text_leaves")).distinct()
    inner, (own_id, own_text) = numbered(docs, id_column, text_column)
    same = F.col(own_id).cast("long").eqNullSafe(F.col("_leaves")) & (text_hash(own_text) == F.col("_text_leaves"))
    return inner.join(leave.hint("merge"), same, "left_anti").toDF(*docs.columns)
