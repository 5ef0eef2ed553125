"""Removal of repeated passages with suffix arrays built by induced sorting.

A byte goes when it is covered by a string of ``length`` bytes that also starts in a document with a smaller id. Strings
are judged on the input, they may overlap, and none crosses documents.

1. *Anchors.* Every string of ``length`` bytes has one anchor, the ``GRAM`` bytes in it with the smallest hash, so equal strings have equal
   anchors. Anchors that one document alone has are dropped: all anchors are sorted by range, and those that are met twice go to
   a bit field.
2. *Stretches.* Neighbouring strings with one anchor are one stretch of text. Stretches are dealt to shards by anchor, so all places of
   a string meet in one shard. Equal stretches are one before they are shuffled, with the smallest id that has them; where a task
   sees a stretch in several documents, the larger ids lose it on the spot. So a passage that very many documents share costs each task
   one stretch.
3. *Shard arrays.* The stretches of a shard that share an anchor, and enough bytes around it, with another one are put together and their suffix array is built: suffixes are
   classified as smaller or larger than the next, the leftmost-smaller substrings are sorted by induction and named, the string of names
   is sorted recursively, and all suffixes are induced from it. The common prefixes of neighbours in the array, permuted to text order, tell where a string of ``length`` bytes
   occurs again; the smallest id of each run of the array decides.
4. Covered ranges meet their documents, and the rest of each text is put together.

The string of names is sorted by the same method, level by level, until all names differ. Where buckets are large, induction takes a bucket at a time
on arrays; with the large alphabets of names it takes a suffix at a time.

NULL text is empty. A NULL id is larger than all others and not smaller than another NULL. Rows that repeat an id do not count
against each other. Texts under ``length`` bytes stay whole. A text is kept as bytes: where a removal cuts a character, ``kept_text``
leaves out its remaining bytes. No rows give no rows; further columns are kept, but for those with the name of a result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.bits import BitField, log2_bits_for, merged, segments
from tallyweave.llm.common import numbered, text_or_empty, total_bytes, with_results
from tallyweave.llm.shingles import mixed, next_hashes, range_hash, running_hash, steps

GRAM = 20
SHARD_BYTES = 3 << 20
HELD_BYTES = 8 << 20  # text that a task collects stretches of before it sends them
NO_ID = (1 << 63) - 1
BUCKET_ROWS = 512  # from this mean size on, buckets are induced as arrays
PLACES = 20_000  # of stretches whose strings are looked up at once
SLACK = 10  # places of an anchor in a string that candidates are looked for at once
PACKED = 7  # symbols of nine bits in a word


# ---- suffix arrays ----

def _larger_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last suffix is not, its end counts as smallest."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], True)
    at = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n))
    following = np.minimum.accumulate(at[::-1])[::-1]  # where the run of equal symbols ends
    after = np.append(text, -1)
    return text < after[following + 1]


def _induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order."""
    first_of = np.searchsorted(text[seeds], np.arange(symbols + 1)) if len(seeds) else np.zeros(symbols + 1, np.int64)
    larger_lists: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def deal(found: np.ndarray, lists: list[list[np.ndarray]], skip: int) -> np.ndarray:
        """Put suffixes into the buckets of their first symbols; those of bucket ``skip`` are given back."""
        own = text[found]
        order = np.argsort(own, kind="stable")
        found, own = found[order], own[order]
        edges = np.flatnonzero(np.append(True, own[1:] != own[:-1])).tolist() if len(own) else []
        back = found[:0]
        for a, b in zip(edges, [*edges[1:], len(own)]):
            if own[a] == skip:
                back = found[a:b]
            else:
                lists[own[a]].append(found[a:b])
        return back

    last = np.array([len(text) - 1], np.int32)
    deal(last, larger_lists, -1)
    whole: list[np.ndarray] = []
    for symbol in range(symbols):
        done, now = [], np.concatenate(larger_lists[symbol]) if larger_lists[symbol] else None
        while now is not None and len(now):
            done.append(now)
            before = now[now > 0] - 1
            now = deal(before[~smaller[before]], larger_lists, symbol)
        whole.append(np.concatenate(done) if done else np.zeros(0, np.int32))
        own = seeds[first_of[symbol]:first_of[symbol + 1]]
        before = own[own > 0] - 1
        deal(before, larger_lists, -1)  # what stands before a leftmost-smaller suffix is larger

    smaller_lists: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    out: list[np.ndarray] = []
    for symbol in range(symbols - 1, -1, -1):  # from the end, so lists are in falling order
        done, now = [], np.concatenate(smaller_lists[symbol]) if smaller_lists[symbol] else None
        while now is not None and len(now):
            done.append(now)
            before = now[now > 0] - 1
            now = deal(before[smaller[before]], smaller_lists, symbol)
        falling = whole[symbol][::-1]
        before = falling[falling > 0] - 1
        deal(before[smaller[before]], smaller_lists, -1)
        out += [*done, falling]
    return np.concatenate(out)[::-1]


def _induce_singly(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """The same, a suffix at a time: for strings whose buckets are too small to be worth arrays of their own."""
    n = len(text)
    ends = np.cumsum(np.bincount(text, minlength=symbols))
    heads = array("i", np.append(0, ends[:-1]).astype(np.int32).tobytes())
    tails = array("i", ends.astype(np.int32).tobytes())
    before = np.append(-1, text).astype(np.int32)  # the symbol before each place
    grows = np.append(False, smaller)  # and whether the suffix there is smaller than the next
    larger_before = array("i", np.where(grows, -1, before)[:n].tobytes()) + array("i", [-1])  # place -1 is an empty slot
    smaller_before = array("i", np.where(grows, before, -1)[:n].tobytes()) + array("i", [-1])

    start = np.full(n, -1, np.int32)
    own = text[seeds]
    start[ends[own] - np.searchsorted(own, own, "right") + np.arange(len(seeds))] = seeds  # at the ends of their buckets
    order = array("i", start.tobytes())
    order[heads[text[-1]]] = n - 1
    heads[text[-1]] += 1
    for place in order:  # grows ahead of the reading
        symbol = larger_before[place]
        if symbol >= 0:
            order[heads[symbol]] = place - 1
            heads[symbol] += 1
    for place in reversed(order):
        symbol = smaller_before[place]
        if symbol >= 0:
            tails[symbol] -= 1
            order[tails[symbol]] = place - 1
    return np.frombuffer(order, np.int32)


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix array of an array of symbols 0 .. symbols - 1."""
    text = text.astype(np.int32)
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    induce = _induce if symbols * BUCKET_ROWS <= n else _induce_singly
    smaller = _larger_types(text)
    leftmost = smaller & np.append(False, ~smaller[:-1])
    where = np.flatnonzero(leftmost).astype(np.int32)
    if len(where) > 1:
        # sort the leftmost-smaller substrings: induce from them in the order of their first symbols
        sorted_once = induce(text, smaller, where[np.argsort(text[where], kind="stable")], symbols)
        seeds = sorted_once[leftmost[sorted_once]]
        del sorted_once
        # name them: equal neighbours get one name; a substring goes up to the next leftmost-smaller one
        size = np.append(where[1:] + 1, np.int32(n)) - where
        of = np.full(n, -1, np.int32)
        of[where] = np.arange(len(where))
        a, b = seeds[:-1], seeds[1:]
        same = (size[of[a]] == size[of[b]]) & (b != where[-1]) & (a != where[-1])
        open_, depth = np.flatnonzero(same), 0
        while len(open_):
            left = size[of[a[open_]]] > depth
            open_ = open_[left]
            equal = text[a[open_] + depth] == text[b[open_] + depth]
            same[open_[~equal]] = False
            open_ = open_[equal]
            depth += 1
        name = np.append(0, np.cumsum(~same))
        names = np.empty(len(where), np.int32)
        names[of[seeds]] = name
        del of, size, a, b, same, open_
        if name[-1] < len(where) - 1:
            seeds = where[suffix_array(names, int(name[-1]) + 1)]
        return induce(text, smaller, seeds, symbols)
    return induce(text, smaller, where, symbols)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in the text the symbols, up to ``most``, that its suffix shares with the one before it in the array.

    Where the symbols before the two suffixes are equal too, the place before shares one symbol more with its own predecessor, so only
    the other places are compared; all that follow count down from them."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int32)
    led = np.append(np.int32(-1), text.astype(np.int32))  # the symbol before each place
    compared = (before <= 0) | (led[:-1] != led[before])
    compared[0] = True
    padded = np.append(led[1:], np.full(PACKED, -1, np.int32))
    del led
    packed = np.zeros(n + 1, np.uint64)
    for i in range(PACKED):
        packed[:n] = (packed[:n] << np.uint64(9)) | (padded[i:i + n] + 1).astype(np.uint64)
    del padded
    open_ = np.flatnonzero(compared & (before >= 0))
    while len(open_):  # PACKED symbols at a time
        x, y = np.minimum(open_ + shared[open_], n), np.minimum(before[open_] + shared[open_], n)
        differing = packed[x] ^ packed[y]
        ended = (differing != 0) | (x == n) | (y == n)
        if ended.any():
            at, bits = open_[ended], differing[ended]
            step = np.zeros(len(at), np.int64)
            for i in range(1, PACKED):
                step += bits < np.uint64(1 << 9 * (PACKED - i))  # the first i symbols agree
            shared[at] += np.where((x[ended] == n) | (y[ended] == n), 0, step)
            open_ = open_[~ended]
        shared[open_] += PACKED
    del packed, before
    place = np.arange(n, dtype=np.int32)
    last = np.maximum.accumulate(np.where(compared, place, np.int32(0)))  # the compared place that each one counts down from
    return np.minimum(shared[last] - (place - last), np.int32(most))


def smallest_ids(stretches: list[bytes], ids: np.ndarray, length: int) -> list[np.ndarray]:
    """For each stretch and each string of ``length`` bytes in it, the smallest id of the stretches that have the string."""
    sizes = np.array([len(s) + 1 for s in stretches])
    text = np.frombuffer(b"\0".join(stretches) + b"\0", np.uint8).astype(np.int32) + 1
    starts = np.cumsum(sizes) - sizes
    text[starts + sizes - 1] = 0  # the end of a stretch is smaller than every byte
    order = suffix_array(text, 257)
    prefixes = common_prefixes(text, order, length)
    begin = np.flatnonzero(prefixes[order] < length)
    del prefixes
    left = np.repeat((starts + sizes - 1).astype(np.int32), sizes) - np.arange(len(text), dtype=np.int32)
    own = np.where(left >= length, np.repeat(ids, sizes), NO_ID)
    del left
    least = np.minimum.reduceat(own[order], begin)
    of_place = np.empty(len(text), np.int64)
    of_place[order] = np.repeat(least, np.diff(np.append(begin, len(text))))
    return [of_place[a:a + size - length] for a, size in zip(starts.tolist(), sizes.tolist())]


def with_partners(stretches: list[bytes], leads: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which of different stretches may share a string of ``length`` bytes with another one; ``leads``: where in each its anchor is.

    Equal strings have their anchors at the same place. For every ``SLACK`` places the bytes around the anchor that are in all those strings
    are hashed, so a stretch whose bytes no other one has is alone. Those that remain are candidates, which their suffix array judges."""
    sizes = np.array([len(s) for s in stretches])
    right = sizes - leads - gram  # bytes behind the anchor
    slices = [(least, max(length - gram - least - SLACK + 1, 0)) for least in range(0, length - gram + 1, SLACK)]
    hashes = np.empty((len(slices), len(stretches)), np.uint64)
    with np.errstate(over="ignore"):
        for a, b in steps(stretches):
            sums = running_hash(np.frombuffer(b"".join(stretches[a:b]), np.uint8))
            at = np.cumsum(sizes[a:b]) - sizes[a:b] + leads[a:b]
            for own, (least, behind) in zip(hashes, slices):
                own[a:b] = range_hash(sums, np.maximum(at - least, 0), np.minimum(at + gram + behind, len(sums) - 1))
    found = np.zeros(len(stretches), bool)
    for own, (least, behind) in zip(hashes, slices):
        long = np.flatnonzero((leads >= least) & (right >= behind))
        _, of, count = np.unique(own[long], return_inverse=True, return_counts=True)
        found[long[count[of] > 1]] = True
    return found


def hit_ranges(hit: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of true values in groups of ``counts`` values put together: group, first value and last value in the group."""
    starts = np.cumsum(counts) - counts
    opens, closes = hit.copy(), hit.copy()
    opens[1:] &= ~hit[:-1]
    closes[:-1] &= ~hit[1:]
    opens[starts] = hit[starts]
    closes[starts + counts - 1] = hit[starts + counts - 1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    group = np.searchsorted(starts, first, "right") - 1
    return group, first - starts[group], last - starts[group]


# ---- anchors and stretches ----

def stretches_of(texts: list[bytes], length: int, gram: int) -> Iterator[tuple]:
    """For about STEP_BYTES of texts at a time: their first number, the bytes put together, where each text starts, and for each stretch its
    text, first byte, end, anchor and where in the stretch that is, and the running hash of the bytes."""
    with np.errstate(over="ignore"):
        for a, b in steps(texts):
            sizes = np.array([len(t) for t in texts[a:b]])
            whole = b"".join(texts[a:b])
            starts = np.cumsum(sizes) - sizes
            raw = np.frombuffer(whole, np.uint8)
            n = len(raw) - length + 1
            if n <= 0:
                continue
            sums = running_hash(raw)
            grams = next_hashes(sums, gram)
            best = grams & np.uint64(0xFFFFFFFF00000000)
            best |= np.arange(len(grams), dtype=np.uint64)  # the leftmost of the smallest wins
            wide, width = length - gram + 1, 1
            while 2 * width <= wide:
                best = np.minimum(best[:-width], best[width:])
                width *= 2
            if wide > width:
                best = np.minimum(best[:n], best[wide - width:wide - width + n])
            anchor = best[:n].astype(np.uint32)
            del best
            crossing = np.zeros(n, bool)  # strings that begin in one text and end in a later one
            for text_end in (starts + sizes)[:-1].tolist():
                crossing[max(text_end - length + 1, 0):text_end] = True
            new = ~crossing
            new[1:] &= (anchor[1:] != anchor[:-1]) | crossing[:-1]
            new[starts[starts < n]] = ~crossing[starts[starts < n]]
            ends = ~crossing
            ends[:-1] &= new[1:] | crossing[1:]
            first, last = np.flatnonzero(new), np.flatnonzero(ends)
            anchor = anchor[first].astype(np.int64)
            of = np.searchsorted(starts, first, "right") - 1
            yield a, whole, starts, of, first, last + length, grams[anchor], anchor - first, sums


def _packed(kind: str, values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype(kind)).tobytes()


def _key(anchors: np.ndarray) -> np.ndarray:
    """The upper 48 bits of anchors; that some share them by chance makes candidates, not results."""
    return anchors & ~np.uint64(0xFFFF)


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers in rising order, byte by byte, so that the bytes that hardly change are together."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def _unsqueezed(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def shared_anchors(docs: DataFrame, length: int, gram: int, log2_bits: int, buckets: int) -> BitField:
    """A field of the anchors that more than one row has."""

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        twice: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            found, count = np.unique(np.concatenate(held), return_counts=True)
            repeated = np.unique(np.concatenate(twice)) if twice else found[:0]
            marked = found | ((count > 1) | np.isin(found, repeated)).astype(np.uint64)
            edges = np.searchsorted(marked >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64) * np.uint64((1 << 32) // buckets + 1))
            full = np.flatnonzero(np.diff(edges))
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([_squeezed(marked[edges[i]:edges[i + 1]]) for i in full], pa.binary())], ["bucket", "anchors"])

        for batch in batches:
            for _, _, _, of, _, _, anchors, _, _ in stretches_of(batch.column(0).cast(pa.binary()).to_pylist(), length, gram):
                anchors = _key(anchors)
                order = np.lexsort((of, anchors))
                anchors, of = anchors[order], of[order]
                kept = np.append(True, (anchors[1:] != anchors[:-1]) | (of[1:] != of[:-1]))[:len(anchors)]
                anchors = anchors[kept]
                again = np.append(anchors[1:] == anchors[:-1], False)[:len(anchors)]
                twice.append(anchors[again])
                held.append(np.unique(anchors))
                size += len(anchors)
                if size > 2_000_000:
                    yield flush()
                    held, twice, size = [], [], 0
        if held:
            yield flush()

    def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.concatenate([_unsqueezed(x.as_py(), "<u8") for batch in batches for x in batch.column("anchors")])
        found.sort()
        plain = _key(found)
        shared = np.unique(plain[(found & np.uint64(1) == 1) | np.append(plain[1:] == plain[:-1], False)])
        field = BitField(log2_bits)
        field.add(shared)
        rows = list(segments(field.data))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["seg", "blob"])

    sent = docs.select(text_or_empty("_text")).mapInArrow(collect, "bucket int, anchors binary")
    pieces = sent.groupBy("bucket").applyInArrow(meet, "seg int, blob binary")
    size = 1 << (log2_bits - 3)
    return BitField(log2_bits, merged(pieces, size, "u1", np.zeros(size, np.uint8), np.bitwise_or))


# A task's stretches for one shard and the places of each: every array compressed. The last four fields hold ranges of some documents.
_SENT = ("bucket int, leads binary, sizes binary, bytes binary, place_stretch binary, place_doc binary, place_at binary, doc_ids binary, "
         "doc_hashes binary, doc_bucket int, doc_counts binary, ranges binary")
_RANGES = ("doc_bucket", "doc_ids", "doc_hashes", "doc_counts", "ranges")


def _ranges(firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges in order, with those that touch or overlap put together."""
    order = np.argsort(firsts, kind="stable")
    firsts, ends = firsts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, firsts[1:] > ends[:-1])
    last = np.append(new[1:], True)
    return firsts[new], ends[last]


def _by_document(ids: np.ndarray, hashes: np.ndarray, firsts: np.ndarray, ends: np.ndarray, buckets: int) -> Iterator[dict]:
    """Ranges put together by document, and documents by bucket, packed: a row for each bucket of documents."""
    if not len(ids):
        return
    bucket = (mixed(ids.view(np.uint64) ^ hashes.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((firsts, hashes, ids, bucket))
    bucket, ids, hashes, firsts, ends = (c[order] for c in (bucket, ids, hashes, firsts, ends))
    new = np.append(True, (bucket[1:] != bucket[:-1]) | (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1]))
    start = np.flatnonzero(new)
    parts = [_ranges(firsts[a:b], ends[a:b]) for a, b in zip(start, np.append(start[1:], len(ids)))]
    counts = np.array([len(f) for f, _ in parts])
    edges = np.flatnonzero(np.append(True, bucket[start][1:] != bucket[start][:-1]))
    for a, b in zip(edges, np.append(edges[1:], len(start))):
        yield {"doc_bucket": int(bucket[start[a]]), "doc_ids": _packed("<i8", ids[start[a:b]]), "doc_hashes": _packed("<i8", hashes[start[a:b]]),
               "doc_counts": _packed("<u4", counts[a:b]),
               "ranges": _packed("<i8", np.concatenate([np.stack(p, 1) for p in parts[a:b]]))}


def covered_ranges(docs: DataFrame, field: BitField, length: int, gram: int, buckets: int) -> DataFrame:
    """``doc_id``, ``doc_hash`` and the packed ranges of bytes to remove, one row for a document."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    names = [part.split()[0] for part in _SENT.split(", ")]

    def row(**values) -> tuple:
        return tuple(values.get(name) for name in names)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32() if " int" in part else pa.int64() if " long" in part else pa.binary() for part in _SENT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            text_hashes = batch.column("_hash").to_numpy(zero_copy_only=False)
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            at, held = 0, 0
            for upto in range(1, len(texts) + 1):  # some megabytes of texts at a time
                held += len(texts[upto - 1])
                if held >= HELD_BYTES or upto == len(texts):
                    rows = part(texts[at:upto], ids[at:upto], text_hashes[at:upto], squeeze)
                    if rows:
                        yield as_batch(rows)
                    at, held = upto, 0

    def part(texts: list[bytes], ids: np.ndarray, text_hashes: np.ndarray, squeeze) -> list[tuple]:
        found: list[tuple] = []
        spelled: dict[int, bytes] = {}
        for base, whole, starts, of, first, end, anchors, leads, sums in stretches_of(texts, length, gram):
            keep = shared.value.has(_key(anchors))
            of, first, end, anchors, leads = of[keep], first[keep], end[keep], anchors[keep], leads[keep]
            hashes = range_hash(sums, first, end)
            for i in np.unique(hashes, return_index=True)[1]:
                spelled.setdefault(int(hashes[i]), whole[first[i]:end[i]])
            found.append((hashes, anchors, leads, of + base, first - starts[of], end - first))
        if not spelled:
            return []
        hashes, anchors, leads, of, at, sizes = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids[of], hashes))
        hashes, anchors, leads, of, at, sizes = (c[order] for c in (hashes, anchors, leads, of, at, sizes))
        head = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(hashes))))
        least = ids[of[head]]
        later = ids[of] > least[group]  # a smaller id has the whole stretch
        rows = [row(bucket=-1 - known["doc_bucket"], **known) for known in _by_document(
            ids[of[later]], text_hashes[of[later]], at[later], at[later] + sizes[later], buckets)]
        bucket = (anchors[head] % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        place = ~later
        p_group, p_of, p_at = group[place], of[place], at[place]
        rank = np.empty(len(head), np.int64)
        edges = np.flatnonzero(np.append(True, bucket[by_bucket][1:] != bucket[by_bucket][:-1]))
        ends = np.append(edges[1:], len(by_bucket))
        for a, b in zip(edges, ends):
            rank[by_bucket[a:b]] = np.arange(b - a)
        p_bucket = bucket[p_group]
        p_order = np.argsort(p_bucket, kind="stable")
        p_edges = np.searchsorted(p_bucket[p_order], bucket[by_bucket[edges]], "left")
        p_ends = np.searchsorted(p_bucket[p_order], bucket[by_bucket[edges]], "right")
        for a, b, c, d in zip(edges, ends, p_edges, p_ends):
            own, places = by_bucket[a:b], p_order[c:d]
            used, doc = np.unique(p_of[places], return_inverse=True)
            rows.append(row(
                bucket=int(bucket[own[0]]), leads=squeeze(_packed("<u2", leads[head[own]])), sizes=squeeze(_packed("<u2", sizes[head[own]])),
                bytes=squeeze(b"".join(spelled[int(h)] for h in hashes[head[own]])),
                place_stretch=_squeezed(rank[p_group[places]].astype("<u4")), place_doc=_squeezed(doc.astype("<u4")),
                place_at=_squeezed(p_at[places].astype("<u4")), doc_ids=_packed("<i8", ids[used]), doc_hashes=_packed("<i8", text_hashes[used])))
        return rows

    def judge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key[0].as_py() < 0:  # ranges that are known already
            for batch in batches:
                yield batch.select(list(_RANGES))
            return
        unpack = zstandard.ZstdDecompressor().decompress
        index: dict[bytes, int] = {}
        lead_of, places = [], []
        for batch in batches:
            for values in batch.to_pylist():
                text, at, local = unpack(values["bytes"]), 0, []
                for size, lead in zip(np.frombuffer(unpack(values["sizes"]), "<u2").tolist(), np.frombuffer(unpack(values["leads"]), "<u2").tolist()):
                    own = text[at:at + size]
                    at += size
                    i = index.setdefault(own, len(index))
                    if i == len(lead_of):
                        lead_of.append(lead)
                    local.append(i)
                doc = _unsqueezed(values["place_doc"], "<u4")
                places.append((np.array(local, np.int64)[_unsqueezed(values["place_stretch"], "<u4")], _unsqueezed(values["place_at"], "<u4").astype(np.int64),
                               np.frombuffer(values["doc_ids"], "<i8")[doc], np.frombuffer(values["doc_hashes"], "<i8")[doc]))
        spelled = list(index)
        stretch, at, ids, text_hashes = (np.concatenate(c) for c in zip(*places))
        least = np.full(len(spelled), NO_ID)
        np.minimum.at(least, stretch, ids)
        several = np.flatnonzero(with_partners(spelled, np.array(lead_of), length, gram))  # one that is alone has only its own ids
        sizes = np.array([len(s) for s in spelled])
        rank = np.full(len(spelled), -1)
        rank[several] = np.arange(len(several))
        gone = np.flatnonzero((rank[stretch] < 0) & (least[stretch] < ids))
        rows_, firsts, ends = [gone], [at[gone]], [at[gone] + sizes[stretch[gone]]]
        if len(several):
            decided = np.concatenate(smallest_ids([spelled[i] for i in several], least[several], length))
            strings = sizes[several] - length + 1
            begin = np.cumsum(strings) - strings
            met = np.flatnonzero(rank[stretch] >= 0)
            for first in range(0, len(met), PLACES):  # some places at a time
                own = met[first:first + PLACES]
                of = rank[stretch[own]]
                counts = strings[of]
                string = np.repeat(begin[of] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                group, first_hit, last_hit = hit_ranges(decided[string] < np.repeat(ids[own], counts), counts)
                rows_.append(own[group])
                firsts.append(at[own[group]] + first_hit)
                ends.append(at[own[group]] + last_hit + length)
        rows_ = np.concatenate(rows_)
        made = list(_by_document(ids[rows_], text_hashes[rows_], np.concatenate(firsts), np.concatenate(ends), buckets))
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[name] for m in made], pa.int32() if name == "doc_bucket" else pa.binary()) for name in _RANGES], list(_RANGES))

    def gather(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for batch in batches:
            for values in batch.to_pylist():
                n = np.frombuffer(values["doc_counts"], "<u4")
                both = np.frombuffer(values["ranges"], "<i8").reshape(-1, 2)
                parts.append((np.repeat(np.frombuffer(values["doc_ids"], "<i8"), n), np.repeat(np.frombuffer(values["doc_hashes"], "<i8"), n), both[:, 0], both[:, 1]))
        for done in _by_document(*(np.concatenate(c) for c in zip(*parts)), 1):
            n = np.frombuffer(done["doc_counts"], "<u4").astype(np.int64)
            edges = 16 * np.append(0, np.cumsum(n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(done["doc_ids"], "<i8")), pa.array(np.frombuffer(done["doc_hashes"], "<i8")),
                 pa.array([done["ranges"][a:b] for a, b in zip(edges, edges[1:])], pa.binary())], ["doc_id", "doc_hash", "ranges"])

    sent = docs.select("_id", "_hash", text_or_empty("_text").alias("_text")).mapInArrow(cut, _SENT)
    judged = sent.groupBy("bucket").applyInArrow(judge, "doc_bucket int, doc_ids binary, doc_hashes binary, doc_counts binary, ranges binary")
    return judged.groupBy("doc_bucket").applyInArrow(gather, "doc_id long, doc_hash long, ranges binary")


def without_repeats(docs: DataFrame, length: int = 50, gram: int = GRAM, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with ``_n_bytes``, ``_n_removed``, ``_n_spans``, ``_kept_sha256``, ``_kept_text`` and the removed ranges ``_spans``."""
    size = total_bytes(docs, text_column)
    prepared = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(F.col(text_column)).alias("_hash"),
                           F.col(text_column).alias("_text"))
    gram = min(gram, length)
    log2_bits = log2_bits_for(size // 40)
    field = shared_anchors(prepared, length, gram, log2_bits, max(1, size // SHARD_BYTES))
    ranges = covered_ranges(prepared, field, length, gram, max(1, size // SHARD_BYTES))
    per_doc = ranges.select(F.col("doc_id").alias("_id_r"), F.col("doc_hash").alias("_hash_r"), F.col("ranges").alias("_ranges"))
    inner, (id_column, text_column) = numbered(docs, id_column, text_column)
    marked = inner.withColumns({"_id": F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)), "_hash": F.xxhash64(F.col(text_column))})
    joined = marked.join(per_doc.hint("merge"), (F.col("_id") == F.col("_id_r")) & (F.col("_hash") == F.col("_hash_r")), "left").drop(
        "_id", "_hash", "_id_r", "_hash_r")
    made = T.StructType([
        T.StructField("_n_bytes", T.LongType()), T.StructField("_n_removed", T.LongType()), T.StructField("_n_spans", T.LongType()),
        T.StructField("_kept_sha256", T.StringType()), T.StructField("_kept_text", T.StringType()),
        T.StructField("_spans", T.ArrayType(T.ArrayType(T.LongType())))])

    def rest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, packed in zip(batch.column(text_column).cast(pa.binary()).to_pylist(), batch.column("_ranges").to_pylist()):
                text = text or b""
                firsts, ends = np.frombuffer(packed or b"", "<i8").reshape(-1, 2).T
                keeps = zip(np.append(0, ends).tolist(), np.append(firsts, len(text)).tolist())
                kept = b"".join(text[a:b] for a, b in keeps)
                rows.append((len(text), len(text) - len(kept), len(firsts), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"),
                             np.stack([firsts, ends], 1).tolist()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.list_(pa.int64()))]
            plain = batch.select([name for name in batch.schema.names if name != "_ranges"])
            yield pa.RecordBatch.from_arrays([*plain.columns, *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]],
                                             [*plain.schema.names, *made.fieldNames()])

    done = joined.mapInArrow(rest, T.StructType([*inner.schema.fields, *made.fields]))
    return with_results(docs, done, made.fieldNames())
