"""Sampled segmentation with the pieces of a SentencePiece model, and lossless decoding.

Segmentations are drawn from all paths through the lattice of pieces that spell a text: the forward
filter sums the weight of all paths up to each position, then pieces are sampled from the end back.
A path's weight is the product of its pieces' weights to the power ``alpha``; a piece's weight falls with its rank in the
model as 1 / (2 + rank), since a BPE model has ranks for scores. Draws depend on the seed, the row's
key and the place in the text alone, so a rerun, another partitioning or a repeated row gives the same pieces.

Spaces are the model's word mark, and a text is read with one mark in front of it. Characters that have no piece are
spelled in byte pieces, and so is the word mark where it occurs in a text itself; decoding gives back
every text byte for byte. No piece crosses the start of a run of spaces or a newline, so lattices are built once per distinct
stretch between these and shared by its occurrences. NULL text counts as empty, has the front
mark alone and decodes to the empty text; NULL keys draw as the key ``None``. No rows give no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyweave.llm.common import byte_steps, text_or_empty
from tallyweave.llm.shingles import mixed

MARK = "▁"
SEPARATOR = 256  # a code that no byte has
DRAWS = 1 << 30
STEP_BYTES, HELD_NODES = 1 << 20, 1_500_000


class PieceModel:
    """The pieces of a model as byte strings, with a space for the word mark, in exact lookup tables by length."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled: list[bytes] = []
        self.byte_id = np.full(256, -1, np.int64)
        weights, by_length = [], {}
        for i in range(model.get_piece_size()):
            piece, rank = model.id_to_piece(i), max(0.0, -model.get_score(i))
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], rank = i, 1e9
                self.spelled.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                self.spelled.append(piece.replace(MARK, " ").encode())
                by_length.setdefault(len(self.spelled[-1]), []).append(i)
                if "\n" in piece or MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} crosses a stretch")
            weights.append(-alpha * np.log(2 + rank))
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        self.weights = np.array(weights)
        self.sizes = np.array([len(piece) for piece in self.spelled])
        self.tables = {length: ([self.spelled[i] for i in ids], np.array(ids, np.int64)) for length, ids in sorted(by_length.items())}
        self._build_trie()

    def _build_trie(self) -> None:
        """A trie of the pieces in two arrays: the child of state ``s`` by byte ``c`` is ``base[s] + c`` if ``parent`` of that is ``s``."""
        children, ends = [{}], [-1]
        for spelled, ids in self.tables.values():
            for piece, i in zip(spelled, ids.tolist()):
                at = 0
                for byte in piece:
                    if byte not in children[at]:
                        children[at][byte] = len(children)
                        children.append({})
                        ends.append(-1)
                    at = children[at][byte]
                ends[at] = i if ends[at] < 0 else ends[at]
        # the first free place that has room for all children, those with most children first; places up to SEPARATOR stay free
        taken, bases, low = bytearray(SEPARATOR + 1), [0] * len(children), SEPARATOR + 1
        for at in sorted((at for at in range(len(children)) if children[at]), key=lambda at: -len(children[at])):
            head, *rest = sorted(children[at])
            place, tries = low, 0
            while True:
                if len(taken) < place + 2 * SEPARATOR:
                    taken.extend(bytes(len(taken)))
                place, tries = taken.index(0, place), tries + 1
                if not any(taken[place - head + byte] for byte in rest):
                    break
                place += 1
            bases[at] = place - head
            for byte in (head, *rest):
                taken[place - head + byte] = 1
            low = place if tries > 64 or not rest else low
        size = len(taken) + SEPARATOR + 1
        self.base, self.parent, self.ending = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        places = [0] * len(children)
        for at, below in enumerate(children):  # parents come before their children
            self.base[places[at]], self.ending[places[at]] = bases[at], ends[at]
            for byte, child in below.items():
                places[child] = bases[at] + byte
                self.parent[places[child]] = places[at]

    def edges(self, raw: np.ndarray, finals: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Start, length and piece of every edge, by ascending length; no two edges that come together have the same end.
        Stretches lie one behind the other, each with one more byte at ``finals``, its end, which is no part of it."""
        codes = raw.astype(np.int32)
        codes[finals] = SEPARATOR
        chars = np.flatnonzero((raw & 0xC0) != 0x80).astype(np.int32)  # first bytes of characters
        char_size = np.diff(np.append(chars, len(raw)))
        known = np.zeros(len(raw), bool)
        at, state, length = chars, np.zeros(len(chars), np.int32), 0
        while len(at):
            below = self.base[state] + codes[at + length]
            alive = np.flatnonzero(self.parent[below] == state)
            at, state, length = at[alive], below[alive], length + 1
            pieces = self.ending[state]
            hit = np.flatnonzero(pieces >= 0)
            starts = at[hit]
            if length <= 4:
                known[starts[self._char_size(raw, starts) == length]] = True
            yield starts, length, pieces[hit]
            inside = np.flatnonzero(self.base[state])
            at, state = at[inside], state[inside]
        lone = np.repeat(~known[chars], char_size)
        lone[finals - chars[0]] = False
        spelled = np.flatnonzero(lone) + chars[0]
        yield spelled, 1, self.byte_id[raw[spelled]]

    @staticmethod
    def _char_size(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        first = raw[at]
        return 1 + (first >= 0xC0).astype(int) + (first >= 0xE0) + (first >= 0xF0)

    def decode(self, ids: Iterable[int]) -> bytes:
        """The text of a sequence of pieces, without the mark in front."""
        return b"".join(map(self.spelled.__getitem__, ids))[1:]


class Lattices:
    """Lattices of many stretches: for each node (a byte position) the edges that end there, with running
    probabilities of where a path through it came from, in steps of 2^-30 above the edge's piece."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.finals, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.begin, self.edges = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    @property
    def nodes(self) -> int:
        return len(self.begin)

    def add(self, stretches: list[bytes]) -> None:
        """Build the lattices of new stretches."""
        raw = np.frombuffer(b"\0".join([*stretches, b""]), np.uint8)
        sizes = np.array([len(s) for s in stretches])
        finals = np.cumsum(sizes + 1) - 1
        firsts = finals - sizes
        # edges lie by the depth of the node they end at, then longest stretch first, so that a depth's nodes are together
        order = np.argsort(-sizes, kind="stable")
        rank = np.empty(len(sizes), np.int64)
        rank[order] = np.arange(len(sizes))
        wide = np.bincount(sizes)[::-1].cumsum()[::-1]  # stretches that reach a depth
        level = np.append(0, np.cumsum(wide))
        place = level[np.arange(len(raw)) - np.repeat(firsts, sizes + 1)] + np.repeat(rank, sizes + 1)
        blocks = [(starts, place[starts + length], pieces) for starts, length, pieces in self.model.edges(raw, finals)]
        count = np.zeros(len(raw), np.int64)
        for _, ends, _ in blocks:
            count[ends] += 1
        begin = np.append(0, np.cumsum(count))
        source, pieces, free = np.empty(begin[-1], np.int64), np.empty(begin[-1], np.int64), begin[:-1].copy()
        for starts, ends, own in blocks:
            at = free[ends]
            source[at], pieces[at], free[ends] = starts, own, at + 1
        weight, by_rank = self.model.weights[pieces], firsts[order]
        total, share = np.zeros(len(raw)), np.empty(len(source), np.uint64)
        for depth in range(1, len(wide)):
            here = np.flatnonzero(count[level[depth]:level[depth + 1]])  # none inside a character that is a piece
            if not len(here):
                continue
            own = slice(begin[level[depth]], begin[level[depth + 1]])
            head, n = begin[level[depth] + here] - own.start, count[level[depth] + here]
            value = total[source[own]] + weight[own]
            most = np.maximum.reduceat(value, head)
            part = np.exp(value - np.repeat(most, n))
            summed = np.add.reduceat(part, head)
            total[by_rank[here] + depth] = most + np.log(summed)
            running = np.cumsum(part)
            running -= np.repeat(running[head] - part[head], n)
            running /= np.repeat(summed, n)
            running[head + n - 1] = 1.0
            share[own] = np.ceil(np.minimum(running, 1.0) * DRAWS)
        self.begin = np.concatenate([self.begin, len(self.edges) + begin[place]])
        self.finals = np.concatenate([self.finals, self.nodes - len(raw) + finals])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.edges = np.concatenate([self.edges, share << np.uint64(32) | pieces.astype(np.uint64)])
        for stretch in stretches:
            self.index[stretch] = len(self.index)

    def sample(self, which: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of the given stretches in order, and how many each has."""
        node, left, active, steps = self.finals[which], self.sizes[which], np.arange(len(which)), []
        counts = np.zeros(len(which), np.int64)
        low = np.uint64(0xFFFFFFFF)
        while len(active):
            shift = len(steps) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF
            bar = drawn(keys + np.uint64(shift)) << np.uint64(32) | low
            at = self.begin[node]
            edge = self.edges[at]
            on = np.flatnonzero(edge <= bar)  # the node's last edge has all of the probability before it
            while len(on):
                at[on] += 1
                next_edge = self.edges[at[on]]
                edge[on] = next_edge
                on = on[next_edge <= bar[on]]
            piece = (edge & low).astype(np.int32)
            size = self.model.sizes[piece]
            steps.append((active, piece))
            left = left - size
            going = np.flatnonzero(left > 0)
            counts[active] = len(steps)
            node, left, keys, active = (node - size)[going], left[going], keys[going], active[going]
        ends = np.cumsum(counts)
        out = np.empty(int(counts.sum()), np.int32)
        for step, (own, piece) in enumerate(steps):
            out[ends[own] - 1 - step] = piece
        return out, counts


def drawn(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 up to, and never, DRAWS."""
    return mixed(keys) >> np.uint64(34)


@lru_cache(maxsize=1)
def piece_model(path: str, alpha: float) -> PieceModel:
    """One model for all tasks of a Python worker."""
    return PieceModel(path, alpha)


def _stretches(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The stretches of all texts, each with a space in front, the first stretch of each text and the number of its stretches."""
    joined = b"".join([part for text in texts for part in (b" ", text)])
    raw = np.frombuffer(joined, np.uint8)
    text_at = np.cumsum([0, *(len(text) + 1 for text in texts[:-1])])
    space, line = raw == 0x20, raw == 0x0A
    begins = line.copy()  # at a newline, behind one and at the first of some spaces
    begins[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    begins[text_at] = True
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(raw))
    stretches = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    first = np.searchsorted(starts, text_at)
    return stretches, first, np.diff(np.append(first, len(starts)))


def sampled_pieces(docs: DataFrame, model_path: str, seed: int = 0, alpha: float = 1.0,
                   key_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``key``, ``ids`` (array of int), ``n_pieces`` and ``lossless``: whether the pieces decode to the text."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path, alpha)
        lattices = Lattices(model)
        base = np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
        for batch in batches:
            keys = batch.column(0)
            names = keys.cast(pa.string()).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for first, last in byte_steps(texts, STEP_BYTES):
                stretches, row_at, sizes = _stretches(texts[first:last])
                coded = stretches.dictionary_encode()
                distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
                new = [s for s in distinct if s not in lattices.index]
                if new and lattices.nodes > HELD_NODES:
                    lattices.clear()
                    new = distinct
                if new:
                    lattices.add(new)
                which = np.fromiter(map(lattices.index.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
                row = np.array([zlib.crc32(str(name).encode()) for name in names[first:last]], np.uint64)
                place = np.arange(len(which)) - np.repeat(row_at, sizes)
                occurrence = mixed(np.repeat(mixed(row + base), sizes)
                                   + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                ids, counts = lattices.sample(which, occurrence)
                of_row = np.add.reduceat(counts, row_at)
                offsets = np.append(0, np.cumsum(of_row))
                values = ids.tolist()
                same = [model.decode(values[a:b]) == text for a, b, text in zip(offsets, offsets[1:], texts[first:last])]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, last - first), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                     pa.array(of_row), pa.array(same)], ["key", "ids", "n_pieces", "lossless"])

    schema = T.StructType([T.StructField("key", docs.schema[key_column].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()), T.StructField("lossless", T.BooleanType())])
    return docs.select(key_column, text_or_empty(text_column)).mapInArrow(encode, schema)


def decoded(pieces: DataFrame, model_path: str) -> DataFrame:
    """``key`` and the text that its ``ids`` spell."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path, 1.0)
        for batch in batches:
            texts = [None if ids is None else model.decode(ids).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    schema = T.StructType([pieces.schema["key"], T.StructField("text", T.StringType())])
    return pieces.select("key", "ids").mapInArrow(decode, schema)
