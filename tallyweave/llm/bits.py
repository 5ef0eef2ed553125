"""Bounded filters for keys: a bit field that is made on the executors and is small enough to send to all.

A field says "perhaps" or "no". What passes by chance is dropped by a later exact step; when more keys
than the field is made for are put in, more passes, and results stay the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 1 << 16


def _places(keys: np.ndarray, log2_bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.astype(np.uint64)
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    mask = np.uint64((1 << log2_bits) - 1)
    return (keys >> np.uint64(7)) & mask, (keys >> np.uint64(33)) & mask


class BitField:
    def __init__(self, log2_bits: int, data: np.ndarray | None = None):
        self.log2_bits = log2_bits
        self.data = np.zeros(1 << (log2_bits - 3), np.uint8) if data is None else data

    def add(self, keys: np.ndarray) -> None:
        for at in _places(keys, self.log2_bits):
            np.bitwise_or.at(self.data, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in _places(keys, self.log2_bits):
            out &= (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def log2_bits_for(n: int, least: int = 16, most: int = 28) -> int:
    """Sixteen bits a key, between 8 KB and 32 MB in all."""
    return min(most, max(least, (16 * max(n, 1)).bit_length()))


def segments(values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Numbered, compressed pieces of an array that are not all zero."""
    per = SEGMENT // values.itemsize
    for i in range(0, len(values), per):
        piece = values[i:i + per]
        if piece.any():
            yield i // per, zlib.compress(piece.tobytes(), 1)


def merged(pieces: DataFrame, size: int, dtype: str, total: np.ndarray, combine) -> np.ndarray:
    """Combine the pieces (``seg``, ``blob``) of all tasks into ``total``; each piece is merged in a task of its own."""

    def merge(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in rows:
            for blob in batch.column("blob"):
                piece = np.frombuffer(zlib.decompress(blob.as_py()), dtype).astype(total.dtype)
                out = piece if out is None else combine(out, piece)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(out.tobytes(), 1)])], ["seg", "blob"])

    per = SEGMENT // np.dtype(dtype).itemsize
    summed = pieces.select("seg", "blob").groupBy("seg").applyInArrow(merge, "seg int, blob binary")
    for seg, blob in summed.collect():  # the field has a fixed size
        piece = np.frombuffer(zlib.decompress(blob), total.dtype)
        total[seg * per:seg * per + len(piece)] = piece
    return total


def bit_field(keys: DataFrame, column: str, log2_bits: int) -> BitField:
    """A field with all values of a long column."""

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = BitField(log2_bits)
        for batch in batches:
            field.add(batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64))
        rows = list(segments(field.data))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows])], ["seg", "blob"])

    pieces = keys.select(F.col(column).cast("long")).mapInArrow(put, "seg int, blob binary")
    size = 1 << (log2_bits - 3)
    return BitField(log2_bits, merged(pieces, size, "u1", np.zeros(size, np.uint8), np.bitwise_or))
