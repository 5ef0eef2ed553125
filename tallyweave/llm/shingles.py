"""Sets of word shingles as 64-bit hashes, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

STEP_BYTES = 1 << 16  # arrays of eight bytes for each byte of a step stay in a core's cache
_BASE, _MASK = 0x9E3779B97F4A7C15 | 1, (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Table:
    """Powers of the base and of its inverse, as long as the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, STEP_BYTES + 65_536)
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


_TABLE = _Table()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running_hash(raw: np.ndarray) -> np.ndarray:
    """Prefix sums of bytes times powers, modulo 2^64, with a zero in front."""
    _TABLE.reach(len(raw) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _TABLE.up[:len(raw)])])


def range_hash(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges, equal for equal bytes wherever they stand."""
    _TABLE.reach(len(sums))
    return mixed((sums[last] - sums[first]) * _TABLE.down[first] + (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def next_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """``range_hash`` of the ``size`` bytes from each place on that has as many."""
    _TABLE.reach(len(sums))
    x = sums[size:] - sums[:-size]
    x *= _TABLE.down[:len(x)]
    x += np.uint64(size * 0xC2B2AE3D27D4EB4F & _MASK)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def steps(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about STEP_BYTES together."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= STEP_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted. A-Z are lower-cased; words are runs of bytes other than
    ASCII white space; a text of fewer words has one shingle, its whole sequence, and one without words none."""
    with np.errstate(over="ignore"):
        for first, last in steps(texts):
            sizes = np.array([len(t) + 1 for t in texts[first:last]])
            raw = np.frombuffer(b"\n".join(texts[first:last]).lower() + b"\n", np.uint8)
            starts = np.cumsum(sizes) - sizes
            space = (raw == 32) | ((raw >= 9) & (raw <= 13))
            before = np.concatenate([[True], space[:-1]])
            begin, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
            word = range_hash(running_hash(raw), begin, end)
            edge = np.searchsorted(begin, np.append(starts, len(raw)))
            n = len(word) - words + 1
            rolled = np.zeros(max(n, 0), np.uint64)
            for i in range(words):
                rolled = rolled * np.uint64(0x9FB21C651E98DF25) + word[i:i + n] if n > 0 else rolled
            rolled = mixed(rolled + np.uint64(words))
            for a, b in zip(edges := edge.tolist(), edges[1:]):
                if b - a >= words:
                    yield np.unique(rolled[a:b - words + 1])
                elif b > a:
                    whole = np.uint64(b - a)
                    for h in word[a:b]:
                        whole = whole * np.uint64(0xD6E8FEB86659FD93) + h
                    yield mixed(np.array([whole], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
