"""Words of whole texts as 64-bit values, in Arrow batches.

A word is a maximal run of bytes other than 0x20 and 0x09 to 0x0D of the UTF-8 text. Two
words get the same value only if they are equal, up to a collision of 64 bits; results that
depend on a sequence of words use at least 128 bits of such values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
U = np.uint64
GROUP_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = mix(np.arange(1, 65, dtype=U) * U(0xD1342543DE82EF95)) | U(1)


def _places(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = mix(np.arange(1, 2 * n + 1, dtype=U) * U(0xD1342543DE82EF95)) | U(1)
    return _powers


class Words:
    """The words of some texts: values, and the bounds of each text's words."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if lower:
            data = LOWER[data]
        self.data = data
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        blank = SPACE[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(data) and not blank[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        size = self.end - self.start
        self.bounds = np.searchsorted(self.start, np.append(begins, len(data)))
        if not len(size):
            self.value = np.zeros(0, U)
            return
        at = np.flatnonzero(~blank)
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        place = at - np.repeat(self.start, size)
        terms = BYTE[data[at]] * _places(int(size.max()))[place]
        self.value = mix(np.add.reduceat(terms, first) + size.astype(U))

    def __len__(self) -> int:
        return len(self.bounds) - 1


def grouped(texts: list[bytes | None], most: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts in groups of about ``most`` bytes, with the place of the first."""
    group: list[bytes] = []
    begin = size = 0
    for i, text in enumerate(texts):
        group.append(text or b"")
        size += len(group[-1])
        if size >= most:
            yield begin, group
            begin, group, size = i + 1, [], 0
    if group:
        yield begin, group


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A text column as UTF-8."""
    return column(batch, name).cast(pa.binary()).to_pylist()


class Places(dict):
    """Numbers for keys in the order in which they are first asked for; ``new`` collects those."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        place = self[key] = len(self)
        self.new.append(key)
        return place

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def taken(self) -> list:
        """The keys asked for since the last call."""
        new, self.new = self.new, []
        return new


class Stretches:
    """Arrays of different lengths, one after the other, by number."""

    def __init__(self, kind):
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind)

    def add(self, size: np.ndarray, flat: np.ndarray) -> None:
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.flat = np.concatenate((self.flat, flat))

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of some numbers, joined, and where each of them ends."""
        size = self.size[at]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)], ends


def sequence_hash(value: np.ndarray, bounds: np.ndarray, seed: int) -> np.ndarray:
    """For each stretch of ``value`` between two bounds a 64-bit value of its elements in order."""
    n = np.diff(bounds)
    place = np.arange(len(value)) - np.repeat(bounds[:-1], n)
    terms = mix(value + mix(place.astype(U) * U(0x9E3779B97F4A7C15) + U(seed)))
    total = np.concatenate((np.zeros(1, U), np.cumsum(terms, dtype=U)))
    return mix(total[bounds[1:]] - total[bounds[:-1]] + n.astype(U) * U(seed | 1))
