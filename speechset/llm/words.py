"""Words, lines and their hashes for a whole Arrow column at once, in numpy.

A word is a run of bytes other than the space and 0x09-0x0D. These are ASCII, so splitting UTF-8
bytes splits the text. Nothing here loops over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values over all 64."""
    x = x ^ (x >> np.uint64(31))
    x = x * _MULTIPLIERS[0]
    x ^= x >> np.uint64(29)
    x *= _MULTIPLIERS[1]
    x ^= x >> np.uint64(32)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offset of each row (one more than rows); null: empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, eight bytes a step; only longer ranges go on to the next."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at_byte = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    size = end - start
    out = (size.astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[2]
    active, done = np.flatnonzero(size > 0), 0
    while len(active):
        left = np.minimum(size[active] - done, 8)
        out[active] = mix(out[active] ^ ((at_byte[start[active] + done] & _MASKS[left]) * _MULTIPLIERS[3]))
        done += 8
        active = active[size[active] > done]
    return out


class Words:
    """All words of a column. ``start`` and ``end`` are byte ranges in ``data``, ``row`` is the row of
    each word, and the words of row i are ``first[i]`` up to ``first[i + 1]``."""

    def __init__(self, column: pa.Array, lower: bool = False):
        data, self.offsets = column_bytes(column)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        self.data = data
        n = len(data)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.ones(n + 1, bool)  # a boundary before byte i: a space there, or the end of a row
        edge[1:n] = space[:-1]
        edge[self.offsets] = True
        self.start = np.flatnonzero(~space & edge[:n])
        edge = np.ones(n + 1, bool)
        edge[:n] = space
        edge[self.offsets] = True
        self.end = np.flatnonzero(~space & edge[1:]) + 1
        self.space = space
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.count)), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return hash_ranges(self.data, self.start, self.end)

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The text with each run of separators as one space, and the word ranges in it: words i to j of
        a row, joined by single spaces, are ``text[start[i]:end[j]]``."""
        if not len(self):
            return b"", self.start, self.end
        gap = np.zeros(len(self.data), bool)
        after = self.end[self.end < len(self.data)]
        gap[after] = self.space[after]
        keep = ~self.space | gap
        place = np.cumsum(keep)
        text = np.where(gap, np.uint8(32), self.data)[keep].tobytes()
        return text, place[self.start] - 1, place[self.end - 1]

    def fits(self, size: int) -> np.ndarray:
        """The words at which a window of ``size`` words of one row starts."""
        return np.flatnonzero(np.arange(len(self)) + size <= self.first[1:][self.row])


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive words, as long as the input; the last ``size - 1`` are void.
    Callers keep to starts whose words all lie in one row."""
    out = np.zeros(len(hashes), np.uint64)
    for i in range(size):
        part = hashes[i:] * mix(np.array([i + 1], np.uint64) * _MULTIPLIERS[1])[0]
        out[: len(part)] += part
    return mix(out)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive ``offsets``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeats(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, whether an equal one stands earlier in its row, and whether any other does."""
    order = np.lexsort((keys, row)) if len(keys) else np.zeros(0, np.int64)
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        a, b = order[:-1], order[1:]
        same[1:] = (keys[a] == keys[b]) & (row[a] == row[b])
    earlier, other = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order] = same
    other[order] = same | np.concatenate([same[1:], [False]])[: len(same)]
    return earlier, other


def cover(starts: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a range of ``size`` places from one of ``starts``."""
    step = np.bincount(starts, minlength=n + 1) - np.bincount(starts + size, minlength=n + 1)
    return np.cumsum(step[:n]) > 0
