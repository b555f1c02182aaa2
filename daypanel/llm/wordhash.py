"""Vectorised hashing of the words of Arrow text columns, used inside tasks.

A word's hash comes from one running sum over the bytes of a block: sum(value[byte] * B**i), with an odd B, so that
B**i has an inverse modulo 2**64 and the hash of any span is a difference times an inverse power. The result is mixed
with the length. Blocks are cut between words, so memory follows ``BLOCK`` and not the length of a text (a single word
longer than a block makes a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
U = np.uint64
ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(2 * seed + 1) * U(ODD))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()
#: White space of the word rule: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


class Powers:
    """Powers of an odd base and their inverses modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up, self.down = np.ones(1, U), np.ones(1, U)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK + 1024)
            self.up = np.concatenate([np.ones(1, U), np.cumprod(np.full(size, self.base, U))])
            self.down = np.concatenate([np.ones(1, U), np.cumprod(np.full(size, self.inverse, U))])
        return self.up, self.down


POWERS = Powers(0xD6E8FEB86659FD93)
VALUES = byte_values(7)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def hashed_words(text: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a byte array."""
    starts, ends, hashes, at = [], [], [], 0
    while at < len(text):
        stop = min(at + BLOCK, len(text))
        while stop < len(text) and not SPACE[text[stop]]:  # to the end of the word
            gaps = np.flatnonzero(SPACE[text[stop : stop + BLOCK]])
            stop = stop + int(gaps[0]) if len(gaps) else min(stop + BLOCK, len(text))
        part = text[at:stop]
        word = ~SPACE[part]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]])))
        first, last = edge[::2], edge[1::2]
        up, down = POWERS.reach(len(part) + 1)
        sums = np.zeros(len(part) + 1, U)
        np.cumsum(VALUES[LOWER[part] if lower else part] * up[: len(part)], out=sums[1:])
        hashes.append(mix((sums[last] - sums[first]) * down[first] + (last - first).astype(U) * U(ODD)))
        starts.append(first + at)
        ends.append(last + at)
        at = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; of the whole sequence if it is shorter; none without words."""
    k = min(k, len(words))
    if not k:
        return words
    out = np.zeros(len(words) - k + 1, U)
    for j in range(k):
        out = out * U(0xC2B2AE3D27D4EB4F) + words[j : len(words) - k + 1 + j]
    return mix(out + U(k))


def documents_in_blocks(column: pa.Array, lower: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, row bounds within them) for runs of rows of about a block of bytes."""
    data, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        pieces, bounds = [], [0]
        if last - row == 1:
            pieces = [hashed_words(data[offsets[row] : offsets[last]], lower)[2]]
            bounds.append(len(pieces[0]))
        else:
            # rows are separated by a blank so that no word crosses them
            rows = offsets[row : last + 1] - offsets[row]
            joined = np.insert(data[offsets[row] : offsets[last]], rows[1:], 32)
            starts, _, hashes = hashed_words(joined, lower)
            pieces = [hashes]
            bounds = np.searchsorted(starts, rows + np.arange(len(rows)))
        yield row, pieces[0], np.asarray(bounds, np.int64)
        row = last
