"""Vectorised access to the words of many texts at once: byte tables, cuts and hashes of segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE_BYTES = [0x20, *range(0x09, 0x0E)]


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def seeds(n: int, stream: int = 0) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    counter = np.arange(1, n + 1, dtype=np.uint64) + (np.uint64(stream) << np.uint64(40))
    return mixed(counter * np.uint64(0x9E3779B97F4A7C15))


def groups(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts of a string column as bytes with row bounds, about ``most`` bytes at a time; nulls are empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + most, side="right")) - 1)
        yield data[bounds[row]:bounds[stop]], bounds[row:stop + 1] - bounds[row]
        row = stop


_multipliers: dict[int, np.ndarray] = {}


def segment_hashes(values: np.ndarray, starts: np.ndarray, stream: int = 0) -> np.ndarray:
    """64-bit hash of each segment of ``values`` (uint64, 0 where a byte does not count).

    Segments begin at ``starts`` and reach to the next start. Multilinear hashing: the sum of the values times random
    odd numbers that belong to the places within the segment.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(starts, append=len(values))
    longest = int(lengths.max())
    table = _multipliers.get(stream)
    if table is None or len(table) < longest:
        table = seeds(max(256, longest), stream) | np.uint64(1)
        _multipliers[stream] = table[:1 << 20]
    place = np.arange(starts[0], len(values)) - np.repeat(starts, lengths)
    return mixed(np.add.reduceat(values[starts[0]:] * table[place], starts - starts[0]))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()
IS_SPACE = np.isin(np.arange(256), SPACE_BYTES)


def word_hashes(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray, stream: int = 0,
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of the texts, and the number of words before each text.

    ``is_word`` tells for each byte value whether it belongs to a word; a text's end ends a word.
    """
    inside = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] |= inside[first]
    starts = np.flatnonzero(begins)
    values = np.where(inside, LOWER[data].astype(np.uint64) + np.uint64(1), np.uint64(0))
    before = np.concatenate([[0], np.cumsum(begins)])[bounds]
    return segment_hashes(values, starts, stream), before
