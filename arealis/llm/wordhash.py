"""Hashes of words and shingles over Arrow text columns, in bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes hashed at a time
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)[_LOWER]
_VALUE[_SPACE] = 0
_PLACES = mix(np.arange(1000, 1006, dtype=np.uint64) * BASE) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, step in (("up", BASE), ("down", inverse)):
            table = np.full(n, step, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table)
    return _powers["up"][:n], _powers["down"][:n]


def polynomial_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over the bytes, and the factors that shift a difference of two sums to the start."""
    up, down = _power_tables(max(len(data), 1 << 16) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=total[1:])
    return total, down


def words_of(data: np.ndarray, first_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words in a run of bytes; ``first_bytes`` are places where a new text begins."""
    n = len(data)
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = first_bytes[first_bytes < n]
    starts[cut] = inside[cut]
    begins = np.flatnonzero(starts)
    stops = np.zeros(n + 1, bool)
    stops[1:] = inside
    stops[:-1] &= ~inside
    back = cut[(cut > 0)]
    stops[back[inside[back - 1]]] = True
    ends = np.flatnonzero(stops)
    total, down = polynomial_sums(data)
    hashes = mix((total[ends] - total[begins]) * down[begins] + (ends - begins).astype(np.uint64))
    return hashes, begins, ends


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a text column; nulls are empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    if data is None or not len(column):
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]]  # a slice shares its batch's bytes


def word_hashes(column: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order.  Texts are hashed together up to a piece; longer ones in pieces cut at white space."""
    at, data = text_buffers(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(at, at[row] + PIECE, "right")) - 1)
        if at[row + 1] - at[row] > PIECE:
            parts, place = [], int(at[row])
            while place < at[row + 1]:
                end = min(place + PIECE, int(at[row + 1]))
                while end < at[row + 1] and not _SPACE[data[end]]:
                    end += 1
                parts.append(words_of(data[place:end], np.zeros(1, np.int64))[0])
                place = end
            yield np.concatenate(parts)
            row += 1
            continue
        hashes, begins, _ = words_of(data[at[row] : at[last]], at[row:last] - at[row])
        bounds = np.searchsorted(begins, at[row : last + 1] - at[row])
        for i in range(last - row):
            yield hashes[bounds[i] : bounds[i + 1]]
        row = last


def shingle_set(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words (five at most); fewer words make one shingle, none an empty set."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(size, n)
    out = np.full(n - width + 1, int(_PLACES[5]) * width % (1 << 64), np.uint64)
    for i in range(width):
        out += hashes[i : n - width + 1 + i] * _PLACES[i]
    return np.unique(mix(out))
