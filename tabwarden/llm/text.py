"""Words, lines and rolling hashes of whole columns of text, as numpy arrays.

Texts are UTF-8 bytes laid end to end with their offsets, as Arrow holds them, so one
numpy call handles all rows of a slice. A word is a run of ``[^\\x20\\x09-\\x0D]``.
Hashes have 64 bits; equal strings always hash alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled by one round of numpy calls; one longer text is a round of its own.
SLICE_BYTES = 2_000_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(rows, max(end, row + 1))
        yield row, end
        row = end


def sliced(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of every slice of a string column."""
    data, offsets = utf8(column)
    for i, j in slices(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]))
        for name, step in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, step, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of (values[t] + 1) * BASE**t over i <= t < j."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values in each [start, end)."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word, and the index of the first word of every row with the
    number of words at the end."""
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(SPACE[data], out=inside[:-1])
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~before | first))
    end = np.flatnonzero((~inside | first)[1:] & inside[:-1]) + 1
    return start, end, np.searchsorted(start, offsets)


def window_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """Order-dependent hash of every ``width`` neighbouring numbers."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    n = len(hashes) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = out * BASE + hashes[i : i + n]
    return mix(out)


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row of every item, from the index of each row's first item."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values of every row."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``width`` words after lower-casing A-Z, and the index of the first
    window of every row. Fewer words make one window of them all; no word makes none."""
    start, end, bounds = word_spans(data, offsets)
    words = span_hash(prefix_sums(LOWER[data]), start, end)
    counts = np.diff(bounds)
    windows = window_hash(words, width)
    whole = np.where(counts >= width, counts - width + 1, 0)
    out = np.empty(int((whole + ((counts > 0) & (counts < width))).sum()), np.uint64)
    ends = np.concatenate(([0], np.cumsum(whole + ((counts > 0) & (counts < width)))))
    if len(windows):
        row = row_of(np.concatenate(([0], np.cumsum(whole))))
        nth = np.arange(len(row)) - np.concatenate(([0], np.cumsum(whole)))[row]
        out[ends[row] + nth] = windows[bounds[row] + nth]
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        out[ends[r]] = window_hash(words[bounds[r] : bounds[r + 1]], int(counts[r]))[0]
    return out, ends


def clear_prefix(columns: list[str]) -> str:
    """A prefix that no column has, for columns of our own beside those of a user."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix
