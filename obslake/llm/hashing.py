"""Vectorised hashes of the words and n-grams of a batch of texts (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

_SEED = np.random.default_rng(20240229)
#: A random 64-bit value for each byte, and odd multipliers.
_BYTES = _SEED.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEP = _SEED.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes that are summed at a time; tables and sums have this length however long a text is.
STRETCH_BYTES = 1 << 20
_POWERS: list = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


def utf8(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string array (null: empty)."""
    import pyarrow as pa

    array = array.cast(pa.large_string()) if not pa.types.is_large_string(array.type) else array
    if array.null_count:
        array = array.fill_null("")
    n = len(array)
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64, count=n + 1 + array.offset)[array.offset :]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word, in order."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    inside = ~_IS_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True  # a row's first byte begins a word whatever stands before it
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes, from running sums of a polynomial over stretches of whole words.

    A word's hash depends on its bytes alone, not on its place or on how the stretches fall."""
    sums = np.empty(len(start), dtype=np.uint64)
    lo = 0
    while lo < len(start):
        base = int(start[lo])
        hi = int(np.searchsorted(end, base + STRETCH_BYTES, side="right"))
        if hi <= lo:
            sums[lo] = _long_word_sum(data[base : end[lo]])
            lo += 1
            continue
        piece = data[base : end[hi - 1]]
        powers, inverse = _powers(len(piece) + 1)
        running = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[piece] * powers[: len(piece)], out=running[1:])
        a, b = start[lo:hi] - base, end[lo:hi] - base
        sums[lo:hi] = (running[b] - running[a]) * inverse[a]
        lo = hi
    return mix(sums + (end - start).astype(np.uint64) * _STEP[63])


def _long_word_sum(word: np.ndarray) -> np.uint64:
    """The polynomial of a word longer than a stretch, piece by piece."""
    total = 0
    for at in range(0, len(word), STRETCH_BYTES):
        piece = word[at : at + STRETCH_BYTES]
        part = np.sum(_BYTES[piece] * _powers(STRETCH_BYTES)[0][: len(piece)], dtype=np.uint64)
        total += int(part) * pow(int(_BASE), at, 1 << 64)
    return np.uint64(total % (1 << 64))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive entries (fewer than ``n`` entries: none)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        total += words[k : k + count] * _STEP[k]
    return mix(total)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def row_starts(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """First entry of each row (``n_rows`` + 1 values) of a sorted row number per entry."""
    return np.searchsorted(rows, np.arange(n_rows + 1), side="left")


def shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every ``n`` consecutive words of a row; a row with fewer words (but one at
    least) gives its whole sequence as one."""
    grams = ngram_hashes(words, n)
    inside = rows[: len(grams)] == rows[n - 1 :] if len(grams) else np.zeros(0, dtype=bool)
    gram_rows, grams = rows[: len(grams)][inside], grams[inside]
    starts = row_starts(rows, n_rows)
    counts = np.diff(starts)
    short_rows, short = [], []
    for size in range(1, n):
        found = np.flatnonzero(counts == size)
        if len(found):
            total = np.full(len(found), size, dtype=np.uint64) * _STEP[62]
            for k in range(size):
                total += words[starts[found] + k] * _STEP[k]
            short_rows.append(found)
            short.append(mix(total))
    if short:
        gram_rows = np.concatenate([gram_rows, *short_rows])
        grams = np.concatenate([grams, *short])
    return gram_rows, grams
