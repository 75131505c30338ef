"""Arrow batches of texts as numpy arrays, and hashes of their words.

A word is a maximal run of bytes other than space and \\x09-\\x0D.  Texts are
never joined or cut: word hashes depend on the word alone, whichever batch or
chunk holds it, so a text of any length gives the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: Places of a word whose numbers are kept in a table.
_PLACES = 64
_PLACED = mix64(np.arange(_PLACES << 8, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and where each text begins in them; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def in_small_batches(batches: Iterator[pa.RecordBatch], column: str,
                     size: int = 4 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows, in batches of about ``size`` bytes of text or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + size, "right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 2 * CHUNK_BYTES)
        tables = []
        for base in (_MULTIPLIER, _INVERSE):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers = tables[0], tables[1]
    return _powers


def _placed_bytes(part: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A random number for each byte and its place behind the last ``first`` one.

    A word's hash is their sum: unlike a polynomial's, its collisions do not
    follow from the words' structure, however long they are.
    """
    index = np.arange(len(part), dtype=np.int32)
    place = index - np.maximum.accumulate(np.where(first, index, np.int32(0)))
    out = _PLACED[np.minimum(place, _PLACES - 1) << 8 | part]
    far = np.flatnonzero(place >= _PLACES)
    out[far] = mix64((place[far].astype(np.uint64) << np.uint64(8) | part[far]) * np.uint64(_MULTIPLIER))
    return out


def word_hashes(raw: np.ndarray, at: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and where each text's words begin."""
    hashes, starts, begin, n = [], [], 0, len(raw)
    while begin < n:
        end = min(n, begin + CHUNK_BYTES)
        if end < n:  # never inside a word
            step = 1 << 12
            while end < n:
                blank = np.flatnonzero(_SPACE[raw[end:end + step]])
                if len(blank):
                    end += int(blank[0])
                    break
                end, step = min(n, end + step), step * 2
        part = raw[begin:end]
        if lower:
            part = _LOWER[part]
        inside = ~_SPACE[part]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = at[np.searchsorted(at, begin, "right"):np.searchsorted(at, end, "left")] - begin
        first[edges] = inside[edges]
        last[edges - 1] |= inside[edges - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_placed_bytes(part, first), out=sums[1:])
        hashes.append(mix64(sums[e] - sums[s]))
        starts.append(s + begin)
        begin = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), at)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on (shorter by size - 1)."""
    n = max(len(words) - size + 1, 0)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = mix64(out * np.uint64(_MULTIPLIER) + words[j:j + n])
    return out


def gram_hashes(part: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position on (shorter by size - 1); few bytes, not proof of equality."""
    up, down = _grown(len(part) + 1)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
    n = max(len(part) - size + 1, 0)
    return mix64((sums[size:] - sums[:n]) * down[:n])
