"""Words of UTF-8 texts as numpy arrays, one Arrow batch at a time.

A word is a maximal run of bytes other than space and 0x09-0x0D.  All separators
are ASCII, so splitting bytes and splitting characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
_BLOCK = 1 << 21  # bytes hashed at once; bounds the working arrays
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        up, down = np.full(size, _ODD), np.full(size, _ODD_INVERSE)
        up[0] = down[0] = 1
        _powers, _inverses = np.cumprod(up), np.cumprod(down)
    return _powers[:n], _inverses[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the start of each text (and the end of the last); null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset: texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[places[0]: places[-1]], places - places[0]


@dataclass
class Words:
    """Words of a batch in order: byte spans, hashes and the text each belongs to."""

    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    first: np.ndarray  # index of the first word of each text, and the number of words


def words(data: np.ndarray, places: np.ndarray, hashed: bool = True) -> Words:
    """Find the words of every text and hash them."""
    solid = ~_IS_SPACE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    inner = places[(places > 0) & (places < len(data))]
    opens[inner] = solid[inner]  # a text begins here, whatever stood before
    start = np.flatnonzero(opens)
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    closes[inner - 1] = solid[inner - 1]
    end = np.flatnonzero(closes) + 1
    code = span_hashes(data, start, end) if hashed else np.zeros(0, np.uint64)
    return Words(start, end, code, np.searchsorted(start, places, "left"))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; spans are sorted and do not overlap."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = start[at]
        to = max(int(np.searchsorted(end, base + _BLOCK, "right")), at + 1)
        n = int(end[to - 1] - base)
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data[base: base + n]] * up[:n], out=sums[1:])
        a, b = start[at:to] - base, end[at:to] - base
        out[at:to] = mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        at = to
    return out


def window_hashes(code: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, with the index of their first word."""
    n = len(code)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total *= _ODD
        total += code[k: n - size + 1 + k]
    usable = np.ones(n - size + 1, bool)
    for back in range(1, size):  # runs that would cross into the next text
        bad = first[1:-1] - back
        usable[bad[(bad >= 0) & (bad < len(usable))]] = False
    index = np.flatnonzero(usable)
    return mixed(total[index]), index


def owner(first: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Number of the text that holds each word index; texts without words own nothing."""
    return np.searchsorted(first, index, "right") - 1


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each, so that working arrays stay small."""
    lengths = np.diff(flat(batch.column(column))[1])
    row = 0
    while row < batch.num_rows:
        sizes = np.cumsum(lengths[row:])
        n = max(int(np.searchsorted(sizes, limit, "right")), 1)
        yield batch.slice(row, n)
        row += n


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The concatenation of ``start[i] .. start[i] + length[i] - 1``."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    keep = length > 0
    start, length = start[keep].astype(np.int64), length[keep].astype(np.int64)
    step = np.ones(total, np.int64)
    step[0] = start[0]
    heads = np.cumsum(length)[:-1]
    step[heads] = start[1:] - (start[:-1] + length[:-1] - 1)
    return np.cumsum(step)
