"""A count-min sketch over all partitions: which hashes may occur more than once.

Every task adds its hashes to two rows of cells; the sketches of all tasks are
merged block by block, never on the driver, which gets the cells of a block as
a list while they are few.  The merged sketch is two bit sets
of fixed size whatever the corpus, hence safe to broadcast.  Counts are never
too low.  When a corpus outgrows the sketch more hashes pass; none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.llm import bytewords as bw
from fieldatlas.session import Scratch

CELL_BITS = 27     # cells of each row: two rows of 16 MB as bit sets
_BLOCK_BITS = 16
_AT_ONCE = 1 << 20  # hashes that a task gathers before it sorts them into cells
_SPARSE = (1 << _BLOCK_BITS) // 16  # below so many repeated cells a block is a list of offsets, else a bit set


def _cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def bits_for(hashes: float, most: int = CELL_BITS) -> int:
    """Bits of a cell number for about so many hashes, eight cells or more for each of them, but at most ``most``."""
    return min(most, max(_BLOCK_BITS, int(8 * hashes).bit_length()))


def _blocks(hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int, text: str | None):
    """Cells hit by some rows, one row a block of cells: sorted offsets, and those hit twice."""
    def sorted_in(hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        for row, cells in enumerate(_cells(hashes, bits)):
            cell, n = np.unique(cells, return_counts=True)
            block = cell >> _BLOCK_BITS
            heads = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            offset = (cell & ((1 << _BLOCK_BITS) - 1)).astype(np.uint16)
            ends = np.r_[heads[1:], len(cell)]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(block[heads] + (row << bits >> _BLOCK_BITS), pa.int64()),
                "cells": pa.array([offset[a:b].tobytes() for a, b in zip(heads, ends, strict=True)], pa.binary()),
                "twice": pa.array([offset[a:b][n[a:b] > 1].tobytes() for a, b in zip(heads, ends, strict=True)], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for part in bw.pieces(batch, text) if text else [batch]:
                held.append(hashes_of(part))
                count += len(held[-1])
                if count >= _AT_ONCE:
                    yield from sorted_in(np.concatenate(held))
                    held, count = [], 0
        if count:
            yield from sorted_in(np.concatenate(held))
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the sketches of all partitions; rows arrive sorted by block."""
    block, counts = None, np.zeros(1 << _BLOCK_BITS, np.uint8)

    def done() -> pa.RecordBatch:
        few = np.flatnonzero(counts > 1)
        raw = few.astype(np.uint16) if len(few) < _SPARSE else np.packbits(counts > 1)
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()),
                                           "repeated": pa.array([raw.tobytes()], pa.binary())})

    for batch in batches:
        for b, cells, twice in zip(*(batch.column(k).to_pylist() for k in ("block", "cells", "twice")), strict=True):
            if b != block:
                if block is not None:
                    yield done()
                block = b
                counts[:] = 0
            for raw in (cells, twice):  # offsets are distinct within one list
                at = np.frombuffer(raw, np.uint16)
                counts[at] = np.minimum(counts[at] + 1, 2)
    if block is not None:
        yield done()


def repeated_cells(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], bits: int = CELL_BITS,
                   columns: Sequence[str] = ("text",), text: str | None = "text") -> np.ndarray:
    """Both rows of the merged sketch as bit sets: which cells were hit at least twice.

    Batches are cut by the length of ``text``, where given.
    """
    parts = rows.select(*columns).mapInArrow(_blocks(hashes_of, bits, text), "block long, cells binary, twice binary")
    merged = parts.repartition("block").sortWithinPartitions("block") \
                  .mapInArrow(_merge, "block long, repeated binary").where(F.length("repeated") > 0)
    size = (1 << _BLOCK_BITS) // 8
    out = np.zeros(max((2 << bits) // 8, 2 * size), np.uint8)
    with Scratch(rows.sparkSession) as scratch:  # written first, so that the shuffle goes before the sketch is used
        for row in scratch.save(merged).toLocalIterator():  # at most 2 ** (bits + 1) bits, one partition at a time
            raw = np.frombuffer(row.repeated, np.uint8)
            if len(raw) < size:
                full = np.zeros(1 << _BLOCK_BITS, bool)
                full[raw.view(np.uint16)] = True
                raw = np.packbits(full)
            out[row.block * size: (row.block + 1) * size] = raw
    return out.reshape(2, -1)


_KEY_BYTES = 5  # of a hash travel; with the part that it falls into 48 bits or more tell it from others
_PART_ROWS = 1 << 21  # hashes that a part is made for
_LEAST_PARTS = 256


def parts_for(hashes: float) -> int:
    return max(_LEAST_PARTS, int(hashes) // _PART_ROWS)


def _keys(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    part = (hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)
    return part.astype(np.int64), hashes & np.uint64((1 << 8 * _KEY_BYTES) - 1)


def named(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The names that ``repeated_names`` tells the hashes by."""
    part, key = _keys(hashes, parts)
    return bw.mixed((part.astype(np.uint64) << np.uint64(8 * _KEY_BYTES)) | key)


def _dealt_keys(hashes_of: Callable[[pa.RecordBatch], np.ndarray], parts: int, text: str | None):
    """Keys of some rows, one row a part; one that occurs more often stands there twice."""
    def dealt(hashes: np.ndarray) -> pa.RecordBatch:
        unique, n = np.unique(hashes, return_counts=True)
        part, key = _keys(np.repeat(unique, np.minimum(n, 2)), parts)
        heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        raw = np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES])
        return pa.RecordBatch.from_pydict({
            "part": pa.array(part[heads], pa.int64()),
            "keys": pa.array([raw[a:b].tobytes() for a, b in zip(heads, np.r_[heads[1:], len(key)], strict=True)], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for part in bw.pieces(batch, text) if text else [batch]:
                held.append(hashes_of(part))
                count += len(held[-1])
                if count >= _AT_ONCE:
                    yield dealt(np.concatenate(held))
                    held, count = [], 0
        if count:
            yield dealt(np.concatenate(held))
    return run


def _repeated_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the keys that occur more than once in a part; rows arrive sorted by part."""
    at, held = None, []

    def done() -> pa.RecordBatch:
        raw = np.frombuffer(b"".join(held), np.uint8).reshape(-1, _KEY_BYTES)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :_KEY_BYTES] = raw
        key = np.sort(wide.view("<u8").ravel())
        again = np.unique(key[1:][key[1:] == key[:-1]])
        names = bw.mixed((np.uint64(at) << np.uint64(8 * _KEY_BYTES)) | again)
        return pa.RecordBatch.from_pydict({"name": pa.array(names.view(np.int64), pa.int64())})

    for batch in batches:
        for part, keys in zip(*(batch.column(k).to_pylist() for k in ("part", "keys")), strict=True):
            if part != at:
                if held:
                    yield done()
                at, held = part, []
            held.append(keys)
    if held:
        yield done()


def repeated_names(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], np.ndarray], parts: int,
                   columns: Sequence[str] = ("text",), text: str | None = "text") -> DataFrame:
    """``name`` of every hash that occurs more than once, and of next to no other, however many hashes there are.

    For hashes that would fill the cells of a sketch: their keys are shuffled, 5 bytes for each.
    """
    keys = rows.select(*columns).mapInArrow(_dealt_keys(hashes_of, parts, text), "part long, keys binary")
    return keys.repartition("part").sortWithinPartitions("part").mapInArrow(_repeated_keys, "name long")


def maybe_repeated(sketch: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = int(sketch.shape[1] * 8).bit_length() - 1
    out = np.ones(len(hashes), bool)
    for row, cell in zip(sketch, _cells(hashes, bits), strict=True):
        out &= (row[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return out
