"""Removal of word windows that an earlier document holds, behind a count-min prefilter.

Pass one adds, for every window of 13 words, its smallest 5-word hash to a
count-min sketch.  That hash depends on the window alone, so its count is never
below the window's: partition sketches are merged block by block and say which
windows may be repeated.  Pass two groups exactly those windows.  Windows
repeated inside one chunk of a task are settled there, so a hot window reaches
the shuffle once a chunk, not once a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldatlas.llm import bytewords as bw
from fieldatlas.llm.frames import arrow_map
from fieldatlas.llm.sketch import CELL_BITS, maybe_repeated, repeated_cells
from fieldatlas.llm.spans import row_tag, with_spans
from fieldatlas.session import Scratch

SIZE = 13          # words in a window
_GRAM = 5          # words in the hashed part that a window is counted by
_CHUNK = 1 << 22   # candidate windows that a task settles at once


# --- pass one: the sketch ------------------------------------------------------

def _anchors(found: bw.Words) -> tuple[np.ndarray, np.ndarray]:
    """Smallest gram hash of every window, with the index of the window's first word."""
    code, first = found.code, found.first
    _, index = bw.window_hashes(code, first, SIZE)
    grams = np.zeros(max(len(code) - _GRAM + 1, 0), np.uint64)
    for k in range(_GRAM):
        grams *= bw._ODD
        grams += code[k: len(code) - _GRAM + 1 + k]
    grams = bw.mixed(grams)
    low, width = grams, 1
    while width < SIZE - _GRAM + 1:  # sliding minimum over 9 grams by doubling
        step = min(width, SIZE - _GRAM + 1 - width)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        width += step
    return low[index], index


def _window_parts(part: pa.RecordBatch) -> np.ndarray:
    """The hashes to count: one for each run of windows of a text with the same smallest gram."""
    found = bw.words(*bw.flat(part.column("text")))
    anchor, index = _anchors(found)
    text = bw.owner(found.first, index)
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    return anchor[new]


# --- pass two: exact groups ----------------------------------------------------

def _settled(key, doc, tag, start) -> Iterator[dict]:
    """Windows of one chunk: the earliest document of each goes on, the others are covered for sure."""
    order = np.lexsort((start, tag, doc, key))
    key, doc, tag, start = key[order], doc[order], tag[order], start[order]
    head = np.r_[True, key[1:] != key[:-1]]
    lead = doc[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
    covered = doc > lead
    # several windows of the leading document may share a key; all go on together
    at = np.flatnonzero(covered)
    at = at[np.lexsort((start[at], tag[at]))]
    if len(at):
        t, s = tag[at], start[at]
        brk = np.r_[True, (t[1:] != t[:-1]) | (s[1:] > s[:-1] + SIZE)]
        heads = np.flatnonzero(brk)
        last = np.r_[heads[1:], len(at)] - 1
        yield {"key": bw.mixed((t[heads] ^ (s[heads] << 1)).astype(np.uint64)).view(np.int64), "doc": doc[at][heads],
               "tag": t[heads], "start": s[heads], "length": s[last] - s[heads] + SIZE,
               "covered": np.ones(len(heads), bool)}
    on = np.flatnonzero(~covered)
    on = on[np.lexsort((start[on], tag[on]))]  # rows of one text side by side compress well
    yield {"key": key[on], "doc": doc[on], "tag": tag[on], "start": start[on],
           "length": np.full(len(on), SIZE), "covered": np.zeros(len(on), bool)}


_ROWS = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("start", pa.int32()),
                   ("length", pa.int32()), ("covered", pa.bool_())])


def _to_batches(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in _ROWS], schema=_ROWS)


def candidates(documents: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Windows that may be repeated, and runs that an earlier document of the same chunk covers."""
    held = documents.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            for part in bw.pieces(batch, "text"):
                data, places = bw.flat(part.column("text"))
                found = bw.words(data, places)
                code, index = bw.window_hashes(found.code, found.first, SIZE)
                anchor, _ = _anchors(found)
                hit = np.flatnonzero(maybe_repeated(held.value, anchor))
                if not len(hit):
                    continue
                text = bw.owner(found.first, index[hit])
                ids, tags = (part.column(k).to_numpy(zero_copy_only=False) for k in ("doc_id", "tag"))
                kept.append((code[hit].view(np.int64), ids[text], tags[text], index[hit] - found.first[text]))
                size += len(hit)
                if size >= _CHUNK:
                    yield from map(_to_batches, _settled(*map(np.concatenate, zip(*kept, strict=True))))
                    kept, size = [], 0
        if size:
            yield from map(_to_batches, _settled(*map(np.concatenate, zip(*kept, strict=True))))

    given = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text", row_tag().alias("tag"))
    return given.mapInArrow(run, "key long, doc long, tag long, start int, length int, covered boolean")


def covered_spans(documents: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """Word spans ``tag, start, length`` covered by windows that start in a document with a smaller id."""
    sketch = repeated_cells(documents.where(F.col("doc_id").isNotNull()), _window_parts, bits)
    rows = candidates(documents, sketch)
    first = F.min("doc").over(Window.partitionBy("key"))  # at most one document a chunk for each key
    return rows.withColumn("first", first).where(F.col("covered") | (F.col("doc") > F.col("first"))) \
               .select("tag", "start", "length")


def _covered_words(part: pa.RecordBatch, found: bw.Words) -> np.ndarray:
    """Which words of the batch lie in a span."""
    edge = np.zeros(len(found.start) + 1, np.int64)
    starts, lengths = part.column("_starts"), part.column("_lengths")
    n = pc.fill_null(pc.list_value_length(starts), 0).to_numpy(zero_copy_only=False)
    base = np.repeat(found.first[:-1], n)
    s = starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ln = lengths.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    np.add.at(edge, base + s, 1)
    np.add.at(edge, base + s + ln, -1)
    return np.cumsum(edge)[:-1] > 0


def digests(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            data, places = bw.flat(part.column("text"))
            found = bw.words(data, places, hashed=False)
            gone = _covered_words(part, found)
            left = np.flatnonzero(~gone)
            start, length = found.start[left], found.end[left] - found.start[left]
            at = np.r_[0, np.cumsum(length + 1)]
            line = np.full(int(at[-1]), 0x20, np.uint8)
            line[bw.ranges(at[:-1], length)] = data[bw.ranges(start, length)]
            of = at[np.searchsorted(left, found.first)]
            total = np.r_[0, np.cumsum(gone)]
            yield {"doc_id": part.column("doc_id"), "n_words": np.diff(found.first),
                   "n_removed": np.diff(total[found.first]),
                   "kept_sha256": [hashlib.sha256(line[a: max(b - 1, a)].tobytes()).hexdigest()
                                   for a, b in zip(of[:-1], of[1:], strict=True)]}

    joined = with_spans(documents, spans, ["doc_id", "text"])
    return arrow_map(joined, "doc_id long, n_words long, n_removed long, kept_sha256 string", step)


def pruned(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """The given rows with covered words cut out of ``text``, each with the white space after it."""
    keep = documents.columns

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            data, places = bw.flat(part.column("text"))
            found = bw.words(data, places, hashed=False)
            gone = np.flatnonzero(_covered_words(part, found))
            text = bw.owner(found.first, gone)
            following = np.minimum(gone + 1, len(found.start) - 1) if len(found.start) else gone
            to = np.where(gone + 1 < found.first[text + 1], found.start[following], places[text + 1])
            mark = np.ones(len(data), bool)
            mark[bw.ranges(found.start[gone], to - found.start[gone])] = False
            size = np.r_[0, np.cumsum(mark)][places]
            raw = data[mark].tobytes()
            nulls = part.column("text").is_null().to_numpy(zero_copy_only=False)
            texts = [None if none else raw[a:b].decode() for a, b, none in zip(size[:-1], size[1:], nulls, strict=True)]
            out = {name: part.column(name) for name in keep}
            yield out | {"text": pa.array(texts, pa.string())}

    joined = with_spans(documents, spans, keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return arrow_map(joined, schema, step)


def deduplicated(documents: DataFrame, scratch: Scratch, bits: int = CELL_BITS) -> tuple[DataFrame, DataFrame]:
    """Digests of every row, and the spans they come from.

    Null and empty texts have no words and lose none.  Rows with a null id stand
    before and after no other: they lose nothing and take nothing from others.
    Rows that repeat an id do not take words from each other.
    """
    spans = scratch.save(covered_spans(documents, bits))
    return digests(documents, spans), spans
