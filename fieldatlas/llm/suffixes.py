"""Removal of repeated byte strings by enhanced suffix arrays over shared buckets.

Any 100-byte string holds the smallest hash of its 32-byte grams, and every copy
of the string holds it at the same place.  Those anchors deal the text out: two
copies of a string meet in the bucket of their anchor, with the bytes that reach
100 to either side.  A count-min sketch drops anchors that occur once.  Equal
surroundings are settled by their first occurrence; only different ones, once
each, go into a bucket's suffix array.

There the longest-common-prefix intervals of at least 100 bytes form a tree that
one stack scan visits.  An interval whose members all follow the same byte is a
part of a longer repeat and is skipped; the others are maximal repeats, reported
with all their occurrences.  All but the first occurrence of each are removed.
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
from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

SIZE = 100            # bytes of a repeated string
_GRAM = 32            # bytes of an anchor
_WIDTH = SIZE - _GRAM + 1
_CHUNK = 1 << 20      # anchors that a task settles at once
_PIECE = 1 << 20      # bytes of text hashed at once
_BATCH = 1 << 19      # bytes of pieces searched at once
HOT_BUCKET = 50_000   # buckets with more members are dealt out by the first 100 bytes of their suffixes


# --- anchors ---------------------------------------------------------------------

def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any span follows, and the factors that shift it to place."""
    up, down = bw.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(bw._BYTE_CODES[data] * up[:-1], out=sums[1:])
    return sums, down


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Sliding minimum or maximum by doubling."""
    have = 1
    while have < width and len(values):
        step = min(have, width - have)
        values = pick(values[:-step], values[step:]) if len(values) > step else values[:0]
        have += step
    return values


def anchors(data: np.ndarray, places: np.ndarray, sums=None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all anchors of the texts."""
    if len(data) < SIZE:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums, down = sums or _prefix_sums(data)
    n = len(data) - _GRAM + 1
    grams = bw.mixed((sums[_GRAM:] - sums[:-_GRAM]) * down[:n])
    low = _slide(grams, _WIDTH, np.minimum)  # of the 100 bytes from each place
    inside = np.zeros(len(low), bool)
    lengths = np.diff(places)
    inside[bw.ranges(places[:-1], np.maximum(lengths - SIZE + 1, 0))] = True
    low = np.where(inside, low, np.uint64(0))
    pad = np.zeros(_WIDTH - 1, np.uint64)
    high = _slide(np.concatenate([pad, low, pad]), _WIDTH, np.maximum)  # of the strings that hold each gram
    at = np.flatnonzero((grams == high[:n]) & (high[:n] > 0))
    return at, grams[at]


def _anchor_hashes(batch: pa.RecordBatch) -> np.ndarray:
    return np.concatenate([anchors(*bw.flat(part.column("text")))[1] for part in bw.pieces(batch, "text", _PIECE)])


_ROWS = pa.schema([("key", pa.int64()), ("around", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()),
                   ("at", pa.int32()), ("left", pa.int32()), ("right", pa.int32()), ("covered", pa.bool_())])
_ROW_TYPES = "key long, around long, doc long, tag long, at int, left int, right int, covered boolean"


def _settled(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Among equal surroundings of one chunk only the first goes on; the others are covered for sure."""
    order = np.lexsort((rows["at"], rows["tag"], rows["doc"], rows["around"], rows["key"]))
    rows = {k: v[order] for k, v in rows.items()}
    key, around = rows["key"], rows["around"]
    rows["covered"] = ~np.r_[True, (key[1:] != key[:-1]) | (around[1:] != around[:-1])]
    order = np.lexsort((rows["at"], rows["tag"]))  # rows of one text side by side compress well
    rows = {k: v[order] for k, v in rows.items()}
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in _ROWS], schema=_ROWS)


def surroundings(documents: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Anchors that may be repeated, with a hash of the bytes around them and how far those reach."""
    held = documents.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            for part in bw.pieces(batch, "text", _PIECE):
                data, places = bw.flat(part.column("text"))
                if len(data) < SIZE:
                    continue
                sums, down = _prefix_sums(data)
                at, key = anchors(data, places, (sums, down))
                hit = maybe_repeated(held.value, key)
                at, key = at[hit], key[hit]
                text = np.searchsorted(places, at, "right") - 1
                begin = np.maximum(at - _WIDTH + 1, places[text])
                end = np.minimum(at + SIZE, places[text + 1])
                shape = ((at - begin) * 256 + (end - at)).astype(np.uint64)
                around = bw.mixed(bw.mixed((sums[end] - sums[begin]) * down[begin]) + shape)
                ids, tags = (part.column(k).to_numpy(zero_copy_only=False) for k in ("doc_id", "tag"))
                kept.append({"key": key.view(np.int64), "around": around.view(np.int64), "doc": ids[text],
                             "tag": tags[text], "at": at - places[text], "left": at - begin, "right": end - at})
                size += len(at)
                if size >= _CHUNK:
                    yield _settled({k: np.concatenate([x[k] for x in kept]) for k in kept[0]})
                    kept, size = [], 0
        if size:
            yield _settled({k: np.concatenate([x[k] for x in kept]) for k in kept[0]})

    given = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text", row_tag().alias("tag"))
    return given.mapInArrow(run, _ROW_TYPES)


# --- the enhanced suffix array ------------------------------------------------------

def suffix_array(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the given suffixes, each reaching to its ``end``, and the common prefix of each with the next."""
    length = end - start
    width = -(-int(length.max()) // 8) * 8
    rows = np.zeros((len(start), width), np.uint8)
    for k in range(width):
        rows[:, k] = np.where(k < length, data[np.minimum(start + k, len(data) - 1)], 0)
    words = rows.view(">u8")
    order = np.lexsort([length, *words.T[::-1]])
    rows, length = rows[order], length[order]
    apart = rows[1:] != rows[:-1]
    same = np.where(apart.any(1), apart.argmax(1), width)
    return order, np.minimum(same, np.minimum(length[1:], length[:-1]))


def _tree(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Intervals ``length, first, last`` of one run, innermost first; ``lcp[i]`` joins members i and i + 1."""
    stack: list[tuple[int, int]] = []  # length, first member
    for i in range(len(lcp) + 1):
        depth = int(lcp[i]) if i < len(lcp) else -1
        first = i
        while stack and stack[-1][0] > depth:
            length, first = stack.pop()
            yield length, first, i
        if i < len(lcp) and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(data: np.ndarray, begin: np.ndarray, end: np.ndarray,
                    size: int = SIZE) -> Iterator[tuple[int, np.ndarray]]:
    """Length and all places of every maximal repeat of at least ``size`` bytes of the pieces ``begin..end``."""
    n = np.maximum(end - begin - size + 1, 0)
    at, stop = bw.ranges(begin, n), np.repeat(end.astype(np.int32), n)
    if len(at) < 2:
        return
    sums, down = _prefix_sums(data)
    head = bw.mixed((sums[at + size] - sums[at]) * down[at])  # of the first bytes: equal in every interval wanted
    before = np.where(at > np.repeat(begin, n), data[at - 1], -1 - np.arange(len(at)))  # no byte: like no other
    order = np.argsort(head, kind="stable")
    at, stop, head, before = at[order], stop[order], head[order], before[order]
    group = np.cumsum(np.r_[0, head[1:] != head[:-1]])
    heads = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
    # where all follow the same byte, the whole subtree lies inside a longer repeat
    keep = (np.minimum.reduceat(before, heads) < np.maximum.reduceat(before, heads))[group]
    at, stop, before, group = at[keep], stop[keep], before[keep], group[keep]
    cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(at) else np.zeros(1, np.int64)
    first = 0
    while first < len(cut) - 1:  # arrays of about 32,000 suffixes, whole groups at once
        last = max(int(np.searchsorted(cut, cut[first] + (1 << 15), "right")) - 1, first + 1)
        some = slice(int(cut[first]), int(cut[last]))
        order, lcp = suffix_array(data, at[some], stop[some])
        sa, left = at[some][order], before[some][order]
        changes = np.cumsum(np.r_[0, left[1:] != left[:-1]])
        runs = np.flatnonzero(np.diff(np.r_[False, lcp >= size, False].astype(np.int8)))
        for a, b in zip(runs[::2].tolist(), runs[1::2].tolist(), strict=True):
            for length, x, y in _tree(lcp[a:b]):
                if changes[a + y] > changes[a + x]:  # left-diverse
                    yield length, sa[a + x: a + y + 1]
        first = last


_LAST = np.iinfo(np.int64).max


def _bucket_spans(pieces: list[bytes], doc: np.ndarray, tag: np.ndarray, place: np.ndarray) -> dict[str, np.ndarray]:
    """Spans of all but the first occurrence of every maximal repeat of some buckets."""
    end = np.cumsum([len(p) for p in pieces])
    begin = end - np.array([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    owner = np.repeat(np.arange(len(pieces)), end - begin)
    inner = np.arange(len(data)) - begin[owner] + place[owner]
    found = list(maximal_repeats(data, begin, end))
    if not found:
        return {"tag": tag[:0], "start": place[:0], "length": place[:0]}
    at = np.concatenate([places for _, places in found])
    sizes = np.array([len(places) for _, places in found])
    heads = np.cumsum(sizes) - sizes
    later = np.zeros(len(at), bool)
    for part in (doc[owner[at]], inner[at], tag[owner[at]]):  # not the first occurrence, which several pieces may hold
        least = np.minimum.reduceat(np.where(later, _LAST, part), heads)
        later |= part > np.repeat(least, sizes)
    length = np.repeat([n for n, _ in found], sizes)[later]
    at = at[later]
    if not len(at):
        return {"tag": tag[:0], "start": place[:0], "length": place[:0]}
    start = inner[at]
    # overlapping spans of a text become one
    _, row = np.unique(tag[owner[at]], return_inverse=True)
    base = row.astype(np.int64) << 32
    order = np.lexsort((start, row))
    start, stop = (base + start)[order], (base + start + length)[order]
    reach = np.maximum.accumulate(stop)
    heads = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return {"tag": tag[owner[at]][order][heads], "start": start[heads] & 0xFFFFFFFF,
            "length": reach[np.r_[heads[1:], len(start)] - 1] - start[heads]}


_SPANS = pa.schema([("tag", pa.int64()), ("start", pa.int32()), ("length", pa.int32())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over whole buckets, as many at once as fit; rows arrive sorted by key."""
    kept, size, key = [], 0, None

    def done() -> pa.RecordBatch:
        spans = _bucket_spans([r[0] for r in kept], *(np.array([r[k] for r in kept], np.int64) for k in (1, 2, 3)))
        return pa.RecordBatch.from_arrays([pa.array(spans[f.name], f.type) for f in _SPANS], schema=_SPANS)

    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("piece", "doc", "tag", "start", "key")), strict=True):
            if row[4] != key:
                if size >= _BATCH:
                    yield done()
                    kept, size = [], 0
                key = row[4]
            kept.append(row)
            size += len(row[0])
    if kept:
        yield done()


# --- Spark -----------------------------------------------------------------------

def _pieces(documents: DataFrame, mixed_rows: DataFrame) -> DataFrame:
    """The bytes around each given anchor: ``key, hot, piece, doc, tag, start``."""
    per_row = mixed_rows.groupBy("tag").agg(F.collect_list(F.struct("key", "hot", "at", "left", "right")).alias("_a"))
    texts = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text", row_tag().alias("tag"))

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            data, places = bw.flat(part.column("text"))
            raw = data.tobytes()
            a = part.column("_a")
            n = pc.list_value_length(a).to_numpy(zero_copy_only=False)
            rows = a.flatten()
            col = {f.name: rows.field(f.name).to_numpy(zero_copy_only=False) for f in rows.type}
            base = np.repeat(places[:-1], n)
            begin, end = base + col["at"] - col["left"], base + col["at"] + col["right"]
            yield {"key": col["key"], "hot": col["hot"], "doc": np.repeat(part.column("doc_id").to_numpy(), n),
                   "piece": [raw[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)],
                   "tag": np.repeat(part.column("tag").to_numpy(), n), "start": begin - base}

    return arrow_map(lookup(texts, per_row, "tag"), "key long, hot boolean, piece binary, doc long, tag long, start int", step)


def _window_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Every 100-byte string of the pieces of hot buckets, by hash."""
    pieces = batch.column("piece").to_pylist()
    if not pieces:
        return
    lengths = np.array([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    begin = np.r_[0, np.cumsum(lengths)][:-1]
    n = np.maximum(lengths - SIZE + 1, 0)
    sums, down = _prefix_sums(data)
    at = bw.ranges(begin, n)
    of = np.repeat(np.arange(len(pieces)), n)
    plain = (sums[at + SIZE] - sums[at]) * down[at]
    start = batch.column("start").to_numpy()
    yield {"h1": bw.mixed(plain).view(np.int64), "h2": bw.mixed(plain ^ np.uint64(0x5BF03635)).view(np.int64),
           "doc": batch.column("doc").to_numpy()[of], "tag": batch.column("tag").to_numpy()[of],
           "start": start[of] + at - begin[of]}


def repeated_spans(documents: DataFrame, scratch: Scratch, bits: int = CELL_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """Byte spans ``tag, start, length`` whose strings of 100 bytes also start earlier."""
    sketch = repeated_cells(documents.where(F.col("doc_id").isNotNull()), _anchor_hashes, bits)
    rows = surroundings(documents, sketch)
    bucket = Window.partitionBy("key")
    same = Window.partitionBy("key", "around")
    first = F.min(F.struct("doc", "at", "tag")).over(same)
    # rows covered inside their chunk stay as they are; they follow a row that goes on
    rows = rows.withColumn("_first", first).withColumn("_members", F.count(F.lit(1)).over(bucket)) \
        .withColumn("_mixed", F.min("around").over(bucket) != F.max("around").over(bucket)) \
        .withColumn("covered", F.col("covered") | (F.struct("doc", "at", "tag") != F.col("_first")))
    rows = scratch.save(rows.where("covered OR _mixed").select(
        "key", "doc", "tag", "at", "left", "right", "covered", (F.col("_members") > hot).alias("hot")))
    whole = rows.where("covered").select("tag", (F.col("at") - F.col("left")).alias("start"),
                                         (F.col("left") + F.col("right")).alias("length"))
    pieces = scratch.save(_pieces(documents, rows.where("NOT covered")))
    found = pieces.where("NOT hot").drop("hot").repartition("key").sortWithinPartitions("key") \
        .mapInArrow(_search, "tag long, start int, length int")
    spans = whole.unionAll(found)
    strings = scratch.save(arrow_map(pieces.where("hot").select("piece", "doc", "tag", "start"),
                                     "h1 long, h2 long, doc long, tag long, start int", _window_rows))
    lead = strings.groupBy("h1", "h2").agg(F.min(F.struct("doc", "start", "tag")).alias("lead"))
    later = lookup(strings, lead, ["h1", "h2"]).where(F.struct("doc", "start", "tag") != F.col("lead")) \
        .select("tag", "start", F.lit(SIZE).alias("length"))
    return spans.unionAll(later)


def _removed(part: pa.RecordBatch, places: np.ndarray) -> np.ndarray:
    edge = np.zeros(int(places[-1]) + 1, np.int32)
    n = pc.fill_null(pc.list_value_length(part.column("_starts")), 0).to_numpy(zero_copy_only=False)
    start = np.repeat(places[:-1], n) + part.column("_starts").flatten().to_numpy(zero_copy_only=False)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + part.column("_lengths").flatten().to_numpy(zero_copy_only=False), -1)
    return np.cumsum(edge)[:-1] > 0


def digests(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            data, places = bw.flat(part.column("text"))
            gone = _removed(part, places)
            total = np.r_[0, np.cumsum(gone)]
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = places[(places > 0) & (places < len(data))]
            opens[inner] = gone[inner]
            runs = np.r_[0, np.cumsum(opens)]
            left = data[~gone].tobytes()
            cut = places - total[places]
            yield {"doc_id": part.column("doc_id"), "n_bytes": np.diff(places), "n_removed": np.diff(total[places]),
                   "n_spans": np.diff(runs[places]),
                   "kept_sha256": [hashlib.sha256(left[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]}

    joined = with_spans(documents, spans, ["doc_id", "text"])
    return arrow_map(joined, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", step)


def deduplicated(documents: DataFrame, scratch: Scratch, bits: int = CELL_BITS) -> DataFrame:
    """Digests of every row after the removal of repeated strings.

    Null texts count as empty.  Rows with a null id lose nothing and take nothing
    from others.  Rows that share an id are ordered by place, then by a hash of their text; rows equal
    in id and text are one document and keep what it keeps.
    """
    return digests(documents, scratch.save(repeated_spans(documents, scratch, bits)))
