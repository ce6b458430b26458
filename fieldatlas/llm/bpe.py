"""Byte-level BPE with content-defined chunk reuse.

A rolling hash of the last 32 bytes cuts every text into chunks, so passages
that documents share fall into equal chunks.  Chunks found in several documents
are encoded once, the most reused ones for all tasks (a dictionary of bounded
size), any other once in each task; reuse never changes a result.  Around every
cut the text is encoded again between sure token borders, and the stretch grows
until its first and last tokens agree exactly with those of the chunks.

A border is sure before a space that follows a visible ASCII character: no token
pattern of the vocabulary goes on there, whatever stands on either side.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.llm import bytewords as bw
from fieldatlas.llm.frames import arrow_map
from fieldatlas.llm.spans import row_tag

# Fixed value: the split pattern of the vocabulary's byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHUNK_BITS = 11                # a cut every 2 KB on average
DICTIONARY_BYTES = 8 << 20     # text of the chunks whose encodings all tasks hold
_CACHE_BYTES = 32 << 20        # text of the chunks a task remembers by itself
_GEAR = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)


# --- vocabulary ----------------------------------------------------------------

class Vocabulary:
    """Merges, special tokens and token bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        for place, merge in enumerate(spec["model"]["merges"]):
            if vocab["".join(merge.split(" ") if isinstance(merge, str) else merge)] != 256 + place:
                raise ValueError("token ids do not follow the order of the merges")
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
        self.coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.split = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        raw = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        size = max(raw) + 1
        self.length = np.array([len(raw.get(i, b"")) for i in range(size)], np.int64)
        self.offset = np.r_[0, np.cumsum(self.length)][:-1]
        self.bytes = np.frombuffer(b"".join(raw.get(i, b"") for i in range(size)), np.uint8)

    def plain(self, text: bytes) -> np.ndarray:
        """Ids of text without special tokens."""
        return np.array(self.coder.encode_ordinary(text.decode("utf-8")), np.int64)

    def decode(self, ids: np.ndarray) -> str:
        return self.bytes[bw.ranges(self.offset[ids], self.length[ids])].tobytes().decode("utf-8", "replace")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def vocabulary(name: str) -> Vocabulary:
    """The file shipped to this executor under its name, read once a process."""
    return Vocabulary(SparkFiles.get(name))


def shipped(spark: SparkSession, path: str) -> str:
    """Send the vocabulary file to every executor; gives its name there."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rpartition("/")[2]


# --- chunks ----------------------------------------------------------------------

def cuts(data: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Places where a chunk starts: the hash of the 32 bytes before ends in zeros, at a character's first byte."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] = h[width:] + (h[:-width] << np.uint64(width))
    top = (h >> np.uint64(20)) & np.uint64((1 << bits) - 1)
    place = np.flatnonzero(top[:-1] == 0) + 1 if len(data) else np.zeros(0, np.int64)
    return place[(data[place] & 0xC0) != 0x80]


def chunk_spans(data: np.ndarray, bits: int = CHUNK_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the chunks of one text."""
    at = cuts(data, bits)
    start, end = np.r_[0, at], np.r_[at, len(data)]
    if not len(data):
        return start[:0], end[:0], np.zeros(0, np.uint64)
    return start, end, bw.span_hashes(data, start, end)


def sure_borders(data: np.ndarray) -> np.ndarray:
    """Places where a token starts for certain, and both ends of the text."""
    before = data[:-1]
    inner = np.flatnonzero((data[1:] == 0x20) & (before > 0x20) & (before < 0x7F)) + 1
    return np.r_[0, inner, len(data)]


class Coder:
    """Encodes texts, remembering the chunks it has seen."""

    def __init__(self, vocab: Vocabulary, known: dict[tuple[int, int], np.ndarray], bits: int = CHUNK_BITS):
        self.vocab, self.known, self.bits = vocab, known, bits
        self.own: dict[tuple[int, int], np.ndarray] = {}
        self.held = 0

    def chunk(self, key: tuple[int, int], text: bytes) -> np.ndarray:
        ids = self.known.get(key)
        if ids is None:
            ids = self.own.get(key)
        if ids is None:
            ids = self.vocab.plain(text)
            if self.held > _CACHE_BYTES:
                self.own, self.held = {}, 0
            self.own[key] = ids
            self.held += len(text)
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; the strings of special tokens become those tokens."""
        if self.vocab.split is None or not self.vocab.split.search(text):
            return self._ordinary(text.encode("utf-8"))
        out, at = [], 0
        for found in self.vocab.split.finditer(text):
            out += [self._ordinary(text[at: found.start()].encode("utf-8")), [self.vocab.special[found.group()]]]
            at = found.end()
        return np.concatenate([*out, self._ordinary(text[at:].encode("utf-8"))]).astype(np.int64)

    def _ordinary(self, raw: bytes) -> np.ndarray:
        data = np.frombuffer(raw, np.uint8)
        start, end, code = chunk_spans(data, self.bits)
        if len(start) < 2:
            return self.vocab.plain(raw)
        borders = sure_borders(data)
        parts = [self.chunk((int(c), int(b - a)), raw[a:b])
                 for a, b, c in zip(start.tolist(), end.tolist(), code.tolist(), strict=True)]
        ids = np.concatenate(parts)
        to = np.cumsum(self.vocab.length[ids])  # where each token ends, as the chunks have it
        out, done = [], 0  # everything before byte `done` is in `out`
        for cut in start[1:].tolist():
            if cut < done:
                continue
            left, right, fresh = self._joined(raw, ids, to, borders, cut, done)
            out += [_between(ids, to, done, left), fresh]
            done = right
        return np.concatenate([*out, _between(ids, to, done, len(raw))])

    def _joined(self, raw, ids, to, borders, cut, done) -> tuple[int, int, np.ndarray]:
        """Encode around a cut until the stretch's first and last tokens agree with the chunks' own."""
        low = int(np.searchsorted(borders, cut, "right")) - 1
        high = int(np.searchsorted(borders, cut, "left"))
        reach = 1
        while True:
            a = max(low - reach, 0)
            b = min(high + reach, len(borders) - 1)
            left, right = max(int(borders[a]), done), int(borders[b])
            fresh = self.vocab.plain(raw[left:right])
            inner, outer = int(borders[low]), int(borders[high])
            head = _between(ids, to, left, inner) if inner > left else fresh[:0]
            tail = _between(ids, to, outer, right) if right > outer else fresh[:0]
            if head is not None and tail is not None and len(head) + len(tail) <= len(fresh) \
                    and np.array_equal(fresh[:len(head)], head) \
                    and np.array_equal(fresh[len(fresh) - len(tail):], tail) and _starts(to, right):
                return left, right, fresh
            if left == done and right == len(raw):
                return left, right, fresh
            reach *= 2


def _starts(to: np.ndarray, place: int) -> bool:
    """Whether a token ends at the place."""
    at = int(np.searchsorted(to, place))
    return place == 0 or (at < len(to) and int(to[at]) == place)


def _between(ids: np.ndarray, to: np.ndarray, a: int, b: int) -> np.ndarray | None:
    """Tokens of bytes a..b, or None if they do not break there."""
    if not (_starts(to, a) and _starts(to, b)):
        return None
    return ids[np.searchsorted(to, a, "right") if a else 0: np.searchsorted(to, b, "right")] if b > a else ids[:0]


# --- Spark -------------------------------------------------------------------------

def shared_chunks(documents: DataFrame, limit: int = DICTIONARY_BYTES, bits: int = CHUNK_BITS) -> DataFrame:
    """Chunks of several documents, most bytes saved first: ``code, size, owner`` up to ``limit`` bytes of text."""
    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            data, places = bw.flat(part.column("text"))
            found = [chunk_spans(data[a:b], bits) for a, b in zip(places[:-1], places[1:], strict=True)]
            tag = np.repeat(part.column("tag").to_numpy(), [len(f[0]) for f in found])
            code = np.concatenate([f[2] for f in found])
            yield {"code": code.view(np.int64), "size": np.concatenate([f[1] - f[0] for f in found]), "tag": tag}

    rows = arrow_map(documents.select("text", row_tag().alias("tag")), "code long, size long, tag long", step)
    counts = rows.groupBy("code", "size").agg(F.count(F.lit(1)).alias("n"), F.min("tag").alias("owner"),
                                              F.max("tag").alias("last")).where("owner <> last")
    saved = F.col("size") * (F.col("n") - 1)
    most = counts.orderBy(saved.desc(), "code", "size").limit(limit >> bits)
    return most.select("code", "size", "owner")


def dictionary(documents: DataFrame, name: str, limit: int = DICTIONARY_BYTES,
               bits: int = CHUNK_BITS) -> dict[tuple[int, int], np.ndarray]:
    """Encodings of the most reused chunks, each made once, where its owner is read."""
    chosen = {(r["code"] & (2 ** 64 - 1), r["size"]): r["owner"] for r in shared_chunks(documents, limit, bits).collect()}
    if not chosen:
        return {}
    held = documents.sparkSession.sparkContext.broadcast(chosen)  # at most limit >> bits keys
    owners = documents.sparkSession.sparkContext.broadcast(set(chosen.values()))

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        vocab = vocabulary(name)
        out = []
        for tag, text in zip(batch.column("tag").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if tag not in owners.value or not text:
                continue
            raw = text.encode("utf-8")
            for a, b, c in zip(*(x.tolist() for x in chunk_spans(np.frombuffer(raw, np.uint8), bits)), strict=True):
                if held.value.get((c, b - a)) == tag:
                    out.append((c, b - a, vocab.plain(raw[a:b]).astype(np.uint32).tobytes()))
        yield {"code": np.array([o[0] for o in out], np.uint64).view(np.int64), "size": [o[1] for o in out],
               "ids": [o[2] for o in out]}

    rows = arrow_map(documents.select("text", row_tag().alias("tag")), "code long, size long, ids binary", step)
    return {(r["code"] & (2 ** 64 - 1), r["size"]): np.frombuffer(r["ids"], np.uint32).astype(np.int64)
            for r in rows.collect()}


def encoded(documents: DataFrame, path: str, keep: list[str], columns: dict[str, str], finish,
            limit: int = DICTIONARY_BYTES, bits: int = CHUNK_BITS) -> DataFrame:
    """The kept columns and what ``finish(vocabulary, list of id arrays)`` makes of every text's ids.

    Null and empty texts have no ids.  Repeated rows are encoded each.  ``columns``
    names and types the results of ``finish``.
    """
    spark = documents.sparkSession
    name = shipped(spark, path)
    known = spark.sparkContext.broadcast(dictionary(documents, name, limit, bits))
    given = documents.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name in keep]
                       + [f"`{c}` {kind}" for c, kind in columns.items()])
    state: dict[str, Coder] = {}

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        if "coder" not in state:  # one a task
            state["coder"] = Coder(vocabulary(name), known.value, bits)
        coder = state["coder"]
        for part in bw.pieces(batch, "text"):
            ids = [coder.encode(text or "") for text in part.column("text").to_pylist()]
            yield {c: part.column(c) for c in keep} | finish(coder.vocab, ids)

    return arrow_map(given, schema, step)


def as_list(vocab: Vocabulary, ids: list[np.ndarray]) -> dict:
    """``n_tokens``, the ids themselves, and the text that they decode to."""
    ends = np.r_[0, np.cumsum([len(i) for i in ids])].astype(np.int32)
    return {"n_tokens": np.diff(ends).astype(np.int64), "decoded": [vocab.decode(i) for i in ids],
            "ids": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids).astype(np.int32)))}
