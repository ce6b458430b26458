"""Conversation repair: a generalised LR parse of the role sequence with weighted edits.

Roles are symbols of the grammar ``C: empty | P | s P;  P: u a | P u a``.  Each
row of a conversation is kept, given another role or deleted, and rows may be
inserted anywhere.  All parses advance together on a graph-structured stack:
stacks share their lower nodes, and of stacks with an equal top only the one of
least (cost, audit) goes on.

Rows are dealt by range, so a long conversation is parsed in segments by several
tasks, each from every stack top that it may meet; segments are then joined in
order.  Tasks parse facts of rows (role initial, fault), not their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

SPACES = " \t\n\v\f\r"
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
_NAMES = {"u": "user", "a": "assistant"}


# --- the parser ----------------------------------------------------------------

# LR(0) states by what has been read: 0 nothing, 1 s, 2 u of a first pair, 4 pairs, 5 s and pairs, 6 pairs and u.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (4, "u"): 6, (5, "u"): 6}
_REDUCE = {(2, "a"): 1, (6, "a"): 2}  # nodes above the one whose goto on P follows
_GOTO = {0: 4, 1: 5}
_KIND = {0: 0, 1: 1, 2: 2, 6: 2, 4: 3, 5: 3}  # tops of one kind accept the same continuations
_ACCEPTS = (0, 3)

Node = tuple  # (state, node below)
_BOTTOM: Node = (0, None)
_STARTS: dict[int, Node] = {0: _BOTTOM, 1: (1, _BOTTOM), 2: (2, _BOTTOM), 3: (4, _BOTTOM)}


def _read(node: Node, symbol: str) -> Node | None:
    """The stack after one symbol, reductions included; None if the grammar forbids it."""
    if (node[0], symbol) in _SHIFT:
        return _SHIFT[node[0], symbol], node
    above = _REDUCE.get((node[0], symbol))
    if above is None:
        return None
    for _ in range(above):
        node = node[1]
    return _GOTO[node[0]], node


# A top is (node, cost, rank, inserts): its audit is the one numbered ``rank`` among those that end with
# an edit of the last row, followed by so many I.  No such audit begins another, so ranks order audits for good.
Top = tuple[Node, int, int, int]


def _with_inserts(tops: dict[int, tuple]) -> dict[int, tuple]:
    """Close tops (by state: node, cost, rank, inserts, origin) under insertion."""
    while True:
        more = dict(tops)
        for node, cost, rank, inserts, origin in tops.values():
            for symbol in "ua":
                reached = _read(node, symbol)
                if reached is None:
                    continue
                new = (reached, cost + INSERT, rank, inserts + 1, origin)
                if reached[0] not in more or new[1:4] < more[reached[0]][1:4]:
                    more[reached[0]] = new
        if more == tops:
            return tops
        tops = more


def _settled(tops: dict[int, tuple]) -> tuple[tuple[Top, ...], int, tuple]:
    """Tops with costs from their least one on, that least cost, and where each came from."""
    order = sorted(tops)
    least = min(top[1] for top in tops.values())
    return (tuple((tops[s][0], tops[s][1] - least, tops[s][2], tops[s][3]) for s in order), least,
            tuple((tops[s][3], tops[s][4]) for s in order))


@lru_cache(1 << 16)
def _begin(kind: int) -> tuple[tuple[Top, ...], int, tuple]:
    return _settled(_with_inserts({_STARTS[kind][0]: (_STARTS[kind], 0, 0, 0, None)}))


@lru_cache(1 << 16)
def _advance(tops: tuple[Top, ...], initial: str, fault: str) -> tuple[tuple[Top, ...], int, tuple]:
    """Edit one row: ``fault`` is b (blank or duplicate), t (truncated) or empty.

    Returns the tops, the cost added to all, and for each top its trailing inserts
    and (edit, index of the top it came from).
    """
    best: dict[int, tuple] = {}
    for index, (node, cost, rank, inserts) in enumerate(tops):
        edits = [("D", node, DELETE)]
        if fault != "b":
            extra = TRUNCATED if fault == "t" else 0
            edits += [("K", _read(node, initial), extra)]
            edits += [("R", _read(node, symbol), REROLE + extra) for symbol in "ua"]
        for letter, reached, price in edits:
            if reached is None:
                continue
            new = (cost + price, (rank, "I" * inserts + letter), reached, (letter, index))
            if reached[0] not in best or new[:2] < best[reached[0]][:2]:
                best[reached[0]] = new
    ranks = {audit: place for place, audit in enumerate(sorted({top[1] for top in best.values()}))}
    return _settled(_with_inserts({state: (reached, cost, ranks[audit], 0, origin)
                                   for state, (cost, audit, reached, origin) in best.items()}))


class Parse:
    """All parses of a run of rows from one kind of stack top; memory: one reference a row."""

    def __init__(self, kind: int):
        self.tops, self.cost, first = _begin(kind)
        self.trail = [first]

    def row(self, initial: str, fault: str) -> None:
        self.tops, more, origins = _advance(self.tops, initial, fault)
        self.cost += more
        self.trail.append(origins)

    def ends(self) -> dict[int, tuple[int, str]]:
        """Least (cost, audit) for each kind of top reached."""
        found: dict[int, tuple] = {}
        for index, (node, cost, rank, inserts) in enumerate(self.tops):
            kind = _KIND[node[0]]
            if kind not in found or (cost, rank, inserts) < found[kind][0]:
                found[kind] = ((cost, rank, inserts), index)
        return {kind: (self.cost + key[0], self._audit(index)) for kind, (key, index) in found.items()}

    def _audit(self, index: int) -> str:
        out = []
        for origins in reversed(self.trail):
            inserts, origin = origins[index]
            out.append("I" * inserts)
            if origin:
                out.append(origin[0])
                index = origin[1]
        return "".join(reversed(out))


# --- facts of rows ---------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after damage by crc32 of ``conv_id:turn``; null role and text are one space."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))), F.lit(20))
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                                fate.alias("fate")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")) \
            .otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def _tag() -> Column:
    """256-bit identity of role and text."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def facts(rows: DataFrame) -> DataFrame:
    """Rows of one turn, role and text as one, ``n`` of them: ``initial``, ``blank``, ``cut`` and whether seen ``later``."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    known = rows.select("conv_id", "turn", "role", _tag().alias("tag"),
                        F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
                        (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"))
    alike = known.groupBy(*known.columns).agg(F.count(F.lit(1)).alias("n"))
    turn = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    firsts = alike.groupBy("conv_id", "tag").agg(F.min(turn).alias("first"))
    return lookup(alike, firsts, ["conv_id", "tag"]).withColumn("later", turn > F.col("first")).drop("first")


def counts(found: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated``."""
    def total(value: Column) -> Column:
        return F.sum(F.coalesce(value, F.lit(0)))

    seen = F.when(F.col("later"), F.col("n")).otherwise(F.col("n") - 1)
    per_turn = found.groupBy("conv_id", "turn").agg(
        total(F.when(F.col("blank"), F.col("n"))).alias("blank"), total(F.when(~F.col("blank"), seen)).alias("duplicate"),
        total(F.when(~F.col("blank") & ~F.col("later") & F.col("cut"), 1)).alias("truncated"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return per_turn.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[
        F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")])


# --- segments --------------------------------------------------------------------

_ENDS = pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32(), "cost": pa.int64(), "audit": pa.string()}))
_SEGMENT = pa.schema({"conv_id": pa.int64(), "part": pa.int32(), "first": pa.string(), "last": pa.string(),
                      "illegal": pa.int64(), "ends": _ENDS})
_PARSE = pa.schema({"conv_id": pa.int64(), "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string()})
_ROW = pa.schema({"conv_id": pa.int64(), "place": pa.int64(), "role": pa.string(), "text": pa.string()})
_DIGEST = pa.schema({"conv_id": pa.int64(), "repaired_sha256": pa.string()})
_LEGAL = {"su", "ua", "au"}


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parse the rows of one task; only its first conversation may have begun in an earlier task."""
    part = TaskContext.get().partitionId()
    conv, parses, first, last, illegal = None, None, "", "", 0

    def done() -> dict:
        ends = [{"start": start, "end": end, "cost": cost, "audit": audit}
                for start, parse in parses.items() for end, (cost, audit) in parse.ends().items()]
        return {"conv_id": conv, "part": part, "first": first, "last": last, "illegal": illegal, "ends": ends}

    for batch in batches:
        out = []
        for key, initial, blank, cut, n, later in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "initial", "blank", "cut", "n", "later")), strict=True):
            if parses is None or key != conv:
                if parses is not None:
                    out.append(done())
                parses = {kind: Parse(kind) for kind in (_STARTS if parses is None else (0,))}
                conv, first, last, illegal = key, initial, "", 0
            for place in range(n):
                fault = "b" if blank or later or place else "t" if cut else ""
                illegal += bool(last) and last + initial not in _LEGAL
                last = initial
                for parse in parses.values():
                    parse.row(initial, fault)
        yield pa.RecordBatch.from_pylist(out, _SEGMENT)
    if parses is not None:
        yield pa.RecordBatch.from_pylist([done()], _SEGMENT)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the segments of each conversation, which arrive in order."""
    begun, conv, held, illegal, last = False, None, {}, 0, ""

    def done() -> dict:
        cost, audit = min(held[kind] for kind in _ACCEPTS if kind in held)
        return {"conv_id": conv, "illegal": illegal, "cost": cost, "audit": audit}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if not begun or row["conv_id"] != conv:
                if begun:
                    out.append(done())
                begun, conv, held, illegal, last = True, row["conv_id"], {0: (0, "")}, 0, ""
            illegal += row["illegal"] + (bool(last) and last + row["first"] not in _LEGAL)
            last = row["last"]
            further: dict[int, tuple[int, str]] = {}
            for way in row["ends"]:
                if way["start"] in held:
                    cost, audit = held[way["start"]]
                    new = (cost + way["cost"], audit + way["audit"])
                    further[way["end"]] = min(new, further.get(way["end"], new))
            held = further
        yield pa.RecordBatch.from_pylist(out, _PARSE)
    if begun:
        yield pa.RecordBatch.from_pylist([done()], _PARSE)


def parsed(found: DataFrame, parts: int | None = None) -> DataFrame:
    """``conv_id, illegal, cost, audit`` of every conversation with rows."""
    order = ["conv_id", "turn", "role", "tag"]
    dealt = found.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    segments = dealt.select("conv_id", "initial", "blank", "cut", "n", "later").mapInArrow(
        _segments, from_arrow_schema(_SEGMENT))
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        _joined, from_arrow_schema(_PARSE))


# --- repaired conversations --------------------------------------------------------

def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply audits to rows; each conversation's audit comes before its rows, which stream past."""
    conv, audit, at, place, last = None, "", 0, 0, ""
    for batch in batches:
        out: list[dict] = []

        def write(role: str | None, text: str) -> None:
            nonlocal place, last
            role = role if role is not None else _NAMES["a" if last == "u" else "u"]
            out.append({"conv_id": conv, "place": place, "role": role, "text": text})
            place, last = place + 1, role[:1]

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                write(None, "")
                at += 1

        for key, row, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "row", "role", "text")),
                                        strict=True):
            if not row:
                conv, audit, at, place, last = key, text, 0, 0, ""
                insert()
                continue
            letter = audit[at]
            at += 1
            if letter != "D":
                write(role if letter == "K" else None, text)
            insert()
        yield pa.RecordBatch.from_pylist(out, _ROW)


def repaired(rows: DataFrame, parses: DataFrame) -> DataFrame:
    """``conv_id, place, role, text`` of the repaired conversations, each in order within one partition."""
    given = rows.select("conv_id", F.lit(True).alias("row"), "turn", _tag().alias("tag"), "role", "text")
    audits = parses.select("conv_id", F.lit(False).alias("row"), F.lit(None).cast("long").alias("turn"),
                           F.lit(None).cast("binary").alias("tag"), F.lit("").alias("role"), F.col("audit").alias("text"))
    return audits.unionAll(given).repartition("conv_id").sortWithinPartitions("conv_id", "row", "turn", "role", "tag") \
        .select("conv_id", "row", "role", "text").mapInArrow(_edited, from_arrow_schema(_ROW))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest = None, None
    for batch in batches:
        out = []
        for key, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")),
                                          strict=True):
            if place == 0:
                if digest:
                    out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                conv, digest = key, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        yield pa.RecordBatch.from_pylist(out, _DIGEST)
    if digest:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": digest.hexdigest()}], _DIGEST)


def digests(fixed: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the rows of ``repaired``: ``role:text`` lines, hashed as they stream past."""
    return fixed.mapInArrow(_hashed, from_arrow_schema(_DIGEST))


def audited(conversations: DataFrame, scratch: Scratch, parts: int | None = None) -> DataFrame:
    """Damage, parse and repair: one row for every conversation of the input.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``.  Null role and text are one space; null turns come first;
    rows of one turn go by role, then by SHA-256 of role and text, repeated rows
    side by side.  Rows without conv_id are one conversation.  Conversations may
    have any number of rows and texts any length.  Where damage leaves no row all
    numbers are 0, the audit is empty and the hash is that of no bytes.  An
    empty table gives an empty result; other columns of the input play no part.
    """
    rows = damaged(conversations)
    found = scratch.save(facts(rows))
    parses = scratch.save(parsed(found, parts))
    out = conversations.select("conv_id").distinct()
    for part in (counts(found), parses, digests(repaired(rows, parses))):
        out = lookup(out, part, "conv_id", "left")
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in names],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
