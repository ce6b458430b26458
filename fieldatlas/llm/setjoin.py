"""Jaccard self-join of shingle sets by universe partition and pigeonhole.

The token universe is hashed into segments, their number chosen by size band so
that two similar sets must agree in at least one segment.  A set is indexed by
the hash of each segment; where the cost model finds equal segments too common,
fewer and larger segments are indexed together with all their one-deletion
neighbours.  Segments so small that unrelated sets share them are indexed only
for sets that have too many of them for the pigeonhole argument to do without.

Equal sets are one class from the start; one row of a class is indexed, told
by a sketch of the ids that stand for classes, so that copies do not make
signatures look shared and no text moves for it.  Candidates are verified on whole sets, and a bucket of
candidates is searched by stars: its members are compared with its first and
last one; only members that stay in other components are compared further.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.llm import bytewords as bw
from fieldatlas.llm.frames import arrow_map
from fieldatlas.llm.sketch import CELL_BITS, bits_for, maybe_repeated, named, parts_for, repeated_cells, repeated_names
from fieldatlas.operators.graph import connected_components
from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

_BAND_RATIO = 1.25
_COMMON = 0.003  # assumed chance that an unrelated set holds a given token; for the cost model only
_MARKS = 256     # buckets of the token counts that candidates are compared by first
_DENSE = 8       # tokens a bucket; sets with more have finer counts, which few unrelated sets have alike


# --- allocation ----------------------------------------------------------------

def largest_difference(total: int, percent: int) -> int:
    """Most tokens that only one of two similar sets may hold, given the sum of their sizes."""
    return total * (100 - percent) // (100 + percent)


def bands(largest: int) -> list[tuple[int, int]]:
    """Ranges of set sizes; each is at most a quarter wider than its start."""
    out, low = [], 1
    while low <= largest:
        high = max(low, math.ceil(low * _BAND_RATIO) - 1)
        out.append((low, high))
        low = high + 1
    return out


@dataclass(frozen=True)
class Scheme:
    """Segments of one size band: ``plain`` matched as they are, ``fuzzy`` up to one deletion."""

    plain: int
    fuzzy: int
    small: int  # plain segments of at most this many tokens are avoided
    slack: int  # segment weight that similar sets share at least

    @property
    def segments(self) -> int:
        return self.plain + self.fuzzy


def _at_most(k: int, mean: float) -> float:
    return sum(math.exp(-mean) * mean ** i / math.factorial(i) for i in range(k + 1))


def _shared_by_chance(mean: float) -> float:
    """Chance that an unrelated set holds all tokens but one of a segment; most of it comes from small segments."""
    return math.exp(-mean) + (math.exp(-mean * (1 - _COMMON)) - math.exp(-mean)) / _COMMON


def allocate(low: int, high: int, sets: int, percent: int) -> Scheme | None:
    """Cheapest scheme for a band: indexed signatures plus expected chance pairs.  None: only equal sets link."""
    bound = largest_difference(2 * high, percent)
    if bound == 0:
        return None
    best = None
    for fuzzy in sorted({0, (bound + 1) // 4, (bound + 2) // 2}):
        for small in range(4):
            plain = max(bound + 1 - 2 * fuzzy, 0)
            for _ in range(20 if plain else 0):  # room for the segments that are avoided
                expected = plain * _at_most(small, low / (plain + fuzzy))
                wanted = max(bound + 1 - 2 * fuzzy, 0) + math.ceil(expected + 4 * math.sqrt(expected))
                if wanted <= plain:
                    break
                plain = wanted
            mean = low / max(plain + fuzzy, 1)
            if mean < 1:
                continue
            index = sets * (plain + fuzzy * (mean + 1))
            chance = sets * sets / 2 * (plain * _COMMON ** (small + 1) + fuzzy * _shared_by_chance(mean))
            scheme = Scheme(plain, fuzzy, small, plain + 2 * fuzzy - bound)
            if best is None or index + chance < best[0]:
                best = (index + chance, scheme)
    return best[1] if best else Scheme(bound + 1, 0, -1, 1)


def schemes_of(size: int, ranges: list[tuple[int, int]], percent: int) -> list[int]:
    """Bands whose scheme a set takes part in: its own, and later ones that hold a similar larger set."""
    own = next(i for i, (low, high) in enumerate(ranges) if low <= size <= high)
    out = [own]
    while out[-1] + 1 < len(ranges) and ranges[out[-1] + 1][0] * percent <= 100 * size:
        out.append(out[-1] + 1)
    return out


# --- shingle sets ----------------------------------------------------------------

def shingle_sets(part: pa.RecordBatch, size: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; fewer words than a shingle make one."""
    data, places = bw.flat(part.column("text"))
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data)
    found = bw.words(data, places)
    hashes, index = bw.window_hashes(found.code, found.first, size)
    cut = np.searchsorted(index, found.first)
    out = []
    for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if b > a:
            out.append(np.unique(hashes[a:b]))
            continue
        short = found.code[found.first[i]: found.first[i + 1]]
        if len(short):
            total = np.array([len(short)], np.uint64)
            for code in short:
                total = bw.mixed(total * bw._ODD + code)
            out.append(total)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_ids(documents: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, h1, h2``: set size and a 128-bit identity of the set."""
    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            sets = shingle_sets(part, size)
            sums = np.array([(s.sum(), bw.mixed(s).sum()) for s in sets], np.uint64).reshape(-1, 2)
            yield {"doc_id": part.column("doc_id"), "n_shingles": np.array([len(s) for s in sets], np.int64),
                   "h1": bw.mixed(sums[:, 0]).view(np.int64), "h2": bw.mixed(sums[:, 1]).view(np.int64)}

    return arrow_map(documents.select("doc_id", "text"), "doc_id long, n_shingles long, h1 long, h2 long", step)


# --- signatures --------------------------------------------------------------------

def set_signatures(sets: list[np.ndarray], band: int, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets under one scheme, with the number of the set each belongs to."""
    return _weighed_signatures(sets, band, scheme)[:2]


def _weighed_signatures(sets: list[np.ndarray], band: int, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with the number of plain signatures that their set must share, less those left out; 0: not plain."""
    m = scheme.segments
    token = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seed = bw.mixed(np.array([band + 1], np.uint64))[0]
    spread = bw.mixed(token ^ seed)
    segment = ((spread >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    cell = owner * m + segment
    total = np.zeros(len(sets) * m, np.uint64)
    np.add.at(total, cell, spread)
    count = np.bincount(cell, minlength=len(total))

    def signature(which: np.ndarray, value: np.ndarray, n: np.ndarray) -> np.ndarray:
        place = bw.mixed((which % m).astype(np.uint64) + (seed << np.uint64(1)))
        return bw.mixed(value + place + n.astype(np.uint64) * bw._ODD)

    cells = np.arange(len(total))
    plain = cells % m < scheme.plain
    small = plain & (count <= scheme.small)
    needs = small.reshape(-1, m).sum(1) >= scheme.slack  # without its small segments nothing is certain
    use = (plain & ~small) | (small & np.repeat(needs, m)) | ~plain
    kept = cells[use]
    out, of = [signature(kept, total[kept], count[kept])], [kept // m]
    spare = np.where(needs, 1, scheme.slack - small.reshape(-1, m).sum(1))
    spares = [np.where(plain[kept], spare[kept // m], 0)]
    if scheme.fuzzy:
        inner = np.flatnonzero(segment >= scheme.plain)
        out.append(signature(cell[inner], total[cell[inner]] - spread[inner], count[cell[inner]] - 1))
        of.append(owner[inner])
        spares.append(np.zeros(len(inner), np.int64))
    return np.concatenate(out), np.concatenate(of), np.concatenate(spares)


def _signatures_of(part: pa.RecordBatch, size: int, ranges: list[tuple[int, int]], schemes: list[Scheme | None],
                   percent: int) -> Iterator[dict[str, np.ndarray]]:
    """``sig, h1, band, spare`` of the distinct sets of some rows; ``h1`` names the set."""
    groups: dict[int, list[np.ndarray]] = {}
    seen = set()
    for s in shingle_sets(part, size):
        name = bw.mixed(np.array([s.sum()], np.uint64)).view(np.int64)[0] if len(s) else 0
        if not len(s) or (name, len(s)) in seen:
            continue
        seen.add((name, len(s)))
        for band in schemes_of(len(s), ranges, percent):
            if schemes[band] is not None:
                groups.setdefault(band, []).append(s)
    for band, sets in groups.items():
        sig, of, spare = _weighed_signatures(sets, band, schemes[band])
        yield {"sig": sig, "h1": bw.mixed(np.array([s.sum() for s in sets], np.uint64)).view(np.int64)[of],
               "band": np.full(len(sig), band), "spare": spare}


_ROOM = 4  # cells for each signature, else a sketch tells too little
_CHOSEN_BITS = 25  # cells of each row of the sketch of ids: two rows of 4 MB as bit sets


def _id_hashes(part: pa.RecordBatch) -> np.ndarray:
    return bw.mixed(np.asarray(part.column("doc_id").to_numpy(zero_copy_only=False), np.int64).view(np.uint64))


def chosen_ids(ids: DataFrame) -> np.ndarray:
    """A sketch that holds every id of a one-column table, and few others."""
    named = ids.toDF("doc_id")
    return repeated_cells(named, lambda part: np.repeat(_id_hashes(part), 2), _CHOSEN_BITS, ("doc_id",), None)


def _among(part: pa.RecordBatch, chosen: Broadcast) -> pa.RecordBatch:
    """The rows whose id may be among the chosen ones."""
    return part.filter(pa.array(maybe_repeated(chosen.value, _id_hashes(part))))


def signatures(documents: DataFrame, classes: DataFrame, size: int, ranges: list[tuple[int, int]],
               schemes: list[Scheme | None], percent: int, expected: float = 0,
               bits: int = CELL_BITS) -> tuple[DataFrame, list[Broadcast]]:
    """``sig, h1, band, spare``: the signatures that may belong to several sets, and the broadcast sketches that tell.

    Rows that stand for no class in ``classes`` are left out, but for a few that the sketch of ids lets through.  A first
    pass sketches all signatures; one that occurs once can link nothing and never leaves its task.  Where the
    ``expected`` number of them would fill the sketch, their keys are counted first, and the sketch holds the repeated ones.
    """
    context = documents.sparkSession.sparkContext
    chosen = context.broadcast(chosen_ids(classes.select("rep")))

    def found(part: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        rows = _among(part, chosen)
        return _signatures_of(rows, size, ranges, schemes, percent) if rows.num_rows else iter(())

    def hashes(part: pa.RecordBatch) -> np.ndarray:
        sigs = [rows["sig"] for rows in found(part)]
        return np.concatenate(sigs) if sigs else np.zeros(0, np.uint64)

    many, parts = expected * _ROOM > 1 << bits, parts_for(expected)
    if many:
        with Scratch(documents.sparkSession) as scratch:
            names = scratch.save(repeated_names(documents, hashes, parts, ("doc_id", "text")))
            cells = repeated_cells(names, lambda part: np.repeat(part.column("name").to_numpy().view(np.uint64), 2),
                                   bits_for(names.count(), bits), ("name",), None)
    else:
        cells = repeated_cells(documents, hashes, bits_for(expected, bits) if expected else bits, ("doc_id", "text"))
    held = context.broadcast(cells)
    del cells

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            for rows in found(part):
                hit = maybe_repeated(held.value, named(rows["sig"], parts) if many else rows["sig"])
                yield {name: values[hit] for name, values in (rows | {"sig": rows["sig"].view(np.int64)}).items()}

    return arrow_map(documents.select("doc_id", "text"), "sig long, h1 long, band int, spare int", step), [chosen, held]


def sifted(rows: DataFrame, bits: int = CELL_BITS) -> tuple[DataFrame, Broadcast]:
    """The rows whose signature may occur again among ``rows`` themselves, told by other cells than those they passed.

    The cells of the first sketch fill up as documents grow; what it lets through fills few cells of the second.
    """
    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        return bw.mixed(batch.column("sig").to_numpy().view(np.uint64))

    cells = repeated_cells(rows, hashes, bits_for(rows.count(), bits), ("sig",), None)
    held = rows.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_repeated(held.value, hashes(batch))))

    return rows.mapInArrow(run, rows.schema), held


def _indexed(documents: DataFrame, classes: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """``sig, h1, band, spare``, written: the signatures that may belong to several sets."""
    largest = classes.agg(F.max("n_shingles")).first()[0] or 0
    ranges = bands(largest)
    in_band = {r["low"]: r["sets"] for r in _per_band(classes, ranges).collect()}  # one row a band
    counts = [in_band.get(low, 0) + in_band.get(below, 0)
              for below, (low, _) in zip([0, *[r[0] for r in ranges]], ranges, strict=False)]
    schemes = [allocate(low, high, n, percent) for n, (low, high) in zip(counts, ranges, strict=True)]
    expected = sum(n * (s.segments + high) for n, (_, high), s in zip(counts, ranges, schemes, strict=True) if s)
    emitted, sketches = signatures(documents, classes, size, ranges, schemes, percent, expected)
    first = scratch.save(emitted)
    for sketch in sketches:
        sketch.destroy()
    del emitted, sketches  # the driver lets go of the first sketch before it takes the second
    again, sketch = sifted(first)
    rows = scratch.save(again)
    sketch.destroy()
    scratch.drop(first)
    return rows


def thinned(hits: DataFrame) -> DataFrame:
    """Leave out each set's most frequent plain signatures, as many as it can do without.

    ``hits`` has ``sig, h1, band, spare`` and ``n``, the frequency of the signature.  Two similar sets agree in
    more segments than either leaves out, and both leave out by one order, so that the rarest on which they agree stays.
    """
    order = Window.partitionBy("h1", "band", F.col("spare") > 0).orderBy(F.col("n").desc(), "sig")
    return hits.withColumn("_turn", F.row_number().over(order)).where("spare = 0 OR _turn >= spare").drop("_turn")


# --- candidates and verification -------------------------------------------------

def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Leave out pairs whose counts of tokens by bucket differ more than similar sets may; whole sets stay where they are."""
    def side(end: str) -> DataFrame:
        return sets.select(F.col("doc").alias(end), F.col("n").alias(f"n{end}"), F.col("marks").alias(f"m{end}"))

    both = lookup(lookup(pairs, side("a"), "a"), side("b"), "b")
    apart = F.aggregate(F.zip_with("ma", "mb", lambda x, y: F.abs(x.cast("int") - y)), F.lit(0), lambda so_far, d: so_far + d)
    return both.where(apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)).select("a", "b")


def _compare_finer(percent: int):
    """The pairs whose finer counts differ no more than similar sets may; a pair without them stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            sizes = batch.column("na").to_numpy().astype(np.int64) + batch.column("nb").to_numpy()
            for i, (x, y) in enumerate(zip(_arrays(batch.column("fa")), _arrays(batch.column("fb")), strict=True)):
                m = min(len(x), len(y))
                if m:  # numbers of buckets are powers of two, so that finer counts fold
                    apart = np.abs(x.reshape(-1, m).sum(0, np.int64) - y.reshape(-1, m).sum(0, np.int64)).sum()
                    keep[i] = apart * (100 + percent) <= sizes[i] * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _finer(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Leave out pairs of large sets by finer counts; the buckets of the first ones fill up and are alike by chance."""
    def side(end: str) -> DataFrame:
        return sets.select(F.col("doc").alias(end), F.col("n").alias(f"n{end}"), F.col("fine").alias(f"f{end}"))

    return lookup(lookup(pairs, side("a"), "a"), side("b"), "b").mapInArrow(_compare_finer(percent), "a long, b long")


_FOLLOWERS = 64  # texts that one copy of a leading text is compared with


def _asked(pairs: DataFrame) -> DataFrame:
    """``doc, lead, block, follows``: the texts that the tasks need for ``pairs``, one task for each ``lead, block``.

    The end with more pairs leads, so the other text travels once for a pair and the leading one once for a block.
    """
    def degrees(end: str) -> DataFrame:
        return pairs.groupBy(end).agg(F.count(F.lit(1)).alias(f"k{end}"))

    counted = lookup(lookup(pairs, degrees("a"), "a"), degrees("b"), "b")
    a_leads = F.col("ka") >= F.col("kb")
    led = counted.select(F.when(a_leads, F.col("a")).otherwise(F.col("b")).alias("lead"),
                         F.when(a_leads, F.col("b")).otherwise(F.col("a")).alias("doc"),
                         F.ceil(F.greatest("ka", "kb") / _FOLLOWERS).cast("int").alias("blocks"))
    led = led.select("doc", "lead", F.pmod(F.xxhash64("doc"), "blocks").cast("int").alias("block"), F.lit(True).alias("follows"))
    return led.unionAll(led.select(F.col("lead").alias("doc"), "lead", "block", F.lit(False)).distinct())


def _compare_texts(size: int, percent: int):
    """Pairs ``a < b`` whose whole sets are similar; rows arrive by block, its leading text first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lead = None, None
        for batch in batches:
            found: list[tuple[int, int]] = []
            for part in bw.pieces(_unpacked(batch), "text"):
                rows = zip(*(part.column(k).to_pylist() for k in ("doc", "lead", "block", "follows")), strict=True)
                for (doc, led_by, block, follows), tokens in zip(rows, shingle_sets(part, size), strict=True):
                    if not follows:
                        key, lead = (led_by, block), tokens
                        continue
                    if (led_by, block) != key:
                        raise RuntimeError("a block without its leading text")
                    shared = len(lead) + len(tokens) - len(np.union1d(lead, tokens))
                    if shared * 100 >= (len(lead) + len(tokens) - shared) * percent:
                        found.append((min(doc, led_by), max(doc, led_by)))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


def verified(pairs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """Of distinct pairs ``a < b``, those whose whole sets are similar."""
    rows = lookup(_asked(pairs), sets.select("doc", "packed", "bytes"), "doc")
    return rows.repartition("lead", "block").sortWithinPartitions("lead", "block", "follows") \
               .mapInArrow(_compare_texts(size, percent), "a long, b long")


def _similar_sizes(x: str, y: str, percent: int):
    return (F.least(x, y) * 100 >= F.greatest(x, y) * percent)


def _stars(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of each bucket's first and last member with the others."""
    place = F.struct("doc", "n")
    lead = members.groupBy("sig").agg(F.array_distinct(F.array(F.min(place), F.max(place))).alias("lead"))
    rows = lookup(members, lead, "sig").withColumn("lead", F.explode("lead")).where(F.col("doc") != F.col("lead.doc"))
    return rows.where(_similar_sizes("n", "lead.n", percent)) \
               .select(F.least("doc", "lead.doc").alias("a"), F.greatest("doc", "lead.doc").alias("b")).distinct()


def _split_buckets(members: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of buckets that still hold several components."""
    named = lookup(members.drop("component"), labels.withColumnsRenamed({"node": "doc"}), "doc", "left") \
        .withColumn("component", F.coalesce("component", "doc"))
    named = scratch.save(named)
    open_ = named.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y")) \
                 .where("x <> y").select("sig")
    return scratch.save(lookup(named, open_, "sig"))


def links(members: DataFrame, sets: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """Enough verified pairs ``a, b`` to connect every component of the similarity graph.

    A text travels once for each pair, so each set is first compared with one of its candidates only; the
    others follow where the two are not connected by then.
    """
    stars = scratch.save(_near(_stars(members, percent), sets, percent))
    one = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    found = scratch.save(verified(scratch.save(_finer(one, sets, percent)), sets, size, percent))
    labels = connected_components(found.withColumn("w", F.lit(1.0)), scratch)
    for end in "ab":
        stars = lookup(stars, labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left")
    open_ = stars.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    open_ = scratch.save(_finer(open_, sets, percent))
    found = scratch.save(found.unionAll(verified(open_, sets, size, percent)))
    labels = scratch.save(connected_components(found.withColumn("w", F.lit(1.0)), scratch))
    members = _split_buckets(members, labels, scratch)
    counts = members.groupBy("sig").agg(F.count(F.lit(1)).alias("members"))
    members = scratch.save(lookup(members, counts, "sig"))
    small = scratch.save(_near(_small_bucket_pairs(members.where(F.col("members") <= _LARGE), percent), sets, percent))
    large = scratch.save(_large_bucket_pairs(members.where(F.col("members") > _LARGE), sets, percent, scratch))
    rest = scratch.save(_finer(small.unionAll(large).distinct(), sets, percent))
    return scratch.save(found.unionAll(verified(rest, sets, size, percent)))


_LARGE = 48  # buckets up to this size list their pairs of different components


def _small_bucket_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs across components of small buckets."""
    x = members.select("sig", F.col("doc").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
    y = members.select("sig", F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    return x.join(y, "sig").where(F.col("a") < F.col("b")).where("ca <> cb") \
            .where(_similar_sizes("na", "nb", percent)).select("a", "b").distinct()


_BLOCK = 256  # sets whose counts a task holds while the rest of a bucket streams past


def _compare_blocks(percent: int):
    """Pairs of sets of different components whose counts by bucket are near; rows arrive by block, its own sets first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, held = None, [], None
        for batch in batches:
            found: list[tuple[int, int]] = []
            marks = _arrays(batch.column("marks"))
            rows = list(zip(*(batch.column(k).to_pylist() for k in ("sig", "block", "other", "doc", "component", "n")),
                            strict=True))
            at = 0
            while at < len(rows):
                sig, block, other, *facts = rows[at]
                if (sig, block) != key:
                    key, own, held = (sig, block), [], None
                if not other:
                    own.append((*facts, marks[at]))
                    at += 1
                    continue
                if held is None:
                    held = [np.array(column) for column in zip(*own, strict=True)]
                    held[3] = held[3].astype(np.int16)
                to = at
                while to < len(rows) and to < at + 64 and rows[to][:3] == (sig, block, True):
                    to += 1
                docs, groups, sizes = (np.array([r[k] for r in rows[at:to]]) for k in (3, 4, 5))
                apart = np.abs(held[3][:, None, :] - np.stack(marks[at:to]).astype(np.int16)[None, :, :]).sum(2, np.int64)
                near = (apart * (100 + percent) <= (held[2][:, None] + sizes[None, :]) * (100 - percent)) \
                    & (held[1][:, None] != groups[None, :])
                i, j = np.nonzero(near)
                found += zip(held[0][i].tolist(), docs[j].tolist(), strict=True)
                at = to
            pairs = {(min(p), max(p)) for p in found}
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


def _arrays(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _large_bucket_pairs(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs across components of large buckets whose counts are near, compared in blocks.

    Buckets that share members form one group, so a set is sent once, not once a
    bucket.  One component of a group, the largest there, needs no block of its
    own: any pair of two components has a member outside it.
    """
    lead = members.groupBy("sig").agg(F.min("doc").alias("first"))
    stars = lookup(members, lead, "sig").where("doc <> first").select(F.col("first").alias("a"), F.col("doc").alias("b"))
    groups = connected_components(stars.distinct().withColumn("w", F.lit(1.0)), scratch) \
        .select(F.col("node").alias("doc"), F.col("component").alias("sig"))
    members = scratch.save(lookup(members.select("doc", "component").distinct(), groups, "doc"))
    sizes = members.groupBy("sig", "component").agg(F.count(F.lit(1)).alias("k"))
    rest = sizes.groupBy("sig").agg(F.max(F.struct("k", "component")).alias("top"), F.sum("k").alias("all")) \
        .where(F.col("all") > F.col("top.k")).select(
            "sig", F.col("top.component").alias("main"),
            F.ceil((F.col("all") - F.col("top.k")) / _BLOCK).cast("int").alias("blocks"))
    rows = lookup(members, rest, "sig")
    own = rows.where("component <> main").select("sig", F.pmod(F.xxhash64("doc"), "blocks").cast("int").alias("block"),
                                                 F.lit(False).alias("other"), "doc", "component")
    other = rows.select("sig", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                        F.lit(True).alias("other"), "doc", "component")
    filled = own.select("sig", "block").distinct()
    dealt = lookup(own.unionAll(other.join(filled, ["sig", "block"], "left_semi")), sets.select("doc", "n", "marks"), "doc")
    return dealt.repartition("sig", "block").sortWithinPartitions("sig", "block", "other") \
                .mapInArrow(_compare_blocks(percent), "a long, b long").distinct()


_SETS = "packed binary, bytes int, n int, marks array<tinyint>, fine array<tinyint>"


def _unpacked(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows with their ``text`` instead of ``packed, bytes``."""
    zstd = pa.Codec("zstd")
    texts = [zstd.decompress(raw, size, asbytes=True) if size else b""
             for raw, size in zip(*(batch.column(k).to_pylist() for k in ("packed", "bytes")), strict=True)]
    rest = [k for k in batch.schema.names if k not in ("packed", "bytes")]
    text = pa.array(texts, pa.large_binary()).view(pa.large_string())  # as it was, valid or not
    return pa.RecordBatch.from_arrays([*[batch.column(k) for k in rest], text], [*rest, "text"])


def _counts(tokens: np.ndarray) -> np.ndarray:
    """Counts of a large set by so many buckets, a power of two, that few hold more than ``_DENSE`` tokens."""
    buckets = 1 << (-(-len(tokens) // _DENSE) - 1).bit_length()
    counts = np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 127).astype(np.int8)


def _set_columns(sets: list[np.ndarray], texts: pa.Array) -> dict[str, pa.Array]:
    """The text, packed, which is far smaller than its tokens; their number and counts by bucket, cut off where a byte ends."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    fine = [np.zeros(0, np.int8) if len(s) <= _DENSE * _MARKS else _counts(s) for s in sets]
    data, places = bw.flat(texts)
    zstd = pa.Codec("zstd")
    packed = [zstd.compress(data[a:b].tobytes(), asbytes=True) for a, b in zip(places[:-1], places[1:], strict=True)]
    cell = np.repeat(np.arange(len(sets)), n) * _MARKS + (flat.view(np.uint64) % np.uint64(_MARKS)).astype(np.int64)
    marks = np.minimum(np.bincount(cell, minlength=len(sets) * _MARKS), 127).astype(np.int8)
    return {"packed": pa.array(packed, pa.binary()), "bytes": pa.array(np.diff(places), pa.int32()), "n": pa.array(n, pa.int32()),
            "marks": pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * _MARKS, pa.array(marks)),
            "fine": pa.ListArray.from_arrays(np.r_[0, np.cumsum([len(f) for f in fine])].astype(np.int32),
                                             pa.array(np.concatenate(fine)))}


def token_sets(documents: DataFrame, size: int, chosen: Broadcast) -> DataFrame:
    """``doc, packed, bytes, n, marks, fine`` of the rows whose id is chosen, and of few others; no text is shuffled."""
    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            rows = _among(part, chosen)
            if rows.num_rows:
                yield {"doc": rows.column("doc_id")} | _set_columns(shingle_sets(rows, size), rows.column("text"))

    return arrow_map(documents.select("doc_id", "text"), f"doc long, {_SETS}", step)


def _class_sets(documents: DataFrame, size: int, classes: DataFrame, chosen: Broadcast) -> DataFrame:
    """``doc, packed, bytes, n, marks, fine`` of every class, ``doc`` its number; rows are matched by set identity, not by id."""
    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            rows = _among(part, chosen)
            if not rows.num_rows:
                continue
            sets = shingle_sets(rows, size)
            sums = np.array([(s.sum(), bw.mixed(s).sum()) for s in sets], np.uint64).reshape(-1, 2)
            yield {"h1": bw.mixed(sums[:, 0]).view(np.int64), "h2": bw.mixed(sums[:, 1]).view(np.int64),
                   "n_shingles": np.array([len(s) for s in sets], np.int64)} | _set_columns(sets, rows.column("text"))

    found = arrow_map(documents.select("doc_id", "text"), f"h1 long, h2 long, n_shingles long, {_SETS}", step)
    return lookup(found, classes.select("h1", "h2", "n_shingles", "node"), ["h1", "h2", "n_shingles"]) \
        .groupBy(F.col("node").alias("doc")).agg(*[F.first(name).alias(name) for name in ("packed", "bytes", "n", "marks", "fine")])


def components(documents: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Two documents link when their sets of ``size``-word shingles (lower-cased)
    have a Jaccard similarity of at least ``percent`` / 100; the component is the
    smallest id reachable.  Null and empty texts have no set and stay alone.
    Rows are told apart by their sets: one id with several texts takes part with
    each, and each row gets the component of its own text.  A row without an id gets the component of the rows with an equal set, else null.
    """
    ids = scratch.save(set_ids(documents, size))
    repeats = _repeats_ids(ids)  # then ids do not name sets, and classes are numbered
    node = F.monotonically_increasing_id() if repeats else F.col("rep")
    classes = scratch.save(ids.where("n_shingles > 0").groupBy("h1", "h2", "n_shingles")
                           .agg(F.min("doc_id").alias("rep")).where("rep IS NOT NULL").withColumn("node", node))
    named_rows = documents.where(F.col("doc_id").isNotNull())
    rows = _indexed(named_rows, classes, size, percent, scratch)
    shared = rows.groupBy("sig").agg(F.min("h1").alias("x"), F.max("h1").alias("y"), F.count(F.lit(1)).alias("n")) \
        .where("x <> y").select("sig", "n")
    hits = thinned(lookup(rows, shared, "sig").distinct())
    members = scratch.save(lookup(hits, classes, "h1").select("sig", F.col("node").alias("doc"),
                                                              F.col("n_shingles").alias("n")))
    scratch.drop(rows)
    wanted = members.select(F.col("doc").alias("node")).distinct()
    named = lookup(classes, wanted, "node", "left_semi")
    chosen = documents.sparkSession.sparkContext.broadcast(chosen_ids(named.select("rep")))
    sets = scratch.save(_class_sets(named_rows, size, named, chosen) if repeats else token_sets(named_rows, size, chosen))
    chosen.destroy()
    edges = links(members, sets, size, percent, scratch)
    labels = scratch.save(connected_components(edges.withColumn("w", F.lit(1.0)), scratch))
    named = lookup(classes, labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if repeats:
        least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
        named = lookup(named, least, "component")
    else:
        named = named.withColumn("component_id", F.col("component"))
    named = named.select("h1", "h2", "n_shingles", "component_id")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return lookup(ids, named, ["h1", "h2", "n_shingles"], "left").select("doc_id", "n_shingles",
                                                                         own.alias("component_id"))


def _repeats_ids(ids: DataFrame) -> bool:
    return not ids.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").isEmpty()


def _per_band(classes: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    lows = F.array(*[F.lit(low) for low, _ in ranges]) if ranges else F.array(F.lit(1))
    low = F.array_max(F.filter(lows, lambda v: v <= F.col("n_shingles")))
    return classes.groupBy(low.alias("low")).agg(F.count(F.lit(1)).alias("sets"))
