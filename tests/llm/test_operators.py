"""Every corpus operator against brute force on small tables with nulls, ties, repeats and long texts."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldatlas.llm import bpe, langid, mixing, quality, setjoin, sketch, suffixes, toxicity, vectors, warc, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string"


def passages(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice("abcdefghij") + rng.choice("aeiou") * rng.randint(1, 3) for _ in range(30))
            for _ in range(n)]


def sample_rows():
    rng = random.Random(5)
    shared = passages(1, 4)
    rows = []
    for i in range(60):
        own = " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 120)))
        text = f"{own} {rng.choice(shared)}\n{rng.choice(shared)} end{i}" if i % 3 else own
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b"]), len(text), "clash"))
    base = rows[7][1]
    words = ("lorem ipsum dolor sit amet " * 40 + " ".join(f"t{k}" for k in range(300))).split()
    rows += [(100, None, "en", "a", None, None), (101, "", None, None, 0, None), (102, " \t\n", "en", "a", 3, None),
             (103, base, "en", "a", 1, None), (104, base, "en", "b", 1, None), (104, base, "en", "b", 1, None),
             (105, "Ein KURZER text", "de", None, 1, None), (106, "ein kurzer TEXT", "de", "b", 1, None),
             (107, "é" * 70 + " ß" * 60, "de", "a", 1, None), (108, " ".join(words), "en", "a", 1, None),
             (109, " ".join([*words[:250], "changed", *words[251:]]), "en", "a", 1, None),
             (110, "x" * 5000 + " " + "ab " * 4000, "en", "b", 1, None), (111, "x" * 4000, None, "b", 1, None),
             (112, "one <|endoftext|> two<|endoftext|>", "en", "a", 1, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return sample_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def asserted(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# --- windows (10) ----------------------------------------------------------------

def brute_windows(rows):
    first = {}
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - 12):
            key = tuple(w[k: k + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k: k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_windows_equal_brute_force(docs, rows, scratch):
    got, _ = windows.deduplicated(docs, scratch, bits=18)
    assert asserted(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == brute_windows(rows)


def test_windows_when_the_sketch_is_full(docs, rows, scratch):
    got, _ = windows.deduplicated(docs, scratch, bits=16)
    assert asserted(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == brute_windows(rows)


def test_windows_small_chunks(docs, rows, scratch, monkeypatch):
    monkeypatch.setattr(windows, "_CHUNK", 50)
    got, _ = windows.deduplicated(docs.coalesce(1), scratch, bits=18)
    assert asserted(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == brute_windows(rows)


def test_pruned_keeps_columns_and_rows(docs, rows, scratch):
    spans = scratch.save(windows.covered_spans(docs, 18))
    got = windows.pruned(docs, spans)
    assert got.columns == docs.columns and got.count() == len(rows)
    texts = {(r.doc_id, r.source): r.text for r in got.collect()}
    assert texts[100, "a"] is None and texts[101, None] == "" and texts[0, rows[0][3]] == rows[0][1]
    removed = {i: n for i, _, n, _ in brute_windows(rows)}
    for r in got.collect():
        assert len(WORD.findall(r.text or "")) == len(WORD.findall(dict((x[0], x[1]) for x in rows)[r.doc_id] or "")) \
            - removed[r.doc_id]


def test_windows_null_ids_and_empty_table(spark, nothing, scratch):
    text = passages(9, 1)[0]
    got, _ = windows.deduplicated(spark.createDataFrame([(None, text), (1, text), (2, text)], "doc_id long, text string"),
                                  scratch, bits=16)
    assert {r.doc_id: r.n_removed for r in got.collect()} == {None: 0, 1: 0, 2: 30}
    assert windows.deduplicated(nothing, scratch, bits=16)[0].count() == 0


# --- suffixes (3) ----------------------------------------------------------------

def brute_bytes(rows):
    first = {}
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    for k in order:
        b = (rows[k][1] or "").encode()
        for i in range(len(b) - 99):
            first.setdefault(b[i: i + 100], (rows[k][0], i))
    out = []
    for i, text, *_ in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 99):
            if first[b[k: k + 100]] < (i, k):
                gone[k: k + 100] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((gone[:-1] & ~np.r_[False, gone[:-1]][: len(b)]).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


COLUMNS3 = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_suffixes_equal_brute_force(docs, rows, scratch):
    assert asserted(suffixes.deduplicated(docs, scratch, bits=18), COLUMNS3) == brute_bytes(rows)


def test_hot_buckets_are_dealt_by_string(docs, rows, scratch):
    spans = suffixes.repeated_spans(docs, scratch, bits=18, hot=2)
    assert asserted(suffixes.digests(docs, spans), COLUMNS3) == brute_bytes(rows)


def test_suffixes_empty_table(nothing, scratch):
    assert suffixes.deduplicated(nothing, scratch, bits=16).count() == 0


def test_maximal_repeats_have_all_occurrences():
    rng = random.Random(3)
    text = bytes(rng.choice(b"ab") for _ in range(160))
    got = {(n, tuple(sorted(p.tolist()))) for n, p in suffixes.maximal_repeats(
        np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]), size=4)}
    want = set()
    for n in range(4, 160):
        places = {}
        for i in range(len(text) - n + 1):
            places.setdefault(text[i: i + n], []).append(i)
        for p in places.values():
            left = {text[i - 1] if i else None for i in p}
            right = {text[i + n] if i + n < len(text) else None for i in p}
            if len(p) > 1 and len(left) > 1 and len(right) > 1:
                want.add((n, tuple(p)))
    assert got == want


# --- set join (6) ------------------------------------------------------------------

def brute_sets(rows, size, percent):
    sets = []
    for i, text, *_ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(w[k: k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        sets.append((i, grams))
    label = {i: i for i, _ in sets}
    changed = True
    while changed:
        changed = False
        for x, a in sets:
            for y, b in sets:
                if a and b and 100 * len(a & b) >= percent * len(a | b) and label[x] != label[y]:
                    label[x] = label[y] = min(label[x], label[y])
                    changed = True
    return sorted((i, len(s), label[i]) for i, s in sets)


def near_copies():
    rng = random.Random(11)
    rows = []
    for size in (8, 15, 40, 90, 300):
        base = [f"v{rng.randint(0, 2000)}" for _ in range(size)]
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randint(0, max(1, size // 40))):
                words[rng.randrange(size)] = f"v{rng.randint(0, 2000)}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_set_join_equals_brute_force(spark, docs, rows, scratch, size, percent):
    columns = ["doc_id", "n_shingles", "component_id"]
    assert asserted(setjoin.components(docs, scratch, size, percent), columns) == brute_sets(rows, size, percent)
    near = near_copies()
    got = setjoin.components(spark.createDataFrame(near, "doc_id long, text string"), scratch, size, percent)
    assert asserted(got, columns) == brute_sets(near, size, percent)


def test_set_join_of_a_large_group(spark, scratch, monkeypatch):
    monkeypatch.setattr(setjoin, "_LARGE", 4)
    monkeypatch.setattr(setjoin, "_BLOCK", 5)
    near = near_copies()
    got = setjoin.components(spark.createDataFrame(near, "doc_id long, text string"), scratch, 3, 90)
    assert asserted(got, ["doc_id", "n_shingles", "component_id"]) == brute_sets(near, 3, 90)


def test_set_join_of_ids_with_several_texts(spark, scratch):
    """Each text of a repeated id is compared on its own set, whatever the order of rows."""
    rng = random.Random(4)
    texts = [[f"u{rng.randint(0, 9000)}" for _ in range(200)] for _ in range(12)]
    rows = []
    for k, words in enumerate(texts):
        near = [*words[:100], "changed", *words[101:]]
        rows += [(k // 2, " ".join(words)), (100 + k, " ".join(near))]  # two texts an id, a near copy of each
    for turned in (rows, rows[::-1]):
        got = setjoin.components(spark.createDataFrame(turned, "doc_id long, text string").coalesce(1), scratch, 3, 90)
        assert sorted((r.doc_id, r.component_id) for r in got.collect()) == sorted(
            [(k // 2, k // 2) for k in range(12)] + [(100 + k, k // 2) for k in range(12)])


def test_set_join_without_rows_or_ids(spark, nothing, scratch):
    assert setjoin.components(nothing, scratch, 3, 90).count() == 0
    got = setjoin.components(spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, "z"), (None, None)],
                                                   "doc_id long, text string"), scratch, 3, 90)
    assert sorted((r.n_shingles, r.component_id or -1) for r in got.collect()) == [(0, -1), (1, -1), (2, 4), (2, 4)]


def test_copies_of_a_set_are_not_indexed(spark, scratch):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text) for i in range(40)] + [(100 + i, " ".join(f"x{i}y{j}" for j in range(60))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    classes = setjoin.set_ids(docs, 3).groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    ranges = setjoin.bands(58)
    schemes = [setjoin.allocate(low, high, 60, 90) for low, high in ranges]
    emitted, _ = setjoin.signatures(docs, classes, 3, ranges, schemes, 90)
    assert emitted.count() == 0  # nothing is shared by different sets


def test_a_sketch_of_few_hashes_is_sent_as_lists():
    """Cells hit twice travel to the driver; 64 KB of cells took 8 KB whatever they held."""
    cells = np.array([5, 77, 900], np.uint16).tobytes()
    rows = pa.RecordBatch.from_pydict({"block": [3, 3], "cells": [cells, cells[2:4]], "twice": [cells[:2], b""]})
    merged = list(sketch._merge(iter([rows])))
    assert [b.to_pylist() for b in merged] == [[{"block": 3, "repeated": np.array([5, 77], np.uint16).tobytes()}]]


@pytest.mark.parametrize("count", [300, 90_000])
def test_a_sketch_holds_every_repeated_hash(spark, count):
    data = spark.range(0, count, 1, 3).selectExpr("xxhash64(id) AS sig").unionAll(
        spark.range(0, count // 30).selectExpr("xxhash64(id) AS sig"))
    cells = sketch.repeated_cells(data, lambda b: b.column("sig").to_numpy().view(np.uint64), 17, ("sig",), None)
    hit = sketch.maybe_repeated(cells, data.toArrow().column("sig").to_numpy().view(np.uint64))
    assert hit[: count // 30].all() and hit[count:].all()
    assert count > 1000 or hit.sum() < count // 10


def test_signatures_are_sifted_a_second_time(spark):
    """What the first sketch let through and occurs once goes before the rows are shuffled."""
    rows = spark.range(2000).selectExpr("xxhash64(id div 2 + if(id < 1900, id, 0)) AS sig", "id AS h1", "1 AS band", "1 AS spare")
    wanted = {r.sig for r in rows.groupBy("sig").count().where("count > 1").collect()}
    got = [r.sig for r in setjoin.sifted(rows)[0].collect()]
    assert wanted and wanted <= set(got) and len(got) < 1000


def test_sets_are_read_without_a_shuffle_of_texts(spark, docs):
    ids = docs.where("doc_id % 7 = 0").select("doc_id")
    chosen = spark.sparkContext.broadcast(setjoin.chosen_ids(ids))
    sets = setjoin.token_sets(docs, 3, chosen)
    assert "hashpartitioning" not in sets._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id for r in ids.collect()} <= {r.doc for r in sets.collect()}


def test_a_text_is_sent_once_to_each_block_of_its_pairs(spark, scratch, monkeypatch):
    """A hub of 40 pairs travels once for eight others, not once for each pair, and no tokens travel."""
    monkeypatch.setattr(setjoin, "_FOLLOWERS", 8)
    words = [f"w{k}" for k in range(60)]
    texts = [(i, " ".join([*words[:40], *(["other"] * (20 if i % 5 == 4 else 1)), *(words[50:] if i % 4 == 3 else []), f"end{i}"])) for i in range(41)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = scratch.save(setjoin.token_sets(docs, 3, spark.sparkContext.broadcast(setjoin.chosen_ids(docs.select("doc_id")))))
    assert "tokens" not in sets.columns
    pairs = spark.createDataFrame([(0, i) for i in range(1, 41)], "a long, b long")
    asked = setjoin._asked(pairs)
    assert asked.where("follows").count() == 40 and 1 <= asked.where("NOT follows").count() <= 5
    got = sorted((r.a, r.b) for r in setjoin.verified(pairs, sets, 3, 80).collect())
    grams = [set(zip(w, w[1:], w[2:], strict=False)) for w in (t.split() for _, t in texts)]
    assert got == [(0, i) for i in range(1, 41) if len(grams[0] & grams[i]) * 100 >= 80 * len(grams[0] | grams[i])]
    assert 0 < len(got) < 40


def test_large_unrelated_sets_never_meet_as_texts(spark, scratch):
    """Counts by 256 buckets take two unrelated sets of 20,000 tokens for similar; finer counts tell them apart."""
    rng = np.random.default_rng(8)
    words = [[f"w{k}" for k in rng.integers(0, 10 ** 6, 20_000)] for _ in range(2)]
    near = [*words[0][:-900], *(f"z{k}" for k in range(900))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate([*words, near])], "doc_id long, text string")
    sets = scratch.save(setjoin.token_sets(docs, 5, spark.sparkContext.broadcast(setjoin.chosen_ids(docs.select("doc_id")))))
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a long, b long")
    assert setjoin._near(pairs, sets, 80).count() == 3
    assert [(r.a, r.b) for r in setjoin._finer(pairs, sets, 80).collect()] == [(0, 2)]
    assert [(r.a, r.b) for r in setjoin.verified(pairs, sets, 5, 80).collect()] == [(0, 2)]


def test_signatures_beyond_the_sketch_are_counted(spark, scratch, monkeypatch):
    """A sketch of 2 x 65,536 cells lets most of 300,000 hashes through; counted keys keep the repeated ones only."""
    data = spark.range(0, 300_000, 1, 3).selectExpr("xxhash64(id) AS sig").unionAll(spark.range(0, 500).selectExpr("xxhash64(id) AS sig"))
    hashes = lambda b: b.column("sig").to_numpy().view(np.uint64)
    everything = np.unique(hashes(data.toArrow().combine_chunks().to_batches()[0]))
    assert sketch.maybe_repeated(sketch.repeated_cells(data, hashes, 16, ("sig",), None), everything).sum() > 250_000
    names = sketch.repeated_names(data, hashes, 300, ("sig",), None).toArrow().column("name").to_numpy().view(np.uint64)
    wanted = {r.sig for r in spark.range(0, 500).selectExpr("xxhash64(id) AS sig").collect()}
    assert set(everything[np.isin(sketch.named(everything, 300), names)].view(np.int64).tolist()) == wanted
    monkeypatch.setattr(setjoin, "_ROOM", 1 << 40)
    near = near_copies()
    got = setjoin.components(spark.createDataFrame(near, "doc_id long, text string"), scratch, 3, 90)
    assert asserted(got, ["doc_id", "n_shingles", "component_id"]) == brute_sets(near, 3, 90)


def test_every_scheme_finds_similar_sets():
    rng = np.random.default_rng(2)
    for percent in (80, 90):
        for low, high in setjoin.bands(600):
            for fuzzy in (False, True):
                scheme = setjoin.allocate(low, high, 10 ** 9 if fuzzy else 1000, percent)
                bound = setjoin.largest_difference(2 * high, percent)
                if scheme is None:
                    assert bound == 0
                    continue
                assert scheme.plain + 2 * scheme.fuzzy - bound == scheme.slack >= 1
                for _ in range(3):
                    a = np.unique(rng.integers(0, 1 << 63, high, dtype=np.uint64))
                    cut = int(rng.integers(0, bound + 1))
                    keep = rng.permutation(a)[: len(a) - cut]
                    b = np.unique(np.r_[keep, rng.integers(0, 1 << 63, bound - cut, dtype=np.uint64)])
                    sig, of = setjoin.set_signatures([a, b], 3, scheme)
                    assert set(sig[of == 0]) & set(sig[of == 1])


# --- vectors (5) -----------------------------------------------------------------

def test_vectors_equal_brute_force(spark, scratch, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 20)
    monkeypatch.setattr(vectors, "BLOCK", 7)
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 8))
    data = [(i, (centers[i % 12] + rng.normal(size=8) * 0.12).astype(np.float32).tolist()) for i in range(150)]
    data += [(200, data[3][1]), (201, data[3][1]), (201, data[3][1]), (202, None), (203, [0.0] * 8), (204, []),
             (205, [float("nan")] + [1.0] * 7), (206, [None] + [1.0] * 7), (207, [1.0, 0.0]), (208, [1.0, 0.001])]
    got = vectors.links(spark.createDataFrame(data, "vec_id long, vec array<float>"), scratch, 0.95)
    usable = [v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v) for _, v in data]
    near = lambda x, y: len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95
    pairs = {(a, b) for a in range(len(data)) for b in range(len(data))
             if a != b and usable[a] and usable[b] and near(np.array(data[a][1], float), np.array(data[b][1], float))}
    label = {i: i for i, _ in data}
    for _ in range(30):
        for a, b in pairs:
            label[data[a][0]] = label[data[b][0]] = min(label[data[a][0]], label[data[b][0]])
    want = sorted((i, sum(a == k for a, _ in pairs), label[i], label[i] == i) for k, (i, _) in enumerate(data))
    assert asserted(got, ["vec_id", "n_links", "component_id", "kept"]) == want


def test_vectors_are_not_copied_for_each_block(spark, scratch, monkeypatch):
    """Without any structure each of 300 vectors was dealt to 15 blocks; now one row of each is all that is written."""
    monkeypatch.setattr(vectors, "CELL", 100)
    monkeypatch.setattr(vectors, "BLOCK", 20)
    monkeypatch.setattr(vectors, "CHUNK_BYTES", 16 * 8 * 40)
    monkeypatch.setattr(vectors, "_FOLD", 3)
    rng = np.random.default_rng(3)
    data = rng.normal(size=(300, 16))
    data[150:170] = data[:20] + rng.normal(size=(20, 16)) * 0.01
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, vec array<double>")
    distinct = vectors.classes(table)
    cells = vectors.make_cells(distinct, np.sqrt(0.1))
    assert cells.chunks >= 5
    assert vectors._placed(distinct, cells).count() == 300
    got = asserted(vectors.links(table, scratch, 0.95), ["vec_id", "n_links", "component_id", "kept"])
    pair = {**{i: i + 150 for i in range(20)}, **{i + 150: i for i in range(20)}}
    assert got == [(i, int(i in pair), min(i, pair.get(i, i)), i <= pair.get(i, i)) for i in range(300)]


def test_vectors_empty(spark, scratch):
    assert vectors.links(spark.createDataFrame([], "vec_id long, vec array<float>"), scratch, 0.95).count() == 0


# --- archives (2) ------------------------------------------------------------------

def test_archive_round_trip(spark, scratch):
    import base64

    pages = [(1, "http://a.b/c d", "same"), (2, None, "same"), (3, "http://x", "same"), (3, "http://x", "same"),
             (4, "https://h/p?q", None), (5, "nonsense", ""), (6, "http://z", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\né" * 50),
             (None, "http://n", "same"), (None, "http://m", "alone"), (7, "http://a\r\nX: y", "q")]
    got = warc.archived(spark.createDataFrame(pages, "page_id long, url string, html string"), scratch)
    out = sorted((r.metadata.page or -1, r.response.size, r.response.found or r.response.digest, r.response.kind,
                  r.refers_to or -1) for r in got.collect())
    largest = {}
    for i, _, html in pages:
        largest[html or ""] = max(largest.get(html or "", -1), i or -1)
    want = sorted((i or -1, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
                   "response" if (i or -1) == largest[h or ""] else "revisit",
                   -1 if (i or -1) == largest[h or ""] else largest[h or ""]) for i, _, h in pages)
    assert out == want
    assert all(r.asked.id and r.metadata.id for r in got.collect())


def test_archive_keeps_payloads_and_files_are_warc(spark, scratch, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x\r\n\r\ny"), (2, "http://b", "z")], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "w"))
    read = warc.captures(warc.read(spark, str(tmp_path / "w")), scratch)
    assert {r.metadata.page: r.response.payload for r in read.collect()} == {1: "x\r\n\r\ny", 2: "z"}
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("part-*"))
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and raw.count(b"WARC-Type: ") == 6


def test_archive_of_no_pages(spark, scratch):
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string"), scratch).count() == 0


# --- encoding (9) ------------------------------------------------------------------

def test_encoding_equals_the_library(docs, rows, scratch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = bpe.encoded(docs, path, ["doc_id", "component_id"],
                      {"n_tokens": "long", "ids": "array<int>", "decoded": "string"}, bpe.as_list, bits=4)
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t, *_ in rows}
    out = got.collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.ids == want[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)


@pytest.mark.parametrize("bits", [1, 2, 4])
def test_joins_are_exact_for_any_cut(bits):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, coder = Tokenizer.from_file(path), bpe.Coder(bpe.Vocabulary(path), {}, bits)
    rng = random.Random(bits)
    parts = [" ", "  ", "\n", "\t", " a", "the", "ing", " Éa", "ß", "'s", "12", "!!!", "<|endoftext|>", "世界", "　", " "]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 80)))
        assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_shared_chunks_are_encoded_once(spark):
    import public_tokenizers

    text = " ".join(passages(4, 20))
    docs = spark.createDataFrame([(i, text + f" tail{i}") for i in range(6)], "doc_id long, text string")
    known = bpe.dictionary(docs, bpe.shipped(spark, public_tokenizers.path("byte_bpe_50k.json")), bits=6)
    assert known and bpe.shared_chunks(docs, bits=6).count() == len(known)
    assert bpe.dictionary(docs.limit(0), "byte_bpe_50k.json", bits=6) == {}


# --- mixing (7) --------------------------------------------------------------------

def shares(budget, weights, capacity):
    """Proportional filling one node at a time."""
    out, left = {}, dict(weights)
    while left:
        level = budget / sum(left.values())
        full = [k for k in left if capacity[k] <= level * left[k]]
        if not full:
            return out | {k: level * w for k, w in left.items()}
        for k in full:
            out[k] = capacity[k]
            budget -= capacity[k]
            del left[k]
    return out


def test_budgets_fill_siblings_before_ancestors(spark):
    leaves = {("x", "a"): 10, ("x", "b"): 500, ("y", "c"): 40, ("y", "d"): 30, ("z", "e"): 900}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "top string, leaf string, tokens long")
    got = mixing.leaf_budgets(df, ["top", "leaf"], {"top": {"x": 2.0, "z": 1.0}, "leaf": {"b": 1.0, "a": 3.0}}, 0.6, 2)
    budget = float(int(0.6 * sum(leaves.values())))
    top = shares(budget, {"x": 2.0, "y": 1.0, "z": 1.0}, {t: 2 * sum(v for k, v in leaves.items() if k[0] == t) for t in "xyz"})
    want = {}
    for t in "xyz":
        weights = {k[1]: {"a": 3.0}.get(k[1], 1.0) for k in leaves if k[0] == t}
        want |= shares(top[t], weights, {k[1]: 2 * v for k, v in leaves.items() if k[0] == t})
    assert {r.leaf: r.budget for r in got.collect()} == {k: int(v) for k, v in want.items()}


def test_mixing_takes_whole_epochs_and_a_prefix(docs, rows, scratch):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    weights = {"lang": {"en": 1.0, "de": 4.0}}
    got = mixing.mixed(docs, levels, weights, 0.8, 3, 9, scratch)
    again = mixing.mixed(docs.repartition(7), levels, weights, 0.8, 3, 9, scratch)
    assert got.columns == docs.columns
    key = lambda df: sorted((r.doc_id, r.text or "", r.source or "") for r in df.collect())
    assert key(got) == key(again)
    tokens = lambda t: len(WORD.findall(t or ""))
    total, longest = sum(tokens(r[1]) for r in rows), max(tokens(r[1]) for r in rows)
    taken = sum(tokens(r.text) for r in got.collect())
    assert 0.8 * total - 10 <= taken <= 0.8 * total + 7 * 2 * longest


def test_mixing_nothing(nothing, scratch):
    assert mixing.mixed(nothing, {"lang": F.col("lang")}, {}, 0.5, 2, 1, scratch).count() == 0


# --- quality (4) -------------------------------------------------------------------

def test_quality_counts_equal_brute_force(docs, rows):
    got = asserted(quality.measured(docs, ["doc_id"]), ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                         "n_repeat_words", "base_failed"])
    want = []
    for i, text, *_ in rows:
        text = text or ""
        w = WORD.findall(text)
        grams = [tuple(w[k: k + 3]) for k in range(len(w) - 2)]
        covered = {j for k, g in enumerate(grams) if grams.count(g) > 1 for j in (k, k + 1, k + 2)} if len(w) < 3000 else \
            _fast_repeats(grams)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                     len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    assert got == sorted(want)


def _fast_repeats(grams):
    from collections import Counter

    n = Counter(grams)
    return {j for k, g in enumerate(grams) if n[g] > 1 for j in (k, k + 1, k + 2)}


def test_quality_cutoffs_follow_the_group(spark, scratch):
    rng = random.Random(1)
    text = lambda marks: " ".join(f"word{rng.randint(0, 9999)}" for _ in range(80)) + " #" * marks
    rows = [(i, text(40), "en", "marked") for i in range(250)] + [(1000 + i, text(0), "en", "plain") for i in range(250)]
    rows += [(5000, text(40), "en", "plain"), (5001, text(40), "en", "marked"), (5002, text(0), None, None)]
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), scratch)
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert not kept[5000] and kept[5001] and kept[5002]
    assert sum(kept.values()) == len(rows) - 1


def test_quality_of_nothing(nothing, docs, rows, scratch):
    assert quality.judged(nothing, scratch).count() == 0
    assert quality.judged(docs, scratch).count() == len(rows)


# --- models (1, 8) -----------------------------------------------------------------

def test_languages_held_out(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = langid.train(docs.where(~held & F.col("text").isNotNull() & F.col("lang").isNotNull()))
    assert set(model.languages) == {"germanic", "romance"}
    got = langid.predicted(docs.where(held), model, ["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95 and all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_texts(docs, rows, nothing):
    model = langid.train(docs.where("text IS NOT NULL AND lang IS NOT NULL"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predicted(docs, model, ["doc_id"]).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0) and got[108][0] in ("en", "de")
    assert langid.predicted(nothing, model, ["doc_id"]).count() == 0
    nobody = langid.train(nothing)
    assert nobody is None and {r.lang_pred for r in langid.predicted(docs, nobody, ["doc_id"]).collect()} == {"und"}


def test_toxicity_of_planted_words(spark, scratch):
    rng = random.Random(2)
    plain = [f"{a}{b}{c}" for a in "bdgk" for b in "aeiou" for c in "lmnrst"]
    bad = ["grunkle", "vorpstein", "zaxwort"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 200))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(["", "s", "ing"])
        rows.append((i, " ".join(words), "clash"))
        labels.append((i, int(toxic)))
    rows += [(900, None, ""), (901, "", ""), (None, "grunkle zaxwort", "")]
    labels += [(None, 1), (5000, 1), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    train = F.col("doc_id") % 4 != 1
    got = toxicity.toxicity(docs, docs.where(train), known.where(train), scratch, ["doc_id"]).collect()
    wrong = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 1
             and (r.score >= 0.5) != (r.doc_id % 5 == 0)]
    assert len(wrong) <= 3 and all(0 <= r.score <= 1 for r in got) and len(got) == len(rows)
    one_class = toxicity.toxicity(docs, docs, known.where("toxic = 0"), scratch, ["doc_id"])
    assert {r.score for r in one_class.collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), docs, known.limit(0), scratch).count() == 0


def test_toxicity_keeps_every_gram(spark, scratch, monkeypatch):
    """A model of more grams than tasks hold gives the features of the whole model, words seen once included."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["common", "words", "Ärger", f"rare{i}x{k}"]) for k in range(rng.randint(1, 40))),
             i % 2) for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    more = [(100, None), (101, " "), (None, "unseen rare3x1 rare3x1"), (7, rows[7][1]), (7, rows[8][1]), (102, "z" * 9000)]
    docs = train.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))

    def of(limit):
        got = toxicity.features(docs, toxicity.train(train, scratch, limit), ["doc_id", "text"]).collect()
        return sorted(((r.doc_id is None, r.doc_id, r.text or ""), r[2:]) for r in got)

    whole = of(1 << 21)
    assert len(whole) == len(rows) + len(more) and len({v for _, v in whole}) > 50
    for front in (1 << 20, 3, 0):
        monkeypatch.setattr(toxicity, "FRONT_WORDS", front, raising=False)
        got = of(40)
        assert [k for k, _ in got] == [k for k, _ in whole]
        assert np.allclose([v for _, v in got], [v for _, v in whole], atol=1e-9)


def test_toxicity_counts_every_training_row(spark, scratch, monkeypatch):
    """The model that scores documents counts the fifth that fits the weights as well."""
    fold = {i: zlib.crc32(f"fold{i}".encode()) % 5 for i in range(40)}
    rows = [(i, f"calm w{i % 7} " + ("zaxwort" if fold[i] == 4 else "grunkle") * (i % 2)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    used = []
    features = toxicity.features
    monkeypatch.setattr(toxicity, "features", lambda df, model, keep: used.append(model) or features(df, model, keep))
    assert toxicity.toxicity(docs, docs, known, scratch).count() == 40
    gram = int.from_bytes(b"zaxwor", "big")
    assert {fold[i] for i in range(1, 40, 2)} > {4}
    assert gram not in used[0].grams and gram in used[-1].grams
