"""Chunk recipes, the divergence audit and conversation repair against brute force on small odd tables."""

import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fieldatlas.llm import divergence, recipes, repair

SCHEMA = "doc_id long, text string, lang string, source string, recipe string, text_key0 string, term string, n long"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def documents():
    rng = random.Random(3)
    base = " ".join(rng.choice(["Ab", "éÉ", "cde", "xyz, Q", "fünf.", "ÀB"]) + str(rng.randint(0, 9)) for _ in range(4000))
    texts = [None, "", base, base.upper().lower(), base + "!", base.replace("cde", "CDE"), "Éa", "éa", "ÉA", "x" * 20000,
             "X" * 20000, "x" * 20001, "AaAa" * 3000, "漢字、" * 5000, "漢字、" * 5000 + "a", " ", "\n", "b\x00c", "B\x00C"]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s", "t", None]), "r", "k", "t", 1) for i, t in enumerate(texts)]
    rows += [(50, base, "en", "s", None, None, None, None), (50, base, "en", "s", None, None, None, None),
             (50, "other", "en", "t", None, None, None, None), (None, base, "en", "s", None, None, None, None),
             (None, "lonely", None, None, None, None, None, None)]
    return rows


# --- recipes -------------------------------------------------------------------

@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


def expected_groups(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").translate(LOWER)].append(row[0])
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("coders", [
    recipes.CODERS,
    # a code that cannot tell chunks apart is found out, and the next one is used
    (lambda chunk: F.length(chunk).cast("long"), lambda chunk: F.xxhash64(chunk))])
def test_recipes_equal_whole_texts(odd, scratch, coders):
    got = [tuple(r) for r in recipes.deduplicated(odd, scratch, coders).collect()]
    assert sorted(got, key=repr) == expected_groups(documents())


def test_no_coder_is_an_error(odd, scratch):
    with pytest.raises(ValueError):
        recipes.deduplicated(odd, scratch, [lambda chunk: F.lit(1).cast("long")])


def test_chunks_cover_texts_and_follow_content(spark):
    rng = random.Random(8)
    base = " ".join("".join(rng.choices("aeinorstbcdfghjklmpquvwxyz", [3] * 8 + [1] * 18, k=rng.randint(2, 9)))
                    for _ in range(9000))
    rows = spark.createDataFrame([(base,), ("inserted words " + base,)], "text string") \
        .select(recipes._chunks(recipes.lowered(F.col("text"))).alias("c")).collect()
    assert ["".join(r.c) for r in rows] == [base, "inserted words " + base]
    assert len(rows[0].c) > 9 and len(set(rows[0].c) & set(rows[1].c)) >= len(rows[0].c) - 2


def test_survivors_keep_one_row_of_each_text(odd, scratch):
    kept = recipes.survivors(odd, recipes.deduplicated(odd, scratch)).collect()
    assert kept[0].__fields__ == odd.columns
    texts = Counter((r.text or "").translate(LOWER) for r in kept)
    assert set(texts.values()) == {1} and len(texts) == len({(r[1] or "").translate(LOWER) for r in documents()})


def test_recipes_of_nothing(spark, scratch):
    none = spark.createDataFrame([], SCHEMA)
    assert recipes.deduplicated(none, scratch).collect() == []


# --- divergence ----------------------------------------------------------------

def brute_audit(rows, least, k):
    docs = [((r[2] or ""), (r[3] or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(LOWER)))
            for r in rows]
    by_lang = defaultdict(Counter)
    for lang, _, terms in docs:
        by_lang[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in by_lang[lang].items() if n >= least) for lang, _, _ in docs}
    n = defaultdict(Counter)
    for lang, source, terms in docs:
        n[lang, source].update(t for t in terms if t in set(kept[lang]))
        n[lang, None].update(t for t in terms if t in set(kept[lang]))
    def p(group, term):
        total, v = sum(n[group].values()), len(kept[group[0]])
        return 1 + 10 ** 9 * (n[group][term] + 2) // (total + 2 * v)
    def f(a, b):
        return (a - b) ** 2 // (a + b)
    out = []
    groups = sorted({(lang, source) for lang, source, _ in docs})
    for lang, source in groups:
        pairs = [(-sum(f(p((lang, source), t), p((lang, other), t)) for t in kept[lang]), other)
                 for where, other in groups if where == lang and other != source]
        terms = [(-f(p((lang, source), t), p((lang, None), t)), t) for t in kept[lang]
                 if n[lang, source][t] and p((lang, source), t) > p((lang, None), t)]
        for part, found in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                            ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:k])):
            out += [(lang, source, part, item, -value, rank + 1) for rank, (value, item) in enumerate(found)]
    return sorted(out)


def audit_rows():
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("ab", "Éc", "zz", "ß", "ñ") for b in "abcdefghijklmnop"]
    rows = []
    for i in range(160):
        source = rng.choice(["s0", "s0", "s1", "s2", "", None])
        words = rng.choices(vocabulary, [1 + (j * (1 + len(source or ""))) % 7 for j in range(len(vocabulary))],
                            k=rng.randint(0, 60))
        rows.append((i, " ".join(words).title() if i % 5 else "-".join(words), rng.choice(["en", "de", None]), source,
                     None, None, "t", i))
    rows += rows[:3]
    rows += [(300, None, "en", "silent", None, None, None, None), (301, "rare words only", "xx", "s0", None, None, None, None),
             (302, "", "xx", "s1", None, None, None, None), (303, "ab" * 9000, "en", "s1", None, None, None, None)]
    return rows


@pytest.mark.parametrize(("least", "k"), [(10, 10), (3, 2), (1, 1)])
def test_audit_equals_brute_force(spark, scratch, least, k):
    rows = audit_rows()
    found = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(5), scratch, least, k).collect()
    assert sorted(tuple(r) for r in found) == brute_audit(rows, least, k)


def test_audit_of_nothing(spark, scratch):
    assert divergence.audit(spark.createDataFrame([], SCHEMA), scratch).collect() == []


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_keeps_exactly_what_few_dominate(k):
    rng = random.Random(k)
    rows = [(rng.randint(1, 12), rng.randint(12, 30), f"{rng.randint(0, 10 ** 6):06d}{i}".encode()) for i in range(400)]
    rows.sort(key=lambda r: (-r[0], r[1], r[2]))
    band = divergence.Skyband(k)
    kept = [r for r in rows if band.admits(r[1], r[2])]
    want = [r for r in rows if sum(o[0] >= r[0] and o[1] <= r[1] and o[2] < r[2] for o in rows) < k]
    assert kept == want and len(kept) < len(rows)


def test_counts_beyond_64_bits(spark):
    row = spark.sql("SELECT 300000000000L AS n, 1000000000000L AS total, 7L AS v").select(
        divergence.share(F.col("n"), F.col("total"), F.col("v")).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (300000000000 + 2) // (10 ** 12 + 14)


# --- conversations --------------------------------------------------------------

BLANK, END = re.compile(r"[^\x20\x09-\x0D]"), ".!?"


def brute_rows(rows):
    """Rows of each conversation after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        out[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    def order(row):
        tag = hashlib.sha256(f"{len(row[1])}:{row[1]}{row[2]}".encode()).digest()
        return (row[0] is not None, row[0] or 0, row[1], tag)
    return {conv: sorted(given, key=order) for conv, given in out.items()}


def best_edits(codes):
    """Least (cost, audit) over all edit strings, by plain recursion over rows and what was read last."""
    @functools.cache
    def rest(i, last, inserts):
        found = [(0, "")] if i == len(codes) and last in ("", "a") else []
        if inserts < 3:
            for symbol in "ua":
                if allowed(last, symbol):
                    cost, audit = rest(i, symbol, inserts + 1)
                    found.append((cost + 5, "I" + audit))
        if i < len(codes):
            initial, fault = codes[i]
            cost, audit = rest(i + 1, last, 0)
            found.append((cost + 2, "D" + audit))
            if fault != "b":
                for letter, symbol, price in (("K", initial, 0), ("R", "u", 1), ("R", "a", 1)):
                    if allowed(last, symbol):
                        cost, audit = rest(i + 1, symbol, 0)
                        found.append((cost + price + 5 * (fault == "t"), letter + audit))
        return min(found, default=(10 ** 9, ""))
    def allowed(last, symbol):
        return last + symbol in ("s", "u", "su", "ua", "au")
    return rest(0, "", 0)


def brute_repair(rows):
    after, out = brute_rows(rows), []
    for conv in {r[0] for r in rows}:
        given = after.get(conv, [])
        seen, codes = set(), []
        counts = Counter()
        for _, role, text in given:
            body = BLANK.findall(text)
            kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in END else ""
            seen.add((role, text))
            counts[kind] += 1
            codes.append((role[:1] or "-", {"blank": "b", "duplicate": "b", "truncated": "t", "": ""}[kind]))
        turns = [t for t, _, _ in given if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(codes, codes[1:], strict=False))
        cost, audit = best_edits(codes)
        lines, last, i = [], "", 0
        for letter in audit:
            role, text = (None, "") if letter == "I" else given[i][1:]
            i += letter != "I"
            if letter == "D":
                continue
            role = role if letter == "K" else "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def talks(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        turn = rng.randint(0, 3)
        for _ in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            text = rng.choice(["Good.", "What?", "cut off", " \t", "", None, "End. \n", "Ça va!", "cut"])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, text))
            turn += rng.choice([0, 1, 1, 1, 2])
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (n, 0, "user", "x" * 100000 + ".")]
    return rows


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("parts", [None, 7])
def test_repair_equals_brute_force(spark, scratch, parts):
    rows = talks(2, 120)
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumn("tag", F.lit("x")).withColumn("audit", F.lit(1)).repartition(3)
    got = [tuple(r) for r in repair.audited(df, scratch, parts).collect()]
    assert sorted(got, key=repr) == brute_repair(rows)


def test_one_long_conversation_in_many_segments(spark, scratch):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"So {t}.", f"cut {t}", "Again."]))
            for t in range(600)]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    import sys
    sys.setrecursionlimit(20000)
    want = brute_repair(rows)
    for parts in (1, 12):
        assert [tuple(r) for r in repair.audited(df, scratch, parts).collect()] == want
    found = repair.facts(repair.damaged(df))
    assert found.repartitionByRange(12, "conv_id", "turn", "role", "tag").select(F.spark_partition_id()).distinct().count() > 6


def test_repair_of_nothing(spark, scratch):
    none = spark.createDataFrame([], CONVERSATIONS)
    assert repair.audited(none, scratch).collect() == []


def test_everything_dropped(spark, scratch):
    gone = [(c, t) for c in range(2000) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    rows = spark.createDataFrame([(c, t, "user", "Hi.") for c, t in gone], CONVERSATIONS)
    assert {tuple(r)[1:] for r in repair.audited(rows, scratch).collect()} == {
        (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
