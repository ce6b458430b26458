"""The corpus operators as queries over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.llm import (bpe, divergence, langid, mixing, quality, recipes, repair, setjoin, suffixes, toxicity, vectors,
                            warc, windows)
from fieldatlas.llm.frames import table
from fieldatlas.session import Scratch


def remainder(of: int) -> Column:
    """crc32 of the document id as text, modulo ``of``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = langid.train(documents.where((remainder(4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    return langid.predicted(documents, model, ["doc_id"]).select(
        "doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archived(table(spark, folder, "pages"), Scratch(spark), least=0)
    return found.select(F.col("metadata.page").alias("page_id"), F.col("response.size").alias("payload_bytes"),
                        F.coalesce("response.found", "response.digest").alias("payload_digest"),
                        F.col("response.kind").alias("record_type"), "refers_to")


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, folder, "documents"), Scratch(spark))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"), Scratch(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    scored = toxicity.toxicity(documents, documents.where(remainder(5) != 0), labels.where(remainder(5) != 0),
                               Scratch(spark))
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return windows.deduplicated(table(spark, folder, "documents"), Scratch(spark))[0]


def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return vectors.links(given, Scratch(spark), least=0.95)


def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return setjoin.components(table(spark, folder, "documents"), Scratch(spark), size=3, percent=90)


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT *, (SELECT string_agg('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((v >> s) & 31)], '' ORDER BY k, s DESC)
        FROM (SELECT k, ('0x' || h[5 * k + 1:5 * k + 5])::INT AS v, unnest([15, 10, 5, 0]) AS s
              FROM (SELECT unnest(range(8)) AS k))) AS payload_digest FROM d),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS largest FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END
  AS record_type, CASE WHEN page_id < largest THEN largest END AS refers_to FROM m"""


OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, h[2 * i + 1:2 * i + 200] AS s FROM (
        SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS turn FROM w),
c AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r WHERE turn > 1),
runs AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 100 THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY ALL),
gaps AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM spans),
per AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n_spans, max(b) AS tail,
          string_agg(h[2 * p + 1:2 * a], '' ORDER BY a) AS body FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(body, '') || h[2 * coalesce(tail, 0) + 1:])) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id)"""


def _sql_cutoffs(name: str, by: str) -> str:
    """Cutoffs of the groups ``by``, from the bucket counts of all documents."""
    quantile = ", ".join(f"CASE WHEN min(bucket) FILTER (upto >= {q} * total) = {quality._ZERO} THEN 0 ELSE "
                         f"2 * pow({quality.GAMMA}, min(bucket) FILTER (upto >= {q} * total)) / {quality.GAMMA + 1} "
                         f"END AS q{int(q * 100)}" for q in (0.1, 0.5, 0.9))
    limits = []
    for measure, (extra, both) in quality.MEASURES.items():
        limits.append(f"max(q50 + {quality.REACH} * (q90 - q50) + {extra}) FILTER (measure = '{measure}') AS high_{measure}")
        if both:
            limits.append(f"max(q50 - {quality.REACH} * (q50 - q10) - {extra}) FILTER (measure = '{measure}') "
                          f"AS low_{measure}")
    return f"""
{name} AS (SELECT {by}, {", ".join(limits)} FROM (
  SELECT {by}, measure, max(total) AS rows, {quantile} FROM (
    SELECT *, sum(n) OVER (PARTITION BY {by}, measure ORDER BY bucket) AS upto,
           sum(n) OVER (PARTITION BY {by}, measure) AS total
    FROM (SELECT {by}, measure, bucket, count(*) AS n FROM buckets GROUP BY ALL))
  GROUP BY {by}, measure) WHERE rows >= {quality.LEAST_ROWS} GROUP BY {by})"""


def _sql_fits() -> str:
    def limit(column: str) -> str:
        return f"coalesce(g1.{column}, g2.{column}, g3.{column})"

    return " AND ".join([f"coalesce({m} <= {limit('high_' + m)}, true)" for m in quality.MEASURES]
                        + [f"coalesce({m} >= {limit('low_' + m)}, true)"
                           for m, (_, both) in quality.MEASURES.items() if both])


OP4_SQL = f"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM t),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, s FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT i) AS n FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM win JOIN twice USING (doc_id, s)) GROUP BY doc_id),
lines AS (SELECT doc_id, count(line) AS n, count(line) - count(DISTINCT line) AS dup
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT t.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        coalesce(lines.n, 0) AS n_lines
      FROM t JOIN w USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
r AS (SELECT *, n_symbols / greatest(word_chars, 1) AS symbol_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
        n_repeat_words / greatest(n_words, 1) AS repeat_share, word_chars / greatest(n_words, 1) AS mean_word,
        n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
buckets AS (SELECT lang, source, 1 AS every, measure,
              CASE WHEN value > 0 THEN ceil(ln(value) / ln({quality.GAMMA}))::INT ELSE {quality._ZERO} END AS bucket
            FROM (SELECT lang, source, unnest({list(quality.MEASURES)}) AS measure,
                         unnest([{", ".join(quality.MEASURES)}]) AS value FROM r WHERE NOT base_failed)),
{_sql_cutoffs("g1", "lang, source")}, {_sql_cutoffs("g2", "lang")}, {_sql_cutoffs("g3", "every")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_sql_fits()} AS kept
FROM r LEFT JOIN g1 ON r.lang IS NOT DISTINCT FROM g1.lang AND r.source IS NOT DISTINCT FROM g1.source
  LEFT JOIN g2 ON r.lang IS NOT DISTINCT FROM g2.lang LEFT JOIN g3 ON true"""

OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
firsts AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM win JOIN firsts USING (s) WHERE doc_id > first),
gone_of AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS s FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN gone_of USING (doc_id) LEFT JOIN kept USING (doc_id)"""

OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
          WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION
          SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT a AS vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(b) AS component_id, a = min(b) AS kept
FROM reach LEFT JOIN n ON n.vec_id = a GROUP BY a"""

OP6_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                                "'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
           FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * c >= 90 * (p.n + q.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION
          SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a)
SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a"""

def _digests(vocab: bpe.Vocabulary, ids: list[np.ndarray]) -> dict:
    return {"n_tokens": [len(i) for i in ids],
            "ids_sha256": [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
            "decoded_sha256": [hashlib.sha256(vocab.decode(i).encode("utf-8")).hexdigest() for i in ids]}


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoded(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"],
                       {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}, _digests)


# op7: four domains of sources, languages in them, sources in those
MIX_WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
               "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 3, 17
MIX_LEVELS = ("domain", "lang", "source")


def domain_of_source() -> Column:
    digit = F.conv(F.substring(F.md5(F.coalesce("source", F.lit(""))), 1, 1), 16, 10).cast("int")
    return F.concat(F.lit("domain"), (digit % 4).cast("string"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").withColumn("domain", domain_of_source())
    return mixing.selected(documents, MIX_LEVELS, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED,
                           Scratch(spark)).drop("_tag")


def _sql_weight(level: str) -> str:
    cases = " ".join(f"WHEN '{value}' THEN {float(weight)}" for value, weight in MIX_WEIGHTS.get(level, {}).items())
    return f"CASE {level} {cases} ELSE 1.0 END" if cases else "1.0"


def _sql_level(depth: int) -> str:
    """Budgets of one level of the tree from those of the level above."""
    path, parent = ", ".join(MIX_LEVELS[:depth]), ", ".join(MIX_LEVELS[:depth - 1])
    above = f"JOIN b{depth - 1} USING ({parent})" if parent else \
        f"CROSS JOIN (SELECT floor({MIX_SHARE} * sum(tokens))::DOUBLE AS budget FROM leaves)"
    group = f"PARTITION BY {parent}" if parent else ""
    return f"""
n{depth} AS (SELECT *, capacity / weight AS ratio FROM (
    SELECT {path}, sum(tokens) * {MIX_EPOCHS} AS capacity, {_sql_weight(MIX_LEVELS[depth - 1])}::DOUBLE AS weight
    FROM leaves GROUP BY {path}) {above}),
s{depth} AS (SELECT *, capacity * sum(weight) OVER later <= weight * (budget - coalesce(sum(capacity) OVER sooner, 0))
      AS short FROM n{depth} WINDOW
    later AS ({group} ORDER BY ratio, {path} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    sooner AS ({group} ORDER BY ratio, {path} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b{depth} AS (SELECT {path}, CASE WHEN short THEN capacity::DOUBLE ELSE weight * ((budget
      - coalesce(sum(CASE WHEN short THEN capacity END) OVER ({group}), 0))
      / sum(CASE WHEN NOT short THEN weight END) OVER ({group})) END AS budget FROM s{depth})"""


OP7_SQL = f"""
WITH d AS (SELECT doc_id, lang, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS n_tokens,
             'domain' || (('0x' || md5(coalesce(source, ''))[1])::INT % 4) AS domain FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
{",".join(_sql_level(depth) for depth in (1, 2, 3))},
plan AS (SELECT domain, lang, source, tokens, floor(budget)::BIGINT AS budget,
           CASE WHEN tokens > 0 THEN floor(budget)::BIGINT // tokens ELSE 0 END AS whole
         FROM leaves JOIN b3 USING (domain, lang, source)),
o AS (SELECT d.*, whole, budget - whole * tokens AS rest, md5('{MIX_SEED}:' || whole || ':' || doc_id) AS place
      FROM d JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN coalesce(sum(n_tokens) OVER (
    PARTITION BY domain, lang, source ORDER BY place, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest THEN 1 ELSE 0 END)::INT AS copies
FROM o"""


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.audited(table(spark, folder, "conversations"), Scratch(spark))


OP11_SQL = r"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i))),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
d0 AS (SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
         list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
         lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS fate FROM c, tab),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS time FROM d0 WHERE fate <> 0),
o AS (SELECT *, substr(role, 1, 1) AS r, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
        NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, time) > 1 AS again FROM d),
f AS (SELECT *, CASE WHEN blank OR again THEN 'b' WHEN cut THEN 't' ELSE '' END AS fault,
        lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
facts AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n,
            count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
            count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before || r NOT IN ('su', 'ua', 'au')) AS illegal
          FROM f GROUP BY conv_id),
ins(a, b, price, w) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'),
  (1, 2, 5, 'I'), (1, 3, 10, 'II'), (2, 3, 5, 'I'), (3, 2, 5, 'I')),
read(a, sym, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
edit AS (SELECT 'D' AS letter, a, NULL AS sym, b, 2 AS price FROM ins WHERE w = ''
         UNION ALL SELECT 'K', a, sym, b, 0 FROM read UNION ALL SELECT 'R', a, NULL, b, 1 FROM read WHERE sym <> 's'),
parse AS (
  SELECT conv_id, 0 AS i, b AS state, {'cost': price, 'audit': w} AS best FROM facts, ins WHERE a = 0
  UNION ALL
  SELECT p.conv_id, p.i + 1, n.b, min({'cost': p.best.cost + e.price + n.price
           + CASE WHEN fault = 't' AND letter <> 'D' THEN 5 ELSE 0 END, 'audit': p.best.audit || letter || n.w})
  FROM parse p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
  JOIN edit e ON e.a = p.state AND (letter = 'D' OR fault <> 'b') AND (letter <> 'K' OR sym = r)
  JOIN ins n ON n.a = e.b GROUP BY p.conv_id, p.i, n.b),
done AS (SELECT p.conv_id, min(best) AS best FROM parse p JOIN facts x ON x.conv_id IS NOT DISTINCT FROM p.conv_id AND x.n = p.i
         WHERE state IN (0, 3) GROUP BY p.conv_id),
letters AS (SELECT conv_id, unnest(string_split(best.audit, '')) AS letter, unnest(range(length(best.audit))) AS spot FROM done),
edits AS (SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY spot) AS i FROM letters),
kept AS (SELECT w.conv_id, spot, letter, role, text, row_number() OVER one AS place,
           first_value(letter = 'K' AND r = 's') OVER one AS system
         FROM edits w LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i AND letter <> 'I'
         WHERE letter <> 'D' WINDOW one AS (PARTITION BY w.conv_id ORDER BY spot)),
fixed AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place + system::INT) % 2 = 1 THEN 'user'
            ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY spot) AS body FROM kept GROUP BY conv_id)
SELECT q.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM q.conv_id"""


def op12_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"), Scratch(spark))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT i, lang, source, unnest(w) AS term FROM d),
terms AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT i) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
dense AS (SELECT g.lang, g.source, term, lang_n, coalesce(n, 0) AS n
          FROM g JOIN terms USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER own + 2 * count(*) OVER own) AS p,
        1 + 1000000000::HUGEINT * (lang_n + 2) // (sum(lang_n) OVER own + 2 * count(*) OVER own) AS q
      FROM dense WINDOW own AS (PARTITION BY lang, source)),
pair AS (SELECT x.lang, x.source, y.source AS item, coalesce(v, 0) AS value FROM g x JOIN g y USING (lang)
         LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS v
                    FROM s a JOIN s b USING (lang, term) GROUP BY ALL) f
           ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
         WHERE x.source <> y.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM s WHERE n > 0 AND p > q),
parts AS (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term', * FROM term)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 10"""


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.deduplicated(table(spark, folder, "documents"), Scratch(spark))


OP13_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)"""


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_warc": op2_warc,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_exact_dedup": op13_exact_dedup,
}
SQL = {
    "op2_warc": OP2_SQL,
    "op3_suffix_dedup": OP3_SQL,
    "op4_quality_rules": OP4_SQL,
    "op5_embedding_dedup": OP5_SQL,
    "op6_ngram_jaccard_join": OP6_SQL,
    "op7_mixing": OP7_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_divergence_audit": OP12_SQL,
    "op13_exact_dedup": OP13_SQL,
}
