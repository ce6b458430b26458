"""Toxicity from two class-conditional Kneser-Ney models of the bytes of words.

The order-6 counts are kept per class; every lower order is one Kneser-Ney
continuation table of both classes together, so an expression that neither
class has seen gets the same backed-off probability from both and says nothing.
All counts are grouped sums over every training row.  A word's score depends on
its bytes alone, so each batch scores its distinct words once.  Where the counts
have more keys than a task should hold, they stay a table: the distinct words of
the corpus are scored by a join with it, tasks hold the scores of the most
frequent words, and the others are joined to the documents that have them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.llm import bytewords as bw
from fieldatlas.llm.frames import arrow_map
from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

ORDER = 6
DISCOUNT = 0.75
MAX_GRAMS = 1 << 21       # a model of more grams or contexts is joined as a table and not held by tasks
FRONT_WORDS = 1 << 20     # scores of frequent words that tasks hold beside such a table
CALIBRATION_ROWS = 50_000  # labelled rows that fit the four weights of the final score
_SPACE = 0x20
_FEATURES = ("mean_llr", "max_word_llr", "max_word_sum", "log_words")


@dataclass
class Model:
    """Sorted keys with the log ratio of each gram, and of the back-off weight of each context."""

    grams: np.ndarray
    gram_llr: np.ndarray
    contexts: np.ndarray
    context_llr: np.ndarray
    sent: list[Broadcast] = field(default_factory=list)


@dataclass
class Table:
    """The same as rows ``h, llr, next``: a context, its back-off's log ratio, and that of each byte seen after it."""

    contexts: DataFrame
    scratch: Scratch
    sent: list[Broadcast] = field(default_factory=list)


# --- grams of words ----------------------------------------------------------

def _word_grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed order-6 grams of the given words, one per byte and one for the end, with the word's number."""
    length = end - start
    pad = ORDER - 1
    size = length + pad + 1
    at = np.concatenate([[0], np.cumsum(size)])
    line = np.full(int(at[-1]), _SPACE, np.uint8)
    line[bw.ranges(at[:-1] + pad, length)] = data[bw.ranges(start, length)]
    packed = np.zeros(max(len(line) - pad, 0), np.int64)
    for k in range(ORDER):
        packed = (packed << 8) | line[k: len(line) - pad + k]
    index = bw.ranges(at[:-1], length + 1)
    return packed[index], np.repeat(np.arange(len(start)), length + 1)


def _distinct(batch: pa.RecordBatch) -> tuple[np.ndarray, bw.Words, np.ndarray, np.ndarray]:
    data, places = bw.flat(pc.utf8_lower(batch.column("text").cast(pa.large_string())))
    found = bw.words(data, places)
    _, index, inverse = np.unique(found.code, return_index=True, return_inverse=True)
    return data, found, index, inverse


def _count_step(batch: pa.RecordBatch) -> Iterator[dict]:
    for part in bw.pieces(batch, "text"):
        data, found, index, inverse = _distinct(part)
        toxic = np.asarray(part.column("toxic").to_numpy(zero_copy_only=False), np.int64)
        of = np.repeat(toxic, np.diff(found.first))
        per_word = np.stack([np.bincount(inverse[of == c], minlength=len(index)) for c in (0, 1)])
        grams, word = _word_grams(data, found.start[index], found.end[index])
        keys, place = np.unique(grams, return_inverse=True)
        sums = [np.bincount(place, weights=per_word[c][word], minlength=len(keys)) for c in (0, 1)]
        yield {"gram": keys, "ordinary": sums[0].astype(np.int64), "toxic": sums[1].astype(np.int64)}


def gram_counts(labelled: DataFrame) -> DataFrame:
    """Counts of every order-6 gram by class: rows ``gram, ordinary, toxic``."""
    parts = arrow_map(labelled.select("text", "toxic"), "gram long, ordinary long, toxic long", _count_step)
    return parts.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


# --- Kneser-Ney --------------------------------------------------------------

def _lower_orders(grams: DataFrame, scratch: Scratch) -> DataFrame:
    """``gram, p``: shared continuation probability of every order-5 gram.  Every order is a table, so no plan nests."""
    levels = []
    keys = grams.select("gram")
    for order in range(ORDER - 1, 0, -1):
        tail = F.col("gram").bitwiseAND(F.lit((1 << (8 * order)) - 1))
        counts = scratch.save(keys.groupBy(tail.alias("gram")).agg(F.count(F.lit(1)).alias("n")))
        levels.append((order, counts))
        keys = counts.select("gram")
    lower = None
    for order, counts in reversed(levels):
        context = F.shiftright("gram", 8)
        totals = counts.groupBy(context.alias("h")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        rows = counts.withColumn("h", context).join(totals, "h")
        below = F.lit(1.0 / 256)
        if lower is not None:
            tail = F.col("gram").bitwiseAND(F.lit((1 << (8 * (order - 1))) - 1))
            rows = rows.withColumn("tail", tail).join(lower.withColumnsRenamed({"gram": "tail", "p": "q"}), "tail")
            below = F.col("q")
        previous, lower = lower, scratch.save(rows.select(
            "gram", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * below) / F.col("total")).alias("p")))
        for part in (previous, counts):
            scratch.drop(part)
    return lower


def _class_sums(grams: DataFrame) -> DataFrame:
    """Totals and kinds of each order-5 context in each class."""
    seen = [F.sum(name).alias(f"total_{name}") for name in ("ordinary", "toxic")]
    kinds = [F.count(F.when(F.col(name) > 0, 1)).alias(f"kinds_{name}") for name in ("ordinary", "toxic")]
    return grams.groupBy(F.shiftright("gram", 8).alias("h")).agg(*seen, *kinds)


def _backoff(name: str):
    total = F.col(f"total_{name}")
    return F.when(total > 0, DISCOUNT * F.col(f"kinds_{name}") / total).otherwise(1.0)


def log_ratios(grams: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Log ratio toxic to ordinary of each seen gram, and of the back-off weight of each seen context."""
    sums = scratch.save(_class_sums(grams))
    lower = _lower_orders(grams, scratch)
    tail = F.col("gram").bitwiseAND(F.lit((1 << (8 * (ORDER - 1))) - 1))
    rows = (grams.withColumn("h", F.shiftright("gram", 8)).withColumn("tail", tail).join(sums, "h")
            .join(lower.withColumnsRenamed({"gram": "tail"}), "tail"))

    def probability(name: str):
        total = F.col(f"total_{name}")
        seen = F.greatest(F.col(name) - DISCOUNT, F.lit(0.0)) / total
        return F.when(total > 0, seen + _backoff(name) * F.col("p")).otherwise(F.col("p"))

    per_gram = rows.select(F.col("gram").alias("key"),
                           F.log(probability("toxic") / probability("ordinary")).cast("float").alias("llr"))
    per_context = sums.select(F.col("h").alias("key"),
                              F.log(_backoff("toxic") / _backoff("ordinary")).cast("float").alias("llr"))
    saved = scratch.save(per_gram), scratch.save(per_context)
    for part in (sums, lower):
        scratch.drop(part)
    return saved


def _held(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = table.toArrow()
    key = rows.column("key").to_numpy()
    order = np.argsort(key)
    return key[order], rows.column("llr").to_numpy()[order]


def _by_context(per_gram: DataFrame, per_context: DataFrame) -> DataFrame:
    """Rows ``h, llr, next``; a context has at most 256 next bytes."""
    byte = F.col("key").bitwiseAND(F.lit(255)).cast("int")
    after = per_gram.groupBy(F.shiftright("key", 8).alias("h")) \
        .agg(F.map_from_entries(F.collect_list(F.struct(byte, "llr"))).alias("next"))
    return per_context.withColumnRenamed("key", "h").join(after, "h")


def train(labelled: DataFrame, scratch: Scratch, max_grams: int = MAX_GRAMS) -> Model | Table | None:
    """Fit both models on all rows ``text, toxic`` (0 or 1); None unless both classes have rows."""
    grams = scratch.save(gram_counts(labelled))
    model = fitted(grams, scratch, max_grams)
    scratch.drop(grams)
    return model


def fitted(grams: DataFrame, scratch: Scratch, max_grams: int = MAX_GRAMS) -> Model | Table | None:
    """The models of given counts; None unless both classes have some.

    Every gram and context is kept; above ``max_grams`` of either they are a table.
    """
    totals = grams.agg(F.sum("ordinary"), F.sum("toxic")).first()
    if not totals[0] or not totals[1]:
        return None
    per_gram, per_context = log_ratios(grams, scratch)
    if max(per_gram.count(), per_context.count()) > max_grams:
        model = Table(scratch.save(_by_context(per_gram, per_context)), scratch)
    else:
        model = Model(*_held(per_gram), *_held(per_context))
    for part in (per_gram, per_context):
        scratch.drop(part)
    return model


# --- scoring -----------------------------------------------------------------

def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return np.where(hit, values[at], 0.0), hit


def word_scores(model: Model, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each word, summed over its bytes."""
    grams, word = _word_grams(data, start, end)
    llr, hit = _find(model.grams, model.gram_llr, grams)
    rest = np.flatnonzero(~hit)
    llr[rest] = _find(model.contexts, model.context_llr, grams[rest] >> 8)[0]
    return np.bincount(word, weights=llr, minlength=len(start))


def _corpus_words(df: DataFrame) -> DataFrame:
    """``code, word, n``: every distinct word, and in how many places it stands."""
    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            data, found, index, inverse = _distinct(part)
            start, length = found.start[index], (found.end - found.start)[index]
            ends = np.r_[0, np.cumsum(length)].astype(np.int64)
            joined = data[bw.ranges(start, length)]
            yield {"code": found.code[index].view(np.int64), "n": np.bincount(inverse, minlength=len(index)),
                   "word": pa.LargeStringArray.from_buffers(len(index), pa.py_buffer(ends), pa.py_buffer(joined))}

    parts = arrow_map(df.select("text"), "code long, word string, n long", step)
    return parts.groupBy("code").agg(F.min("word").alias("word"), F.sum("n").alias("n"))


def _scored_words(words: DataFrame, table: Table) -> DataFrame:
    """``code, total, size, n``: the score of each word by a join of its grams with the whole model."""
    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "word"):
            data, places = bw.flat(part.column("word"))
            grams, word = _word_grams(data, places[:-1], places[1:])
            yield {"code": part.column("code").to_numpy()[word], "h": grams >> 8, "byte": grams & 255}

    grams = arrow_map(words.select("code", "word"), "code long, h long, byte int", step)
    llr = F.coalesce(F.col("next")[F.col("byte")], "llr", F.lit(0.0))
    totals = lookup(grams, table.contexts, "h", "left").groupBy("code").agg(
        F.sum(llr.cast("double")).alias("total"), F.count(F.lit(1)).alias("size"))
    return totals.join(words.select("code", "n"), "code")


def _front(words: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes and scores of the words at or above the smallest number of places that leaves at most ``limit``; that number."""
    sizes = np.array([tuple(r) for r in words.groupBy(F.least("n", F.lit(1 << 16)).alias("n"))
                      .agg(F.count(F.lit(1)).alias("rows")).orderBy(F.col("n").desc()).collect()] or [(1, 0)])
    fits = np.cumsum(sizes[:, 1]) <= limit
    least = int(sizes[fits][-1, 0]) if fits.any() else 1 << 62
    front = words.where(F.col("n") >= least).select(F.col("code").alias("key"), F.col("total").alias("llr"))
    return *_held(front), least


def _sums(df: DataFrame, keep: list[str], score: Callable) -> DataFrame:
    """The kept columns, sums and maxima over each text's words with a score, and ``_open``: the codes of the others.

    ``score`` gives the total of each distinct word of a batch, and whether it has one.
    """
    given = df.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name in keep]
                       + ["_sum double, _ratio double, _most double, _bytes long, _n long, _open array<long>"])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in bw.pieces(batch, "text"):
            data, found, index, inverse = _distinct(part)
            total, known = score(data, found, index)
            size = (found.end - found.start)[index] + 1
            n = np.diff(found.first)
            has = n > 0
            heads = found.first[:-1][has]
            out = {name: np.full(part.num_rows, -np.inf) for name in ("_ratio", "_most")}
            out |= {"_sum": np.zeros(part.num_rows), "_bytes": np.zeros(part.num_rows, np.int64), "_n": n}
            missing = ~known[inverse]
            if len(heads):
                sums, sizes = total[inverse], size[inverse]
                out["_sum"][has] = np.add.reduceat(np.where(missing, 0.0, sums), heads)
                out["_bytes"][has] = np.add.reduceat(sizes, heads)
                out["_ratio"][has] = np.maximum.reduceat(np.where(missing, -np.inf, sums / sizes), heads)
                out["_most"][has] = np.maximum.reduceat(np.where(missing, -np.inf, sums), heads)
            ends = np.r_[0, np.cumsum(missing)][found.first].astype(np.int32)
            out["_open"] = pa.ListArray.from_arrays(ends, pa.array(found.code[missing].view(np.int64)))
            yield {name: part.column(name) for name in keep} | out

    return arrow_map(given, schema, step)


def _as_features(sums: DataFrame, keep: list[str]) -> DataFrame:
    some = F.col("_n") > 0
    values = (F.col("_sum") / F.col("_bytes"), F.col("_ratio"), F.col("_most"), F.log1p("_n"))
    return sums.select(*keep, *[F.when(some, value).otherwise(0.0).alias(f"_{name}")
                                for name, value in zip(_FEATURES, values, strict=True)])


def features(df: DataFrame, model: Model | Table, keep: list[str]) -> DataFrame:
    """Keep the named columns and add the four length-normalised features of each text."""
    context = df.sparkSession.sparkContext
    if isinstance(model, Model):
        held = context.broadcast(model)  # at most 2 * MAX_GRAMS keys
        model.sent.append(held)

        def score(data: np.ndarray, found: bw.Words, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return word_scores(held.value, data, found.start[index], found.end[index]), np.ones(len(index), bool)

        return _as_features(_sums(df, keep, score), keep)

    scratch = model.scratch
    words = scratch.save(_corpus_words(df))
    scored = scratch.save(_scored_words(words, model))
    scratch.drop(words)
    codes, totals, least = _front(scored, FRONT_WORDS)
    front = context.broadcast((codes, totals))  # at most FRONT_WORDS words
    model.sent.append(front)

    def known(data: np.ndarray, found: bw.Words, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _find(*front.value, found.code[index].view(np.int64))

    sums = _sums(df, keep, known)
    rest = scored.where(F.col("n") < least)
    if rest.isEmpty():
        return _as_features(sums, keep)
    sums = scratch.save(sums.withColumn("_row", F.monotonically_increasing_id()))
    opened = sums.select("_row", F.explode("_open").alias("code"))
    more = lookup(opened, rest.select("code", "total", "size"), "code").groupBy("_row").agg(
        F.sum("total").alias("_sum2"), F.max(F.col("total") / F.col("size")).alias("_ratio2"),
        F.max("total").alias("_most2"))
    both = lookup(sums.drop("_open"), more, "_row", "left")
    return _as_features(both.withColumns({
        "_sum": F.col("_sum") + F.coalesce("_sum2", F.lit(0.0)), "_ratio": F.greatest("_ratio", "_ratio2"),
        "_most": F.greatest("_most", "_most2")}), keep)


def calibrated(scored: DataFrame, labels: DataFrame, rows: int = CALIBRATION_ROWS) -> np.ndarray:
    """Logistic weights (last: constant) for the features, from at most about ``rows`` labelled rows."""
    names = [f"_{name}" for name in _FEATURES]
    joined = scored.select("doc_id", *names).join(labels.select("doc_id", "toxic"), "doc_id")
    count = labels.count()
    if count > rows:
        share = int(rows / count * (1 << 30))
        joined = joined.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    got = joined.select(*names, "toxic").toArrow()
    x = np.stack([got.column(name).to_numpy() for name in names] + [np.ones(got.num_rows)], 1) \
        if got.num_rows else np.zeros((0, len(names) + 1))
    y = got.column("toxic").to_numpy().astype(float) if got.num_rows else np.zeros(0)
    return fit_logistic(x, y)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps on standardised columns; the last column is constant."""
    if not len(y):
        return np.array([1.0] + [0.0] * (x.shape[1] - 1))
    mean, spread = x[:, :-1].mean(0), x[:, :-1].std(0) + 1e-9
    z = np.hstack([(x[:, :-1] - mean) / spread, x[:, -1:]])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    flat = w[:-1] / spread
    return np.append(flat, w[-1] - flat @ mean)


def with_score(scored: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    line = F.lit(float(weights[-1]))
    for weight, feature in zip(weights, _FEATURES, strict=False):
        line = line + F.lit(float(weight)) * F.col(f"_{feature}")
    return scored.withColumn(name, 1.0 / (1.0 + F.exp(-line))).drop(*[f"_{f}" for f in _FEATURES])


def toxicity(documents: DataFrame, labelled: DataFrame, labels: DataFrame, scratch: Scratch,
             keep: list[str] | None = None, score: str = "score") -> DataFrame:
    """The kept columns of every document and a toxicity score between 0 and 1.

    ``labelled`` holds the training documents, ``labels`` has ``doc_id, toxic``
    for training rows only.  Counts of four fifths of them score the last fifth, which gives
    the final weights; the counts behind the scores of the documents are those of all.
    Null and empty texts have no words and get the score of a text without any;
    repeated rows are scored each; rows with a null label are not used.  If one
    class has no training row, every score is 1 where all labels are 1, else 0.
    """
    keep = keep or ["doc_id"]
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()) \
                  .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = scratch.save(known)
    fold = F.pmod(F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string"))), F.lit(5))
    texts = labelled.where(F.col("doc_id").isNotNull()).select("doc_id", "text", (fold == 4).alias("last"))
    rows = texts.join(known.hint("shuffle_hash"), "doc_id")
    most, last = [scratch.save(gram_counts(rows.where(part))) for part in (~F.col("last"), F.col("last"))]
    grams = scratch.save(most.unionAll(last).groupBy("gram").agg(
        F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")))
    totals = grams.agg(F.sum("ordinary"), F.sum("toxic")).first()
    if not totals[0] or not totals[1]:
        least = known.agg(F.min("toxic")).first()[0]
        return documents.select(*keep, F.lit(1.0 if least == 1 else 0.0).alias(score))
    weights = fit_logistic(np.zeros((0, len(_FEATURES) + 1)), np.zeros(0))
    partial = fitted(most, scratch)
    if partial is not None:
        held = labelled.where(F.col("doc_id").isNotNull() & (fold == 4)).select("doc_id", "text")
        weights = calibrated(features(held, partial, ["doc_id"]), known.where(fold == 4))
        for used in partial.sent:  # one model at a time
            used.destroy()
    model = fitted(grams, scratch)
    for part in (most, last, grams):
        scratch.drop(part)
    return with_score(features(documents, model, keep), weights, score)
