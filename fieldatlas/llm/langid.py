"""Language of whole texts: first the family, then the language within it.

Features are shares of hashed byte pairs and triples of the lower-cased text.
Families, and the languages inside each, are told apart by one-versus-one linear
support vector machines; the winner of most duels is the answer.  A linear model
of shares is a mean over a text's grams, so prediction adds table entries and
holds nothing per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.llm import bytewords as bw
from fieldatlas.llm.frames import arrow_map

BINS = 4096
TRAIN_ROWS = 6000  # labelled texts that fit the machines, spread evenly over the languages
_PASSES = 30
UNKNOWN = "und"
_SPEECH = np.array([b == 0x20 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])  # digits and marks say little

# The families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa sa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "celtic": "br cy ga gd",
    "austronesian": "id jv mg ms tl",
    "dravidian": "kn ml ta te",
    "sinitic": "yue zh",
}


def family(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs.split()), lang)


# --- features ----------------------------------------------------------------

def _gram_bins(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all grams of a batch and the index of each text's first one; grams stay inside a text."""
    data, places = bw.flat(pc.utf8_lower(part.column("text").cast(pa.large_string())))
    x = data.astype(np.uint32)
    bins, texts = [], []
    owner = np.repeat(np.arange(part.num_rows), np.diff(places))
    for size in (2, 3):
        n = max(len(x) - size + 1, 0)
        packed = np.full(n, size, np.uint32)
        for k in range(size):
            packed = packed * np.uint32(257) + x[k: k + n]
        inside = owner[:n] == owner[size - 1:]
        for k in range(size):
            inside &= _SPEECH[data[k: k + n]]
        packed = packed[inside]
        packed ^= packed >> np.uint32(15)
        packed *= np.uint32(0x2C1B3C6D)
        packed ^= packed >> np.uint32(12)
        bins.append(packed % np.uint32(BINS))
        texts.append(owner[:n][inside])
    bins, texts = np.concatenate(bins), np.concatenate(texts)
    order = np.argsort(texts, kind="stable")
    return bins[order], np.searchsorted(texts[order], np.arange(part.num_rows + 1))


def _share_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for part in bw.pieces(batch, "text", 1 << 22):
        bins, first = _gram_bins(part)
        shares = [np.bincount(bins[a:b], minlength=BINS).astype(np.float32) / np.float32(max(b - a, 1))
                  for a, b in zip(first[:-1], first[1:], strict=True)]
        yield {"lang": part.column("lang"), "shares": [s.tobytes() for s in shares]}


# --- machines ------------------------------------------------------------------

def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, passes: int = _PASSES) -> np.ndarray:
    """Weights of a hinge-loss machine by dual coordinate ascent; the last column of ``x`` is constant."""
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    norms = (x * x).sum(1) + 1e-12
    rng = np.random.default_rng(0)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(y)):
            grad = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - grad / norms[i], 0.0), cost)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class Duels:
    """One machine for each pair of classes: a weight for each bin, and a constant."""

    classes: list[str]
    weights: np.ndarray  # pairs x (bins + 1)

    def decide(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winning class of each text and a confidence; ``means`` is pairs x texts."""
        n, k = means.shape[1], len(self.classes)
        votes, margins = np.zeros((k, n)), np.full((k, n), np.inf)
        for row, (a, b) in zip(means, combinations(range(k), 2), strict=True):
            votes[a] += row > 0
            votes[b] += row <= 0
            margins[a], margins[b] = np.minimum(margins[a], row), np.minimum(margins[b], -row)
        best = np.lexsort((np.repeat(np.arange(k)[:, None], n, 1), -margins, -votes), axis=0)[0]
        return best, 1 / (1 + np.exp(-3 * np.clip(margins[best, np.arange(n)], -10, 10)))


def fit_duels(x: np.ndarray, names: np.ndarray, scale: np.ndarray) -> Duels:
    classes = sorted(set(names))
    weights = np.zeros((len(classes) * (len(classes) - 1) // 2, BINS + 1))
    for row, (a, b) in enumerate(combinations(classes, 2)):
        mine = (names == a) | (names == b)
        w = linear_svm(x[mine], np.where(names[mine] == a, 1.0, -1.0))
        weights[row] = np.append(w[:-1] * scale, w[-1])
    return Duels(classes, weights)


@dataclass
class Model:
    families: Duels
    languages: dict[str, Duels]


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most about ``rows`` texts ``text, lang``; None without a labelled text."""
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    each = rows / len(counts)
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(int(min(1.0, each / n) * (1 << 30)))).otherwise(share)
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share).select("text", "lang")
    got = arrow_map(chosen, "lang string, shares binary", _share_rows).toArrow()
    langs = np.array(got.column("lang").to_pylist(), object)
    shares = np.stack([np.frombuffer(b, np.float32) for b in got.column("shares").to_pylist()]) \
        if len(langs) else np.zeros((0, BINS), np.float32)
    del got
    scale = 1 / np.sqrt(shares.mean(0) + 1e-6) if len(langs) else np.ones(BINS)
    x = np.hstack([shares * scale.astype(np.float32), np.ones((len(langs), 1), np.float32)])
    groups = np.array([family(lang) for lang in langs], object)
    if not len(langs):  # no sampled row: the most frequent language answers
        lang = max(counts, key=lambda k: (counts[k], k))
        langs, groups = np.array([lang], object), np.array([family(lang)], object)
        x = np.zeros((1, BINS + 1), np.float32)
    return Model(fit_duels(x, groups, scale),
                 {g: fit_duels(x[groups == g], langs[groups == g], scale) for g in sorted(set(groups))})


def predicted(documents: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The kept columns, ``lang_pred`` and ``score`` of every row.

    A null text or one without a letter is ``und`` with score 0, and so is every
    text where nothing was learned.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)  # BINS weights a pair of classes
    given = documents.select(*keep, *([] if "text" in keep else ["text"]))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name in keep]
                       + ["lang_pred string", "score double"])

    def means(duels: Duels, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.zeros((len(duels.weights), len(first) - 1))
        full = np.diff(first) > 0
        for row, w in zip(out, duels.weights, strict=True):
            if full.any():
                row[full] = np.add.reduceat(w[:-1][bins], first[:-1][full]) / np.diff(first)[full]
            row += w[-1]
        return out

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        model = held.value
        for part in bw.pieces(batch, "text", 1 << 22):
            letters = pc.fill_null(pc.match_substring_regex(part.column("text"), r"\pL"), False).to_numpy(
                zero_copy_only=False)
            names, score = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
            if model is not None:
                bins, first = _gram_bins(part)
                group, sure = model.families.decide(means(model.families, bins, first))
                for g, title in enumerate(model.families.classes):
                    duels = model.languages[title]
                    best, within = duels.decide(means(duels, bins, first))
                    mine = letters & (group == g)
                    names[mine] = np.array(duels.classes, object)[best[mine]]
                    score[mine] = (sure * within)[mine]
            yield {k: part.column(k) for k in keep} | {"lang_pred": pa.array(names, pa.string()), "score": score}

    return arrow_map(given, schema, step)
