"""Embeddings, centroids and planar coordinates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unit(vector: Column) -> Column:
    """L2-normalised array; a zero vector stays."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(vector, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(x.cast("double")))


def centroids(df: DataFrame, key: str, vector: str = "embedding", weight: str | None = None) -> DataFrame:
    """Unit-length (weighted) mean vector per group, from mergeable partial sums."""
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key), array_to_vector(vector).alias("_v"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"))
    return rows.groupBy(key).agg(Summarizer.mean(F.col("_v"), F.col("_w")).alias("_m")) \
               .select(key, unit(vector_to_array("_m")).alias(vector))


def rolled_up(micro: DataFrame, meta: DataFrame, level: str) -> DataFrame:
    """Centroids of a higher level: micro centroids weighted by publications.

    ``meta`` has micro_cluster, the parent ids, publications and rep_count; a
    cluster without publications weighs as many works as represent it.
    """
    weighted = micro.join(meta, "micro_cluster").withColumn(
        "_weight", F.coalesce("publications", "rep_count"))
    return centroids(weighted, f"{level}_cluster", weight="_weight")


def hashed_embeddings(df: DataFrame, key: str, text: str, size: int = 256) -> DataFrame:
    """Deterministic text vectors: hashed word counts, IDF weights, unit length."""
    words = RegexTokenizer(inputCol=text, outputCol="_words", gaps=False, pattern=r"[\p{L}\p{N}_]+") \
        .transform(df.select(key, F.coalesce(F.col(text), F.lit("")).alias(text)))
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=size).transform(words)
    weighted = IDF(inputCol="_counts", outputCol="_weighted").fit(counts).transform(counts)
    scaled = Normalizer(inputCol="_weighted", outputCol="_unit").transform(weighted)
    return scaled.select(key, vector_to_array("_unit", dtype="float32").alias("embedding"))


Encoder = Callable[[list[str]], np.ndarray]


def encoded(df: DataFrame, key: str, text: str, make_encoder: Callable[[], Encoder],
            batch: int = 512, unit_length: bool = True) -> DataFrame:
    """Vectors from any encoder, made once per task and fed in batches of texts."""
    schema = T.StructType([df.schema[key], T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_encoder()
        for part in parts:
            for start in range(0, len(part), batch):
                piece = part.iloc[start:start + batch]
                found = np.asarray(encode(piece[text].fillna("").tolist()), dtype=np.float32)
                if unit_length:
                    lengths = np.linalg.norm(found, axis=1, keepdims=True)
                    found = found / np.where(lengths == 0, 1.0, lengths)
                yield pd.DataFrame({key: piece[key].values, "embedding": list(found)})

    return df.select(key, text).mapInPandas(run, schema)


def plane_axes(micro: DataFrame, vector: str = "embedding") -> np.ndarray:
    """Two principal axes (dimension x 2), each with its largest loading positive."""
    model = PCA(k=2, inputCol="_v", outputCol="_p").fit(micro.select(array_to_vector(vector).alias("_v")))
    axes = model.pc.toArray().copy()
    for at in range(axes.shape[1]):
        if axes[np.argmax(np.abs(axes[:, at])), at] < 0:
            axes[:, at] = -axes[:, at]
    return axes


def on_plane(df: DataFrame, axes: np.ndarray, vector: str = "embedding") -> DataFrame:
    """Add ``x_coords`` and ``y_coords`` on shared axes."""
    def along(at: int) -> Column:
        axis = F.array(*[F.lit(float(x)) for x in axes[:, at]])
        return F.aggregate(F.zip_with(vector, axis, lambda a, b: a.cast("double") * b),
                           F.lit(0.0), lambda s, x: s + x)

    return df.withColumns({"x_coords": along(0), "y_coords": along(1)})
