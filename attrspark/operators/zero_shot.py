"""Zero-shot scores: cosine of an item vector with every label vector."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrspark.functions.scoring import with_attributes
from attrspark.vocabulary import CONFIDENCE_THRESHOLD, IMAGE_VOCABULARY, Vocabulary

# Label vectors travel to every task; a vocabulary beyond this is a mistake.
MAX_LABEL_BYTES = 64 << 20


class LabelVectors:
    """One unit vector per option, in vocabulary order, as a dim x options matrix."""

    def __init__(self, rows: np.ndarray, vocabulary: Vocabulary = IMAGE_VOCABULARY):
        matrix = np.asarray(rows, dtype=np.float64)
        if matrix.ndim != 2 or matrix.shape[0] != vocabulary.size:
            raise ValueError(f"expected {vocabulary.size} label vectors, got shape {matrix.shape}")
        if matrix.nbytes > MAX_LABEL_BYTES:
            raise ValueError(f"label vectors take {matrix.nbytes} bytes, limit {MAX_LABEL_BYTES}")
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        if not (norms > 0).all():
            raise ValueError("label vectors must not be zero")
        self.vocabulary = vocabulary
        self.matrix = np.ascontiguousarray((matrix / norms).T)

    @classmethod
    def from_encoder(
        cls, encode: Callable[[list[str]], Any], vocabulary: Vocabulary = IMAGE_VOCABULARY
    ) -> "LabelVectors":
        """Encode the prompt of every option, once, with a text encoder."""
        return cls(np.asarray(encode([row[5] for row in vocabulary.rows()])), vocabulary)

    @classmethod
    def from_frame(
        cls, labels: DataFrame, vocabulary: Vocabulary = IMAGE_VOCABULARY
    ) -> "LabelVectors":
        """Read (ordinal, vector) rows; there are as many as the vocabulary has options."""
        rows = labels.select("ordinal", "vector").orderBy("ordinal").limit(vocabulary.size + 1).collect()
        if [r["ordinal"] for r in rows] != list(range(vocabulary.size)):
            raise ValueError("labels must have each ordinal of the vocabulary exactly once")
        return cls(np.array([r["vector"] for r in rows]), vocabulary)


def cosine_scores(vector: Column, labels: LabelVectors, scale: float = 1.0) -> Column:
    """Array of `scale * cosine` per option; null for a missing or unusable vector.

    The built-in array functions have no compiled dot product, so this one step runs
    on Arrow batches: vectors arrive as one flat buffer and meet the label matrix in
    a single matrix product per batch.
    """
    matrix = labels.matrix
    dim, width = matrix.shape

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def score(vectors: pa.Array) -> pa.Array:
        lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        usable = lengths == dim
        flat = vectors if usable.all() else vectors.filter(pa.array(usable))
        values = flat.flatten().cast(pa.float64())
        rows = values.to_numpy(zero_copy_only=False).reshape(-1, dim)
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            scored = (rows @ matrix) * (scale / norms)
        # A zero vector, or one holding null or NaN, has no direction.
        sound = np.isfinite(scored).all(axis=1)
        usable[usable] = sound
        ends = np.concatenate([[0], np.cumsum(np.where(usable, width, 0))]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(ends), pa.array(scored[sound].ravel()), mask=pa.array(~usable)
        )

    return score(vector)


def classify_vectors(
    df: DataFrame,
    vector: str,
    labels: LabelVectors,
    scale: float,
    threshold: float = CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """Add `attributes` and `confidence` for a vector column."""
    scored = df.withColumn("scores", cosine_scores(F.col(vector), labels, scale))
    return with_attributes(scored, labels.vocabulary, "scores", threshold).drop("scores")
