"""Plug-in point for model scorers written in Python.

A scorer turns a list of inputs into score arrays in vocabulary order. It is set
up once per Python worker and fed Arrow batches; only the input column leaves the
JVM. Whatever a scorer raises becomes the `error` of the item that caused it.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrspark.functions.attributes import empty_record, widen
from attrspark.functions.scoring import with_attributes
from attrspark.operators.lexical import extract_text
from attrspark.operators.zero_shot import LabelVectors, cosine_scores
from attrspark.vocabulary import (
    CONFIDENCE_THRESHOLD,
    IMAGE_VOCABULARY,
    TEXT_VOCABULARY,
    Vocabulary,
)

SCORED = "scores array<double>, error string, seconds double"
IMAGE_MISSING = "image_load_failed"
BATCH_SIZE, BATCH_BYTES = 32, 64 << 20


class Scorer(Protocol):
    def setup(self) -> None:
        """Load the model; called once per Python worker."""

    def score(self, inputs: list[Any]) -> Sequence[Sequence[float] | None]:
        """One score array per input; None where there is nothing to say."""


class Embedder(Protocol):
    def setup(self) -> None:
        """Load the model; called once per Python worker."""

    def embed(self, inputs: list[Any]) -> Any:
        """One vector per input, as rows of a matrix."""


class EmbeddingScorer:
    """Scores by an embedder: each input is embedded once and meets all label vectors at once."""

    def __init__(self, embedder: Embedder, labels: LabelVectors, scale: float):
        self.embedder, self.labels, self.scale = embedder, labels, scale

    def setup(self) -> None:
        self.embedder.setup()

    def score(self, inputs: list[Any]) -> list[list[float]]:
        vectors = np.asarray(self.embedder.embed(inputs), dtype=np.float64)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        if not (np.isfinite(norms).all() and (norms > 0).all()):
            raise ValueError("embedding without direction")
        return ((vectors / norms) @ self.labels.matrix * self.scale).tolist()


def score_batch(scorer: Scorer, inputs: list[Any], missing: str | None) -> pd.DataFrame:
    """Score a batch; one that fails is halved until the bad items are alone."""
    began = time.perf_counter()
    at = [i for i, value in enumerate(inputs) if value is not None]
    scores: list[Any] = [None] * len(inputs)
    errors: list[str | None] = [missing if value is None else None for value in inputs]

    def run(positions: list[int]) -> None:
        found = list(scorer.score([inputs[i] for i in positions]))
        if len(found) != len(positions):
            raise ValueError(f"scorer returned {len(found)} results for {len(positions)} inputs")
        for i, s in zip(positions, found):
            scores[i] = None if s is None else [float(x) for x in s]

    todo = [at] if at else []
    while todo:
        part = todo.pop()
        try:
            run(part)
        except Exception as failure:  # noqa: BLE001 - any model failure is reported per item
            if len(part) > 1:
                todo += [part[: len(part) // 2], part[len(part) // 2 :]]
            else:
                scores[part[0]], errors[part[0]] = None, str(failure) or type(failure).__name__
    seconds = (time.perf_counter() - began) / max(len(inputs), 1)
    return pd.DataFrame({"scores": scores, "error": errors, "seconds": seconds})


def item_batches(sizes: Sequence[int], items: int, size: int) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of at most `items` items and `size` bytes; a larger item is alone."""
    first = held = 0
    for i, one in enumerate(sizes):
        if i > first and (i - first >= items or held + one > size):
            yield first, i
            first, held = i, 0
        held += one
    if first < len(sizes):
        yield first, len(sizes)


def item_bytes(value: Any) -> int:
    """Bytes of an input: of a text in UTF-8, of an array of doubles, none of a null."""
    if value is None:
        return 0
    if isinstance(value, str):
        return len(value.encode("utf-8", "surrogatepass"))
    return len(value) if isinstance(value, (bytes, bytearray, memoryview)) else 8 * np.size(value)


def score_batches(scorer: Scorer, inputs: list[Any], missing: str | None, items: int, size: int) -> pd.DataFrame:
    """Score inputs in batches of at most `items` inputs and `size` bytes; nulls take no place in one."""
    given = [i for i, value in enumerate(inputs) if value is not None]
    parts = [score_batch(scorer, [None] * (len(inputs) - len(given)), missing)]
    order = [i for i, value in enumerate(inputs) if value is None]
    for first, end in item_batches([item_bytes(inputs[i]) for i in given], items, size):
        parts.append(score_batch(scorer, [inputs[i] for i in given[first:end]], missing))
        order += given[first:end]
    done = pd.concat([p for p in parts if len(p)] or parts, ignore_index=True)
    done.index = order
    return done.sort_index()


def scored(
    column: Column,
    scorer: Scorer,
    missing: str | None = None,
    batch_size: int = BATCH_SIZE,
    batch_bytes: int = BATCH_BYTES,
) -> Column:
    """Struct of scores, error and seconds for an input column."""

    @F.pandas_udf(SCORED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer.setup()
        for batch in batches:
            yield score_batches(scorer, batch.tolist(), missing, batch_size, batch_bytes)

    return run(column)


class Extractor(Protocol):
    """Adds a struct column `out` with attributes, error and seconds for `column`."""

    vocabulary: Vocabulary

    def apply(self, df: DataFrame, column: str, out: str) -> DataFrame: ...


def _outcome(attributes: Column, error: Column, seconds: Column, out: str) -> Column:
    return F.struct(
        attributes.alias("attributes"),
        error.cast("string").alias("error"),
        seconds.cast("double").alias("seconds"),
    ).alias(out)


class LexicalExtractor:
    """Text attributes by column expressions."""

    def __init__(
        self,
        vocabulary: Vocabulary = IMAGE_VOCABULARY,
        text_vocabulary: Vocabulary = TEXT_VOCABULARY,
        threshold: float = CONFIDENCE_THRESHOLD,
    ):
        self.vocabulary, self.text_vocabulary, self.threshold = vocabulary, text_vocabulary, threshold

    def apply(self, df: DataFrame, column: str, out: str) -> DataFrame:
        done = extract_text(df, column, self.vocabulary, self.text_vocabulary, self.threshold)
        return done.select(
            *df.columns, _outcome(F.col("attributes"), F.lit(None), F.lit(0.0), out)
        )


class VectorExtractor:
    """Image attributes from embedding vectors and label vectors."""

    def __init__(
        self,
        labels: LabelVectors,
        scale: float,
        threshold: float = CONFIDENCE_THRESHOLD,
        missing: str | None = IMAGE_MISSING,
    ):
        self.labels, self.scale, self.threshold, self.missing = labels, scale, threshold, missing
        self.vocabulary = labels.vocabulary

    def apply(self, df: DataFrame, column: str, out: str) -> DataFrame:
        scores = df.withColumn("scores", cosine_scores(F.col(column), self.labels, self.scale))
        done = with_attributes(scores, self.labels.vocabulary, "scores", self.threshold)
        error = F.when(F.col("scores").isNull(), F.lit(self.missing))
        return done.select(*df.columns, _outcome(F.col("attributes"), error, F.lit(0.0), out))


class ModelExtractor:
    """Attributes from a Python scorer over images or texts."""

    def __init__(
        self,
        scorer: Scorer,
        vocabulary: Vocabulary = IMAGE_VOCABULARY,
        scored_vocabulary: Vocabulary | None = None,
        threshold: float = CONFIDENCE_THRESHOLD,
        missing: str | None = None,
        partitions: int | None = None,
        batch_size: int = BATCH_SIZE,
        batch_bytes: int = BATCH_BYTES,
    ):
        """`partitions` spreads the rows over that many tasks before scoring.

        Spark sizes tasks by bytes; a slow model over short texts needs more of them. The
        scorer gets at most `batch_size` inputs of together `batch_bytes` at a time, a larger
        input alone.
        """
        if batch_size <= 0 or batch_bytes <= 0:
            raise ValueError("batch_size and batch_bytes must be positive")
        self.batch_size, self.batch_bytes = batch_size, batch_bytes
        self.scorer, self.vocabulary, self.threshold = scorer, vocabulary, threshold
        self.scored_vocabulary = scored_vocabulary or vocabulary
        self.missing, self.partitions = missing, partitions

    def from_scores(self, df: DataFrame, scores: str, keep: list[str], out: str) -> DataFrame:
        """The outcome struct for a column that already holds scored structs."""
        staged = df.withColumn("__scores", F.col(scores)["scores"])
        done = with_attributes(staged, self.scored_vocabulary, "__scores", self.threshold)
        record = widen("attributes", self.scored_vocabulary.names, self.vocabulary)
        failed = F.col(scores)["error"].isNotNull()
        record = F.when(failed, empty_record(self.vocabulary)).otherwise(record)
        outcome = _outcome(record, F.col(scores)["error"], F.col(scores)["seconds"], out)
        return done.select(*keep, outcome)

    def apply(self, df: DataFrame, column: str, out: str) -> DataFrame:
        rows = df.repartition(self.partitions) if self.partitions else df
        staged = rows.withColumn("__scored", scored(F.col(column), self.scorer, self.missing, self.batch_size, self.batch_bytes))
        return self.from_scores(staged, "__scored", df.columns, out)
