"""Result tables: merging, run and batch summaries, dataset statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrspark.functions.attributes import is_empty
from attrspark.vocabulary import IMAGE_VOCABULARY, Vocabulary


def merge_results(old: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier and new result rows; columns only one side has are null on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def summary_metrics(
    vocabulary: Vocabulary = IMAGE_VOCABULARY, hit: Column | None = None
) -> list[Column]:
    """Counters of a run, for `agg` or `observe`.

    Two notions of success are kept apart: `successful` has no error and at least one
    attribute, `no_error` only lacks an error. `computed` counts what was extracted
    in this run without error, cache hits excluded.
    """
    fine = F.col("error").isNull()
    good = fine & ~is_empty(F.col("attributes"), vocabulary)
    hit = F.lit(False) if hit is None else hit
    return [
        F.count("*").alias("total"),
        F.count_if(good).alias("successful"),
        F.count_if(~good).alias("failed"),
        F.count_if(fine).alias("no_error"),
        F.count_if(~fine).alias("errors"),
        F.count_if(hit).alias("cache_hits"),
        F.count_if(~hit & fine).alias("computed"),
    ]


def run_summary(
    results: DataFrame, vocabulary: Vocabulary = IMAGE_VOCABULARY, hit: Column | None = None
) -> DataFrame:
    return results.agg(*summary_metrics(vocabulary, hit))


def batch_summary(results: DataFrame, batch: str = "batch") -> DataFrame:
    """Per batch: rows without and with an error; an empty record counts as success."""
    return results.groupBy(batch).agg(
        F.count_if(F.col("error").isNull()).alias("success_count"),
        F.count_if(F.col("error").isNotNull()).alias("error_count"),
    )


def throughput(items: int, seconds: float) -> float:
    """Items per second; 0 when no time has passed."""
    return items / seconds if seconds > 0 else 0.0


def dataset_stats(
    df: DataFrame, order: list[str], tags: str | None = "general", image: str | None = "image"
) -> DataFrame:
    """One row: number of rows, column names, tag count and image size of the first sample."""
    at = F.struct(*order)
    stats = [
        F.count("*").alias("total_samples"),
        F.lit(",".join(df.columns)).alias("sample_keys"),
    ]
    if tags in df.columns:
        kind = df.schema[tags].dataType
        size = F.size(tags) if isinstance(kind, T.ArrayType) else F.length(tags)
        # Null tags count as none; -1 is what size() gives for null.
        stats.append(F.min_by(F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)), at).alias("sample_tags"))
    kind = df.schema[image].dataType if image in df.columns else None
    if isinstance(kind, T.StructType) and {"width", "height"} <= set(kind.names):
        stats.append(F.min_by(F.col(image)["width"], at).alias("sample_width"))
        stats.append(F.min_by(F.col(image)["height"], at).alias("sample_height"))
    return df.agg(*stats)
