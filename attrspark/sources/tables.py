"""Dataset tables and result files: Parquet in, JSON lines in and out."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from attrspark.operators.results import summary_metrics, throughput
from attrspark.operators.resume import processed_ids
from attrspark.schema import result_schema
from attrspark.sources.files import exists
from attrspark.vocabulary import IMAGE_VOCABULARY, Vocabulary


def dataset(spark: SparkSession, path: str, split: str | None = None, streaming: bool = False):
    """A Parquet dataset, or one split of it, as a batch or a streaming DataFrame."""
    location = f"{path.rstrip('/')}/{split}" if split else path
    if streaming:
        schema = spark.read.parquet(location).schema
        return spark.readStream.schema(schema).parquet(location)
    return spark.read.parquet(location)


def prior_ids(spark: SparkSession, path: str, fields: tuple[str, ...] = ("id", "item_id")):
    """Distinct ids in the JSON lines earlier runs have written; none if there are no files."""
    if not exists(spark, path):
        return spark.createDataFrame([], "id string")
    return processed_ids(spark.read.text(path), fields)


def read_results(spark: SparkSession, path: str, vocabulary: Vocabulary = IMAGE_VOCABULARY) -> DataFrame:
    """Result rows from JSON lines."""
    return spark.read.schema(result_schema(vocabulary)).json(path)


def write_results(results: DataFrame, path: str, append: bool = False) -> None:
    """One JSON object per row, nulls spelled out, non-ASCII text as it is."""
    mode = "append" if append else "overwrite"
    results.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_with_summary(
    results: DataFrame,
    path: str,
    append: bool = False,
    vocabulary: Vocabulary = IMAGE_VOCABULARY,
    hit: Column | None = None,
    drop: tuple[str, ...] = (),
) -> dict:
    """Write result rows and count them on the way: no second pass over the data."""
    seen = Observation("run")
    began = time.perf_counter()
    watched = results.observe(seen, *summary_metrics(vocabulary, hit)).drop(*drop)
    write_results(watched, path, append)
    seconds = time.perf_counter() - began
    counts = dict(seen.get)
    return {
        **counts,
        "processing_time": seconds,
        "samples_per_second": throughput(counts["total"], seconds),
        "output_path": path,
    }
