"""Connected components of a graph of links, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.session import scratch_path


def _written(spark: SparkSession, df: DataFrame) -> DataFrame:
    place = scratch_path(spark, "links")
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def _state(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum("a"), F.sum("b"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in `links(a, b)`; component is its smallest id.

    Large-star and small-star steps in turn: each replaces links by links to smaller ids,
    never adds more than there were, and all end at the smallest id of each component after
    a number of rounds logarithmic in its size. Smallest neighbours are found by partial
    aggregation and joined back, so a hub is not gathered in one task; each round is
    written to the shared folder. Nulls and loops are left out, repeated links count once.
    No links: no rows.
    """
    spark = links.sparkSession
    a, b = F.col("a"), F.col("b")
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(a.isNotNull() & b.isNotNull() & (a != b))
    edges = _written(spark, edges.distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select(b.alias("a"), a.alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: neighbours above a point at the smallest of a and its neighbours.
        large = both.where(b > a).join(smallest, "a").select(b.alias("a"), F.col("m").alias("b")).where(a != b)
        large = _written(spark, large.distinct())
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        # Small star: a and its neighbours below point at the smallest of them.
        small = large.join(smallest, "a").select(b.alias("a"), F.col("m").alias("b"))
        small = small.union(smallest.select("a", F.col("m").alias("b"))).where(a != b)
        edges = _written(spark, small.distinct())
    return edges.select(a.alias("id"), b.alias("component")).union(edges.select(b, b)).distinct()
