"""Match images with their texts by name, and count what a shard holds.

A member table has one row per file: `name` and a column that gives the archive
order. All forms aggregate on the key with partial aggregates, so the files of one
key are never brought together in one place, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrspark.functions.names import (
    SHARD_IMAGE_SUFFIXES,
    STREAM_IMAGE_SUFFIXES,
    TEXT_SUFFIXES,
    item_id,
    member_kind,
    stem,
    strip,
)
from attrspark.operators.positions import number_within


def with_item_ids(members: DataFrame, prefix: str, name: str = "name") -> DataFrame:
    """Add `id`; members without the prefix are dropped."""
    return members.withColumn("id", item_id(F.col(name), prefix)).where(F.col("id").isNotNull())


def group_members(members: DataFrame, prefix: str, order: str = "pos") -> DataFrame:
    """Members of each id, numbered in archive order, with the size of the group."""
    return number_within(with_item_ids(members, prefix), ["id"], [order])


def first_of_kind(
    members: DataFrame,
    keys: list[str],
    order: str,
    image: Column,
    text: Column,
    name: str = "name",
) -> DataFrame:
    """Per key: `image` of the first image and `text` of the first text, either may be missing."""
    kind = member_kind(F.col(name))

    def position(k: str) -> Column:
        return F.when(kind == k, F.col(order))

    return (
        members.where(kind != "other")
        .groupBy(*keys)
        .agg(
            F.min_by(image, position("image")).alias("image"),
            F.min_by(text, position("text")).alias("text"),
        )
    )


def pair_by_id(
    members: DataFrame, prefix: str, image: Column, text: Column, order: str = "pos", keys=("id",)
) -> DataFrame:
    """First image and first text of each id."""
    return first_of_kind(with_item_ids(members, prefix), list(keys), order, image, text)


def pair_positions(members: DataFrame, prefix: str, order: str = "offset", keys=("tar", "id")):
    """Like `pair_by_id`, but only where the image and the text are, not what they hold.

    Two bigint minima per id: the plan is a hash aggregate over narrow rows, and the
    content is read afterwards, for the items that are still wanted.
    """
    kind = member_kind(F.col("name"))
    return (
        with_item_ids(members, prefix)
        .where(kind != "other")
        .groupBy(*keys)
        .agg(
            F.min(F.when(kind == "image", F.col(order))).alias("image_at"),
            F.min(F.when(kind == "text", F.col(order))).alias("text_at"),
        )
    )


def pair_by_stem(members: DataFrame, image: Column, text: Column, order: str = "pos") -> DataFrame:
    """Inner pairing on the whole stem; of repeated halves the last one counts."""
    kind = member_kind(F.col("name"), STREAM_IMAGE_SUFFIXES, TEXT_SUFFIXES)
    is_image, is_text = kind == "image", kind == "text"
    return (
        members.where(kind != "other")
        .groupBy(stem(F.col("name")).alias("stem"))
        .agg(
            F.max_by(image, F.when(is_image, F.col(order))).alias("image"),
            F.max_by(strip(text), F.when(is_text, F.col(order))).alias("text"),
            F.count_if(is_image).alias("__images"),
            F.count_if(is_text).alias("__texts"),
        )
        .where((F.col("__images") > 0) & (F.col("__texts") > 0))
        .drop("__images", "__texts")
    )


def shard_stats(
    members: DataFrame,
    prefix: str,
    images: Iterable[str] = SHARD_IMAGE_SUFFIXES,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Files, image files, text files, distinct ids and size in MB."""
    kind = member_kind(F.col("name"), images, TEXT_SUFFIXES)
    ids = item_id(F.col("name"), prefix)
    # Two levels keep the exact distinct count a plain partial aggregate: no row is
    # expanded, and a hot id collapses before the shuffle.
    per_id = members.groupBy(*keys, ids.alias("__id")).agg(
        F.count("*").alias("files"),
        F.count_if(kind == "image").alias("images"),
        F.count_if(kind == "text").alias("texts"),
        F.sum("size").alias("bytes"),
    )
    return per_id.groupBy(*keys).agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("total_files"),
        F.coalesce(F.sum("images"), F.lit(0)).alias("image_files"),
        F.coalesce(F.sum("texts"), F.lit(0)).alias("text_files"),
        F.count("__id").alias("unique_ids"),
        (F.coalesce(F.sum("bytes"), F.lit(0)) / F.lit(1024 * 1024)).alias("size_mb"),
    )
