"""Items to result rows: source choice, extraction of images and texts, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrspark.functions.tags import SHARD_RULES, TagRules, split_commas, with_tags
from attrspark.operators.scorers import Extractor

SOURCES = ("image", "text", "caption")


NO_INPUT = "no_input"


def with_source(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Add `source` and `text_input`: image, else text, else caption.

    Rows without any are dropped, or kept with a null source.
    """
    present = [s for s in SOURCES if s in df.columns]
    if not present:
        raise ValueError(f"none of the columns {SOURCES} is there")
    source = F.when(F.lit(False), F.lit(None).cast("string"))
    for name in present:
        source = source.when(F.col(name).isNotNull(), name)
    texts = [F.col(s) for s in present if s != "image"]
    text = F.coalesce(*texts) if texts else F.lit(None).cast("string")
    rows = df.withColumn("source", source)
    if not keep_empty:
        rows = rows.where(F.col("source").isNotNull())
    return rows.withColumn("text_input", F.when(F.col("source") != "image", text))


def marked_empty(df: DataFrame) -> DataFrame:
    """Give the `outcome` of rows with a null source the error `no_input`."""
    outcome = F.col("outcome")
    return df.withColumn(
        "outcome", F.when(F.col("source").isNull(), outcome.withField("error", F.lit(NO_INPUT))).otherwise(outcome)
    )


def image_bytes(df: DataFrame, name: str = "image") -> Column:
    """The bytes of an image column, whether it is a struct holding them or plain binary."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StructType):
        return F.col(name)["bytes"]
    return F.col(name)


def extract_sources(
    df: DataFrame, images: Extractor | None, texts: Extractor, image: str = "image"
) -> DataFrame:
    """Add `outcome` to rows that carry `source` and `text_input`.

    Both extractors run over the same rows in one pass, each on the rows of its
    source only; no split and union, so the input is read once.
    """
    staged = texts.apply(df, "text_input", "__text")
    if images is None:
        return staged.withColumn("outcome", F.col("__text")).drop("__text")
    staged = images.apply(staged, image, "__image")
    outcome = F.when(F.col("source") == "image", F.col("__image")).otherwise(F.col("__text"))
    return staged.withColumn("outcome", outcome).drop("__text", "__image")


def extract_pairs(
    pairs: DataFrame,
    images: Extractor,
    texts: Extractor,
    rules: TagRules = SHARD_RULES,
    has_image: Column | None = None,
) -> DataFrame:
    """Extract (id, image, text) pairs: the image if there is one, else the text.

    With an image, tags are read from the text when it is not empty; a text alone
    always gets tags. `has_image` tells apart an image that cannot be used, which is
    an error, from none at all.
    """
    has_image = F.col("image").isNotNull() if has_image is None else has_image
    usable = pairs.where(has_image | F.col("text").isNotNull())
    staged = usable.withColumn("source", F.when(has_image, "image").otherwise("text")).withColumn(
        "text_input", F.when(~has_image, F.col("text"))
    )
    done = extract_sources(staged, images, texts)
    tagged = (F.col("source") == "text") | (F.length("text") > 0)
    return with_tags(done, split_commas(F.col("text")), rules, only_if=tagged)


def to_results(
    df: DataFrame, id: str = "id", outcome: str = "outcome", keep: list[str] | None = None
) -> DataFrame:
    """Result rows: id, attributes, source, processing_time, error, and tags if there are."""
    done = F.col(outcome)
    # An item that was never scored, such as a null text, has an empty record.
    names = df.schema[outcome].dataType["attributes"].dataType.names
    record = F.struct(*[done["attributes"][n].alias(n) for n in names])
    columns = [
        F.col(id).cast("string").alias("id"),
        record.alias("attributes"),
        F.coalesce(F.col("source"), F.lit("unknown")).alias("source")
        if "source" in df.columns
        else F.lit("unknown").alias("source"),
        F.coalesce(done["seconds"], F.lit(0.0)).alias("processing_time"),
        done["error"].alias("error"),
    ]
    if "tags" in df.columns:
        columns.append(F.col("tags"))
    return df.select(*columns, *(keep or []))
