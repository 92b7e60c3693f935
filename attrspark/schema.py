"""Result rows: one attribute record per item, plus source, time and error."""

from __future__ import annotations

from pyspark.sql import types as T

from attrspark.vocabulary import IMAGE_VOCABULARY, Vocabulary

# The four groups a tag can fall into, in reporting order.
TAG_GROUPS = ("character_tags", "appearance_tags", "clothing_tags", "other_tags")

TAGS_SCHEMA = T.StructType(
    [
        T.StructField("raw_tags", T.ArrayType(T.StringType())),
        T.StructField(
            "categorized",
            T.StructType([T.StructField(g, T.ArrayType(T.StringType())) for g in TAG_GROUPS]),
        ),
        T.StructField("tag_count", T.IntegerType()),
    ]
)


def result_schema(vocabulary: Vocabulary = IMAGE_VOCABULARY, tags: bool = True) -> T.StructType:
    """The schema of a result row, and of the JSON lines it is written as."""
    fields = [
        T.StructField("id", T.StringType()),
        T.StructField("attributes", vocabulary.schema),
        T.StructField("source", T.StringType()),
        T.StructField("processing_time", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
    if tags:
        fields.append(T.StructField("tags", TAGS_SCHEMA))
    return T.StructType(fields)
