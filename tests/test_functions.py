"""Name, tag, record and image expressions against plain Python."""

import os.path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrspark.functions import attributes as A
from attrspark.functions import images as I
from attrspark.functions.names import basename, has_suffix, item_id, member_kind, stem, strip, suffix
from attrspark.functions.tags import (
    DATASET_RULES,
    SHARD_RULES,
    split_auto,
    split_commas,
    tag_source,
    with_tags,
)
from attrspark.operators.extract import image_bytes, with_source
from attrspark.vocabulary import Vocabulary

TEXTS = ["", " a ", "\ta ", "　x y ", "\x1ca\x1f", "a\n", "  ", "é ", "plain"]


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_strip_is_unicode_strip(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").coalesce(1)
    assert values(df, strip(F.col("t"))) == [t.strip() for t in TEXTS]


def test_names(spark):
    paths = ["a.PNG", ".jpg", "x/y.z/b.tar.gz", "noext", "d/.hidden.txt", "a..jpg", "p/item_1_h.JPG", "a.b/c"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").coalesce(1)
    p = F.col("p")
    bases = [os.path.basename(x) for x in paths]
    assert values(df, basename(p)) == bases
    assert values(df, stem(p)) == [os.path.splitext(b)[0] for b in bases]
    assert values(df, suffix(p)) == [os.path.splitext(b)[1].lower() for b in bases]
    assert values(df, has_suffix(p, [".png", ".jpg"])) == [True, False, False, False, False, True, True, False]
    kinds = ["image", "other", "other", "other", "text", "image", "image", "other"]
    assert values(df, member_kind(p)) == kinds


def test_item_id(spark):
    names = ["d/item_12_hash.jpg", "item_12.jpg", "xitem_1_a.jpg", "item_.txt", "item1_a.txt", "item__a.txt"]
    df = spark.createDataFrame([(n,) for n in names], "n string").coalesce(1)
    assert values(df, item_id(F.col("n"), "item")) == ["item_12", "item_12.jpg", None, "item_.txt", None, "item_"]


def parse(spark, texts, rules, auto):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    tags = split_auto(F.col("t"), T.StringType()) if auto else split_commas(F.col("t"))
    return [r["tags"] for r in with_tags(df, tags, rules).orderBy("i").collect()]


def test_comma_tags_keep_empty_ones(spark):
    got = parse(spark, ["a, b,,c ", "", "one two", None], SHARD_RULES, auto=False)
    assert [g["raw_tags"] for g in got] == [["a", "b", "", "c"], [""], ["one two"], []]
    assert [g["tag_count"] for g in got] == [4, 1, 1, 0]


def test_auto_tags_drop_empty_ones(spark):
    got = parse(spark, ["a, b,,c ", "", "one\ttwo  three", "  ", ",", None], DATASET_RULES, auto=True)
    raw = [["a", "b", "c"], [], ["one", "two", "three"], [], [], []]
    assert [g["raw_tags"] for g in got] == raw


def test_groups_partition_the_tags_and_first_rule_wins(spark):
    text = "1girl, Blue HAIR, eyewear, cowboy hat, address, hero_(character), Hero_(Character), red jacket, cat ears"
    a, = parse(spark, [text], SHARD_RULES, auto=False)
    b, = parse(spark, [text], DATASET_RULES, auto=True)
    assert a["categorized"].asDict() == {
        "character_tags": ["1girl", "cowboy hat", "hero_(character)"],
        "appearance_tags": ["Blue HAIR", "eyewear"],
        "clothing_tags": ["address"],
        "other_tags": ["Hero_(Character)", "red jacket", "cat ears"],
    }
    assert b["categorized"].asDict() == {
        "character_tags": ["1girl", "cowboy hat", "hero_(character)", "Hero_(Character)"],
        "appearance_tags": ["Blue HAIR", "eyewear", "cat ears"],
        "clothing_tags": ["address", "red jacket"],
        "other_tags": [],
    }
    for got in (a, b):
        assert sum(len(v) for v in got["categorized"]) == got["tag_count"]


def test_tag_source_prefers_the_first_filled_column(spark):
    rows = [(["x", " ", None], "a b"), ([], "a b"), (None, "a, b"), (None, ""), (None, None)]
    df = spark.createDataFrame(rows, "general array<string>, tag_string_general string").coalesce(1)
    assert values(df, tag_source(df)) == [["x"], ["a", "b"], ["a", "b"], None, None]
    assert values(df, tag_source(df.drop("general"))) == [["a", "b"]] * 2 + [["a", "b"], None, None]
    assert values(df, tag_source(df.select(F.lit(1)))) == [None] * 5


def test_records(spark):
    df = spark.createDataFrame(
        [('{"Age":"teen","Shoe":"x"}',), ("{}",), ("{bad",)], "j string"
    ).coalesce(1).withColumn("r", A.from_json(F.col("j")))
    assert values(df, A.is_empty(F.col("r"))) == [False, True, True]
    assert values(df, A.filled(F.col("r"))) == [{"Age": "teen"}, {}, {}]
    text = values(df, A.to_json(F.col("r")))[0]
    assert text.startswith('{"Age":"teen","Gender":null,') and "Shoe" not in text


def test_a_new_attribute_needs_only_a_vocabulary(spark):
    vocabulary = Vocabulary({"Age": ("old", "new"), "Shoe": ("boot",)})
    df = spark.createDataFrame([('{"Shoe":"boot"}',)], "j string")
    record = A.from_json(F.col("j"), vocabulary)
    assert values(df, A.filled(record, vocabulary)) == [{"Shoe": "boot"}]
    with pytest.raises(ValueError):
        Vocabulary({"Age": ()})


def test_image_rules(spark):
    rows = [(32, 32, "L"), (31, 99, "RGB"), (99, 31, "RGB"), (40, 40, "P"), (-1, -1, None), (1000, 1, "RGBA")]
    df = spark.createDataFrame(rows, "w int, h int, m string").coalesce(1)
    w, h, m = F.col("w"), F.col("h"), F.col("m")
    assert values(df, I.is_valid(w, h, m)) == [True, False, False, False, False, False]
    sizes = values(df, I.target_size(w, h))
    assert tuple(sizes[5]) == (512, 0)
    assert values(df, I.is_degenerate(I.target_size(w, h)))[5] is True


def test_resize_matches_python(spark):
    sides = [1, 31, 511, 512, 513, 777, 1024, 4096]
    df = spark.createDataFrame([(w, h) for w in sides for h in sides], "w int, h int")
    for row in df.select("w", "h", I.target_size(F.col("w"), F.col("h")).alias("t")).collect():
        w, h = row["w"], row["h"]
        if max(w, h) <= 512:
            expected = (w, h)
        elif w > h:
            expected = (512, int(h * 512 / w))
        else:
            expected = (int(w * 512 / h), 512)
        assert tuple(row["t"]) == expected


def test_source_choice(spark):
    rows = [(b"i", "t", "c"), (None, "t", "c"), (None, None, "c"), (None, None, None), (None, "", None)]
    df = spark.createDataFrame(rows, "image binary, text string, caption string").coalesce(1)
    got = [(r["source"], r["text_input"]) for r in with_source(df).collect()]
    assert got == [("image", None), ("text", "t"), ("caption", "c"), ("text", "")]
    nested = df.withColumn("image", F.struct(F.col("image").alias("bytes")))
    assert values(nested, image_bytes(nested))[0] == b"i"
    with pytest.raises(ValueError):
        with_source(df.select(F.lit(1).alias("x")))
