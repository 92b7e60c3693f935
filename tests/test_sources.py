"""Tar shards, image folders, result files."""

import random

import pytest
from pyspark.sql import functions as F

from attrspark.functions.images import is_valid
from attrspark.functions.names import DIRECTORY_JOB_SUFFIXES
from attrspark.operators.pairing import pair_by_id, pair_by_stem, pair_positions, shard_stats
from attrspark.sources.files import list_files
from attrspark.sources.images import decoded_images, image_files
from attrspark.sources.tables import dataset
from attrspark.sources.tar_shard import by_stretch, tar_members, with_digests, with_texts

from helpers import palette_png, png_bytes, write_tar

LONG = "item_7_" + "x" * 150
ENTRIES = [
    ("folder", None),
    ("folder/item_1_a.jpg", b"image one"),
    ("folder/item_1_a.txt", b" one \xff text \n"),
    ("item_2_b.txt", b""),
    ("item_3_c.PNG", b"image three"),
    ("note.txt", b"no prefix"),
    ("item_1_z.jpg", b"second image"),
    (f"{LONG}.jpg", b"long"),
    (f"{LONG}.txt", "größe, 大きい".encode()),
    ("item_9_q.json", b"{}"),
]


@pytest.fixture(scope="module", params=["plain.tar", "packed.tar.gz"])
def shard(request, tmp_path_factory):
    path = tmp_path_factory.mktemp("tar") / request.param
    return write_tar(path, ENTRIES, "w:gz" if request.param.endswith("gz") else "w")


def test_members(spark, shard):
    rows = tar_members(spark, shard).orderBy("offset").collect()
    assert [(r["name"], r["size"]) for r in rows] == [(n, len(c)) for n, c in ENTRIES if c is not None]
    assert {r["tar"] for r in rows} == {shard}
    held = tar_members(spark, shard, content=True).orderBy("offset").collect()
    assert [r["content"] for r in held] == [c for _, c in ENTRIES if c is not None]


def test_pairs_read_their_texts(spark, shard):
    pairs = pair_positions(tar_members(spark, shard), "item").withColumn("at", F.least("image_at", "text_at"))
    read = with_texts(by_stretch(pairs, "at", 2), "text_at")
    got = {r["id"]: (r["image_at"] is not None, r["text"]) for r in read.collect()}
    assert got == {
        "item_1": (True, " one  text \n"),
        "item_2": (False, ""),
        "item_3": (True, None),
        "item_7": (True, "größe, 大きい"),
    }


def test_digests(spark, shard):
    import hashlib

    pairs = pair_positions(tar_members(spark, shard), "item")
    rows = with_digests(by_stretch(pairs, "image_at", 2), "image_at", "image", "d")
    rows = with_digests(rows, "text_at", "text", "t").collect()
    got = {r["id"]: (r["d"], r["t"]) for r in rows}
    assert got["item_1"][0] == hashlib.md5(b"image:image one").hexdigest()
    assert got["item_1"][1] == hashlib.md5(b"text: one  text \n").hexdigest()
    assert got["item_2"] == (None, hashlib.md5(b"text:").hexdigest())


def test_a_folder_of_shards(spark, tmp_path):
    for n in range(3):
        write_tar(tmp_path / f"s{n}.tar", [(f"item_{n}_a.txt", b"x" * n)])
    (tmp_path / "other.dat").write_bytes(b"no tar")
    rows = tar_members(spark, str(tmp_path)).collect()
    assert sorted((r["name"], r["size"]) for r in rows) == [(f"item_{n}_a.txt", n) for n in range(3)]
    assert tar_members(spark, f"file:{tmp_path}").count() == 3


def test_missing_paths(spark, tmp_path):
    with pytest.raises(Exception, match="not found"):
        tar_members(spark, str(tmp_path / "gone.tar")).count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        image_files(spark, str(tmp_path / "gone"))
    with pytest.raises(FileNotFoundError):
        list_files(str(tmp_path / "gone"), (".tar",))


def test_pair_forms(spark):
    rows = [
        (0, "item_1_a.jpg", "i0"), (1, "item_1_a.txt", " t1 "), (2, "item_1_b.jpg", "i2"), (3, "item_1_a.txt", "t3"),
        (4, "item_2_a.bmp", "i4"), (5, "item_2_a.txt", "t5"), (6, "item_3_a.txt", "t6"),
    ]
    df = spark.createDataFrame(rows, "pos int, name string, v string")
    by_id = pair_by_id(df, "item", F.col("v"), F.col("v"))
    got = {r["id"]: (r["image"], r["text"]) for r in by_id.collect()}
    assert got == {"item_1": ("i0", " t1 "), "item_2": ("i4", "t5"), "item_3": (None, "t6")}
    # A full outer join of the first halves says the same.
    kinds = df.withColumn("id", F.regexp_extract("name", "^(item_[^_]*)", 1))
    images = kinds.where(~F.col("name").endswith(".txt")).groupBy("id").agg(F.min_by("v", "pos").alias("image"))
    texts = kinds.where(F.col("name").endswith(".txt")).groupBy("id").agg(F.min_by("v", "pos").alias("text"))
    outer = images.join(texts, "id", "full_outer")
    assert {r["id"]: (r["image"], r["text"]) for r in outer.collect()} == got
    # By stem: the last half counts, and .bmp is no image there.
    by_stem = pair_by_stem(df, F.col("v"), F.col("v")).collect()
    assert [tuple(r) for r in by_stem] == [("item_1_a", "i0", "t3")]


def test_one_id_with_a_third_of_all_members(spark):
    draw = random.Random(3)
    rows = []
    for pos in range(3000):
        n = 7 if pos % 3 == 0 else draw.randrange(8, 500)
        rows.append((pos, f"d/item_{n}_{pos % 5}.{draw.choice(['jpg', 'txt', 'PNG', 'dat'])}", pos % 11))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "pos int, name string, size long").repartition(6)
    firsts: dict = {}
    for pos, name, _ in sorted(rows):
        number, kind = name.split("_")[1], name.rsplit(".", 1)[1].lower()
        if kind != "dat":
            slot = "text" if kind == "txt" else "image"
            firsts.setdefault(f"item_{number}", {}).setdefault(slot, pos)
    expected = {k: (v.get("image"), v.get("text")) for k, v in firsts.items()}
    found = pair_positions(df, "item", "pos", ("id",)).collect()
    assert {r["id"]: (r["image_at"], r["text_at"]) for r in found} == expected
    pairs = pair_by_id(df, "item", F.col("pos"), F.col("pos")).collect()
    assert {r["id"]: (r["image"], r["text"]) for r in pairs} == expected
    stats = shard_stats(df, "item").first()
    assert stats["total_files"] == 3000
    assert stats["unique_ids"] == len({name.split("_")[1] for _, name, _ in rows})
    assert stats["image_files"] == sum(name.lower().endswith(("jpg", "png")) for _, name, _ in rows)


@pytest.fixture(scope="module")
def pictures(tmp_path_factory):
    folder = tmp_path_factory.mktemp("pics")
    (folder / "deep").mkdir()
    (folder / "a.PNG").write_bytes(png_bytes(40, 50, "RGB"))
    (folder / "small.png").write_bytes(png_bytes(20, 50, "L"))
    (folder / "deep" / "rgba.png").write_bytes(png_bytes(64, 64, "RGBA"))
    (folder / "palette.png").write_bytes(palette_png(40, 40))
    (folder / "junk.jpg").write_bytes(b"junk")
    (folder / "x.webp").write_bytes(b"webp")
    (folder / "text.txt").write_bytes(b"text")
    (folder / "_hidden.png").write_bytes(png_bytes(40, 50, "RGB"))
    return str(folder)


def test_image_files(spark, pictures):
    assert sorted(r["id"] for r in image_files(spark, pictures).select("id").collect()) == [
        "a", "junk", "palette", "rgba", "small", "x"
    ]
    narrow = image_files(spark, pictures, DIRECTORY_JOB_SUFFIXES)
    assert "x" not in [r["id"] for r in narrow.select("id").collect()]
    plan = narrow.select("id", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_decoded_images(spark, pictures):
    df = decoded_images(spark, pictures)
    df = df.withColumn("ok", is_valid(F.col("width"), F.col("height"), F.col("mode")))
    got = {r["id"]: (r["width"], r["height"], r["mode"], r["ok"], r["error"]) for r in df.collect()}
    assert got == {
        "a": (40, 50, "RGB", True, None),
        "small": (20, 50, "L", False, None),
        "rgba": (64, 64, "RGBA", True, None),
        "palette": (40, 40, "RGB", True, None),
        "junk": (None, None, None, False, "image_load_failed"),
        "x": (None, None, None, False, "image_load_failed"),
    }


def test_dataset_splits(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/train")
    spark.range(5).write.parquet(f"{tmp_path}/test")
    assert dataset(spark, str(tmp_path), "train").count() == 3
    assert dataset(spark, str(tmp_path), "test", streaming=True).isStreaming
