"""Whole jobs on small files: resume, cache, errors, tags."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from attrspark.operators.cache import CacheTable
from attrspark.operators.scorers import IMAGE_MISSING, ModelExtractor
from attrspark.plans.jobs import Resume, dataset_job, directory_job, in_waves, shard_job, shard_report
from attrspark.session import scratch_path
from attrspark.sources.tables import read_results
from attrspark.sources.tar_shard import shard_errors, tar_members
from attrspark.vocabulary import IMAGE_VOCABULARY

from helpers import png_bytes, write_tar

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FirstOption:
    """Every attribute gets its first option; content 'corrupt' cannot be read."""

    def setup(self):
        self.cells = [0.0] * IMAGE_VOCABULARY.size
        for a in IMAGE_VOCABULARY.attributes:
            self.cells[a.start] = 9.0

    def score(self, inputs):
        if any(x == b"corrupt" for x in inputs):
            raise ValueError(IMAGE_MISSING)
        return [self.cells for _ in inputs]


@pytest.fixture
def images():
    return ModelExtractor(FirstOption(), missing=IMAGE_MISSING)


@pytest.fixture(scope="module")
def shards(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shards")
    write_tar(folder / "a.tar", [
        ("item_1_a.jpg", b"one"), ("item_1_a.txt", "1girl, blé hair".encode()),
        ("item_2_a.txt", b"a teen with red hair"),
        ("item_3_a.jpg", b"corrupt"), ("item_3_a.txt", b"tag"),
        ("item_4_a.jpg", b"four"), ("item_4_a.txt", b""),
        ("item_5_a.txt", b""),
    ])
    write_tar(folder / "b.tar", [("item_6_a.png", b"one"), ("other_1_a.jpg", b"x")])
    return str(folder)


def rows_of(spark, path):
    return {r["id"]: r for r in read_results(spark, path).collect()}


def test_shard_job(spark, shards, images):
    path = scratch_path(spark, "out")
    summary = shard_job(spark, shards, path, images)
    rows = rows_of(spark, path)
    assert sorted(rows) == [f"item_{n}" for n in range(1, 7)]
    assert {k: r["source"] for k, r in rows.items()} == {
        "item_1": "image", "item_2": "text", "item_3": "image", "item_4": "image", "item_5": "text", "item_6": "image"
    }
    assert rows["item_1"]["attributes"]["Dress"] == "casual"
    assert rows["item_1"]["tags"]["raw_tags"] == ["1girl", "blé hair"]
    assert rows["item_2"]["attributes"]["Hair_Color"] == "red"
    # A corrupt image is an error row that keeps its tags.
    assert rows["item_3"]["error"] == IMAGE_MISSING and rows["item_3"]["tags"]["tag_count"] == 1
    assert rows["item_3"]["attributes"]["Age"] is None
    # No tags for an image with an empty text; one empty tag for an empty text alone.
    assert rows["item_4"]["tags"] is None and rows["item_5"]["tags"]["raw_tags"] == [""]
    assert rows["item_6"]["tags"] is None
    assert {k: summary[k] for k in ("total", "successful", "failed", "errors", "computed", "cache_hits")} == {
        "total": 6, "successful": 4, "failed": 2, "errors": 1, "computed": 5, "cache_hits": 0
    }
    assert summary["samples_per_second"] > 0
    text = "\n".join(r[0] for r in spark.read.text(path).collect())
    assert "blé" in text and '"error":null' in text


def test_running_in_parts_equals_running_once(spark, shards, images):
    whole, parts = scratch_path(spark, "out"), scratch_path(spark, "out")
    shard_job(spark, shards, whole, images)
    assert shard_job(spark, shards, parts, images, samples=2)["total"] == 2
    assert shard_job(spark, shards, parts, images, samples=3)["total"] == 3
    assert shard_job(spark, shards, parts, images)["total"] == 1
    assert shard_job(spark, shards, parts, images)["total"] == 0
    a, b = read_results(spark, whole).drop("processing_time"), read_results(spark, parts).drop("processing_time")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert sorted(rows_of(spark, parts)) == sorted(rows_of(spark, whole))


def test_waves(spark, shards, images):
    path = scratch_path(spark, "out")
    run = lambda n: shard_job(spark, shards, path, images, samples=n)
    first = in_waves(run, 2, samples=3)
    assert first["total"] == 3 and len(rows_of(spark, path)) == 3
    rest = in_waves(run, 2)
    assert rest["total"] == 3 and rest["errors"] + first["errors"] == 1
    assert read_results(spark, path).count() == 6
    assert in_waves(run, 2)["total"] == 0
    with pytest.raises(ValueError):
        in_waves(run, 0)


def test_starting_over_replaces_the_output(spark, shards, images):
    path = scratch_path(spark, "out")
    shard_job(spark, shards, path, images, samples=3)
    assert shard_job(spark, shards, path, images, samples=2, resume=Resume("none"))["total"] == 2
    assert read_results(spark, path).count() == 2


def test_cursor_resume(spark, shards, images):
    path = scratch_path(spark, "out")
    shard_job(spark, f"{shards}/a.tar", path, images, samples=1)
    done = shard_job(spark, f"{shards}/a.tar", path, images, resume=Resume("cursor", "item_3"))
    assert done["total"] == 2 and sorted(rows_of(spark, path)) == ["item_1", "item_4", "item_5"]
    # Over several shards the order is shard, then place in it.
    both = scratch_path(spark, "out")
    shard_job(spark, shards, both, images, samples=1)
    assert shard_job(spark, shards, both, images, resume=Resume("cursor", "item_5"))["total"] == 1
    assert sorted(rows_of(spark, both)) == ["item_1", "item_6"]
    with pytest.raises(ValueError):
        shard_job(spark, shards, path, images, resume=Resume("cursor", "item_77"))
    with pytest.raises(ValueError):
        Resume("cursor")
    with pytest.raises(ValueError):
        Resume("sometimes")


def test_shard_job_with_cache(spark, shards, images):
    cache = CacheTable(spark, scratch_path(spark, "cache"))
    first = shard_job(spark, shards, scratch_path(spark, "out"), images, cache=cache)
    assert first["cache_hits"] == 0
    # item_1 and item_6 hold the same bytes; the corrupt image is not cached.
    assert cache.read().count() == 4
    path = scratch_path(spark, "out")
    second = shard_job(spark, shards, path, images, cache=cache)
    assert second["cache_hits"] == 5 and second["computed"] == 0 and second["errors"] == 1
    rows = rows_of(spark, path)
    assert rows["item_6"]["attributes"]["Dress"] == "casual"
    assert rows["item_2"]["attributes"]["Hair_Color"] == "red"
    assert rows["item_1"]["tags"]["tag_count"] == 2


def test_shard_report(spark, shards, images):
    row = shard_report(spark, shards, "item").first()
    assert (row["total_files"], row["image_files"], row["text_files"], row["unique_ids"]) == (10, 5, 5, 6)
    path = scratch_path(spark, "out")
    shard_job(spark, shards, path, images, samples=2)
    row = shard_report(spark, shards, "item", path).first()
    assert (row["total"], row["processed"], row["remaining"]) == (6, 2, 4)


DATASET = [
    ("1", None, (b"img",), ["1girl", "red hair"], None, None, None),
    ("2", None, (b"corrupt",), [], "blue_eyes 1boy", None, None),
    ("3", None, None, None, "", "a teen", None),
    ("4", None, None, None, None, None, "blonde hair"),
    ("5", None, None, None, None, None, None),
    (None, "x6", None, None, None, "a teen", "unused"),
    (None, None, None, None, None, "elderly", None),
]
DATASET_SCHEMA = (
    "id string, image_id string, image struct<bytes binary>, general array<string>, "
    "tag_string_general string, text string, caption string"
)


@pytest.mark.parametrize("cached", [False, True])
def test_dataset_job(spark, images, cached):
    df = spark.createDataFrame(DATASET, DATASET_SCHEMA)
    path = scratch_path(spark, "out")
    cache = CacheTable(spark, scratch_path(spark, "cache")) if cached else None
    summary = dataset_job(df, path, images, cache=cache)
    rows = rows_of(spark, path)
    (made,) = [k for k in rows if k.startswith("row_")]
    assert {k: r["source"] for k, r in rows.items()} == {
        "1": "image", "2": "image", "3": "text", "4": "caption", "5": "unknown", "x6": "text", made: "text"
    }
    assert rows["5"]["error"] == "no_input" and rows["5"]["attributes"]["Age"] is None
    assert rows["1"]["attributes"]["Age"] == "child" and rows["1"]["tags"]["tag_count"] == 2
    assert rows["2"]["error"] == IMAGE_MISSING and rows["2"]["tags"]["raw_tags"] == ["blue_eyes", "1boy"]
    assert rows["3"]["tags"] is None and rows["4"]["attributes"]["Hair_Color"] == "blonde"
    assert summary["total"] == 7 and summary["errors"] == 2
    again = dataset_job(df, path, images, cache=cache)
    assert again["total"] == 0
    if cached:
        fresh = dataset_job(df, scratch_path(spark, "out"), images, cache=cache)
        assert fresh["cache_hits"] == 5 and fresh["computed"] == 0


def test_dataset_job_without_an_image_extractor(spark):
    df = spark.createDataFrame([("1", b"img", "a teen"), ("2", b"img", None)], "id string, image binary, text string")
    path = scratch_path(spark, "out")
    dataset_job(df, path, None)
    rows = {k: (r["source"], r["attributes"]["Age"], r["error"]) for k, r in rows_of(spark, path).items()}
    assert rows == {"1": ("text", "teen", None), "2": ("unknown", None, "no_input")}


@pytest.mark.parametrize("memoise", [False, True])
def test_dataset_job_on_texts_only(spark, memoise):
    df = spark.createDataFrame([("a teen", 1), ("a teen", 2), ("red hair", 3)], "text string, n int")
    path = scratch_path(spark, "out")
    cache = CacheTable(spark, scratch_path(spark, "cache"))
    summary = dataset_job(df, path, None, order=["n"], samples=3, cache=cache, memoise=memoise)
    assert summary["total"] == 3 and cache.read().count() == 2
    assert len(rows_of(spark, path)) == 3
    assert dataset_job(df.orderBy(F.desc("n")), path, None, order=["n"])["total"] == 0


def test_waves_over_rows_without_input(spark):
    df = spark.createDataFrame([(str(i), None if i == 3 else "a teen") for i in range(40)], "id string, text string")
    path = scratch_path(spark, "out")
    done = in_waves(lambda n: dataset_job(df, path, None, samples=n), 10)
    assert done["total"] == 40 and done["errors"] == 1 and len(rows_of(spark, path)) == 40


def test_waves_over_repeated_and_missing_ids(spark):
    rows = [("a", "a teen"), ("a", "red hair"), ("b", "x"), (None, "one"), (None, "two"), (None, "two"), (None, None), ("c", None)]
    df = spark.createDataFrame(rows, "id string, text string")
    whole, waves = scratch_path(spark, "out"), scratch_path(spark, "out")
    dataset_job(df, whole, None)
    in_waves(lambda n: dataset_job(df, waves, None, samples=n), 1)
    a, b = read_results(spark, whole).drop("processing_time"), read_results(spark, waves).drop("processing_time")
    assert a.count() == len(rows) and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    with pytest.raises(ValueError):
        dataset_job(df, scratch_path(spark, "out"), None, order=["text"], samples=1)


def test_made_ids_stay_when_files_are_added(spark):
    data, path = scratch_path(spark, "in"), scratch_path(spark, "out")
    spark.createDataFrame([("old",)] * 3, "text string").coalesce(1).write.parquet(data)
    assert dataset_job(spark.read.parquet(data), path, None)["total"] == 3
    more = spark.createDataFrame([(f"new {i} " + "x" * 500,) for i in range(20)], "text string")
    more.coalesce(1).write.mode("append").parquet(data)
    assert dataset_job(spark.read.parquet(data), path, None)["total"] == 20
    assert dataset_job(spark.read.parquet(data), path, None)["total"] == 0
    assert len(rows_of(spark, path)) == 23


def test_an_id_in_several_shards_is_one_item(spark, tmp_path, images):
    for shard in "ab":
        write_tar(tmp_path / f"{shard}.tar", [(f"item_{i}_x.jpg", shard.encode()) for i in range(4)])
    whole, waves = scratch_path(spark, "out"), scratch_path(spark, "out")
    assert shard_job(spark, str(tmp_path), whole, images)["total"] == 4
    assert in_waves(lambda n: shard_job(spark, str(tmp_path), waves, images, samples=n), 3)["total"] == 4


def test_damaged_shards_and_unreadable_members(spark, tmp_path, images):
    entries = [(f"item_{{}}{i}_x.txt", b"a teen" * 100) for i in range(10)]
    for shard in "abcd":
        write_tar(tmp_path / f"{shard}.tar", [(n.format(shard), c) for n, c in entries])
    block = 512 + 1024

    def damage(shard, change):
        path = tmp_path / f"{shard}.tar"
        path.write_bytes(change(bytearray(path.read_bytes())))

    def checksum(raw):
        raw[4 * block + 150] ^= 1
        return raw

    damage("b", checksum)
    damage("c", lambda raw: raw[: 5 * block + 100])  # inside a header
    damage("d", lambda raw: raw[: 5 * block + 512 + 50])  # inside content
    found = {r["tar"][-5]: r["offset"] for r in shard_errors(spark, str(tmp_path)).collect()}
    assert found == {"b": 4 * block, "c": 5 * block, "d": 5 * block}
    path = scratch_path(spark, "out")
    done = shard_job(spark, str(tmp_path), path, images)
    assert done["total"] == 10 + 4 + 5 + 6 and done["errors"] == 1
    assert rows_of(spark, path)["item_d5"]["error"]
    assert tar_members(spark, str(tmp_path)).count() == 25


def test_directory_job(spark, tmp_path, images):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.PNG").write_bytes(png_bytes(40, 40, "RGB"))
    (tmp_path / "sub" / "b.jpg").write_bytes(b"corrupt")
    (tmp_path / "c.txt").write_bytes(b"text" * 1000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")  # what is too long is not read
    for cache in (None, CacheTable(spark, scratch_path(spark, "cache"))):
        path = scratch_path(spark, "out")
        summary = directory_job(spark, str(tmp_path), path, images, (".png", ".jpg"), cache)
        rows = rows_of(spark, path)
        assert sorted(rows) == ["a", "b"] and summary["errors"] == 1
        assert rows["a"]["attributes"]["Age"] == "child" and rows["b"]["error"] == IMAGE_MISSING
    assert cache.read().count() == 1
    assert rows["a"]["source"] == "unknown"
    spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
