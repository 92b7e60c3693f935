"""Folders listed and decoded by tasks."""

import os
import random
import struct
import zlib

import pytest

from attrspark.functions.names import DIRECTORY_IMAGE_SUFFIXES
from attrspark.plans import inputs as IN
from attrspark.sources.images import _by_image_source, decoded_images, image_files
from attrspark.sources.listing import files_below

from helpers import palette_png, png_bytes


def chunk(name, body):
    return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))


def filtered_png(draw, width, height, kind, filters, extra=b"", pixels=None):
    channels = {0: 1, 2: 3, 6: 4}[kind]
    rows = b"".join(bytes([draw.choice(filters)]) + draw.randbytes(width * channels) for _ in range(height))
    body = zlib.compress(rows) if pixels is None else pixels
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0))
    parts = chunk(b"IDAT", body[:40]) + chunk(b"IDAT", body[40:])
    return b"\x89PNG\r\n\x1a\n" + head + extra + parts + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("forms")
    (root / "deep" / "er x").mkdir(parents=True)
    (root / "_hidden").mkdir()
    draw = random.Random(5)
    for kind in (0, 2, 6):
        for filters in ([0], [1], [2], [3], [4], [0, 1, 2], [0, 1, 2, 3, 4]):
            for width, height in ((23, 17), (1, 30), (30, 1)):
                name = f"k{kind}_{''.join(map(str, filters))}_{width}.png"
                (root / name).write_bytes(filtered_png(draw, width, height, kind, filters))
    (root / "deep" / "er x" / "a b%20#é[x].PNG").write_bytes(png_bytes(20, 20, "RGBA"))
    (root / "deep" / "clear.png").write_bytes(filtered_png(draw, 9, 9, 2, [0], chunk(b"tRNS", bytes(6))))
    (root / "deep" / "[p]*.png").write_bytes(palette_png(5, 6))
    (root / "deep" / "junk.jpeg").write_bytes(b"junk")
    (root / "_hidden" / "a.png").write_bytes(png_bytes(4, 4, "L"))
    (root / "empty.png").write_bytes(b"")
    os.symlink(root / "gone", root / "link.png")
    return str(root)


def by_path(df):
    return sorted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect())


def test_decodes_as_the_image_source_does(spark, folder):
    expected = _by_image_source(spark, folder, DIRECTORY_IMAGE_SUFFIXES)
    assert len(by_path(expected)) == 67
    assert by_path(decoded_images(spark, folder)) == by_path(expected)


def test_lists_as_the_file_source_does(spark, folder):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    expected = by_path(files.select("path", "length", "content"))
    assert by_path(image_files(spark, folder).select("path", "length", "content")) == expected
    one = image_files(spark, f"{folder}/k0_0_1.png")
    assert [r["id"] for r in one.collect()] == ["k0_0_1"]
    assert image_files(spark, f"{folder}/k0_*").count() == 21


def test_damaged_pixels_are_an_error_row(spark, tmp_path):
    draw = random.Random(6)
    (tmp_path / "short.png").write_bytes(filtered_png(draw, 9, 9, 2, [0], pixels=zlib.compress(b"\x00" * 50)))
    (tmp_path / "bad.png").write_bytes(filtered_png(draw, 9, 9, 2, [0], pixels=b"no zlib data" * 9))
    (tmp_path / "fine.png").write_bytes(png_bytes(9, 9, "L"))
    got = {r["id"]: (r["width"], r["error"]) for r in decoded_images(spark, str(tmp_path)).collect()}
    assert got == {"short": (None, "image_load_failed"), "bad": (None, "image_load_failed"), "fine": (9, None)}


def test_small_files_share_tasks(spark, tmp_path):
    for n in range(300):
        (tmp_path / f"{n}.png").write_bytes(png_bytes(3, 3, "L"))
    cores = spark.sparkContext.defaultParallelism
    images = decoded_images(spark, str(tmp_path))
    assert images.rdd.getNumPartitions() <= cores
    assert images.where("error IS NULL").count() == 300


def test_small_files_read_share_tasks(spark, tmp_path):
    for n in range(300):
        (tmp_path / f"{n}.png").write_bytes(b"%d" % n)
    files = image_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(int(r["content"]) for r in files.collect()) == list(range(300))


def test_the_driver_lists_no_files(spark, folder):
    """No file index of Spark over the folder: what is read are lists in Parquet."""
    assert not [f for f in files_below(spark, folder, (".png",)).inputFiles() if folder in f]
    assert not [f for f in decoded_images(spark, f"{folder}/k*").inputFiles() if folder in f]
    assert not [f for f in image_files(spark, folder).inputFiles() if folder in f]


def test_files_are_written_by_several_tasks(spark):
    part = spark.range(400).selectExpr("id AS p_partkey", "int(id % 4) AS p_size")
    folder = IN.picture_folder(spark, part)
    assert len(list(os.scandir(folder))) == 8
    assert decoded_images(spark, folder).count() == 320
