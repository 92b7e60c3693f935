"""Image folders: recursive listing by suffix, and decoding.

Folders are listed and files read by tasks; the driver holds neither names nor contents. Plain PNG
files (see `png`) are decoded in bulk, in Python; images of any other form go through Spark's image
source, whose reader prepares a new serializer for every file (milliseconds of a core each).
File sources skip names that begin with `_` or `.`, and empty files.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.functions.images import mode_name
from attrspark.functions.names import DIRECTORY_IMAGE_SUFFIXES, has_suffix, stem
from attrspark.session import scratch_path
from attrspark.sources.files import open_file
from attrspark.sources.listing import READ_BYTES, as_uri, file_contents, files_below, read_file, spread
from attrspark.sources.png import PLAIN, SIGNATURE, pixels, plain_parts

#: How files of known image formats begin: BMP, GIF, JPEG, TIFF, WBMP. Others are no images.
BEGINNINGS = (b"BM", b"GIF8", b"\xff\xd8", b"II", b"MM", b"\x00\x00", SIGNATURE)
#: Up to so many images of other forms are given to the image source by name; with more of them
#: it reads the folder.
BY_NAME = 20_000
LOAD_FAILED = "image_load_failed"
_KINDS = "path string, length long, origin string, kind string"
_DECODED = "width int, height int, mode string, data binary, error string"


def name_glob(suffixes: Iterable[str]) -> str:
    """A file name pattern for any of the suffixes in any case."""
    cased = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s) for s in suffixes]
    return "*{" + ",".join(cased) + "}"


def image_files(
    spark: SparkSession, path: str, suffixes: Iterable[str] = DIRECTORY_IMAGE_SUFFIXES
) -> DataFrame:
    """path, id (file stem), length and content of image files, suffixes in any case.

    Other files are left out by name before anything is read, and `content` is read only
    when a query uses it.
    """
    suffixes = tuple(suffixes)
    files = files_below(spark, path, suffixes).where(has_suffix(F.col("path"), suffixes))

    @F.arrow_udf("binary")
    def read(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from file_contents(paths)

    return spread(files).select("path", stem(F.col("path")).alias("id"), "length", read("path").alias("content"))


def _kind(path: str, length: int) -> str:
    """'plain' for a plain PNG, 'none' for what is no image, else 'other'."""
    with open_file(path) as file:
        if plain_parts(file, length) is not None:
            return "plain"
        file.seek(0)
        return "other" if file.read(8).startswith(BEGINNINGS) else "none"


def _with_kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, lengths = (c.to_pylist() for c in batch.columns)
        kinds = [_kind(p, n) for p, n in zip(paths, lengths)]
        columns = [batch.column(0), batch.column(1), pa.array(map(as_uri, paths), pa.string()), pa.array(kinds, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "origin", "kind"])


def _decoded(path: str, kind: str) -> dict:
    if kind == "plain":
        content = read_file(path)
        parts = plain_parts(io.BytesIO(content), len(content))
        data = None if parts is None else pixels(content, *parts)
        if data is not None:
            return {"width": parts[0], "height": parts[1], "mode": PLAIN[parts[2]][0], "data": data, "error": None}
    return {"width": None, "height": None, "mode": None, "data": None, "error": LOAD_FAILED}


def _by_image_source(spark: SparkSession, path: str | list[str], suffixes: tuple[str, ...]) -> DataFrame:
    images = (
        spark.read.format("image")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob(suffixes))
        .option("dropInvalid", "false")
        .load(path)
    )
    origin = F.col("image.origin")
    readable = F.col("image.height") >= 0
    return images.where(has_suffix(origin, suffixes)).select(
        origin.alias("path"),
        stem(origin).alias("id"),
        F.when(readable, F.col("image.width")).alias("width"),
        F.when(readable, F.col("image.height")).alias("height"),
        F.when(readable, mode_name(F.col("image.mode"))).alias("mode"),
        F.when(readable, F.col("image.data")).alias("data"),
        F.when(~readable, F.lit(LOAD_FAILED)).alias("error"),
    )


def decoded_images(
    spark: SparkSession, path: str, suffixes: Iterable[str] = DIRECTORY_IMAGE_SUFFIXES
) -> DataFrame:
    """path, id, width, height, mode, data; an unreadable file has `error` set instead.

    The first bytes of each file are read to tell its form when this is called.
    """
    suffixes = tuple(suffixes)
    kinds = scratch_path(spark, "image-kinds")
    files = spread(files_below(spark, path, suffixes).where(has_suffix(F.col("path"), suffixes)))
    files.mapInArrow(_with_kinds, _KINDS).write.parquet(kinds)
    found = spark.read.schema(_KINDS).parquet(kinds)
    other = [r.path for r in found.where("kind = 'other'").select("path").limit(BY_NAME + 1).collect()]
    if len(other) > BY_NAME:
        return _by_image_source(spark, path, suffixes)

    @F.arrow_udf(_DECODED)
    def decode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct(
            [("width", pa.int32()), ("height", pa.int32()), ("mode", pa.string()), ("data", pa.binary()), ("error", pa.string())]
        )
        for paths, forms in batches:
            held, size = [], 0
            for one, form in zip(paths.to_pylist(), forms.to_pylist()):
                held.append(_decoded(one, form))
                size += len(held[-1]["data"] or b"")
                if size >= READ_BYTES:
                    yield pa.array(held, kind)
                    held, size = [], 0
            if held:
                yield pa.array(held, kind)

    rows = spread(found.where("kind <> 'other'")).withColumn("image", decode("path", "kind"))
    rows = rows.select(F.col("origin").alias("path"), stem(F.col("origin")).alias("id"), "image.*")
    if other:
        # Names are no patterns.
        names = [re.sub(r"([\\*?\[\]{}])", r"\\\1", name) for name in other]
        rows = rows.unionByName(_by_image_source(spark, names, suffixes))
    return rows
