"""Query inputs derived from the given tables: captions, members, cache logs and so on.

Each is a column expression over a whole table; the oracle builds the same in SQL.
"""

from __future__ import annotations

import io
import os
import struct
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.operators.zero_shot import LabelVectors
from attrspark.session import scratch_path
from attrspark.vocabulary import ATTRIBUTE_OPTIONS, IMAGE_VOCABULARY

LOGIT_SCALE = 5.0
DOCS_PER_SHARD = 250
FILES_PER_TASK = 2_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def captions(customer: DataFrame) -> DataFrame:
    """c_custkey, caption, tags, general, tag_string_general."""
    k = F.col("c_custkey")
    color = pick(ATTRIBUTE_OPTIONS["Hair_Color"], k % 7)
    eye = pick(ATTRIBUTE_OPTIONS["Eye_Color"], k % 5)
    caption = F.format_string(
        "a %s %s with %s %s hair and %s eyes",
        pick(ATTRIBUTE_OPTIONS["Age"], k % 5),
        pick(ATTRIBUTE_OPTIONS["Gender"], k % 3),
        pick(ATTRIBUTE_OPTIONS["Hair_Length"], k % 4),
        color,
        eye,
    )
    caption = F.when(k % 13 == 0, F.lit(None)).when(k % 11 == 0, "   ").otherwise(caption)
    outfits = ("school uniform", "cowboy hat", "red jacket", "cat ears", "Hero_(character)")
    tags = F.filter(
        F.array(
            F.when(k % 2 == 0, "1girl").otherwise("1boy"),
            F.concat(color, F.lit(" hair")),
            F.when(k % 7 == 0, ""),
            F.concat(eye, F.lit(" eyes")),
            pick(outfits, k % 5),
            F.when(k % 6 == 0, "main character"),
        ),
        lambda t: t.isNotNull(),
    )
    blanks = F.array_join(F.transform(tags, lambda t: F.replace(t, F.lit(" "), F.lit("_"))), " ")
    text = F.when(k % 17 == 0, "").when(k % 3 == 0, blanks).otherwise(F.array_join(tags, ", "))
    general = F.when(k % 4 == 0, F.lit(None)).when(k % 19 == 0, F.array().cast("array<string>"))
    return customer.select(
        k,
        caption.alias("caption"),
        text.alias("tag_string_general"),
        general.otherwise(tags).alias("general"),
    )


def members(documents: DataFrame) -> DataFrame:
    """Shard members: doc_id, pos, name, payload (text, or a marker for image bytes), size."""
    d = F.col("doc_id")
    digits = F.md5(d.cast("string"))
    base = F.format_string("shard/item_%s_%s", d.cast("string"), digits)
    marker = F.concat(F.when(d % 11 == 0, "bad:").otherwise("img:"), digits)
    ending = F.when(d % 3 == 0, ".JPG").otherwise(".jpg")

    def row(pos: Column, name: Column, payload: Column, when: Column) -> Column:
        return F.when(
            when, F.struct(pos.alias("pos"), name.alias("name"), payload.alias("payload"))
        )

    rows = F.array(
        row(d * 2, F.concat(base, ending), marker, d % 5 != 0),
        row(d * 2 + 1, F.concat(base, F.lit(".txt")), F.col("text"), d % 7 != 0),
        row(d + 1_000_000_000, F.format_string("note_%s.txt", d.cast("string")), F.col("text"), d % 50 == 0),
        row(d + 2_000_000_000, F.format_string("shard/item_%s.jpg", d.cast("string")), marker, d % 50 == 1),
        row(
            d + 3_000_000_000, F.format_string("shard/item_%s_second.jpg", d.cast("string")), marker, d % 50 == 2
        ),
    )
    return (
        documents.select(d, F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("m"))
        .select("doc_id", "m.*")
        .withColumn("size", F.octet_length("payload").cast("bigint"))
    )


def pictured(documents: DataFrame) -> DataFrame:
    """doc_id, id and nullable image (few different ones, some damaged), text, caption."""
    d = F.col("doc_id")
    marker = F.concat(F.when(d % 11 == 0, "bad:").otherwise("img:"), F.md5((d % 100).cast("string")))
    return documents.select(
        d,
        d.cast("string").alias("id"),
        F.when(d % 3 == 0, F.struct(marker.cast("binary").alias("bytes"))).alias("image"),
        F.when(d % 2 == 0, F.col("text")).alias("text"),
        F.when(d % 5 == 0, F.concat(F.lit("caption "), F.col("lang"))).alias("caption"),
    )


def done_ids(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("string").alias("id"))


def multi_source(documents: DataFrame) -> DataFrame:
    """doc_id and nullable image, text, caption."""
    d = F.col("doc_id")
    return documents.select(
        d,
        F.when(d % 3 == 0, F.struct(F.md5(d.cast("string")).cast("binary").alias("bytes"))).alias("image"),
        F.when(d % 2 == 0, F.col("text")).alias("text"),
        F.when(d % 5 == 0, F.concat(F.lit("caption "), F.col("lang"))).alias("caption"),
    )


def label_vectors(embeddings: DataFrame) -> LabelVectors:
    """Option with ordinal o has the vector with vec_id o."""
    labels = embeddings.where(F.col("vec_id") < IMAGE_VOCABULARY.size)
    return LabelVectors.from_frame(labels.select(F.col("vec_id").alias("ordinal"), F.col("embedding").alias("vector")))


def cache_log(events: DataFrame, *more: str) -> DataFrame:
    """hash_key, attributes (JSON text), ts, seq, and `more` columns of the events."""
    return events.select(
        F.md5(F.col("user_id").cast("string")).alias("hash_key"),
        F.col("props").alias("attributes"),
        "ts",
        F.col("event_id").alias("seq"),
        *more,
    )


def prior_lines(conversations: DataFrame) -> DataFrame:
    """conv_id, turn and an output line as an earlier run may have left it."""
    c, t = F.col("conv_id"), F.col("turn")
    made = F.format_string("%s-%s", c.cast("string"), t.cast("string"))
    line = (
        F.when((c % 50 == 0) & (t == 0), "[1]")
        .when((c % 50 == 1) & (t == 0), "5")
        .when(t % 5 == 4, "{bad")
        .when(t % 3 == 1, F.concat(F.lit('{"item_id":"'), made, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"id":"'), made, F.lit('"}')))
    )
    return conversations.select(c, t, line.alias("value"))


def image_meta(part: DataFrame) -> DataFrame:
    """p_partkey, width, height, mode."""
    k = F.col("p_partkey")
    mode = pick(("RGB", "RGBA", "L", "P"), F.col("p_size") % 4)
    return part.select(
        k,
        (F.lit(16) + k * 37 % 1500).cast("int").alias("width"),
        (F.lit(16) + k * 53 % 1500).cast("int").alias("height"),
        mode.alias("mode"),
    )


def classified(embeddings: DataFrame) -> DataFrame:
    """vec_id, attributes, confidence for every embedding."""
    from attrspark.operators.zero_shot import classify_vectors

    done = classify_vectors(embeddings, "embedding", label_vectors(embeddings), LOGIT_SCALE)
    return done.select("vec_id", "attributes", "confidence")


def results(embeddings: DataFrame) -> DataFrame:
    """Result rows with errors, empty records and cache hits among them."""
    from attrspark.functions.attributes import empty_record

    v = F.col("vec_id")
    record = F.when((v % 19 == 0) | (v % 23 == 0), empty_record()).otherwise(F.col("attributes"))
    return classified(embeddings).select(
        v,
        v.cast("string").alias("id"),
        record.alias("attributes"),
        F.lit("image").alias("source"),
        F.lit(0.0).alias("processing_time"),
        F.when(v % 19 == 0, "boom").alias("error"),
        (v % 3 == 0).alias("hit"),
    )


class MarkerScorer:
    """Scores an image marker by its hex digits: cell o is digit o mod 32, divided by 3."""

    def setup(self) -> None:
        self.size = IMAGE_VOCABULARY.size

    def score(self, inputs: list) -> list[list[float]]:
        found = []
        for content in inputs:
            if not content.startswith(b"img:"):
                raise ValueError("not an image")
            digits = content[4:].decode()
            found.append([int(digits[o % 32], 16) / 3.0 for o in range(self.size)])
        return found


class SizeScorer:
    """Scores a PNG by the width in its header: cell o is digit (width + o) mod 7."""

    def setup(self) -> None:
        self.size = IMAGE_VOCABULARY.size

    def score(self, inputs: list) -> list[list[float]]:
        found = []
        for content in inputs:
            if not content.startswith(b"\x89PNG"):
                raise ValueError("image_load_failed")
            width = int.from_bytes(content[16:20], "big")
            found.append([float((width + o) % 7) for o in range(self.size)])
        return found


def write_shards(rows: DataFrame, folder: str) -> DataFrame:
    """Write member rows as tar shards of `DOCS_PER_SHARD` documents each, by Spark tasks."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, archive, name = None, None, None

        def close() -> None:
            if archive is not None:
                archive.close()
                # A retried task puts its own finished file in place of the first.
                os.replace(name + ".part", name)

        for batch in batches:
            for shard, member, payload in zip(batch["shard"], batch["name"], batch["payload"]):
                if shard != current:
                    close()
                    current, name = shard, f"{folder}/shard-{shard:06d}.tar"
                    archive = tarfile.open(name + ".part", "w")
                content = payload.encode("utf-8")
                info = tarfile.TarInfo(member)
                info.size = len(content)
                archive.addfile(info, io.BytesIO(content))
            yield pd.DataFrame({"members": [len(batch)]})
        close()

    placed = rows.withColumn("shard", F.floor(F.col("doc_id") / F.lit(DOCS_PER_SHARD)))
    ordered = placed.repartition("shard").sortWithinPartitions("shard", "pos")
    return ordered.select("shard", "name", "payload").mapInPandas(write, "members long")


def local_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, as a path tasks can open directly."""
    path = scratch_path(spark, label)
    path = path[5:] if path.startswith("file:") else path
    os.makedirs(path, exist_ok=True)
    return path


def shard_folder(spark: SparkSession, documents: DataFrame) -> str:
    folder = local_folder(spark, "shards")
    write_shards(members(documents), folder).agg(F.sum("members")).collect()
    return folder


# PNG colour types and bytes per pixel.
PNG_TYPES = {"L": (0, 1), "RGB": (2, 3), "RGBA": (6, 4)}


def png_bytes(width: int, height: int, mode: str) -> bytes:
    """A plain PNG image of one colour."""
    kind, channels = PNG_TYPES[mode]

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    rows = (b"\x00" + b"\x7f" * (width * channels)) * height
    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", head)
        + chunk(b"IDAT", zlib.compress(rows, 1))
        + chunk(b"IEND", b"")
    )


def picture_files(part: DataFrame) -> DataFrame:
    """p_partkey, path below the folder, width, height, mode; mode 'junk' is no image at all."""
    k = F.col("p_partkey")
    ending = pick((".png", ".PNG", ".png", ".jpeg", ".txt"), k % 5)
    mode = pick(("RGB", "RGBA", "L", "junk"), F.col("p_size") % 4)
    return part.select(
        k,
        F.format_string("d%s/pic_%s%s", (k % 8).cast("string"), k.cast("string"), ending).alias("path"),
        (F.lit(16) + k * 37 % 61).cast("int").alias("width"),
        (F.lit(16) + k * 53 % 61).cast("int").alias("height"),
        mode.alias("mode"),
    )


def picture_folder(spark: SparkSession, part: DataFrame) -> str:
    """Write one file per part row, by Spark tasks."""
    folder = local_folder(spark, "pictures")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = set()
        for batch in batches:
            for path, width, height, mode in zip(
                batch["path"], batch["width"], batch["height"], batch["mode"]
            ):
                target = f"{folder}/{path}"
                if os.path.dirname(target) not in made:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    made.add(os.path.dirname(target))
                with open(target, "wb") as file:
                    file.write(b"junk" if mode == "junk" else png_bytes(width, height, mode))
            yield pd.DataFrame({"files": [len(batch)]})

    # Tasks by number of files: by size, so narrow rows would all end up in one or a few.
    tasks = max(-(-part.count() // FILES_PER_TASK), spark.sparkContext.defaultParallelism)
    rows = picture_files(part).select("path", "width", "height", "mode").repartition(tasks, "path")
    rows.mapInPandas(write, "files long").agg(F.sum("files")).collect()
    return folder
