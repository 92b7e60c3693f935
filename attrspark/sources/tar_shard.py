"""Tar shards: a data source that lists members, and readers for their content.

Listing reads headers only and yields narrow rows, so pairing, resuming and limiting
run on the list. Content is read afterwards, by offset, for the items that are still
wanted, and a model scorer reads it inside the Python worker, so image bytes are
neither shuffled nor sent through the JVM.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import tarfile
import time
import zlib
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from attrspark.operators import scorers
from attrspark.operators.scorers import SCORED, Scorer, score_batch, score_batches
from attrspark.sources.files import list_files, open_file
from attrspark.sources.tar_split import split_members

MEMBER_SCHEMA = "tar string, offset bigint, name string, size bigint"
ENDINGS = (".tar", ".tar.gz", ".tgz")

# Shards longer than this are listed by several tasks.
LIST_STRETCH = 4 << 30
# A shard is read by several tasks, each taking the members in a stretch of this length.
READ_STRETCH = 512 << 20
# Content leaves a Python worker in Arrow batches of about this size.
BATCH_BYTES = 16 << 20


def packed(path: str) -> bool:
    return path.lower().endswith((".gz", ".tgz"))


def open_shard(path: str) -> Any:
    """A seekable file object over the uncompressed shard."""
    raw = open_file(path)
    if packed(path):
        return gzip.GzipFile(fileobj=raw)
    return raw


class DamagedShard(ValueError):
    """A shard that does not end as it should; `offset` is where the good part ends."""

    def __init__(self, message: str, offset: int):
        super().__init__(message)
        self.offset = offset


def walk_members(shard: Any) -> Iterator[tarfile.TarInfo]:
    """Regular files in archive order; content is skipped over, memory stays flat.

    After the last good member raises DamagedShard if what follows is not the block of
    zeros that closes an archive: a wrong or cut header, or content that is cut.
    """
    at = 0
    try:
        with tarfile.TarFile(fileobj=shard, mode="r") as archive:
            while (member := archive.next()) is not None:
                archive.members.clear()
                at = member.offset
                if member.isfile():
                    yield member
            at = archive.offset
    except (tarfile.TarError, EOFError, zlib.error, OSError) as failure:
        raise DamagedShard(f"{type(failure).__name__}: {failure}", at) from failure
    # Two blocks of zeros close an archive. A packed one is not unpacked again for the first.
    if not isinstance(shard, gzip.GzipFile):
        shard.seek(at)
    if shard.read(tarfile.BLOCKSIZE) != tarfile.NUL * tarfile.BLOCKSIZE:
        raise DamagedShard("no closing block: a header is wrong or the file is cut", at)


def read_member(shard: Any, offset: int) -> bytes:
    """Content of the member whose header starts at `offset`."""
    shard.seek(offset)
    archive = tarfile.TarFile(fileobj=shard, mode="r")
    member = archive.firstmember
    if member is None:
        raise ValueError(f"no member at offset {offset}")
    content = archive.extractfile(member)
    if content is None:
        raise ValueError(f"member {member.name} is no regular file")
    held = content.read()
    if len(held) != member.size:
        raise ValueError(f"member {member.name} is cut")
    return held


class _Shard(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _ShardReader(DataSourceReader):
    def __init__(self, paths: list[str], content: bool, damage: bool = False):
        self.paths, self.content, self.damage = paths, content, damage

    def partitions(self) -> list[InputPartition]:
        return [_Shard(path) for path in self.paths]

    def read(self, partition: _Shard) -> Iterator[tuple]:
        with open_shard(partition.path) as shard:
            try:
                for member in walk_members(shard):
                    row = (partition.path, member.offset, member.name, member.size)
                    if self.content:
                        shard.seek(member.offset_data)
                        row += (shard.read(member.size),)
                    if not self.damage:
                        yield row
            except DamagedShard as damage:
                if self.damage:
                    yield (partition.path, damage.offset, str(damage), None)


class TarShardSource(DataSource):
    """`spark.read.format("tar_shard")`: members of one shard or of all below a folder.

    `paths`, a JSON list, names shards one by one. Option `content` = true adds the bytes of every member; without it only headers
    are read. `offset` gives the archive order. With `damage` = true the rows are damaged
    shards instead: `offset` where the good part ends, and the error as `name`.
    """

    @classmethod
    def name(cls) -> str:
        return "tar_shard"

    def _content(self) -> bool:
        return self.options.get("content", "false").lower() == "true"

    def schema(self) -> str:
        return MEMBER_SCHEMA + (", content binary" if self._content() else "")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        if "paths" in self.options:
            paths = json.loads(self.options["paths"])
        elif "path" in self.options:
            paths = [path for path, _ in list_files(self.options["path"], ENDINGS)]
        else:
            raise ValueError("tar_shard needs a path")
        return _ShardReader(paths, self._content(), self.options.get("damage", "false").lower() == "true")


def tar_members(
    spark: SparkSession, path: str, content: bool = False, stretch: int = LIST_STRETCH
) -> DataFrame:
    """The members of the shards at `path`.

    Shards longer than `stretch` are listed by several tasks. Compressed ones cannot
    be, and reading all content is one task per shard.
    """
    spark.dataSource.register(TarShardSource)
    files = list_files(path, ENDINGS)
    large = [f for f in files if f[1] > stretch and not packed(f[0])]
    reader = spark.read.format("tar_shard").option("content", str(content).lower())
    if content or not large:
        return reader.load(path)
    small = [p for p, _ in files if p not in {q for q, _ in large}]
    found = split_members(spark, large, stretch)
    if small:
        found = found.unionByName(reader.option("paths", json.dumps(small)).load())
    return found


def shard_errors(spark: SparkSession, path: str) -> DataFrame:
    """tar, offset, error: one row per shard that is damaged, and where its good part ends.

    Members before that place are listed and used; other shards are not affected.
    """
    spark.dataSource.register(TarShardSource)
    found = spark.read.format("tar_shard").option("damage", "true").load(path)
    return found.select("tar", "offset", F.col("name").alias("error"))


def read_tasks(spark: SparkSession, path: str) -> int:
    """Number of tasks to read the content at `path` with, from the size of the shards."""
    total = sum(size for _, size in list_files(path, ENDINGS))
    return max(-(-total // READ_STRETCH), spark.sparkContext.defaultParallelism)


def by_stretch(df: DataFrame, offset: str, tasks: int, tar: str = "tar") -> DataFrame:
    """Rows near each other in a shard go to one task, in order; a huge shard to many tasks.

    The number of tasks is given: the rows are narrow, and adaptive execution would
    merge them by their own size into far too few tasks for the content they stand for.
    """
    stretch = F.floor(F.col(offset) / F.lit(READ_STRETCH))
    return df.repartition(tasks, F.col(tar), stretch).sortWithinPartitions(tar, offset)


class _Shards:
    """The shard a task is reading; the next one replaces it."""

    def __init__(self) -> None:
        self.path: str | None = None
        self.file: Any = None

    def read(self, path: str, offset: Any) -> bytes | None:
        if offset is None or pd.isna(offset):
            return None
        if path != self.path:
            self.close()
            self.file, self.path = open_shard(path), path
        return read_member(self.file, int(offset))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.file = self.path = None


def with_texts(
    df: DataFrame, offset: str, name: str = "text", tar: str = "tar", error: str = "text_error"
) -> DataFrame:
    """Add the text at `offset`: UTF-8, bad bytes dropped; null where the offset is.

    A text that cannot be read is null with its `error`. This and the readers below expect
    rows arranged by `by_stretch`.
    """
    fields = [f for f in df.schema.fields if f.name not in (name, error)]
    schema = T.StructType([*fields, T.StructField(name, T.StringType()), T.StructField(error, T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards()
        try:
            for batch in batches:
                texts: list[str | None] = []
                errors: list[str | None] = []
                begun, held = 0, 0
                paths, offsets = batch.column(tar).to_pylist(), batch.column(offset).to_pylist()
                for i, (path, at) in enumerate(zip(paths, offsets)):
                    content, failed = None, None
                    try:
                        content = shards.read(path, at)
                    except Exception as failure:  # noqa: BLE001 - reported on the item
                        failed = str(failure) or type(failure).__name__
                    texts.append(None if content is None else content.decode("utf-8", errors="ignore"))
                    errors.append(failed)
                    held += len(content or b"")
                    if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                        part = batch.slice(begun, i + 1 - begun)
                        columns = [*part.columns, pa.array(texts, pa.string()), pa.array(errors, pa.string())]
                        yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, name, error])
                        texts, errors, begun, held = [], [], i + 1, 0
        finally:
            shards.close()

    return df.select(*[f.name for f in fields]).mapInArrow(read, schema)


def with_digests(
    df: DataFrame, offset: str, modality: str, name: str, tar: str = "tar"
) -> DataFrame:
    """Add the cache key of the content at `offset`, without passing the content on.

    Content that cannot be read has none, so it is neither found in a cache nor put there.
    The same as `cache_key` of the bytes, or, for modality "text", of the decoded text.
    """
    prefix, text = f"{modality}:".encode(), modality == "text"

    def key(content: bytes | None) -> str | None:
        if content is None:
            return None
        if text:
            content = content.decode("utf-8", errors="ignore").encode("utf-8")
        return hashlib.md5(prefix + content).hexdigest()

    @F.pandas_udf("string")
    def digest(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shards = _Shards()
        try:
            for paths, offsets in columns:
                keys = []
                for path, at in zip(paths, offsets):
                    try:
                        keys.append(key(shards.read(path, at)))
                    except Exception:  # noqa: BLE001 - the read for scoring reports it
                        keys.append(None)
                yield pd.Series(keys, dtype=object)
        finally:
            shards.close()

    return df.withColumn(name, digest(F.col(tar), F.col(offset)))


def with_member_scores(
    df: DataFrame,
    offset: str,
    scorer: Scorer,
    name: str = "scored",
    tar: str = "tar",
    batch_size: int = scorers.BATCH_SIZE,
    batch_bytes: int = scorers.BATCH_BYTES,
) -> DataFrame:
    """Add a struct of scores, error and seconds for the member at `offset`.

    The worker reads `batch_size` members at a time and hands them to the scorer, at most
    `batch_bytes` at once.
    Null offsets have neither scores nor error.
    """

    @F.pandas_udf(SCORED)
    def run(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        scorer.setup()
        shards = _Shards()
        try:
            for paths, offsets in columns:
                parts = []
                for i in range(0, len(paths), batch_size):
                    contents, errors = [], {}
                    began = time.perf_counter()
                    ends = zip(paths[i : i + batch_size], offsets[i : i + batch_size])
                    for j, (path, at) in enumerate(ends):
                        try:
                            contents.append(shards.read(path, at))
                        except Exception as failure:  # noqa: BLE001 - reported on the item
                            contents.append(None)
                            errors[j] = str(failure) or type(failure).__name__
                    reading = (time.perf_counter() - began) / max(len(contents), 1)
                    part = score_batches(scorer, contents, None, batch_size, batch_bytes)
                    part["seconds"] += reading
                    for j, message in errors.items():
                        part.at[j, "error"] = message
                    parts.append(part)
                yield pd.concat(parts, ignore_index=True) if parts else score_batch(scorer, [], None)
        finally:
            shards.close()

    return df.withColumn(name, run(F.col(tar), F.col(offset)))
