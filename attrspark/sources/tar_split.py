"""List the members of large tar shards with several tasks per shard.

A tar file has no index: each header tells where the next one is. A task that begins
in the middle looks for the first valid header and follows the chain from there. That
is a guess (a shard may hold other tar files), so it is checked: the chain of the
stretch before must arrive at a header this task has found. Where it does not, the
rest of that shard is listed again from the last place known to be right.
"""

from __future__ import annotations

import json
import tarfile
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from attrspark.session import freeze
from attrspark.sources.files import open_file

BLOCK = 512
CHUNK = 1 << 20
NEVER = 1 << 62

# kind: 'member'; 'end' where a chain stops; 'next' where it leaves the stretch; 'torn' where it
# leads beyond the file.
LISTING_SCHEMA = "tar string, split int, kind string, offset bigint, name string, size bigint"


def header_after(shard: Any, start: int, end: int) -> int | None:
    """First position in [start, end) that holds a valid header."""
    shard.seek(start)
    at = start
    while at < end:
        chunk = shard.read(CHUNK)
        for i in range(0, len(chunk) - BLOCK + 1, BLOCK):
            head = chunk[i : i + BLOCK]
            if at + i < end and head[257:262] == b"ustar":
                try:
                    tarfile.TarInfo.frombuf(head, "utf-8", "surrogateescape")
                except tarfile.HeaderError:
                    continue
                return at + i
        if len(chunk) < CHUNK:
            return None
        at += len(chunk)
    return None


def list_stretch(shard: Any, start: int, end: int, exact: bool) -> Iterator[tuple]:
    """(kind, offset, name, size) of what begins in [start, end); `start` is a header if exact."""
    at: int | None = start if exact else header_after(shard, start, end)
    while at is not None:
        shard.seek(at)
        try:
            with tarfile.TarFile(fileobj=shard, mode="r") as archive:
                while (member := archive.next()) is not None:
                    archive.members.clear()
                    if member.offset >= end:
                        yield "next", member.offset, None, None
                        return
                    # Directories and links too: the check needs every header.
                    yield "member", member.offset, member.name if member.isfile() else None, member.size
                stopped = archive.offset
        except tarfile.TarError:
            if exact:
                raise
            # A wrong guess, or a shard that is cut off: listing the rest again will tell.
            yield "torn", at, None, None
            return
        if stopped >= end:
            # The end of the archive, or a header the next stretch has to judge.
            yield "next", stopped, None, None
            return
        yield "end", stopped, None, None
        at = None if exact else header_after(shard, max(stopped, at + BLOCK), end)


class _Stretch(InputPartition):
    def __init__(self, path: str, split: int, start: int, end: int, exact: bool):
        self.path, self.split, self.start, self.end, self.exact = path, split, start, end, exact


class _StretchReader(DataSourceReader):
    def __init__(self, stretches: list[list]):
        self.stretches = stretches

    def partitions(self) -> list[InputPartition]:
        return [_Stretch(*s) for s in self.stretches]

    def read(self, partition: _Stretch) -> Iterator[tuple]:
        with open_file(partition.path) as shard:
            found = list_stretch(shard, partition.start, partition.end, partition.exact)
            for kind, offset, name, size in found:
                yield partition.path, partition.split, kind, offset, name, size


class TarStretchSource(DataSource):
    """Members of given stretches of shards; used through `split_members`."""

    @classmethod
    def name(cls) -> str:
        return "tar_stretch"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _StretchReader(json.loads(self.options["stretches"]))


def _listing(spark: SparkSession, stretches: list[tuple]) -> DataFrame:
    spark.dataSource.register(TarStretchSource)
    return spark.read.format("tar_stretch").option("stretches", json.dumps(stretches)).load()


def chain(ends: list[int], marks: list[list[tuple[str, int]]]) -> list[tuple[int, int]]:
    """(from, to) per stretch: the members that belong to the shard begin in between.

    `marks` are the 'end' and 'next' positions of each stretch, `ends` where it ends.
    """
    spans, expected = [], 0
    for end, found in zip(ends, marks):
        if expected >= end:
            spans.append((NEVER, NEVER))  # the member before covers the whole stretch
            continue
        stops = [at for kind, at in found if kind == "end" and at >= expected]
        leaves = [at for kind, at in found if kind == "next"]
        if stops:
            spans.append((expected, min(stops)))
            expected = NEVER
        else:
            spans.append((expected, NEVER))
            expected = leaves[0] if leaves else NEVER
    return spans


def split_members(spark: SparkSession, files: list[tuple[str, int]], stretch: int) -> DataFrame:
    """tar, offset, name, size of the regular files in uncompressed shards.

    What reaches the driver is one or two positions per stretch, a few thousand rows
    for terabytes of shards.
    """
    if stretch % BLOCK:
        raise ValueError(f"stretch must be a multiple of {BLOCK}")
    plan = {
        path: [(path, i, at, min(at + stretch, size), at == 0) for i, at in enumerate(range(0, max(size, 1), stretch))]
        for path, size in files
    }
    listing = freeze(_listing(spark, [s for parts in plan.values() for s in parts]))
    marks: dict[tuple[str, int], list[tuple[str, int]]] = {}
    for row in listing.where("kind != 'member'").select("tar", "split", "kind", "offset").collect():
        marks.setdefault((row["tar"], row["split"]), []).append((row["kind"], row["offset"]))
    spans = {
        path: chain([s[3] for s in parts], [marks.get((path, s[1]), []) for s in parts])
        for path, parts in plan.items()
    }
    rows = [(p, i, a, b) for p, parts in spans.items() for i, (a, b) in enumerate(parts)]
    known = spark.createDataFrame(rows, "tar string, split int, first bigint, stop bigint")
    members = listing.where("kind = 'member'").join(F.broadcast(known), ["tar", "split"])
    hits = members.where("offset = first").select("tar", "split").collect()
    sure = {(r["tar"], r["split"]) for r in hits}
    again = []
    for path, parts in spans.items():
        for (_, split, _, _, exact), (first, stop) in zip(plan[path], parts):
            torn = any(kind == "torn" for kind, _ in marks.get((path, split), []))
            met = exact or (path, split) in sure or stop == first
            if first != NEVER and (torn or not met):
                again.append((path, split, first, plan[path][-1][3], True))
                break
    kept = members.where("offset >= first AND offset < stop")
    if again:
        bad = spark.createDataFrame([(a[0], a[1]) for a in again], "tar string, bad int")
        kept = kept.join(F.broadcast(bad), "tar", "left").where("bad IS NULL OR split < bad")
        rest = _listing(spark, again).where("kind = 'member'")
        kept = kept.select("tar", "offset", "name", "size").unionByName(
            rest.select("tar", "offset", "name", "size")
        )
    return kept.where("name IS NOT NULL").select("tar", "offset", "name", "size")
