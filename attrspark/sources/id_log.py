"""Ids that are done, kept in Parquet beside the result lines they were read from.

A resumable job asks before each wave which ids its output already has. The log answers from
narrow Parquet files; only result files that it does not know yet are parsed, so each result
line is parsed once however many waves there are.

`entry=<last>-<first>-<ids>` holds what the additions first..last found: `ids` and `files`, the
result files (path, length, time of change) they come from. `files` is written last; an entry
without it is unfinished and not read. An entry counts as long as each of its files is still
there unchanged; otherwise what is left of its files is parsed again. An addition replaces the
entries before it that hold at most twice as many ids, so there are about as many entries as
the number of ids has bits, and an id is rewritten about as often. One writer at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.operators.resume import processed_ids
from attrspark.sources.files import exists, folders

_FILES = "path string, length long, modified long"
_NAME = re.compile(r"entry=(\d+)-(\d+)-(\d+)$")


@dataclass(frozen=True)
class Entry:
    """Additions first..last, of at most `size` ids; sound if all files they were read from are
    unchanged."""

    first: int
    last: int
    size: int
    sound: bool = True

    @property
    def name(self) -> str:
        return f"entry={self.last}-{self.first}-{self.size}"


class IdLog:
    """The ids in the JSON lines below `output`, by the first of `fields` that is not null."""

    def __init__(self, spark: SparkSession, output: str, fields: tuple[str, ...] = ("id", "item_id")):
        self.spark, self.output, self.fields = spark, output.rstrip("/"), fields
        self.path = f"{self.output}.ids/{'-'.join(fields)}"

    def _result_files(self) -> DataFrame:
        """path, length and modified of the result files there are; contents are not read."""
        if not exists(self.spark, self.output):
            return self.spark.createDataFrame([], _FILES)
        found = self.spark.read.format("binaryFile").load(self.output)
        return found.select("path", "length", F.unix_millis("modificationTime").alias("modified"))

    def _files(self, entries: list[str]) -> DataFrame:
        """The result files of entries, with the entry's name."""
        if not entries:
            return self.spark.createDataFrame([], f"entry string, {_FILES}")
        parts = (
            self.spark.read.schema(_FILES).parquet(f"{self.path}/{e}/files").select(F.lit(e).alias("entry"), "*")
            for e in entries
        )
        return reduce(DataFrame.unionByName, parts)

    def _ids(self, entries: list[Entry]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], "id string")
        return self.spark.read.schema("id string").parquet(*[f"{self.path}/{e.name}/ids" for e in entries])

    def _finished(self) -> list[Entry]:
        """The finished entries that no later one replaces, oldest first."""
        found = [_NAME.match(n) for n in folders(self.spark, self.path, "entry=")]
        spans = sorted((Entry(int(m[2]), int(m[1]), int(m[3])) for m in found if m), key=lambda e: -e.last)
        out: list[Entry] = []
        for e in spans:
            if (not out or e.last < out[-1].first) and exists(self.spark, f"{self.path}/{e.name}/files/_SUCCESS"):
                out.append(e)
        return out[::-1]

    def _state(self) -> tuple[list[Entry], list]:
        """The entries in use, oldest first, and the result files that no sound one has."""
        entries = self._finished()
        key = ["path", "length", "modified"]
        known = self._files([e.name for e in entries])
        there = self._result_files().withColumn("there", F.lit(True))
        # Names of files that were added or are gone: the reader's own index holds all names
        # on the driver as well.
        odd = known.join(there, key, "full").where("entry IS NULL OR there IS NULL").select("entry", *key).collect()
        unsound = {r.entry for r in odd if r.entry is not None}
        if not unsound:
            return entries, [tuple(r)[1:] for r in odd]
        entries = [replace(e, sound=e.name not in unsound) for e in entries]
        sound = self._files([e.name for e in entries if e.sound])
        return entries, [tuple(r) for r in there.join(sound, key, "left_anti").select(*key).collect()]

    def _add(self, entries: list[Entry], files: list) -> list[Entry]:
        """The entries in use after one more for `files`, which are parsed."""
        last = max((e.last for e in entries), default=-1) + 1
        added, size = self.spark.createDataFrame([], "id string"), 0
        if files:
            # Names are no patterns.
            paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path, _, _ in files]
            staged = f"{self.path}/added={last}"
            processed_ids(self.spark.read.text(paths), self.fields).write.mode("overwrite").parquet(staged)
            added = self.spark.read.schema("id string").parquet(staged)
            size = added.count()
        # Everything from the first entry on that is unsound or not much larger is replaced.
        at = len(entries)
        while at and (entries[at - 1].size <= 2 * size or not all(e.sound for e in entries[:at])):
            at -= 1
            size += entries[at].size if entries[at].sound else 0
        folded = [e for e in entries[at:] if e.sound]
        entry = Entry(min((e.first for e in entries[at:]), default=last), last, size)
        added.unionByName(self._ids(folded)).write.mode("overwrite").parquet(f"{self.path}/{entry.name}/ids")
        listed = self.spark.createDataFrame(files, _FILES)
        listed = listed.unionByName(self._files([e.name for e in folded]).drop("entry"))
        listed.write.mode("overwrite").parquet(f"{self.path}/{entry.name}/files")
        return [*entries[:at], entry]

    def _catch_up(self) -> tuple[list[Entry], list[str]]:
        entries, files = self._state()
        if files or not all(e.sound for e in entries):
            entries = self._add(entries, files)
        return entries, [path for path, _, _ in files]

    def catch_up(self) -> list[str]:
        """Add the result files the log does not know; returns the paths that were parsed."""
        return self._catch_up()[1]

    def read(self) -> DataFrame:
        """id: those in the result files there are now. An id that is in several files may come
        more than once."""
        return self._ids(self._catch_up()[0])
