"""Lists of the files below a folder, made by tasks and kept in Parquet.

Spark's file sources list a folder on the driver, one file after the other, and hold all files
there. Here each level of folders is listed by tasks, and the driver sees only how many there are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from unicodedata import category
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.session import scratch_path
from attrspark.sources.files import open_file, resolve

LISTED = "path string, length long, folder boolean"
LIST_ROWS = 10_000
#: At most so many files, or about so many bytes of them, for a task that reads them.
TASK_FILES, TASK_BYTES = 2_000, 128 << 20
#: Contents are handed on in batches of about this size.
READ_BYTES = 4 << 20


def named(spark: SparkSession, path: str) -> list[tuple[str, int, bool]]:
    """(path, length, whether it is a folder) of what a path or a pattern names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = store.globStatus(target) or []
    if not len(found):
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {path}.")
    return [(s.getPath().toString(), s.getLen(), s.isDirectory()) for s in found]


def hidden(name: str) -> bool:
    """Whether Spark's file sources skip the name."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def entries(folder: str, wanted: re.Pattern) -> Iterator[tuple[str, int, bool]]:
    """(name, length, whether it is a folder) of the folders, and of the files with a wanted name."""
    store, inner = resolve(folder)
    if not isinstance(store, fs.LocalFileSystem):
        for info in store.get_file_info(fs.FileSelector(inner)):
            if info.type == fs.FileType.Directory or wanted.search(info.base_name):
                yield info.base_name, info.size or 0, info.type == fs.FileType.Directory
        return
    with os.scandir(inner) as found:
        for entry in found:
            if entry.is_dir():
                yield entry.name, 0, True
            elif wanted.search(entry.name):
                try:
                    yield entry.name, entry.stat().st_size, False
                except FileNotFoundError:  # a link to nothing, or a file that has gone
                    continue


def files_below(spark: SparkSession, path: str, suffixes: Iterable[str]) -> DataFrame:
    """path and length of the files below a folder, or of the file, with one of the suffixes in any case.

    As in Spark's file sources, hidden names and empty files are left out and `path` may be a pattern.
    """
    wanted = re.compile(r"(?:" + "|".join(re.escape(s) for s in suffixes) + r")\Z", re.IGNORECASE | re.ASCII)

    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("folder", pa.bool_())])
        held: list[tuple[str, int, bool]] = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for name, length, inside in entries(folder, wanted):
                    if not hidden(name) and (inside or length):
                        held.append((f"{folder.rstrip('/')}/{name}", length, inside))
                    if len(held) == LIST_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], schema=schema)
                        held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], schema=schema)

    root, tasks = scratch_path(spark, "listing"), 4 * spark.sparkContext.defaultParallelism
    first = [n for n in named(spark, path) if n[2] or (n[1] and wanted.search(n[0]))]
    spark.createDataFrame(first, LISTED).coalesce(1).write.parquet(f"{root}/0")
    levels = [f"{root}/0"]
    while True:
        folders = spark.read.schema(LISTED).parquet(levels[-1]).where("folder").select("path")
        if folders.isEmpty():
            break
        levels.append(f"{root}/{len(levels)}")
        folders.repartition(tasks).mapInArrow(list_folders, LISTED).write.parquet(levels[-1])
    return spark.read.schema(LISTED).parquet(*levels).where("NOT folder").drop("folder")


def spread(files: DataFrame) -> DataFrame:
    """Files of a list, spread over as many tasks as their number or size asks for."""
    size = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    tasks = max(-(-size.n // TASK_FILES), -(-size.b // TASK_BYTES))
    return files.repartition(max(tasks, min(size.n, files.sparkSession.sparkContext.defaultParallelism), 1), "path")


def read_file(path: str) -> bytes:
    with open_file(path) as file:
        return file.read()


def file_contents(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Contents of files, in batches of about `READ_BYTES`."""
    for batch in paths:
        held, size = [], 0
        for path in batch.to_pylist():
            held.append(read_file(path))
            size += len(held[-1])
            if size >= READ_BYTES:
                yield pa.array(held, pa.binary())
                held, size = [], 0
        if held:
            yield pa.array(held, pa.binary())


def as_uri(path: str) -> str:
    """A path as Java's URI writes it: other characters than those of a URI's path as %XX, letters
    outside ASCII as they are."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    kept = "/;:@&=+$,_-!.~'()*"
    blanks = ("Cc", "Zs", "Zl", "Zp")
    return "".join(c if not c.isascii() and category(c) not in blanks else quote(c, safe=kept) for c in path)
