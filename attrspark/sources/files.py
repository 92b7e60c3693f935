"""Open and list files from driver and tasks, local or on any store pyarrow can reach."""

from __future__ import annotations

from typing import Any

from pyarrow import fs
from pyspark.sql import SparkSession


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a path or URI; Hadoop's s3a and s3n names mean s3."""
    for alias in ("s3a://", "s3n://"):
        if path.startswith(alias):
            path = "s3://" + path[len(alias) :]
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:") :]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def open_file(path: str) -> Any:
    """A seekable binary file object."""
    store, inner = resolve(path)
    if isinstance(store, fs.LocalFileSystem):
        return open(inner, "rb")
    return store.open_input_file(inner)


def list_files(path: str, endings: tuple[str, ...]) -> list[tuple[str, int]]:
    """(path, size) of a file, or of all files below a folder with one of the endings."""
    store, inner = resolve(path)
    info = store.get_file_info(inner)
    scheme = path.split("://", 1)[0] + "://" if "://" in path and not path.startswith("file:") else ""
    if info.type == fs.FileType.File:
        return [(scheme + info.path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"path not found: {path}")
    found = store.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(
        (scheme + f.path, f.size)
        for f in found
        if f.type == fs.FileType.File and f.path.lower().endswith(endings)
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the file system Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return target.getFileSystem(conf).exists(target)


def folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders in a folder that begin with `prefix`; none if it is not there."""
    jvm = spark._jvm.org.apache.hadoop.fs
    folder = jvm.Path(path)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(folder):
        return []
    names = [s.getPath().getName() for s in store.listStatus(folder) if s.isDirectory()]
    return [n for n in names if n.startswith(prefix)]
