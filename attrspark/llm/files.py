"""Binary files in the shared folder, opened from inside tasks.

A store is named by its URI as in `spark.checkpoint.dir`; pyarrow opens local, S3, GCS,
Azure and HDFS stores. Each task attempt writes a file under a name of its own and reports
that name in its result rows, so a repeated attempt never touches another one's file and
only reported files are read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; Hadoop's s3a and s3n names mean s3."""
    for alias in ("s3a://", "s3n://"):
        if uri.startswith(alias):
            uri = "s3://" + uri[len(alias) :]
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str):
    """(URI, open output stream) of a fresh file."""
    uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
    system, path = store(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A seekable input file."""
    system, path = store(uri)
    return system.open_input_file(path)
