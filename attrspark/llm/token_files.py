"""Token-id files: one independent zstandard frame per document and a trailing seek table.

Layout of a file, all integers little-endian:

- one zstandard frame per document: its ids as unsigned 32-bit integers;
- a skippable frame (magic 0x184D2A50) with the documents' 64-bit ids, in frame order;
- a skippable frame (magic 0x184D2A5E) with the seek table: per frame its compressed size,
  its decompressed size and the low 32 bits of the XXH64 of its decompressed bytes, then
  the number of frames, the descriptor 0x80 (checksums present) and the magic 0x8F92EAB1.

A reader fetches the table from the file's end, knows from it where each document lies and
how many ids it has, and decompresses only the frames it is asked for.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from attrspark.llm.bpe import Encoder
from attrspark.llm.files import new_file, open_input
from attrspark.session import scratch_path

IDS_MAGIC, TABLE_MAGIC, END_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_ENTRY = np.dtype([("compressed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
MANIFEST = StructType(
    [
        StructField("part", LongType()),
        StructField("file", StringType()),
        StructField("n_docs", LongType()),
        StructField("n_tokens", LongType()),
    ]
)
ROWS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("start", LongType()),
        StructField("n_tokens", LongType()),
        StructField("ids", BinaryType()),
    ]
)


class FrameWriter:
    """Writes frames to an open binary stream; `close` adds the tables."""

    def __init__(self, stream, level: int = 3):
        self.stream = stream
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.entries: list[tuple[int, int, int]] = []
        self.doc_ids: list[int] = []

    def add(self, doc_id: int, raw: bytes) -> None:
        frame = self.compressor.compress(raw)
        self.stream.write(frame)
        self.entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)

    def close(self) -> None:
        ids = np.array(self.doc_ids, dtype="<i8").tobytes()
        self.stream.write(struct.pack("<II", IDS_MAGIC, len(ids)) + ids)
        table = np.array(self.entries, dtype=_ENTRY).tobytes()
        foot = struct.pack("<IBI", len(self.entries), 0x80, END_MAGIC)
        self.stream.write(struct.pack("<II", TABLE_MAGIC, len(table) + len(foot)) + table + foot)
        self.stream.close()


class FrameReader:
    """Random access to the documents of one file.

    A damaged file raises ValueError: bad magic when it is opened, a wrong checksum when
    the document is read.
    """

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        count, descriptor, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != END_MAGIC or descriptor != 0x80:
            raise ValueError("no seek table")
        begin = end - 9 - 12 * count
        if struct.unpack("<II", self._at(begin - 8, 8)) != (TABLE_MAGIC, 12 * count + 9):
            raise ValueError("damaged seek table")
        self.entries = np.frombuffer(self._at(begin, 12 * count), dtype=_ENTRY)
        if struct.unpack("<II", self._at(begin - 16 - 8 * count, 8)) != (IDS_MAGIC, 8 * count):
            raise ValueError("damaged id table")
        self.doc_ids = np.frombuffer(self._at(begin - 8 - 8 * count, 8 * count), dtype="<i8")
        self.offsets = np.concatenate(([0], np.cumsum(self.entries["compressed"].astype(np.int64))))
        self.tokens = self.entries["size"].astype(np.int64) // 4
        self.starts = np.cumsum(self.tokens) - self.tokens
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        if offset < 0:
            raise ValueError("cut file")
        self.source.seek(offset)
        return self.source.read(size)

    def __len__(self) -> int:
        return len(self.entries)

    def read(self, frame: int) -> bytes:
        """The ids of one document; nothing else is decompressed."""
        raw = self.decompressor.decompress(self._at(int(self.offsets[frame]), int(self.entries["compressed"][frame])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries["checksum"][frame]:
            raise ValueError(f"checksum of frame {frame} is wrong")
        return raw


def tasks_for(docs: DataFrame, task_bytes: int) -> int:
    """How many tasks to deal `docs(text)` to: at least `spark.sql.shuffle.partitions`, and
    so many that a task has about `task_bytes` of text."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // task_bytes))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end: int = 2, level: int = 3, file_bytes: int = 32 << 20
) -> DataFrame:
    """Encode `docs(doc_id, text)` and write files in ascending doc_id order.

    Documents are dealt by ranges of doc_id, sorted within each range by (doc_id, text),
    and encoded and written as they pass by; a task holds one batch. Returns the manifest,
    one row per file with its place in the order (`part`), written to `folder` as Parquet:
    only files of committed attempts are listed there.

    Null text: the document is its end id. Null doc_id: written as the smallest 64-bit
    integer, so first; read back as null. Repeated rows: one frame each. Other columns are
    ignored. No rows: no files.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartitionByRange(tasks_for(narrow, file_bytes), "doc_id").sortWithinPartitions("doc_id", "text")
    lowest = -(1 << 63)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, writer, uri, tokens = Encoder.of(tokenizer), None, None, 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, ids, bounds in encoder.encode(batch.column(1), end):
                if writer is None:
                    uri, stream = new_file(folder, ".ids.zst")
                    writer = FrameWriter(stream, level)
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                for i, (a, b) in enumerate(zip((bounds[:-1] * 4).tolist(), (bounds[1:] * 4).tolist())):
                    doc_id = doc_ids[first + i]
                    writer.add(lowest if doc_id is None else doc_id, bytes(raw[a:b]))
                tokens += len(ids)
        if writer is not None:
            writer.close()
            row = [[TaskContext.get().partitionId()], [uri], [len(writer.entries)], [tokens]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=MANIFEST.names)

    place = f"{folder.rstrip('/')}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(place)
    return spark.read.schema(MANIFEST).parquet(place)


def read_token_files(manifest: DataFrame, batch_bytes: int = 8 << 20) -> DataFrame:
    """Every document of the files of a manifest: doc_id, start, n_tokens, ids.

    `start` is the number of ids before the document over all files in order. One task
    reads one file at a time, frame by frame. The running sum over files is taken on the
    driver; a manifest has one row per file and no content.
    """
    spark = manifest.sparkSession
    files, total = [], 0
    for row in manifest.orderBy("part").collect():
        files.append((row.file, total))
        total += row.n_tokens

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_input(uri) as source:
                    reader = FrameReader(source)
                    at = 0
                    while at < len(reader):
                        upto, size = at, 0
                        while upto < len(reader) and (upto == at or size < batch_bytes):
                            size += int(reader.entries["size"][upto])
                            upto += 1
                        doc_ids = reader.doc_ids[at:upto]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(doc_ids, pa.int64(), mask=doc_ids == -(1 << 63)),
                                pa.array(reader.starts[at:upto] + base),
                                pa.array(reader.tokens[at:upto]),
                                pa.array([reader.read(i) for i in range(at, upto)], pa.binary()),
                            ],
                            names=ROWS.names,
                        )
                        at = upto

    listed = spark.createDataFrame(files, "file string, base long")
    return listed.repartition(max(1, len(files))).mapInArrow(read, ROWS)


def token_file_rows(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files to the shared folder, read them back and add each document's CRC-32."""
    manifest = write_token_files(docs, scratch_path(spark, "token-files"), tokenizer)
    rows = read_token_files(manifest)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
