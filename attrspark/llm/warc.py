"""WARC archives: one gzip member per record, written and read sequentially.

A record is a `response` with an HTTP block, or a `revisit` that names the response with
the same payload and has no block. Both carry the payload's SHA-256 and length. The reader
takes a file in chunks, decompresses member by member with zlib, frames each block by its
Content-Length and verifies the block and payload digests; it holds one record. It also takes
archives of other writers: field names in any case, folded lines, digests of SHA-256 (hex or
base 32) and SHA-1 or none, and records of any type.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.llm.files import new_file, open_input
from attrspark.session import scratch_path

LEAST_SHARED = 100
CHUNK = 1 << 20
FILE_BYTES = 256 << 20
VERSION = b"WARC/1.1\r\n"
VERSIONS = (b"WARC/1.0\r\n", VERSION)
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
ROWS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary, file string, offset long, error string"
)
NAMES = [c.split()[0] for c in ROWS.split(", ")]


class DamagedRecord(ValueError):
    """A record that is cut, ill-framed or fails a digest."""


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, level: int = 6) -> bytes:
    """One gzip member with one record."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit")]
    head.append(("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"))
    head.append(("WARC-Date", "1970-01-01T00:00:00Z"))
    if url:  # line breaks would end the header
        head.append(("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    head.append(("WARC-Payload-Length", str(len(payload))))
    if refers_to is None:
        block = HTTP % len(payload) + payload
        head.append(("Content-Type", "application/http; msgtype=response"))
        head.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"))
    else:
        block = b""
        head.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        head.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head.append(("Content-Length", str(len(block))))
    raw = VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def members(source, chunk: int = CHUNK) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member of an open file, read in chunks."""
    data, at = b"", 0
    while True:
        if not data:
            data = source.read(chunk)
            if not data:
                return
        inflater = zlib.decompressobj(31)
        parts, used = [], 0
        while not inflater.eof:
            if not data:
                data = source.read(chunk)
                if not data:
                    raise DamagedRecord("file ends inside a record")
            try:
                parts.append(inflater.decompress(data))
            except zlib.error as failure:
                raise DamagedRecord(f"no gzip member: {failure}") from failure
            used += len(data) - len(inflater.unused_data)
            data = inflater.unused_data
        yield at, b"".join(parts)
        at += used


def _number(urn: str | None) -> int | None:
    """The page of a record id; none of an id of another writer."""
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", (urn or "").strip())
    return int(found[1]) if found and -(1 << 63) <= int(found[1]) < 1 << 63 else None


def header(head: bytes) -> dict[str, str]:
    """Fields by lower-case name; a line that begins with white space goes on with the one before."""
    fields: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif not colon or not name.strip():
            raise DamagedRecord("header line without a name")
        else:
            last = name.strip().lower()
            fields[last] = value.strip()
    return fields


def agrees(stated: str | None, content: bytes) -> bool:
    """Whether a digest field fits; one that is not there or of another kind cannot be told."""
    kind, _, value = (stated or "").partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("sha1", "sha256"):
        return True
    digest = hashlib.new(kind, content).digest()
    return value.lower() == digest.hex() or value.upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


def parse(raw: bytes) -> tuple:
    """page_id, url, type, refers_to, payload length, digest and payload; raises DamagedRecord.

    The payload of an HTTP response is what follows its header, of other records the block;
    a revisit has none, its length and digest are those stated. Digests are bare lower-case
    hex SHA-256, of what was read; a revisit's digest of another kind is given as stated.
    """
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(VERSIONS) or not gap:
        raise DamagedRecord("no WARC header")
    fields = header(head)
    try:
        length, kind = int(fields["content-length"]), fields["warc-type"].lower()
        size = int(fields["warc-payload-length"]) if "warc-payload-length" in fields else None
    except (KeyError, ValueError) as missing:
        raise DamagedRecord(f"header: {missing}") from missing
    if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise DamagedRecord("Content-Length does not frame the block")
    block, payload, digest = rest[:length], None, fields.get("warc-payload-digest")
    if not agrees(fields.get("warc-block-digest"), block):
        raise DamagedRecord("block digest is wrong")
    if kind == "revisit":
        digest = digest.removeprefix("sha256:") if digest else None
    else:
        http = kind in ("response", "request") and fields.get("content-type", "").lower().startswith("application/http")
        payload = block.partition(b"\r\n\r\n")[2] if http else block
        if size not in (None, len(payload)) or not agrees(digest, payload):
            raise DamagedRecord("payload digest is wrong")
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    url, page = fields.get("warc-target-uri"), fields.get("warc-record-id")
    if url is not None and (page or "").startswith("<urn:page:"):  # as `record` writes it
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    refers = _number(fields.get("warc-refers-to")) if kind == "revisit" else None
    return _number(page), url, kind, refers, size, digest, payload


def write_archives(pages: DataFrame, folder: str, least_shared: int = LEAST_SHARED, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write `pages(page_id, url, html)` as archives; returns their names (`file`), one per row.

    Of pages with equal payloads of at least `least_shared` bytes, that with the smallest
    page_id is the response and the others revisit it. First responses are found on
    digests alone, by partial aggregation; the pages that revisit one (their ids alone) are
    joined to the pages by page_id, which is even whatever pages are copied. Names of
    archives are written to `folder` as Parquet, so that only those of committed attempts
    are read.

    Null html: an empty payload. Null url: no target. Null page_id: always a response.
    Repeated rows: each is written, all rows with the smallest id as responses. No rows: no
    archives. Other columns are ignored.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digests = narrow.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least_shared))
    digests = digests.select("page_id", F.sha2("payload", 256).alias("digest"))
    place = scratch_path(spark, "digests")
    digests.write.parquet(place)
    digests = spark.read.schema(digests.schema).parquet(place)
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    firsts = firsts.where(F.col("refers_to") < F.col("last")).drop("last")
    revisits = digests.join(firsts, "digest").where(F.col("page_id") != F.col("refers_to")).distinct()
    place = scratch_path(spark, "revisits")
    revisits.write.parquet(place)
    revisits = spark.read.schema(revisits.schema).parquet(place)
    # A page_id with several payloads revisits for those of them that have a first response.
    joined = narrow.withColumn("digest", F.sha2("payload", 256)).join(revisits, ["page_id", "digest"], "left")
    rows = joined.select("page_id", "url", "payload", "digest", "refers_to")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = stream = None
        size, done = 0, []
        for batch in batches:
            for values in zip(*(column for column in batch.columns)):
                if stream is None:
                    uri, stream = new_file(folder, ".warc.gz")
                    size = 0
                raw = record(*(v.as_py() for v in values))
                stream.write(raw)
                size += len(raw)
                if size >= file_bytes:
                    stream.close()
                    done.append(uri)
                    stream = None
        if stream is not None:
            stream.close()
            done.append(uri)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["file"])

    place = f"{folder.rstrip('/')}/names"
    rows.mapInArrow(write, "file string").write.parquet(place)
    return spark.read.schema("file string").parquet(place)


def read_archives(files: DataFrame, keep_payload: bool = True, rows_at_once: int = 500) -> DataFrame:
    """Every record of the archives listed in `files(file)`, with its place.

    Records of other types and writers are rows too, without a page_id. A damaged record becomes a row with `error` and its offset, without the other values;
    what follows a member that does not end cannot be framed, so the file's reading ends
    there, while other files go on.
    """

    def rows_of(uri: str) -> Iterator[tuple]:
        at = 0
        with open_input(uri) as source:
            try:
                for at, raw in members(source):
                    try:
                        row = parse(raw)
                    except DamagedRecord as damage:
                        yield (*[None] * 7, uri, at, str(damage))
                    else:
                        yield (*row[:6], row[6] if keep_payload else None, uri, at, None)
            except DamagedRecord as damage:
                yield (*[None] * 7, uri, at, str(damage))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held: list[tuple] = []
                for row in rows_of(uri):
                    held.append(row)
                    if len(held) >= rows_at_once:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=NAMES)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=NAMES)

    tasks = max(1, files.count())
    return files.repartition(tasks).mapInArrow(read, ROWS)


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    files = write_archives(pages, scratch_path(spark, "warc"))
    rows = read_archives(files, keep_payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "offset", "error")
