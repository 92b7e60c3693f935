"""Token-id files, packing and archives: round trips, places and damage."""

import base64
import gzip
import hashlib
import io
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

from attrspark.llm import packing, token_files, warc
from attrspark.llm.files import new_file, open_input, store
from attrspark.session import scratch_path
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, start long, ids string, length int"
ROWS = [(3, "one two", 9, "x", 1), (1, None, 9, "x", 1), (2, "", 9, "x", 1), (2, "", 9, "x", 1), (None, "z", 9, "x", 1), (7, "long text " * 3000, 9, "x", 1)]


def ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_token_files_round_trip(spark):
    rows = token_files.token_file_rows(spark, spark.createDataFrame(ROWS, DOCS).repartition(3), PATH).collect()
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for doc_id, text, *_ in ordered:
        code = np.array(ids(text), "<u4")
        want.append((doc_id, start, len(code), zlib.crc32(code.tobytes())))
        start += len(code)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want


def test_token_files_of_nothing(spark):
    assert token_files.token_file_rows(spark, spark.createDataFrame([], DOCS), PATH).count() == 0


def test_only_the_asked_frame_is_read(tmp_path):
    uri, stream = new_file(str(tmp_path), ".zst")
    writer = token_files.FrameWriter(stream)
    raws = [bytes(range(4 * n % 256)) * 4 for n in (1, 2, 0, 50)]
    for i, raw in enumerate(raws):
        writer.add(i * 10, raw)
    writer.close()
    reader = token_files.FrameReader(open_input(uri))
    assert reader.doc_ids.tolist() == [0, 10, 20, 30] and [reader.read(i) for i in (3, 0, 2, 1)] == [raws[i] for i in (3, 0, 2, 1)]
    whole = open(uri, "rb").read()
    damaged = bytearray(whole)
    damaged[len(whole) - 9 - 12 * 4 - 8 - 8 * 4 - 8 - 3] ^= 255  # in the last frame
    broken = token_files.FrameReader(io.BytesIO(bytes(damaged)))
    assert broken.read(0) == raws[0]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken.read(3)
    for cut in (whole[:-1], whole[:20], b""):
        with pytest.raises((ValueError, Exception)):
            token_files.FrameReader(io.BytesIO(cut))


def test_store_names(tmp_path):
    assert store(f"file:{tmp_path}")[1] == str(tmp_path) == store(str(tmp_path))[1]


def places(runs):
    out = []
    for size, low, high, first, each, at in runs:
        out += [(first + r // each, at + r % each * size, size) for r in range(high - low)]
    return out


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_a_packing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 12, 30])
    counts = {s: rng.choice([0, 1, 2, 7, 40]) for s in range(1, capacity + 1) if rng.random() < 0.6}
    runs, made = packing.plan(counts, capacity)
    items = places(runs)
    assert {s: n for s, n in counts.items() if n} == {s: sum(1 for i in items if i[2] == s) for s in {i[2] for i in items}}
    for _, group in itertools.groupby(sorted(items), key=lambda i: i[0]):
        end = 0
        for _, at, size in group:
            assert at == end
            end += size
        assert end <= capacity
    assert {i[0] for i in items} == set(range(made))


def fewest(sizes, capacity):
    best = [len(sizes)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in sorted({r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values()):
            put(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1 :])
        put(i + 1, rooms + [capacity - sizes[i]])

    put(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
    counts = {s: sizes.count(s) for s in sizes}
    bins = packing.Bins(20)
    packing.dominance(counts, bins)
    left = [s for s, n in counts.items() for _ in range(n)]
    assert bins.made + fewest(sorted(left, reverse=True), 20) == fewest(sizes, 20)


def test_packed_documents(spark):
    rows = packing.packed_documents(spark, spark.createDataFrame(ROWS * 20, DOCS), PATH, 64).collect()
    tokens = sum(len(ids(r[1])) for r in ROWS) * 20
    assert sum(r.length for r in rows) == tokens
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        end = 0
        for at, length in sorted(spans):
            assert at == end
            end += length
        assert end <= 64
    assert len(by_sequence) <= -(-tokens // 64) + 1
    long = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 7)
    assert long[0][2] < 64 and {p[2] for p in long[20:]} == {64}
    code = np.array(ids(ROWS[-1][1]), "<u4")
    for r in rows:
        if r.doc_id == 7:
            assert r.ids_crc32 == zlib.crc32(code[r.start : r.start + r.length].tobytes())
    assert packing.packed_documents(spark, spark.createDataFrame([], DOCS), PATH).count() == 0


PAGES = "page_id long, url string, html string, digest string, payload int, file string"


def test_archives_round_trip(spark):
    long, big = "ü" * 60, "x" * 3_000_000
    data = [(5, "http://a/é\n%", long), (2, None, long), (9, "u", long), (1, "u", "short"), (3, "u", "short"), (4, "u", None), (None, "u", long), (6, "u", big), (8, "u", big), (2, None, long)]
    pages = spark.createDataFrame([(*r, "d", 1, "f") for r in data], PAGES).repartition(3)
    files = warc.write_archives(pages, scratch_path(spark, "w"), file_bytes=5000)
    rows = warc.read_archives(files, rows_at_once=2).collect()
    assert len(rows) == len(data) and all(r.error is None for r in rows)
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in rows)
    assert got == [
        (0, "response", None, 120), (1, "response", None, 5), (2, "response", None, 120), (2, "response", None, 120), (3, "response", None, 5),
        (4, "response", None, 0), (5, "revisit", 2, 120), (6, "response", None, 3_000_000), (8, "revisit", 6, 3_000_000), (9, "revisit", 2, 120),
    ]
    assert {r.url for r in rows} == {None, "u", "http://a/é\n%"}
    for r in rows:
        payload = (dict((d[0], d[2]) for d in data)[r.page_id] or "").encode()
        assert r.payload_digest == hashlib.sha256(payload).hexdigest()
        assert r.payload == (payload if r.record_type == "response" else None)
    assert warc.archived_pages(spark, pages.limit(0)).count() == 0


def test_members_are_plain_gzip_and_damage_is_reported(spark, tmp_path):
    raw = [warc.record(i, "u", b"p" * 500, hashlib.sha256(b"p" * 500).hexdigest(), None) for i in range(4)]
    assert gzip.decompress(raw[0]).startswith(b"WARC/1.1\r\nWARC-Type: response")
    body = gzip.decompress(raw[1])
    wrong = gzip.compress(body.replace(b"ppp", b"ppq", 1))
    unframed = gzip.compress(body.replace(b"Content-Length: 5", b"Content-Length: 6"))
    cases = {"wrong": raw[0] + wrong + raw[2], "unframed": raw[0] + unframed + raw[2], "cut": raw[0] + raw[1][:-20], "whole": b"".join(raw)}
    for name, content in cases.items():
        (tmp_path / name).write_bytes(content)
    files = spark.createDataFrame([(str(tmp_path / n),) for n in cases], "file string")
    rows = warc.read_archives(files).select("page_id", "error", F.substring_index("file", "/", -1).alias("f"), "offset").collect()
    good = {n: sorted(r.page_id for r in rows if r.f == n and r.error is None) for n in cases}
    bad = {n: [(r.offset, r.error) for r in rows if r.f == n and r.error] for n in cases}
    assert good == {"wrong": [0, 2], "unframed": [0, 2], "cut": [0], "whole": [0, 1, 2, 3]}
    assert {n: [o for o, _ in b] for n, b in bad.items()} == {"wrong": [len(raw[0])], "unframed": [len(raw[0])], "cut": [0], "whole": []}
    small = list(warc.members(io.BytesIO(cases["whole"]), 7))
    assert [at for at, _ in small] == [sum(map(len, raw[:i])) for i in range(4)]


def foreign(kind, block, *lines, version="WARC/1.0"):
    head = [f"warc-type: {kind}", "WARC-Record-ID: <urn:uuid:12>", f"content-length:{len(block)}", *lines]
    return gzip.compress((version + "\r\n" + "\r\n".join(head) + "\r\n\r\n").encode("latin-1") + block + b"\r\n\r\n")


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"
    sha1 = base64.b32encode(hashlib.sha1(http).digest()).decode()
    digest = hashlib.sha256(b"own").hexdigest()
    raw = [
        foreign("warcinfo", b"software: x"),
        foreign("response", http, "WARC-Target-URI: http://a/%25", "Content-Type: application/http;", " msgtype=response", f"WARC-Block-Digest: sha1:{sha1}"),
        foreign("response", http, "Content-Type: application/http", "WARC-Block-Digest: sha1:AAAA"),
        foreign("response", b"x", "a line without a name"),
        foreign("metadata", b"", "WARC-Target-URI: http://\xe9/", "WARC-Payload-Digest: md5:1"),
        foreign("revisit", b"", "WARC-Payload-Digest: sha1:ABC"),
        foreign("response", b"x", version="WARC/0.17"),
        warc.record(7, "http://a/%41", b"own", digest, None),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(raw))
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "file string")
    rows = sorted(warc.read_archives(files).collect(), key=lambda r: r.offset)
    assert [r.error is None for r in rows] == [True, True, False, False, True, True, False, True]
    assert [r.record_type for r in rows if not r.error] == ["warcinfo", "response", "metadata", "revisit", "response"]
    assert (rows[1].page_id, rows[1].url, bytes(rows[1].payload), rows[1].payload_bytes) == (None, "http://a/%25", b"body", 4)
    assert rows[1].payload_digest == hashlib.sha256(b"body").hexdigest()
    assert (rows[5].payload, rows[5].payload_digest, rows[5].refers_to) == (None, "sha1:ABC", None)
    assert (rows[7].page_id, rows[7].url, rows[7].payload_digest) == (7, "http://a/%41", digest)
