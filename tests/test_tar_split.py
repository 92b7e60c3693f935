"""Shards listed in stretches agree with a plain walk, whatever the shard holds."""

import io
import random
import tarfile

import pytest

from attrspark.sources.tar_shard import shard_errors, tar_members, walk_members
from attrspark.sources.tar_split import list_stretch

from helpers import write_tar


def inner_tar(names, cut=None):
    held = io.BytesIO()
    with tarfile.open(fileobj=held, mode="w") as archive:
        for name in names:
            info = tarfile.TarInfo(name)
            info.size = 700
            archive.addfile(info, io.BytesIO(b"y" * 700))
    return held.getvalue()[:cut]


def contents(kind):
    draw = random.Random(kind)
    if kind == "plain":
        return [(f"item_{i}_a.txt", b"x" * draw.randrange(3000)) for i in range(60)]
    if kind == "long names":
        return [(f"item_{i}_" + "n" * draw.randrange(90, 300), b"x" * draw.randrange(900)) for i in range(60)]
    if kind == "folders":
        return [(f"d{i}", None) if i % 3 else (f"item_{i}_a.txt", b"") for i in range(90)]
    if kind == "one huge member":
        return [("item_1_a.txt", b"a"), ("item_2_a.txt", b"\0" * 60_000), ("item_3_a.txt", b"c")]
    if kind == "huge last member":
        return [("item_1_a.txt", b"a" * 5000), ("item_2_a.txt", b"b" * 50_000)]
    if kind == "tar inside":
        held = inner_tar([f"item_{i}_inner.txt" for i in range(40)])
        return [("item_1_a.txt", b"a" * 900), ("item_2_a.tar", held), ("item_3_a.txt", b"c" * 4000), ("item_4_b.txt", b"")]
    if kind == "cut tar inside":
        # Its last header promises more than is there, so a guess ends up beyond the member.
        held = inner_tar([f"item_{i}_inner.txt" for i in range(40)], cut=512 * 101)
        return [("item_1_a.txt", b"a" * 900), ("item_2_a.tar", held)] + [
            (f"item_{i}_z.txt", b"c" * 300) for i in range(3, 40)
        ]
    if kind == "cut tar at the end":
        held = bytearray(inner_tar([f"item_{i}_inner.txt" for i in range(9)], cut=512 * 20))
        at = 512 * 18  # the last inner header promises more than the whole shard holds
        held[at + 124 : at + 136] = b"%011o\0" % 50_000_000
        held[at + 148 : at + 156] = b" " * 8
        held[at + 148 : at + 156] = b"%06o\0 " % sum(held[at : at + 512])
        return [("item_1_a.txt", b"a" * 900), ("item_2_a.tar", bytes(held))]
    return []


KINDS = [
    "plain", "long names", "folders", "one huge member", "huge last member",
    "tar inside", "cut tar inside", "cut tar at the end", "empty",
]


@pytest.fixture(scope="module")
def shards(tmp_path_factory):
    folder = tmp_path_factory.mktemp("split")
    for n, kind in enumerate(KINDS):
        for form in (tarfile.PAX_FORMAT, tarfile.GNU_FORMAT):
            write_tar(folder / f"{n}-{form}.tar", contents(kind), format=form)
    expected = []
    for path in sorted(folder.iterdir()):
        with open(path, "rb") as shard:
            expected += [(str(path), m.offset, m.name, m.size) for m in walk_members(shard)]
    return str(folder), expected


@pytest.mark.parametrize("stretch", [2048, 12_288])
def test_split_listing_is_exact(spark, shards, stretch):
    folder, expected = shards
    got = tar_members(spark, folder, stretch=stretch).select("tar", "offset", "name", "size").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_a_shard_that_is_cut_off_is_noticed(spark, tmp_path):
    path = tmp_path / "cut.tar"
    write_tar(path, contents("one huge member"))
    path.write_bytes(path.read_bytes()[:30_000])
    with pytest.raises(Exception, match="unexpected end of data"):
        tar_members(spark, str(path), stretch=4096).collect()
    # Listed by one task, it gives what is before the cut, and a row that says so.
    listed = tar_members(spark, str(path)).collect()
    (damage,) = shard_errors(spark, str(path)).collect()
    assert "unexpected end of data" in damage["error"] and damage["offset"] == max(r["offset"] for r in listed)


def test_rest_is_listed_again_after_a_wrong_guess(spark, tmp_path):
    # No header can be recognised: every guess finds nothing.
    path = tmp_path / "old.tar"
    write_tar(path, contents("plain"), format=tarfile.USTAR_FORMAT)
    raw = bytearray(path.read_bytes())
    at = 0
    with tarfile.open(path) as archive:
        offsets = [m.offset for m in archive]
    for at in offsets:
        raw[at + 257 : at + 265] = b"\0" * 8
        raw[at + 148 : at + 156] = b" " * 8
        raw[at + 148 : at + 156] = b"%06o\0 " % sum(raw[at : at + 512])
    path.write_bytes(raw)
    got = tar_members(spark, str(path), stretch=8192).orderBy("offset").collect()
    assert [r["offset"] for r in got] == offsets


def test_large_and_small_shards_together(spark, tmp_path):
    write_tar(tmp_path / "large.tar", contents("plain"))
    write_tar(tmp_path / "small.tar", [("item_1_s.txt", b"s")])
    write_tar(tmp_path / "packed.tar.gz", contents("folders"), "w:gz")
    whole = tar_members(spark, str(tmp_path))
    split = tar_members(spark, str(tmp_path), stretch=10_240)
    assert whole.count() == 60 + 1 + 30
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.select(*whole.columns).collect()))


def test_an_exact_stretch_starts_with_its_header(tmp_path):
    path = write_tar(tmp_path / "a.tar", contents("plain"))
    with open(path, "rb") as shard:
        rows = list(list_stretch(shard, 0, 1 << 40, True))
    assert [r[0] for r in rows] == ["member"] * 60 + ["end"]
