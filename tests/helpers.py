"""Small files for tests: PNG images and tar shards."""

import io
import struct
import tarfile
import zlib

from attrspark.plans.inputs import png_bytes


def palette_png(width, height):
    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = struct.pack(">IIBBBBB", width, height, 8, 3, 0, 0, 0)
    rows = (b"\x00" + b"\x00" * width) * height
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", head)
        + chunk(b"PLTE", b"\x01\x02\x03")
        + chunk(b"IDAT", zlib.compress(rows))
        + chunk(b"IEND", b"")
    )


def write_tar(path, entries, mode="w", **options):
    """Entries are (name, bytes), or (name, None) for a directory."""
    with tarfile.open(path, mode, **options) as archive:
        for name, content in entries:
            info = tarfile.TarInfo(name)
            if content is None:
                info.type = tarfile.DIRTYPE
                archive.addfile(info)
            else:
                info.size = len(content)
                archive.addfile(info, io.BytesIO(content))
    return str(path)


__all__ = ["palette_png", "png_bytes", "write_tar"]
