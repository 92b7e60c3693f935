"""The plain PNG forms: 8 bits a channel, grey, RGB or RGBA, not interlaced, no transparent colour."""

from __future__ import annotations

import struct
import zlib
from typing import BinaryIO

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Mode and channels by the colour type of the header.
PLAIN = {0: ("L", 1), 2: ("RGB", 3), 6: ("RGBA", 4)}
MAX_BYTES = (1 << 31) - 1


def plain_parts(file: BinaryIO, length: int) -> tuple[int, int, int, list[tuple[int, int]]] | None:
    """(width, height, colour type, [(place, length)] of the pixel chunks), or None for other forms."""
    head = file.read(33)
    if len(head) < 33 or head[:16] != SIGNATURE + b"\x00\x00\x00\x0dIHDR":
        return None
    width, height, bits, kind, *rest = struct.unpack(">IIBBBBB", head[16:29])
    if bits != 8 or kind not in PLAIN or any(rest) or not 0 < width * height * 4 + height <= MAX_BYTES:
        return None
    at, parts = 33, []
    while True:
        file.seek(at)
        chunk = file.read(8)
        name = chunk[4:]
        if name != b"IDAT" and parts:
            return width, height, kind, parts
        size = int.from_bytes(chunk[:4], "big")
        if len(chunk) < 8 or name in (b"tRNS", b"IEND") or at + 12 + size > length:
            return None
        if name == b"IDAT":
            parts.append((at + 8, size))
        at += 12 + size


def _unfiltered(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Bytes (height, width, channels) from filtered ones and the filter of each row."""
    if not kinds.any():
        return rows
    height, width, channels = rows.shape
    if kinds.max() <= 2:
        out = np.array(rows)
        for r in np.flatnonzero(kinds):
            if kinds[r] == 1:
                out[r] = np.cumsum(rows[r], axis=0, dtype=np.uint8)
            elif r:
                out[r] += out[r - 1]
        return out
    # Each byte needs those to its left, above, and above left: the pixels of an anti-diagonal
    # go together. `last` and `before` are the two diagonals before, by row, after a row of zeros.
    out = np.zeros((height, width, channels), np.uint8)
    last, before = np.zeros((2, height + 1, channels), np.int16)
    kind = kinds[:, None]
    for d in range(height + width - 1):
        r = np.arange(max(0, d - width + 1), min(height - 1, d) + 1)
        left, up, corner, k = last[r + 1], last[r], before[r], kind[r]
        guess = left + up - corner
        a, b, c = abs(guess - left), abs(guess - up), abs(guess - corner)
        paeth = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        base = np.select([k == 1, k == 2, k == 3, k == 4], [left, up, (left + up) >> 1, paeth], 0)
        found = (rows[r, d - r] + base) & 255
        out[r, d - r] = found
        before, last = last, np.zeros_like(last)
        last[r + 1] = found
    return out


def pixels(content: bytes, width: int, height: int, kind: int, parts: list[tuple[int, int]]) -> bytes | None:
    """Grey, BGR or BGRA bytes by row; None for damaged pixels."""
    channels = PLAIN[kind][1]
    size = height * (1 + width * channels)
    try:
        unpack = zlib.decompressobj()
        raw = unpack.decompress(b"".join(content[a : a + n] for a, n in parts), size)
    except zlib.error:
        return None
    if len(raw) < size:
        return None
    rows = np.frombuffer(raw, np.uint8).reshape(height, 1 + width * channels)
    kinds = rows[:, 0]
    if kinds.max() > 4:
        return None
    found = _unfiltered(kinds, rows[:, 1:].reshape(height, width, channels))
    if channels > 1:
        found = found[:, :, [2, 1, 0, 3][:channels]]
    return found.tobytes()
