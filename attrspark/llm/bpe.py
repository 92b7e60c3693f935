"""Token ids of whole texts with the `tokenizers` library, remembering common chunks.

A byte-level BPE first cuts a text where white space meets text and never merges across
those cuts. In a text whose white space is single spaces and line feeds only, the cuts
before each space and around each line feed are therefore safe: such a text is cut there,
each distinct chunk is encoded once, and the ids are put together with array operations.
Any other text is encoded whole. Both ways give the same ids.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from attrspark.llm.words import span_hashes, slices

_KEEP_BYTES = 64
_JOINED = 1000
#: Bytes of text handled at a time: the library's own results take about a hundred for each.
_SLICE = 1 << 20


class Memory:
    """Ids of chunks by hash, as arrays: sorted hashes, and where each one's ids are in a pool."""

    def __init__(self, limit: int):
        self.limit = limit
        self.keep(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def keep(self, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pool: np.ndarray) -> None:
        """Know these chunks and no others."""
        order = np.argsort(keys)
        self.keys, self.starts, self.lengths, self.pool = keys[order], starts[order], lengths[order], pool

    def add(self, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pool: np.ndarray) -> None:
        """Know these as well; `pool` goes on from the one there is."""
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.starts, self.lengths = (
            np.insert(old, at, new[order])
            for old, new in ((self.keys, keys), (self.starts, starts), (self.lengths, lengths))
        )
        self.pool = pool

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether known, place) of each hash."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at


def gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of a pool that begin at `starts`, one after the other."""
    upto = np.cumsum(lengths)
    return pool[np.repeat(starts - (upto - lengths), lengths) + np.arange(upto[-1] if len(upto) else 0)]


class Encoder:
    """Encodes texts to unsigned 32-bit ids; one per worker and file.

    `remember` bounds the number of remembered chunks, and so the memory; beyond it, those of
    the last few texts stay. Strings of special tokens in a text become these tokens, as the
    library does it by default; with `ordinary_specials` they are ordinary text.
    """

    _made: dict[tuple, "Encoder"] = {}

    def __init__(self, path: str, remember: int = 500_000, ordinary_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary_specials
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memory = Memory(remember)
        # A byte-level piece has one letter per byte; a special token stands for its own text.
        special = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.widths = np.zeros(1 + max(self.tokenizer.get_vocab().values()), np.int64)
        for piece, i in self.tokenizer.get_vocab().items():
            self.widths[i] = special.get(i, len(piece))

    @classmethod
    def of(cls, path: str, remember: int = 500_000, ordinary_specials: bool = False) -> "Encoder":
        key = (path, remember, ordinary_specials)
        if key not in cls._made:
            cls._made[key] = cls(*key)
        return cls._made[key]

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each chunk, all ids) of distinct chunks.

        Many chunks are encoded as one text: one that begins with a space follows another as in a
        text, any other after a line feed of its own. Ids give their bytes, which tell where each
        chunk ends. White space alone would join with what follows and goes by itself.
        """
        lengths = np.zeros(len(chunks), np.int64)
        parts: list[np.ndarray] = []
        texts, spans = [], []
        for first in range(0, len(chunks), _JOINED):
            run = [b"" if c in (b" ", b"\n") else c if c[:1] == b" " else b"\n" + c for c in chunks[first : first + _JOINED]]
            texts.append(b"".join(run).decode("utf-8", "replace"))
            spans.append(run)
        alone = {c: ids for c, ids in zip((b" ", b"\n"), self._encoded([" ", "\n"]))}
        for k, ids in enumerate(self._encoded(texts)):
            run = spans[k]
            ends = np.cumsum([len(c) for c in run])
            tokens = np.concatenate(([0], np.cumsum(self.widths[ids])))
            if tokens[-1] != ends[-1]:  # bytes that are no UTF-8
                each = self._encoded([c.decode("utf-8", "replace") for c in chunks[k * _JOINED : (k + 1) * _JOINED]])
            else:
                cuts = np.concatenate(([0], np.searchsorted(tokens, ends)))
                fed = [c[:1] == b"\n" for c in run]
                marks = cuts[:-1] + np.array(fed, np.int64)  # without the line feed before it
                size = cuts[1:] - marks
                if not any(c in alone for c in chunks[k * _JOINED : (k + 1) * _JOINED]):
                    lengths[k * _JOINED : k * _JOINED + len(run)] = size
                    kept = np.ones(len(ids), bool)
                    kept[cuts[:-1][np.array(fed)]] = False
                    parts.append(ids[kept])
                    continue
                each = [
                    alone[c] if c in alone else ids[m : m + n]
                    for c, m, n in zip(chunks[k * _JOINED : (k + 1) * _JOINED], marks, size)
                ]
            lengths[k * _JOINED : k * _JOINED + len(each)] = [len(x) for x in each]
            parts += each
        return lengths, np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def _slice(self, data: np.ndarray, offsets: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        whole = _irregular(data, offsets)
        begins, ends = _chunk_spans(data, offsets)
        of_row = np.searchsorted(begins, offsets)
        if whole.any():
            kept = ~np.repeat(whole, np.diff(of_row))
            begins, ends = begins[kept], ends[kept]
            of_row = np.searchsorted(begins, offsets)
        coded = pa.array(span_hashes(data, begins, ends)).dictionary_encode()
        keys, inverse = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        first = np.empty(len(keys), np.int64)
        first[inverse[::-1]] = np.arange(len(inverse) - 1, -1, -1)
        raw = data.tobytes()
        memory = self.memory
        known, at = memory.find(keys)
        new = np.flatnonzero(~known)
        spans = zip(begins[first[new]].tolist(), ends[first[new]].tolist())
        more, ids = self._chunks([raw[b:e] for b, e in spans])
        pool = np.concatenate((memory.pool, ids))
        starts, lengths = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        starts[known], lengths[known] = memory.starts[at[known]], memory.lengths[at[known]]
        starts[new], lengths[new] = len(memory.pool) + np.cumsum(more) - more, more
        self._remember(keys, starts, lengths, pool, new, ends[first] - begins[first] <= _KEEP_BYTES)
        each = lengths[inverse]
        ids = gathered(pool, starts[inverse], each)
        bounds = np.concatenate(([0], np.cumsum(each)))[of_row]
        if whole.any():
            rows = [ids[bounds[i] : bounds[i + 1]] for i in range(len(whole))]
            which = np.flatnonzero(whole)
            for i, code in zip(which, self._encoded([raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace") for i in which])):
                rows[i] = code
            ids = np.concatenate(rows)
            bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        if end is not None:
            ids = np.insert(ids, bounds[1:], np.uint32(end))
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds

    def _remember(self, keys, starts, lengths, pool, new, short) -> None:
        memory = self.memory
        added = new[short[new]]
        if len(memory.keys) + len(added) <= memory.limit:
            memory.add(keys[added], starts[added], lengths[added], pool)
            return
        used = np.flatnonzero(short)[: memory.limit]
        ids = gathered(pool, starts[used], lengths[used])
        memory.keep(keys[used], np.cumsum(lengths[used]) - lengths[used], lengths[used], ids)

    def encode(self, column: pa.Array, end: int | None = None):
        """Yields (first row, ids, row offsets) for runs of rows; `end` closes every row."""
        for first, _, data, offsets in slices(column, _SLICE):
            yield first, *self._slice(data, offsets, end)


def binary_rows(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One little-endian binary value per row."""
    raw = np.ascontiguousarray(ids, dtype="<u4")
    offsets = pa.py_buffer((np.asarray(bounds) * 4).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(raw)])


def _chunk_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every chunk: a line feed, or text with the space before it."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    feed = data == 10
    starts = feed | (data == 32) | edge[:-1]
    starts[1:] |= feed[:-1]
    begins = np.flatnonzero(starts)
    return begins, np.append(begins[1:], n)


def _irregular(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with white space other than single spaces and line feeds between other characters."""
    rows = np.zeros(len(offsets) - 1, dtype=bool)
    if not len(data):
        return rows
    control = (data < 32) & (data != 10)
    blank = (data == 32) | (data == 10)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    control[1:] |= blank[1:] & blank[:-1] & ~edge[1:-1]
    at = np.flatnonzero(control)
    # White space above ASCII: U+0085, U+00A0, U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    if len(lead):
        padded = np.concatenate((data, np.zeros(2, np.uint8)))
        a, b, c = padded[lead], padded[lead + 1], padded[lead + 2]
        odd = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        odd |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
        odd |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        odd |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
        odd |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
        at = np.concatenate((at, lead[odd]))
    rows[np.searchsorted(offsets, at, side="right") - 1] = True
    return rows
