"""Word hashes and token ids against plain Python."""

import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from attrspark.llm.bpe import Encoder
from attrspark.llm.words import slices, word_hashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b", "a\n b", " lead", "trail ", "x\ty", "a\n\nb", "\xa0é ü", " z q", "it's 's 12 ab12", "“q” …", "a\x00b \x1c c", "<|endoftext|> x", "　"]


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b.中", max_size=30)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_are_found_and_hashed_alike(texts):
    pattern = re.compile(rb"[^\x20\x09-\x0D]+")
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    seen = {}
    for first, end, data, offsets in slices(pa.array(texts, pa.string()), 16):
        hashes, of_row = word_hashes(data, offsets)
        for i in range(first, end):
            words = pattern.findall((texts[i] or "").encode().translate(lower))
            found = hashes[of_row[i - first] : of_row[i - first + 1]].tolist()
            assert len(found) == len(words)
            for word, value in zip(words, found):
                assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def ids_of(encoder, texts, end=None):
    out = []
    for _, ids, bounds in encoder.encode(pa.array(texts, pa.string()), end):
        out += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    return out


@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(alphabet="ab Cé\n.,'1 ", max_size=40), st.text(max_size=20)), max_size=8))
@settings(max_examples=60, deadline=None)
def test_ids_equal_those_of_the_library(texts):
    plain = Tokenizer.from_file(PATH)
    for ordinary in (True, False):
        plain.encode_special_tokens = ordinary
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids_of(Encoder.of(PATH, ordinary_specials=ordinary), texts) == want


def test_many_joined_chunks_equal_the_library():
    """Several runs of joined chunks, with special strings, first words, lone spaces and line feeds among them."""
    rng = np.random.default_rng(8)
    pieces = ["<|endoftext|>", " ", "\n", "'s", "ü中", "12", *(f"w{i}x" for i in range(3000))]
    texts = ["".join(rng.choice(pieces + [" "] * 2000, 400)) for _ in range(40)]
    texts += [" ".join(rng.choice(pieces[3:], 500)) + "\n" + "\n ".join(rng.choice(pieces[3:], 20)) for _ in range(20)]
    plain = Tokenizer.from_file(PATH)
    encoder = Encoder(PATH)
    for _ in range(2):  # the second time from memory
        assert ids_of(encoder, texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_bounded_memory_and_end_id():
    encoder = Encoder(PATH, remember=3)
    assert ids_of(encoder, ["one two three four five", None, "one two"], 2)[1:] == [[2], ids_of(encoder, ["one two"])[0] + [2]]
    assert len(encoder.memory.keys) <= 3


@pytest.mark.parametrize("size", [1, 3, 1 << 20])
def test_slices_cover_all_rows(size):
    column = pa.chunked_array([["aa", None], ["bbbb", "", "c" * 50]])
    rows = [(first, end, data.tobytes(), np.diff(offsets).tolist()) for first, end, data, offsets in slices(column, size)]
    assert [r for first, end, *_ in rows for r in range(first, end)] == list(range(5))
    assert b"".join(r[2] for r in rows) == b"aabbbb" + b"c" * 50
