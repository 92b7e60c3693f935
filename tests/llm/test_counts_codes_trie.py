"""Token counts, vector codes and the conversation trie against brute-force versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from attrspark.llm import conversation_trie as trie
from attrspark.llm import token_counts as counts
from attrspark.llm import vector_codes as codes

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def model():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


ODD_TEXTS = [
    None, "", " ", "  ", "\n", "a", "A", "a  b", " a", "a ", "a\tb\r\nc", "ﬁne Ünïcode 日本語 🙂", "<s> </s> <unk> <0x41>",
    "▁a ▁", "é é", " x y", "x" * 500, "word " * 3000,
]


def test_counts_equal_the_library(spark):
    rows = [(i, t, "x", 7) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", "x", 7), (None, None, "x", 7), (3, "again", "x", 7), (3, "again", "x", 7), (90, "again", "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content string, n_tokens int").repartition(3)
    for path, of in (
        (PIECES, lambda t: len(model().encode(t))),
        (BYTES, lambda t: len(Tokenizer.from_file(BYTES).encode(t, add_special_tokens=False).ids)),
    ):
        found = sorted(map(tuple, counts.token_counts(docs, path, limit=50).collect()), key=repr)
        wanted = [(i, len((t or "").encode()), of(t or "")) for i, t, *_ in rows]
        assert found == sorted(((*w, w[2] > 50) for w in wanted), key=repr)


def test_special_strings_are_handled_as_by_default(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    assert counts.token_counts(docs, BYTES).first()["n_tokens"] == 3


def test_long_texts_in_parts_count_as_whole():
    rng = random.Random(3)
    alphabet = ["a", "bc", " ", "  ", "\n", "▁", "é", "日本", ".", "the ", " of", "\t"]
    text = "".join(rng.choices(alphabet, k=6000))
    assert counts._words_apart(model())
    for size in (1, 7, 100, 5000):
        parts = counts._parts(text, size)
        assert sum(len(model().encode(p)) for p in parts) == len(model().encode(text))
    assert len(counts._parts(text, 100)) > 20
    assert counts._parts("x" * 1000, 10) == ["x" * 1000]
    assert counts._parts("", 10) == [""]


def test_cache_is_used_and_kept_per_tokenizer(spark, tmp_path, monkeypatch):
    cache = f"{tmp_path}/cache"
    docs = spark.createDataFrame([(1, "one"), (2, "one"), (3, "two words"), (4, None)], "doc_id long, text string")
    first = sorted(map(tuple, counts.token_counts(docs, PIECES, cache).collect()))
    stored = spark.read.parquet(cache)
    assert stored.count() == 3  # each content once, the empty one too
    more = docs.union(spark.createDataFrame([(5, "three")], "doc_id long, text string"))
    asked = []
    encode = counts._encode

    def watched(path):
        inner = encode(path)

        def run(batches):
            for batch in inner(batches):
                yield batch

        asked.append(path)
        return run

    monkeypatch.setattr(counts, "_encode", watched)
    again = sorted(map(tuple, counts.token_counts(more, PIECES, cache).collect()))
    assert again[:4] == first and again[4][0] == 5 and asked
    assert spark.read.parquet(cache).count() == 4  # only the new one was added
    # What the cache says counts: a planted number comes back.
    version = counts.tokenizer_digest(PIECES)
    planted = spark.createDataFrame([(hashlib.sha256(b"planted").digest(), 99, version)], counts.CACHE)
    planted.write.partitionBy("tokenizer").mode("append").parquet(cache)
    known = spark.createDataFrame([(9, "planted")], "doc_id long, text string")
    assert counts.token_counts(known, PIECES, cache).first()["n_tokens"] == 99
    assert counts.token_counts(known, BYTES, cache).first()["n_tokens"] != 99
    assert counts.tokenizer_digest(BYTES) != version


def test_counts_of_no_documents_and_of_many_copies(spark):
    assert counts.token_counts(spark.createDataFrame([], "doc_id long, text string"), PIECES).count() == 0
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same text', concat('text ', id)) AS text")
    found = counts.token_counts(docs, PIECES).collect()
    assert len({r["doc_id"] for r in found}) == 3000
    of = model()
    assert all(r["n_tokens"] == len(of.encode("same text" if r["doc_id"] % 3 == 0 else f"text {r['doc_id']}")) for r in found)


# ---- vector codes ----


def brute_codes(rows, entries, parts, rounds):
    """rows of (vec_id, vector or None, label) -> (vec_id, label, code, error), codebooks text."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(1024 * x) for x in r[1]] for r in kept]
    width = len(ints[0]) // parts
    cut = [[v[k * width : (k + 1) * width] for k in range(parts)] for v in ints]
    order = sorted((i for i in range(len(kept)) if kept[i][0] is not None), key=lambda i: (kept[i][0], kept[i][1]))
    first, seen = [], set()
    for i in order:
        if kept[i][0] not in seen and len(first) < entries:
            seen.add(kept[i][0])
            first.append(i)
    books = [[cut[i][k] for i in first] for k in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(book))

    for turn in range(rounds + 1):
        found = [[nearest(c[k], books[k]) for k in range(parts)] for c in cut]
        if turn == rounds:
            break
        for k in range(parts):
            for j in range(len(books[k])):
                mine = [c[k] for c, f in zip(cut, found) if f[k][1] == j]
                if mine:
                    books[k][j] = [sum(x) // len(mine) for x in zip(*mine)]
    text = ",".join(str(x) for book in books for e in book for x in e)
    out = [(r[0], r[2], "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f)) for r, f in zip(kept, found)]
    return out, hashlib.sha256(text.encode()).hexdigest()


def test_codes_equal_full_scans(spark):
    rng = random.Random(11)
    # Coarse values make many ties and entries that stop moving.
    rows = [(i, [rng.choice([-2, -1, 0, 1, 3]) / 512 + 0.0 for _ in range(8)], rng.choice([0, 1, None])) for i in range(300)]
    rows += [(400, None, 1), (401, [1.0] * 7 + [None], 1), (402, [math.nan] * 8, 0), (403, [math.inf] + [0.0] * 7, 0)]
    rows += [(5, rows[5][1], 1), (5, [0.25] * 8, 9), (None, [0.125] * 8, 9), rows[7], rows[7]]
    rng.shuffle(rows)
    schema = "vec_id long, embedding array<float>, label int, codes string, ids string"
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], schema).repartition(3)
    for entries, rounds in ((4, 4), (16, 3), (256, 2), (16, 0)):
        found = codes.vector_codes(table, entries=entries, parts=4, rounds=rounds).collect()
        wanted, digest = brute_codes(rows, entries, 4, rounds)
        assert sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in found), key=repr) == sorted(wanted, key=repr)
        assert {r["codebooks_sha256"] for r in found} == {digest}
        sums = {}
        for _, label, _, error in wanted:
            sums[label] = sums.get(label, 0) + error
        assert all(r["label_error"] == sums[r["label"]] for r in found)


def test_active_entries_equal_full_scans():
    rng = np.random.default_rng(2)
    for _ in range(50):
        parts = rng.integers(-3, 4, (40, 3))
        old = rng.integers(-3, 4, (9, 3))
        new = np.where(rng.random((9, 1)) < 0.4, rng.integers(-3, 4, (9, 3)), old)
        at, stored = codes.assigned(parts, old)
        found = codes.reassigned(parts, new, (new != old).any(axis=1), at, stored)
        assert all((a == b).all() for a, b in zip(found, codes.assigned(parts, new)))
        assert (codes.distances(parts, new) == ((parts[:, None] - new) ** 2).sum(axis=2)).all()
    far = np.array([[1 << 27, -(1 << 27)]])
    assert codes.distances(far, -far)[0, 0] == 2 * (1 << 28) ** 2


def test_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<double>, label string"
    assert codes.vector_codes(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [0.5, -0.5, 0.0, 1.0], "a"), (2, [0.1, 0.2], "a"), (3, [1e300, 0.0, 0.0, 0.0], "b"), (4, [0.5, -0.5, 0.0, 1.0], "a")]
    found = {r["vec_id"]: r for r in codes.vector_codes(spark.createDataFrame(rows, schema)).collect()}
    assert found[1]["code"] == found[4]["code"] == "00000000" and found[1]["error"] == 0
    assert found[2]["code"] is None and found[3]["error"] is None and found[3]["label_error"] is None
    for only in ([(1, [0.5, 0.5, 0.5], "a")], [(None, [0.5] * 4, "a")], [(1, [], "a")]):
        row = codes.vector_codes(spark.createDataFrame(only, schema)).first()
        assert row["code"] is None and row["codebooks_sha256"] == hashlib.sha256(b"").hexdigest()


# ---- conversations ----


def brute_trie(rows, groups=5, folds=9):
    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % folds
        path = own.get(c - math.fmod(c, groups), [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    out = []
    for node, convs in members.items():
        under = [n for n in members if n[: len(node)] == node]
        kids = {n: sum(1 for m in members if len(m) == len(n) + 1 and m[: len(n)] == n) for n in under}
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), kids[node],
            sum(k == 0 for k in kids.values()),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations(rng, n):
    rows = []
    for c in rng.sample(range(3 * n), n):
        shared = rng.random() < 0.5
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            text = f"hot {t}" if shared and t < 4 else rng.choice(["a", "b", "é", "", None, f"own {c}"])
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "user", None]), text))
    copies = [(1000 + 5 * k + 1, t, "user", f"copy {t}") for k in range(60) for t in range(3)]
    rows += copies + [(None, 1, "user", "lost"), rows[0], rows[0], (-7, 0, "user", "below"), (-5, 0, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [5, 40, 200_000])
def test_trie_equals_brute_force(spark, monkeypatch, limit):
    """Also with shards of a few turns, where most nodes are shared by several."""
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = conversations(random.Random(limit), 60)
    schema = "conv_id long, turn long, role string, text string, key string, depth int, path string"
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema).repartition(3)
    shards = trie._shards

    def small(batches):
        trie.SHARD_TURNS, before = limit, trie.SHARD_TURNS
        try:
            yield from shards(batches)
        finally:
            trie.SHARD_TURNS = before

    monkeypatch.setattr(trie, "_shards", small)
    found = sorted(map(tuple, trie.conversation_trie(table).collect()), key=repr)
    assert found == brute_trie(rows)


def test_trie_of_no_and_of_turnless_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], schema)).count() == 0
    short = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    found = [tuple(r) for r in trie.conversation_trie(spark.createDataFrame([(short, 0, "user", "x")], schema)).collect()]
    assert found == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


def test_long_conversation(spark):
    rows = [(5, t, "user", "x" * (t % 7)) for t in range(5000)]
    schema = "conv_id long, turn long, role string, text string"
    found = trie.conversation_trie(spark.createDataFrame(rows, schema))
    assert found.count() == 5001 and found.agg({"n_leaves": "max", "depth": "max"}).first().asDict() == {"max(n_leaves)": 1, "max(depth)": 5000}


def test_double_array_finds_what_was_placed():
    rng = random.Random(4)
    array, wanted, nodes = trie.DoubleArray(0), {}, [0]
    for _ in range(300):
        node = nodes.pop(rng.randrange(len(nodes)))
        chosen = sorted(rng.sample(range(200), rng.choice([1, 1, 2, 9])))
        for code, place in zip(chosen, array.place(node, chosen)):
            wanted[node, code] = place
            nodes.append(place)
    assert len(set(wanted.values())) == len(wanted)
    for node in {n for n, _ in wanted}:
        for code in range(-1, 201):
            assert array.child(node, code) == wanted.get((node, code), -1)
