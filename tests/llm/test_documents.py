"""Document operators against brute-force versions on small fixtures."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrspark.llm import decontaminate, kneser_ney, licenses, minhash, simhash, suffix_tree
from attrspark.llm.components import components

SCHEMA = "doc_id long, text string, id string, component string, bucket int, block int, rank int, held string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3, "z") for r in rows], SCHEMA).repartition(3)


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def shingles(text, size):
    w = words_of(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


def text_of(rng, n, vocabulary=400):
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def near_fixture():
    rng = random.Random(5)
    texts = [text_of(rng, rng.randint(1, 60)) for _ in range(60)]
    chain = text_of(rng, 80).split()
    for k in range(12):  # each near the next, the ends far apart
        chain = chain[:]
        for i in rng.sample(range(80), 3):
            chain[i] = f"c{k}{i}"
        texts.append(" ".join(chain))
    base = text_of(rng, 50).split()
    for k in range(25):  # many variants of one text, some linked and some not
        w = base[:]
        for i in rng.sample(range(50), rng.choice([1, 2, 4, 7])):
            w[i] = f"v{k}{i}"
        texts.append(" ".join(w))
    texts += texts[:5] + [texts[0].upper(), None, "", " \n", "one", "One", "é\xa0x"]
    rows = list(enumerate(texts, 100))
    rng.shuffle(rows)
    return rows + [(100, texts[0]), (None, texts[0]), (None, None)]


def brute_components(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets[doc_id] = shingles(text, size)
    top = {d: d for d in sets}

    def root(d):
        while top[d] != d:
            d = top[d]
        return d

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            top[y] = x
    return {d: root(d) for d in sets}, sets


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    rows = near_fixture()
    want, sets = brute_components(rows, size, 80)
    got = minhash.near_duplicates(frame(spark, rows), size).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.n_shingles, r.kept) == (want[r.doc_id], len(sets[r.doc_id]), want[r.doc_id] == r.doc_id), r
    assert size == 5 or len(set(want.values())) < len(want) - 20


def test_what_stars_miss_is_found_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "_BLOCK", 4)
    rows = near_fixture()
    want, _ = brute_components(rows, 2, 80)
    got = minhash.near_duplicates(frame(spark, rows), 2).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want


def test_no_documents(spark):
    empty = frame(spark, [(1, "x")]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert minhash.near_duplicates(empty).count() == 0
    assert simhash.edited_fingerprints(empty).count() == 0
    assert kneser_ney.toxicity(empty, labels).count() == 0
    assert suffix_tree.scored(empty.withColumn("held_out", F.lit(False))).count() == 0
    assert licenses.license_matches(empty, licenses.notices(spark)).count() == 0
    assert decontaminate.contaminated(empty, spark.createDataFrame([(1, "x")], "item_id long, text string")).count() == 0


def test_densified_minima_estimate_similarity():
    sketcher = minhash.Sketcher(100, 5)
    rng = np.random.default_rng(1)
    for n, share in ((10, 0.8), (300, 0.5), (2000, 0.8)):
        both = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        common = int(round(n * share))
        a, b = np.unique(both[:n]), np.unique(both[n - common : 2 * n - common])
        jaccard = common / (2 * n - common)
        alike = (sketcher.minima(a) == sketcher.minima(b)).mean()
        assert abs(alike - jaccard) < 0.12


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    top = {}
    for a, b in links:
        if a is not None and a != b:
            group = {x for x in top if top[x] in (top.get(a, a), top.get(b, b))} | {a, b}
            top |= dict.fromkeys(group, min(min(group), *(top.get(x, x) for x in group)))
    assert got == top


def test_toxicity(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = text_of(rng, rng.randint(20, 60)).split()
        if toxic:
            for _ in range(2):
                words[rng.randrange(len(words))] = "zorg" + rng.choice("abcdefgh") + rng.choice(["um", "ax", "il"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "zorgaum zorgbax"), (5, rows[5][1]), (1002, "ZORGCUM you")]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in rows if i is not None}
    frames = frame(spark, rows), spark.createDataFrame(labels + [(0, None), (0, 1), (None, 1)], "doc_id long, toxic int")
    got = kneser_ney.toxicity(*frames).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == held.get(r.doc_id, True) for r in got)
    right = [r.predicted == (r.doc_id % 6 == 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(right) >= 0.95 * len(right)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1002].predicted == 1 and by_id[None].predicted == 1 and by_id[1000].score == by_id[1001].score
    # Held-out labels change nothing.
    flipped = frames[1].withColumn("toxic", F.when(kneser_ney.is_held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in kneser_ney.toxicity(frames[0], flipped).collect()}
    assert all(math.isclose(again[r.doc_id], r.score, abs_tol=1e-9) for r in got)


def test_toxicity_without_labels_of_both_kinds(spark):
    docs = frame(spark, [(i, "a b c") for i in range(20)])
    for labels, want in (([], 0.0), ([(i, 0) for i in range(20)], 0.0), ([(i, 1) for i in range(20)], 1.0)):
        got = kneser_ney.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert all(abs(r.score - want) < 1e-3 for r in got)


def brute_ratios(words, discount):
    """Log ratios by plain dictionaries; `words` are (word, is toxic). -> {n-gram: ratio}, {context: ratio}"""
    order = kneser_ney.ORDER
    raw = [{}, {}]
    for word, toxic in words:
        marked = b" " + word.encode()
        for i in range(1, len(marked)):
            gram = marked[max(0, i + 1 - order) : i + 1]
            raw[toxic][gram] = raw[toxic].get(gram, 0) + 1
    types = {n: set() for n in range(1, order + 1)}  # n-grams that occur, also inside longer ones
    for gram in [*raw[0], *raw[1]]:
        types[len(gram)].add(gram)
    follows = {}
    for n in range(order, 1, -1):
        for gram in types[n]:
            follows[gram[1:]] = follows.get(gram[1:], 0) + 1
            types[n - 1].add(gram[1:])

    def shared(h, x):
        if not h:
            total = sum(c for g, c in follows.items() if len(g) == 1)
            kinds = sum(1 for g in follows if len(g) == 1)
            return max(follows.get(x, 0) - discount, 0) / total + discount * kinds / total / 256
        after = [c for g, c in follows.items() if len(g) == len(h) + 1 and g[:-1] == h]
        if not after:
            return shared(h[1:], x)
        return max(follows.get(h + x, 0) - discount, 0) / sum(after) + discount * len(after) / sum(after) * shared(h[1:], x)

    def conditional(k, h, x):
        after = [c for g, c in raw[k].items() if g[:-1] == h]
        if not after:
            return shared(h[1:], x)
        return max(raw[k].get(h + x, 0) - discount, 0) / sum(after) + discount * len(after) / sum(after) * shared(h[1:], x)

    def free(k, h):
        after = [c for g, c in raw[k].items() if g[:-1] == h]
        return discount * len(after) / sum(after) if after else 1.0

    grams = {*raw[0], *raw[1]}
    of_gram = {g: math.log(conditional(1, g[:-1], g[-1:])) - math.log(conditional(0, g[:-1], g[-1:])) for g in grams}
    of_context = {h: math.log(free(1, h)) - math.log(free(0, h)) for h in {g[:-1] for g in grams}}
    distribution = [sum(conditional(k, h, bytes([x])) for x in range(256)) for k in (0, 1) for h in list(of_context)[:5]]
    counts = [c for r in raw for c in r.values()]
    return of_gram, of_context, distribution, (counts.count(1), counts.count(2))


def number(gram):
    return int.from_bytes(gram, "big")


def test_class_models_equal_dictionaries(spark):
    """Every n-gram has the ratio of a plain model with full recursion, those seen once too."""
    rng = random.Random(6)
    alphabet = ["ab", "c", "Dé", "f", "abc", "longer"]
    rows = []
    for i in range(40):
        text = " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12)))
        rows.append((text, i % 3 == 0, i % 4 != 0))
    sample = spark.createDataFrame([(t, int(a), int(b)) for t, a, b in rows], "text string, toxic int, kept int").repartition(3)
    counted = kneser_ney.count_grams(sample)
    kept = [(w, toxic) for t, toxic, k in rows if k for w in words_of(t)]
    _, _, _, (once, twice) = brute_ratios(kept, 0.5)
    discount = min(max(once / (once + 2 * twice), 0.1), 0.9)
    of_gram, of_context, sums, _ = brute_ratios(kept, discount)
    assert np.allclose(sums, 1, atol=0.02)  # all but what single bytes leave to bytes in no text
    model = kneser_ney.Model.read(kneser_ney.learn(counted, F.col("ordinary_kept"), F.col("toxic_kept")))
    assert len(model.grams.keys) == len(of_gram) and len(model.contexts.keys) == len(of_context)
    got = model.values(np.array([number(g) for g in of_gram], np.uint64))
    assert np.allclose(got, list(of_gram.values()), atol=1e-5)
    unknown = [h + b"~" for h in of_context]
    assert np.allclose(model.values(np.array([number(g) for g in unknown], np.uint64)), list(of_context.values()), atol=1e-5)
    assert not model.values(np.array([number(b"zzzzzzzz")], np.uint64)).any()


def test_ngrams_of_words():
    data = "Ab\x00 abcdefghijé".encode()
    grams, begins, ends = kneser_ney.symbols(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    want = [b" a", b" ab", b" ab\t"]
    want += [(" abcdefghijé".encode())[max(0, i - 7) : i + 1] for i in range(1, 13)]
    assert grams.tolist() == [number(g) for g in want]
    assert kneser_ney.gram_lengths(grams).tolist() == [len(g) for g in want]
    assert begins.tolist() == [0, 4] and ends.tolist() == [3, 16]


def test_the_curve_takes_a_fifth_of_the_rows_there_are():
    assert [kneser_ney.one_in(n, 20_000) for n in (0, 500, 80_000, 200_000)] == [5, 5, 5, 10]


def brute_print(text):
    w = words_of(text)
    terms = [(a, b) for a, b in zip(w, w[1:])] or [(x,) for x in w]
    return terms


def test_edited_fingerprints(spark):
    rng = random.Random(9)
    rows = [(i * 50, text_of(rng, rng.randint(0, 80))) for i in range(40)]
    rows += [(100, rows[2][1]), (150, "é中 ab"), (None, "first"), (3000, None), (3100, rows[4][1])]
    got = simhash.edited_fingerprints(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, prints = [], {}
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)
    by_id = {r.doc_id: r for r in got}
    assert by_id[200].fingerprint == by_id[3100].fingerprint and by_id[3000].fingerprint == "0" * 32
    for r in got:
        apart = bin(int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).count("1")
        assert r.near_edited == 1 - apart / 128
    full = [r for r in got if r.n_chars > 100]
    assert sum(r.near_edited > r.near_next for r in full) >= 0.9 * len(full)
    prints = [int(r.fingerprint, 16) for r in got]
    for r in got:
        near = sum(bin(int(r.fingerprint, 16) ^ p).count("1") <= simhash.RADIUS for p in prints)
        assert r.n_near == (near if r.doc_id is not None and r.doc_id % 100 == 0 else None)


def test_block_tables_find_every_fingerprint_in_the_radius(spark):
    rng = random.Random(4)
    base = rng.getrandbits(128)
    values = [base ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 6))) for _ in range(60)] + [base, base]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(signed(v & (1 << 64) - 1), signed(v >> 64)) for v in values]
    prints = spark.createDataFrame(rows, "f0 long, f1 long")
    for radius in (1, 3, 7):
        got = {(r.f0, r.f1): r.n_near for r in simhash.near_counts(prints, prints, radius).collect()}
        assert got == {k: sum(bin(v ^ o).count("1") <= radius for o in values) for k, v in zip(rows, values)}


def test_near_copies_are_found_with_their_ids(spark):
    rng = random.Random(12)
    rows = [(i, text_of(rng, 300, 4000)) for i in range(1, 60)]
    copies = {}
    for i in range(0, 10):  # a word in thirty replaced
        words = rows[10 * (i % 5)][1].split()
        for at in rng.sample(range(300), 10):
            words[at] = f"new{i}{at}"
        copies[100 * (i + 1)] = rows[10 * (i % 5)][0]
        rows.append((100 * (i + 1), " ".join(words)))
    got = {r.doc_id: r for r in simhash.edited_fingerprints(frame(spark, rows)).collect()}
    prints = {d: int(r.fingerprint, 16) for d, r in got.items()}
    least = {}
    for d in sorted(prints):
        least.setdefault(prints[d], d)
    found = 0
    for doc_id, original in copies.items():
        near = [d for d, p in prints.items() if bin(p ^ prints[doc_id]).count("1") <= simhash.RADIUS]
        classes = sorted({least[prints[d]] for d in near})
        assert got[doc_id].near_ids == classes and got[doc_id].n_near == len(near)
        found += original in near
    assert found == len(copies)
    assert got[1].near_ids is None


def test_a_group_of_copies_is_one_entry_of_a_list(spark):
    rows = [(i, "the same text in every one of these documents") for i in range(90, 301)]
    rows += [(None, rows[0][1]), (None, "another text, of no id at all")]
    got = {r.doc_id: r for r in simhash.edited_fingerprints(frame(spark, rows)).collect()}
    for doc_id in (100, 200, 300):
        assert got[doc_id].near_ids == [90] and got[doc_id].n_near == 212


def test_documents_of_many_blocks_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 40)
    rng = random.Random(3)
    rows = [(i * 7 % 211 - 100, text_of(rng, rng.randint(0, 6))) for i in range(211)]
    rows += [(5, "twice"), (5, "thrice"), (None, "none")]
    got = simhash.with_next(frame(spark, rows)).where("own").collect()
    assert len({r.block for r in got}) > 50
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = {(*a, b[1]) for a, b in zip(ordered, ordered[1:] + ordered[:1])}
    assert len(got) == len(rows) and {(r.doc_id, r.text, r.next_text) for r in got} == want


@pytest.mark.parametrize("radius", [0, 2, 10, 21])
def test_any_number_of_blocks_finds_the_same(spark, monkeypatch, radius):
    rng = random.Random(5)
    base = rng.getrandbits(128)
    values = [base ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 16))) for _ in range(50)] + [base, 0, (1 << 128) - 1]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(signed(v & (1 << 64) - 1), signed(v >> 64)) for v in values]
    prints = spark.createDataFrame(rows, "f0 long, f1 long")
    want = {k: sum(bin(v ^ o).count("1") <= radius for o in values) for k, v in zip(rows, values)}
    chosen = simhash.blocks_for
    for size in (1, 300_000):
        monkeypatch.setattr(simhash, "blocks_for", lambda r, n: chosen(r, size))
        assert {(r.f0, r.f1): r.n_near for r in simhash.near_counts(prints, prints, radius).collect()} == want


def test_suffix_tree(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a b c", "c d", "e a b", "F g"]) for _ in range(rng.randint(0, 9)))) for i in range(300)]
    rows += [(400, "unseen words here"), (401, None), (402, ""), (None, "a b c"), (7, rows[7][1])]
    docs = frame(spark, rows).withColumn("held_out", kneser_ney.is_held_out("doc_id", 7, 2))
    got = suffix_tree.scored(docs).collect()
    assert len(got) == len(rows)
    train = [words_of(t) + ["</s>"] for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    count = {}
    for w in itertools.chain(*train):
        count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    texts = {d: t for d, t in rows}
    for r in got:
        tokens = words_of(texts[r.doc_id]) + ["</s>"]
        base = sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in count for w in tokens), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    held = [r for r in got if r.held_out and r.doc_id is not None]
    assert sum(r.score for r in held) > 0.7 * sum(r.base_score for r in held)


def tree_scores(train, asked, least, depth, divergence):
    """Scores by dictionaries: counts of all n-grams, states tested one by one."""
    count = {}
    for tokens in train:
        for i in range(len(tokens)):
            for k in range(min(i, depth) + 1):
                gram = tuple(tokens[i - k : i + 1])
                count[gram] = count.get(gram, 0) + 1
    followers = {}
    for gram, n in count.items():
        followers.setdefault(gram[:-1], {})[gram[-1]] = n
    words = followers.get((), {})
    total = sum(words.values())
    once, twice = (sum(n == k for n in words.values()) for k in (1, 2))
    d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
    retained = {}

    def p(context, word):
        if not context:
            return max(words.get(word, 0) - d, 0) / total if word in words else d * len(words) / total
        lower = p(context[1:], word)
        if not is_state(context):
            return lower
        f = followers[context]
        n = sum(f.values())
        return max(f.get(word, 0) - d, 0) / n + d * len(f) / n * lower

    def is_state(context):
        if context not in retained:
            f = followers.get(context, {})
            n = sum(f.values())
            if n < least:
                retained[context] = False
            else:
                out = {w: max(k - d - 1, 0) / n for w, k in f.items()}
                rest = min(max(1 - sum(out.values()), 1e-9), 1)
                # As documented, the test takes the suffix's probabilities rounded.
                lower = {w: 10 ** (-round(-2048 * math.log10(p(context[1:], w))) / 2048) for w in f}
                retained[context] = sum(k * math.log((out[w] + rest * lower[w]) / lower[w]) for w, k in f.items()) / n >= divergence
        return retained[context]

    score = [sum(math.log10(p(tuple(t[max(i - depth, 0) : i]), w)) for i, w in enumerate(t)) for t in asked]
    return score, {c for c, yes in retained.items() if yes}, p, words


@pytest.mark.parametrize("least, depth, divergence", [(2, 3, 0.02), (2, 2, 0.0), (3, 4, 0.1), (2, 0, 0.0)])
def test_scores_are_those_of_a_tree_of_dictionaries(spark, monkeypatch, least, depth, divergence):
    monkeypatch.setattr(suffix_tree, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(suffix_tree, "KEYS_PER_TASK", 100)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["x y z", "y x", "z z q", f"w{rng.randint(0, 60)}"]) for _ in range(rng.randint(0, 12)))) for i in range(200)]
    rows += [(300, None), (301, "never seen x y"), (302, "x y z " * 2000)]
    docs = frame(spark, rows).withColumn("held_out", F.col("doc_id") % 5 == 1)
    texts = {d: words_of(t) + ["</s>"] for d, t in rows}
    want, states, p, words = tree_scores([t for d, t in texts.items() if d % 5 != 1], texts.values(), least, depth, divergence)
    got = {r.doc_id: r.score for r in suffix_tree.scored(docs, least=least, depth=depth, divergence=divergence).collect()}
    assert got.keys() == texts.keys()
    for d, score in zip(texts, want):
        assert math.isclose(got[d], score, rel_tol=1e-4), d
    if depth > 1:
        assert {len(c) for c in states} >= {1, 2}
        for c in sorted(states)[:20]:  # distributions over the known words and the unseen one
            assert math.isclose(sum(p(c, w) for w in words) + p(c, "unseen"), 1, rel_tol=1e-9)


@pytest.mark.parametrize("least", [1, 2])
def test_scores_of_words_seen_once_in_one_chunk_and_held_out_in_others(spark, monkeypatch, least):
    monkeypatch.setattr(suffix_tree, "CHUNK_TOKENS", 40)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["x", "y", f"w{rng.randint(0, 40)}", f"u{i // 2}"]) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    docs = frame(spark, rows).repartition(9).withColumn("held_out", F.col("doc_id") % 2 == 1)
    texts = {d: words_of(t) + ["</s>"] for d, t in rows}
    want, *_ = tree_scores([t for d, t in texts.items() if d % 2 == 0], texts.values(), least, 3, 0.02)
    got = {r.doc_id: r.score for r in suffix_tree.scored(docs, least=least).collect()}
    for d, score in zip(texts, want):
        assert math.isclose(got[d], score, rel_tol=1e-4), d


def test_a_context_counts_alike_in_a_larger_corpus(spark):
    def gain(others):
        rows = [(1, "rare pair"), (2, "rare pair"), *((10 + i, f"a{i} b{i % 50} c") for i in range(others))]
        docs = frame(spark, [*rows, (5, "rare pair")]).withColumn("held_out", F.col("doc_id") == 5)
        row = suffix_tree.scored(docs).where("doc_id = 5").first()
        return row.score - row.base_score

    assert gain(20) > 1 and gain(2000) > gain(20)


def distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_contaminated(spark):
    rng = random.Random(6)
    items = [(i, text_of(rng, rng.randint(3, 25))) for i in range(12)] + [(20, None), (21, " "), (22, "ab"), (3, None)]
    items.append((23, items[0][1]))
    rows = []
    for i in range(60):
        words = text_of(rng, 40)
        if i % 2:
            passage = list(items[i % 12][1])
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice([[], ["q"], [passage[at], "q"]])
                passage = passage or ["q"]
            words = f"{words[:50]} \n{''.join(passage).upper()}\t {words[50:]}"
        rows.append((i, words))
    rows += [(90, None), (91, ""), (None, items[1][1]), (92, "cab"), (92, "cab")]
    got = decontaminate.contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = []
    for doc_id, text in rows:
        for item_id, item in items:
            item, plain = decontaminate.plain(item), decontaminate.plain(text)
            budget = int(len(item) * decontaminate.ERROR_RATE)
            if item and distance(item, plain) <= budget:
                want.append((doc_id, item_id, distance(item, plain), budget))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r)[:4] for r in got], key=order) == sorted(want, key=order)
    assert len(want) > 20 and any(d for _, _, d, _ in want)
    texts = {d: t for d, t in rows}
    for r in got:
        stretch = decontaminate.plain(texts[r.doc_id])[r.start : r.end]
        assert distance(decontaminate.plain(dict(items[:15] + items[16:])[r.item_id]), stretch) <= r.distance


def test_items_in_slices(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_CHARS", 30)
    items = [(i, f"item number {i} of the benchmark") for i in range(9)]
    docs = frame(spark, [(i, f"so {t} it is") for i, t in items])
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), 0.0)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(i, i) for i in range(9)]


def test_license_matches(spark):
    rng = random.Random(1)
    filler = lambda n: text_of(rng, n)
    rows, want = [], set()
    for i, (name, text) in enumerate(licenses.NOTICES * 3):
        n = rng.choice([0, 1, 5, 200])
        rows.append((i, f"{filler(n)}. {text.upper() if i % 2 else text}\n{filler(rng.choice([0, 3, 100]))}"))
        want.add((i, name))
    rows += [(100, None), (101, ""), (102, "one two"), (103, filler(500)), (None, licenses.NOTICES[0][1]), (0, rows[0][1])]
    got = licenses.license_matches(frame(spark, rows), licenses.notices(spark)).collect()
    found = {(r.doc_id, r.license) for r in got if r.share == 1}
    assert want | {(None, "Apache-2.0")} <= found and {r.doc_id for r in got} == {i for i, _ in want} | {None}
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    runs = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    texts = {d: t for d, t in rows}
    for doc_id, text in texts.items():
        for name, notice in licenses.NOTICES:
            share = len(runs(split(notice)) & runs(split(text))) / len(runs(split(notice)))
            if share == 1:
                assert (doc_id, name) in found
    few = {(r.doc_id, r.license, r.template) for r in got}
    licenses_joined = pytest.MonkeyPatch()
    licenses_joined.setattr(licenses, "MOST_CONSTANTS", 2)
    joined = licenses.license_matches(frame(spark, rows), licenses.notices(spark)).collect()
    licenses_joined.undo()
    assert {(r.doc_id, r.license, r.template) for r in joined} == few
    short = spark.createDataFrame([("A", "two words"), ("B", None), ("C", "")], "license string, text string")
    assert [r.doc_id for r in licenses.license_matches(frame(spark, [(1, "Two  Words!"), (2, "two words more")]), short).collect()] == [1]
    assert licenses.license_matches(frame(spark, rows), short.limit(0)).count() == 0
