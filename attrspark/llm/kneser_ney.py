"""Toxicity by two class-conditional Kneser-Ney models that share their backoff counts.

Symbols are the lower-cased bytes of words and a mark before the first; an n-gram is a byte with
what stands before it in its word, at most `ORDER` symbols, and so fits a long as it is. Each
class c has its own counts of these n-grams; what they do not cover backs off to continuation
counts that both classes share, through all shorter contexts down to the single byte:

    p_c(x | h) = max(n_c(hx) - D, 0) / n_c(h) + D * t_c(h) / n_c(h) * shared(x | h without its first symbol)

so an expression that one class has never shown is still priced by the same shared counts
in both, and rare expressions pull a text neither way. The log-likelihood ratio of a byte
depends on its n-gram alone, or on its context alone if neither class has the n-gram, so
scoring is one or two look-ups per byte.

A text is judged by length-normalised ratios: the mean per byte of the whole text, and the
means of its 1, 2 and 4 most toxic words. A logistic curve turns them into a score; it is
fitted on labelled rows that the models it uses have not seen.

All n-grams count, those seen once too, each under its own key. n-grams with the same two symbols
before their last share all their contexts from two symbols on, so they are dealt by these and
the ratios are computed where they meet; only the counts of single bytes and pairs, at most 65,536
numbers, pass through the driver. Each task writes its ratios to a file in the shared folder, 12
bytes an n-gram, and the workers that score read these files; their size is bounded by `fit_rows`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrspark.llm.files import new_file, open_input
from attrspark.llm.words import _LOWER, mix, slices, word_spans
from attrspark.session import scratch_path

ORDER = 8
MARK = 32
MASKS = np.array([(1 << 8 * n) - 1 for n in range(ORDER + 1)], np.uint64)
BYTE = np.uint64(8)
HELD = 500_000
#: Bytes of text handled at a time; arrays over them take some hundred bytes for each.
SLICE = 1 << 18
TOPS = (1, 2, 4)
COUNT_NAMES = ["ordinary", "toxic", "ordinary_kept", "toxic_kept"]
COUNTS = "gram long, " + ", ".join(f"{c} long" for c in COUNT_NAMES)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of a word, first symbol highest; word starts and ends.

    Space, the mark, is in no word. A zero byte counts as a tab, which is in none either, so
    that leading zeros tell the length of an n-gram.
    """
    begins, ends = word_spans(data, offsets)
    lengths = ends - begins
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    stream = np.full(len(inside) + len(begins), MARK, np.uint64)
    place = np.arange(len(inside)) + np.repeat(np.arange(1, len(begins) + 1), lengths)
    letters = _LOWER[data[np.repeat(begins, lengths) + inside]]
    stream[place] = np.where(letters == 0, 9, letters)
    for width in (1, 2, 4):  # runs of 2, 4 and 8 symbols
        before = stream[:-width] << np.uint64(8 * width)
        stream = stream.copy()
        stream[width:] |= before
    return stream[place] & MASKS[np.minimum(inside + 2, ORDER)], begins, ends


def gram_lengths(grams: np.ndarray) -> np.ndarray:
    return np.searchsorted(MASKS, grams)


def _merged(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    begins = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[begins], np.add.reduceat(counts, begins, axis=0)


def count_grams(sample: DataFrame) -> DataFrame:
    """Counts per n-gram and class of `sample(text, toxic, kept)`.

    Each task adds up what it reads and gives one row per n-gram, or several where it has seen
    very many.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def given() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            grams, cells = _merged(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            for i in range(0, len(grams), 100_000):
                part = slice(i, i + 100_000)
                columns = [grams[part].view(np.int64), *(np.ascontiguousarray(cells[part, k]) for k in range(4))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["gram", *COUNT_NAMES])

        for batch in batches:
            kind = batch.column(1).to_numpy(zero_copy_only=False) + 2 * batch.column(2).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in slices(batch.column(0), SLICE):
                gram, begins, ends = symbols(data, offsets)
                if not len(gram):
                    continue
                of_row = np.searchsorted(offsets, begins, side="right") - 1
                of_kind = np.repeat(kind[first:end][of_row], ends - begins)
                grams, inverse = np.unique(gram, return_inverse=True)
                cells = np.bincount(inverse * 4 + of_kind, minlength=4 * len(grams)).reshape(-1, 4)
                held.append((grams, cells.astype(np.int32)))
                if sum(len(h[0]) for h in held) > HELD:
                    held[:] = [_merged(*(np.concatenate(x) for x in zip(*held)))]
                    if len(held[0][0]) > HELD // 2:
                        yield from given()
        yield from given()

    each = sample.select("text", F.col("toxic").cast("long"), F.col("kept").cast("long")).mapInArrow(count, COUNTS)
    return each.groupBy("gram").agg(*(F.sum(c).cast("int").alias(c) for c in COUNT_NAMES))


@dataclass
class Base:
    """The shortest levels of the shared counts: of single bytes, and of a byte after one symbol."""

    discount: float
    one: np.ndarray
    two: np.ndarray  # by the two symbols as a number

    @classmethod
    def of(cls, discount: float, pairs: np.ndarray, follows: np.ndarray) -> "Base":
        """From the pairs of symbols that occur, and before how many symbols each does."""
        before = np.bincount(pairs & 255, minlength=256)
        n = max(before.sum(), 1)
        one = np.maximum(before - discount, 0) / n + discount * (before > 0).sum() / n / 256
        counts = np.zeros(1 << 16, np.int64)
        counts[pairs] = follows
        counts = counts.reshape(256, 256)
        total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
        n = np.maximum(total, 1)
        two = np.where(total > 0, np.maximum(counts - discount, 0) / n + discount * kinds / n * one, one)
        return cls(discount, one, two.ravel())


def ratios(grams: np.ndarray, counts: list[np.ndarray], base: Base) -> tuple[np.ndarray, ...]:
    """Log ratio of each n-gram; contexts and their log ratios, for n-grams that neither class has.

    `grams` has, of all n-grams with the same two symbols before the last, either all or none.
    """
    d, lengths = base.discount, gram_lengths(grams)
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for n in range(ORDER, 3, -1):  # what stands before n - 1 symbols, in longer n-grams of any kind
        longer = np.union1d(grams[lengths == n], seen[n][0] if n in seen else grams[:0])
        seen[n - 1] = np.unique(longer & MASKS[n - 1], return_counts=True)
    shared: dict[int, np.ndarray] = {}

    def lower(of: np.ndarray, n: int) -> np.ndarray:
        """The shared probability of n-grams cut to their last n symbols."""
        cut = of & MASKS[n]
        if n <= 2:
            return (base.one if n == 1 else base.two)[cut.astype(np.int64)]
        return shared[n][np.searchsorted(seen[n][0], cut)]

    for n in range(3, ORDER):
        types, follows = seen[n]
        _, of = np.unique(types >> BYTE, return_inverse=True)
        total, kinds = np.bincount(of, follows), np.bincount(of)
        shared[n] = np.maximum(follows - d, 0) / total[of] + d * kinds[of] / total[of] * lower(types, n - 1)
    backoff = np.zeros(len(grams))
    for n in range(2, ORDER + 1):
        backoff[lengths == n] = lower(grams[lengths == n], n - 1)
    contexts, of = np.unique(grams >> BYTE, return_inverse=True)
    logs, free = [], []
    for count in counts:
        total, kinds = np.bincount(of, count, len(contexts)), np.bincount(of, count > 0, len(contexts))
        free.append(np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0))
        logs.append(np.log(np.maximum(count - d, 0) / np.maximum(total, 1)[of] + free[-1][of] * backoff))
    return (logs[1] - logs[0]).astype(np.float32), contexts, (np.log(free[1]) - np.log(free[0])).astype(np.float32)


class Table:
    """Values by 64-bit key. Keys are mixed, so their first bits tell about where they are."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = mix(keys)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        bits = min(max(12, int(len(keys)).bit_length() - 1), 24)
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.starts = np.append(np.searchsorted(self.keys, edges), len(keys)).astype(np.int32)

    def fill(self, keys: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Put the values of known keys into `out`; which keys are unknown."""
        wanted = mix(keys)
        slot = (wanted >> self.shift).astype(np.int64)
        at, end = self.starts[slot], self.starts[slot + 1]
        unknown = np.ones(len(keys), bool)
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], wanted[left]
        while len(left):
            hit = self.keys[at] == wanted
            out[left[hit]] = self.values[at[hit]]
            unknown[left[hit]] = False
            at = at + 1
            more = ~hit & (at < end)
            left, at, end, wanted = left[more], at[more], end[more], wanted[more]
        return np.flatnonzero(unknown)


class Model:
    """Log ratios of n-grams and of contexts; a worker reads them once per task."""

    _loaded: tuple[tuple[str, ...], "Model"] | None = None

    def __init__(self, grams: np.ndarray, of_gram: np.ndarray, contexts: np.ndarray, of_context: np.ndarray):
        self.grams, self.contexts = Table(grams, of_gram), Table(contexts, of_context)

    @classmethod
    def read(cls, files: tuple[str, ...]) -> "Model":
        """From the files of `learn`, or as the task has read them before."""
        if cls._loaded is None or cls._loaded[0] != files:
            cls._loaded = None
            found: tuple[list, list, list, list] = ([], [], [], [])
            for file in files:
                kind, keys, values = (c.to_numpy() for c in pa.ipc.open_file(open_input(file)).read_all().columns)
                for i in (0, 1):
                    found[2 * i].append(keys[kind == i])
                    found[2 * i + 1].append(values[kind == i])
            empty = (np.zeros(0, np.uint64), np.zeros(0, np.float32)) * 2
            cls._loaded = files, cls(*(np.concatenate([e, *x]) for e, x in zip(empty, found)))
        return cls._loaded[1]

    @classmethod
    def forget(cls) -> None:
        """At the end of a task: the worker may go on with another operator."""
        cls._loaded = None

    def values(self, grams: np.ndarray) -> np.ndarray:
        """Log ratios of n-grams; where there is none, of their contexts, else 0."""
        out = np.zeros(len(grams), np.float32)
        left = self.grams.fill(grams, out)
        if len(left):
            of_context = np.zeros(len(left), np.float32)
            self.contexts.fill(grams[left] >> BYTE, of_context)
            out[left] = of_context
        return out


_TABLE = pa.schema([("is_context", pa.uint8()), ("key", pa.uint64()), ("value", pa.float32())])


def learn(counted: DataFrame, ordinary: Column, toxic: Column) -> tuple[str, ...]:
    """Files of the model of n-grams from `count_grams`, of these two counts."""
    spark = counted.sparkSession
    seen = counted.select("gram", ordinary.cast("long").alias("ordinary"), toxic.cast("long").alias("toxic"))
    seen = seen.where("ordinary + toxic > 0")
    few = seen.agg(*(F.sum(sum((F.col(c) == n).cast("long") for c in ("ordinary", "toxic"))) for n in (1, 2))).first()
    once, twice = few[0] or 0, few[1] or 0
    low = seen.select(F.col("gram").bitwiseAND(F.lit((1 << 24) - 1)).alias("low")).distinct()
    pairs = low.groupBy(F.col("low").bitwiseAND(F.lit((1 << 16) - 1)).alias("pair"))
    pairs = pairs.agg(F.count_if(F.col("low") >= 1 << 16).alias("follows")).toArrow()  # at most 65,536 rows
    discount = float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.9))
    base = Base.of(discount, pairs["pair"].to_numpy(), pairs["follows"].to_numpy())
    folder = scratch_path(spark, "ratios")

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [[c.to_numpy() for c in batch.columns] for batch in batches if len(batch)]
        if not rows:
            return
        gram, *counts = (np.concatenate(x) for x in zip(*rows))
        gram = gram.view(np.uint64)
        of_gram, contexts, of_context = ratios(gram, counts, base)
        kind = np.repeat(np.array([0, 1], np.uint8), [len(gram), len(contexts)])
        table = [kind, np.concatenate((gram, contexts)), np.concatenate((of_gram, of_context))]
        uri, out = new_file(folder, ".arrow")
        with out, pa.ipc.new_file(out, _TABLE) as writer:
            writer.write_table(pa.table(table, schema=_TABLE))
        yield pa.RecordBatch.from_arrays([pa.array([uri])], names=["uri"])

    dealt = seen.repartition(F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit((1 << 16) - 1)))
    return tuple(sorted(r["uri"] for r in dealt.mapInArrow(compute, "uri string").collect()))


def one_in(rows: int, curve_rows: int) -> int:
    """Of how many labelled rows one fits the curve: a fifth, or about `curve_rows` if they are many."""
    return max(5, -(-rows // curve_rows))


def features(column: pa.Array, model: Model) -> np.ndarray:
    """Per text: mean ratio per byte, means of the most toxic words, log of its words."""
    out = np.zeros((len(column), 2 + len(TOPS)))
    for first, end, data, offsets in slices(column, SLICE):
        grams, begins, ends = symbols(data, offsets)
        if not len(grams):
            continue
        value = model.values(grams)
        upto = np.concatenate(([0.0], np.cumsum(value, dtype=np.float64)))
        lengths = ends - begins
        last = np.cumsum(lengths)
        of_word = upto[last] - upto[last - lengths]
        of_row = np.searchsorted(begins, offsets)
        for i in range(end - first):
            a, b = of_row[i], of_row[i + 1]
            if a == b:
                continue
            words = of_word[a:b]
            top = np.sort(np.partition(words, -TOPS[-1])[-TOPS[-1] :] if b - a > TOPS[-1] else words)[::-1]
            out[first + i] = [words.sum() / lengths[a:b].sum(), *(top[:k].mean() for k in TOPS), np.log1p(b - a)]
    return out


@dataclass
class Curve:
    """A logistic curve over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> "Curve":
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        design = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        w = np.zeros(design.shape[1])
        ridge = penalty * np.eye(len(w))
        ridge[0, 0] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            step = np.linalg.solve((design * (p * (1 - p) + 1e-9)[:, None]).T @ design + ridge, design.T @ (y - p) - ridge @ w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        return cls(mean, scale, w)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def is_held_out(doc_id, folds: int = 5, remainder: int = 0):
    """crc32 of the id as text; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == remainder, F.lit(True))


def toxicity(
    docs: DataFrame, labels: DataFrame, fit_rows: int = 200_000, curve_rows: int = 20_000
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs(doc_id, text)`.

    Learns from at most `fit_rows` rows of `labels(doc_id, toxic)` that are not held out,
    those with the smallest id hashes; their ids (a few MB) are broadcast, so texts are not
    shuffled. Every fifth of them, at most about `curve_rows`, fits the curve with models
    of the others; the final models are of all.

    Null or empty text: a text without words, scored from the curve alone. Null doc_id:
    scored, held out. Repeated documents are scored each. Null labels are left out, of
    contradicting ones the toxic one counts. Without labels of both classes every score is
    the share of toxic ones, or 0. Other columns are ignored.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out("doc_id"))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic") > 0).cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    known = known.orderBy(order, "doc_id").limit(fit_rows)
    share = one_in(known.count(), curve_rows)
    known = known.withColumn("kept", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(share)) != 0).cast("int"))
    sample = narrow.join(F.broadcast(known), "doc_id")
    place = scratch_path(spark, "grams")
    grams = count_grams(sample)
    grams.write.parquet(place)
    grams = spark.read.schema(grams.schema).parquet(place)
    part = learn(grams, F.col("ordinary_kept"), F.col("toxic_kept"))
    width = 2 + len(TOPS)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(0), Model.read(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array(x[:, k]) for k in range(width))],
                names=["toxic", *(f"x{k}" for k in range(width))],
            )
        Model.forget()

    schema = "toxic int, " + ", ".join(f"x{k} double" for k in range(width))
    seen = sample.where("kept = 0").select("text", "toxic").mapInArrow(measure, schema).toArrow()
    y = seen["toxic"].to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        curve = Curve.fit(np.column_stack([seen[f"x{k}"].to_numpy() for k in range(width)]), y)
    else:
        share = float(y.mean()) if len(y) else 0.0
        base = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        curve = Curve(np.zeros(width), np.ones(width), np.array([base, *[0.0] * width]))
    every = (F.col(c) + F.col(f"{c}_kept") for c in ("ordinary", "toxic"))
    files = learn(grams, *every)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = curve(features(batch.column(1), Model.read(files)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["doc_id", "score"])
        Model.forget()

    scored = narrow.mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
