"""Language-model scoring with a probabilistic suffix tree over words.

States are contexts of zero to `DEPTH` words. A context is a candidate if it occurs at least
`LEAST` times in the training documents, whatever their size, and is retained if the
divergence of its smoothed next-symbol distribution from that of its suffix, estimated with
each observation left out, is at least `DIVERGENCE` nats. A token is scored in the longest
suffix of what precedes it that is a retained state.

Distributions are smoothed by absolute discounting. At the root, what is taken from the
words seen goes to the one symbol that stands for all unseen words; at a deeper state it
goes to the suffix:

    p(w | c) = max(n(cw) - d, 0) / n(c) + free(c) * p(w | suffix of c)

so each state's probabilities add up to one over the known words and the unseen symbol. All
words that follow a candidate count, also those that do so once.

Documents are read once into chunks, files of about `CHUNK_TOKENS` tokens: a chunk's
distinct words, sorted, and its tokens as positions in them. When the words are counted they
get numbers, frequent ones small numbers, and the file is replaced by one with these instead.
Nothing of the tree is gathered. It is grown one word of context at a time: each chunk sends
its distinct n-grams whose context is a candidate to the hash range of the context, with their
training counts and their probabilities in the suffix (for the test rounded to 1 / 2048 of a
decade), both known from the pass before. A range sums the counts, tests its contexts, numbers
what may be a context in the next pass, and answers each chunk in the order of its n-grams.
Words and contexts are sent by these numbers, in their order, as differences, which take few
bytes. However frequent an n-gram is, a chunk sends it once; a chunk and a range that share no
n-gram exchange nothing, so the rows sent are at most the n-grams.

A range tells a chunk which n-grams no other chunk has. A longer n-gram that ends in such a
one is in no other chunk either; unless it may be a context itself, nobody needs to know
its word: a context is told only how many of them follow it once. Where an n-gram cannot occur
twice, the test does not depend on its probability in the suffix, which is not sent then.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.llm.files import new_file, open_input, store
from attrspark.llm.words import mix, slices, word_hashes
from attrspark.session import scratch_path, settings, small_batches

LEAST, DEPTH = 2, 3
DIVERGENCE = 0.02
CHUNK_TOKENS = 1_500_000
KEYS_PER_TASK = 1_000_000
END = np.uint64(0x5851F42D4C957F2D)
_STEPS = 2048
CHUNKS = "chunk string, n_words long, n_train long"
ANSWERS = "kind string, chunk string, level int, part int, counts binary, ids binary, types binary"
ANSWER_NAMES = [f.split()[0] for f in ANSWERS.split(", ")]
MESSAGE = "part int, chunk string, contexts binary, followers binary, alone binary, words binary, counts binary, suffix binary"


def packed(values: np.ndarray, sort_of: bool = False) -> bytes:
    """Compressed bytes of an array of integers; of a sorted one its differences.

    The first byte tells how many bytes of each number follow, those of equal weight together:
    they compress better.
    """
    if sort_of and len(values):
        values = np.concatenate((values[:1], np.diff(values)))
    values = np.ascontiguousarray(values)
    values = values.view(f"u{values.itemsize}")
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked(raw: bytes, kind: type, sort_of: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    values = np.zeros(planes.shape[1], kind)
    values.view(np.uint8).reshape(len(values), values.itemsize)[:, : raw[0]] = planes.T
    return np.cumsum(values, dtype=kind) if sort_of else values


def ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys, none negative, and their order; equal keys stay in theirs."""
    # Keys with their places behind them are sorted much faster than places by keys; of long keys the
    # first bits, which are enough to tell hashes apart.
    bits = max(len(keys) - 1, 1).bit_length()
    cut = max(int(keys.max(initial=0)).bit_length() + bits - 64, 0)
    both = keys.astype(np.uint64)
    both >>= np.uint64(cut)
    both <<= np.uint64(bits)
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    found = None if cut else (both >> np.uint64(bits)).astype(keys.dtype, copy=False)
    both &= np.uint64((1 << bits) - 1)
    order = both.view(np.int64)
    if cut:
        found = keys[order]
        if (found[1:] < found[:-1]).any():
            order = np.argsort(keys, kind="stable")
            found = keys[order]
    return found, order


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, the first place of each, and which of them each key is."""
    keys, order = ordered(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    number = np.cumsum(new)
    number -= 1
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = number
    return keys[new], order[new], inverse


@dataclass
class Chunk:
    """The arrays of a chunk: per document id, null id, held out and tokens; the words' hashes, or
    once they are counted their numbers; the tokens as positions in them. Per word, once they are
    counted: times in all training documents, and whether no other chunk has it."""

    doc_ids: np.ndarray
    nulls: np.ndarray
    held: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    tokens: np.ndarray
    counts: np.ndarray
    sole: np.ndarray

    # The order and the kinds of the arrays in a file.
    FIELDS = (("doc_ids", np.int64), ("nulls", np.uint8), ("held", np.uint8), ("lengths", np.uint32), ("words", np.uint64), ("tokens", np.uint32), ("counts", np.int64), ("sole", np.uint8))

    def write(self, folder: str) -> str:
        uri, out = new_file(folder, ".chunk")
        with out:
            for name, kind in self.FIELDS:
                raw = packed(getattr(self, name).astype(kind), name == "words")
                out.write(len(raw).to_bytes(8, "little") + raw)
        return uri

    @classmethod
    def read(cls, uri: str) -> "Chunk":
        with open_input(uri) as source:
            arrays = [unpacked(source.read(int.from_bytes(source.read(8), "little")), kind, name == "words") for name, kind in cls.FIELDS]
        ids, nulls, held, lengths, words, tokens, counts, sole = arrays
        return cls(ids, nulls.astype(bool), held.astype(bool), lengths.astype(np.int64), words, tokens.astype(np.int64), counts, sole.astype(bool))

    def own(self) -> np.ndarray:
        """Times each word occurs in the chunk's training documents."""
        return np.bincount(self.tokens[self.training()], minlength=len(self.words))

    def numbered(self, answers: dict[int, dict], parts: int) -> "Chunk":
        """The chunk with the numbers of its words, in their order, from `count_words`."""
        order, bounds = _ranges(_part(self.words, parts), parts)
        codes, ids = np.zeros(len(order), np.int64), np.zeros(len(order), np.uint64)
        for p, one in answers.items():
            at = order[bounds[p] : bounds[p + 1]]
            codes[at], ids[at] = unpacked(one["counts"], np.int64), unpacked(one["ids"], np.uint64)
        ids, order = ordered(ids)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts = _told(codes, self.own())[order]
        return Chunk(self.doc_ids, self.nulls, self.held, self.lengths, ids, place[self.tokens], counts, codes[order] == 0)

    def follows(self) -> np.ndarray:
        """Which tokens have one of their document before them."""
        out = np.ones(len(self.tokens), dtype=bool)
        out[np.cumsum(self.lengths) - self.lengths] = False
        return out

    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.lengths)


def chunked(docs: DataFrame, folder: str) -> DataFrame:
    """`docs(doc_id, held, text)` as files of about `CHUNK_TOKENS` tokens in `folder`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids, nulls, held, lengths, hashes = (np.concatenate(x) for x in zip(*rows))
            words, _, tokens = distinct(hashes)
            uncounted = np.zeros(0, np.int64)
            place = Chunk(ids, nulls, held, lengths, words, tokens, uncounted, uncounted).write(folder)
            columns = [pa.array([place]), pa.array([len(words)]), pa.array([int(lengths[held == 0].sum())])]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "n_words", "n_train"])

        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            held = batch.column(1).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in slices(batch.column(2)):
                hashes, of_row = word_hashes(data, offsets)
                hashes = np.insert(hashes, of_row[1:], END)
                part = slice(first, end)
                rows.append((ids[part], nulls[part], held[part], (np.diff(of_row) + 1).astype(np.int64), hashes))
                size += len(hashes)
                if size >= CHUNK_TOKENS:
                    yield flush()
                    rows.clear()
                    size = 0
        if rows:
            yield flush()

    return docs.mapInArrow(run, CHUNKS)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of each key."""
    return ((mix(keys) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _ranges(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by hash range, each range in its present order, and the ranges' bounds."""
    part, order = ordered(part)
    return order, np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _next_part(contexts: np.ndarray, part: np.ndarray, of: np.ndarray, words: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of n-grams as contexts, from the number and range of their contexts, `of` which they are, and their words."""
    return _part(mix(contexts * np.uint64(parts) + part)[of] + words, parts)


def _codes(sums: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """Answers on counts: 0 where one chunk alone asks, which knows the count then, else one more than the count."""
    return np.where(chunks == 1, 0, sums + 1)


def _told(codes: np.ndarray, own: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, codes - 1, own)


@dataclass(frozen=True)
class Model:
    """What all tasks know: parameters and three numbers of the training documents."""

    parts: int
    least: int
    divergence: float
    tokens: int = 0
    types: int = 0
    discount: float = 0.5

    def root(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the root's probability of words with these counts; 0 stands for unseen."""
        if not self.tokens:
            return np.zeros(len(counts), np.float32)
        unseen = self.discount * self.types / self.tokens
        return np.log10(np.where(counts > 0, (counts - self.discount) / self.tokens, unseen)).astype(np.float32)

    def probabilities(self, counts: np.ndarray, totals: np.ndarray, types: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """log10 of the probabilities of n-grams; a context without `types` is not retained."""
        kept = types > 0
        some = np.maximum(totals[kept], 1)
        free = np.minimum(self.discount * types[kept] / some, 1)
        p = np.maximum(counts[kept] - self.discount, 0) / some + free * 10.0 ** suffix[kept].astype(float)
        out = suffix.copy()
        out[kept] = np.log10(p)
        return out

    def types_of(self, context: np.ndarray, counts: np.ndarray, suffix: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """The distinct words after each context, 0 where it is not retained.

        `context`, `counts` and `suffix` are of the n-grams: number of the context, training
        count, log10 probability in the suffix, which counts of 2 and more need. `alone`: how
        many more words follow each context once.
        """
        n = len(alone)
        totals = np.bincount(context, weights=counts, minlength=n) + alone
        some = np.maximum(totals, 1)
        types = np.bincount(context, weights=counts > 0, minlength=n) + alone
        again = np.flatnonzero(counts > 1)
        of, counts = context[again], counts[again]
        part = np.maximum(counts - self.discount - 1, 0) / some[of]  # each observation left out
        rest = np.clip(1 - np.bincount(of, weights=part, minlength=n), 1e-9, 1)
        gains = counts * np.log(part / 10.0 ** suffix[again].astype(float) + rest[of])
        # Without an observation left out, words seen once are not seen.
        once = totals - np.bincount(of, weights=counts, minlength=n)
        gain = (np.bincount(of, weights=gains, minlength=n) + once * np.log(rest)) / some
        return np.where((totals >= self.least) & (gain >= self.divergence), types, 0).astype(np.uint32)


@dataclass
class Grams:
    """The distinct n-grams of one length in a chunk, sorted by context, then word."""

    of: np.ndarray  # number of the n-gram that ends at each token, or -1
    context: np.ndarray  # number of each n-gram's context among the n-grams one shorter
    word: np.ndarray  # position of its last word among the chunk's words
    at: np.ndarray  # a token at which it ends
    own: np.ndarray  # times it occurs in the chunk's training documents
    counts: np.ndarray | None = None  # times in all training documents
    ids: np.ndarray | None = None  # number among all n-grams of the length in its range, of candidates; of words among all
    part: np.ndarray | None = None  # hash range to which it goes as a context
    sole: np.ndarray | None = None  # whether no other chunk has it


def _deeper(c: Chunk, shorter: Grams, follows: np.ndarray, training: np.ndarray, least: int) -> Grams:
    """The n-grams one word longer whose contexts are candidates."""
    often = np.append(shorter.counts >= least, False)  # the last for tokens without an n-gram, -1
    use = np.zeros(len(c.tokens), bool)
    use[1:] = often[shorter.of[:-1]]
    use &= follows
    at = np.flatnonzero(use)
    bits = max(len(c.words) - 1, 1).bit_length()
    keys = shorter.of[at - 1].astype(np.int64)
    keys <<= bits
    keys |= c.tokens[at]
    keys, first, inverse = distinct(keys)
    of = np.full(len(c.tokens), -1, np.int32)
    of[at] = inverse
    own = np.bincount(inverse[training[at]], minlength=len(keys))
    return Grams(of, (keys >> bits).astype(np.int32), (keys & ((1 << bits) - 1)).astype(np.int32), at[first].astype(np.int32), own.astype(np.int32))


@dataclass
class Asked:
    """What a chunk asks a range: contexts in the order of their numbers, how many n-grams of each
    it asks for, how many others follow each once, and the n-grams in the order of contexts, then words."""

    contexts: np.ndarray
    sizes: np.ndarray
    alone: np.ndarray
    grams: np.ndarray


def _by_context(g: Grams, shorter: Grams, model: Model) -> Iterator[tuple[int, Asked]]:
    """What is asked of each part. Not asked for is what the chunk knows: n-grams that no other chunk
    has, because it has not what they end in, and that are too rare to be contexts."""
    if not len(g.own):
        return
    asked = ~shorter.sole[shorter.of[g.at]] | (g.own > min(model.least - 1, 1))
    new = np.ones(len(g.context), bool)
    new[1:] = g.context[1:] != g.context[:-1]
    begins = np.flatnonzero(new)
    contexts = g.context[begins]
    grams = np.flatnonzero(asked)
    sizes = np.add.reduceat(asked, begins, dtype=np.int64)
    alone = np.add.reduceat(np.where(asked, 0, g.own), begins, dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    _, by_id = ordered(shorter.ids[contexts])
    order, bounds = _ranges(shorter.part[contexts[by_id]], model.parts)
    order = by_id[order]
    n = sizes[order]
    ends = np.cumsum(n)
    grams = grams[np.repeat(begins[order] - (ends - n), n) + np.arange(len(grams))]
    ends = np.concatenate(([0], ends))[bounds]
    for p in range(model.parts):
        at = order[bounds[p] : bounds[p + 1]]
        if len(at):
            yield p, Asked(contexts[at], sizes[at], alone[at], grams[ends[p] : ends[p + 1]])


def _steps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of these sizes of ascending values, as first values and differences."""
    out = values.copy()
    out[1:] -= values[:-1]
    begins = (np.cumsum(sizes) - sizes)[sizes > 0]
    out[begins] = values[begins]
    return out


def _summed(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of `_steps`."""
    sums, some = np.cumsum(steps, dtype=np.uint64), sizes[sizes > 0]
    begins = np.cumsum(some) - some
    return sums - np.repeat(sums[begins] - steps[begins], some)


@dataclass
class Grown:
    """A chunk after the answers so far: the last n-grams with answers, those one word longer,
    and log10 probability of each token in the longest state known."""

    shorter: Grams
    deeper: Grams
    logs: np.ndarray


def _grown(c: Chunk, answers: list[dict[int, dict]], model: Model, longer: bool = True) -> Grown:
    """`answers` are by level from the first, each by part; with `longer`, n-grams yet to be asked for follow."""
    training, follows = c.training(), c.follows()
    n = len(c.words)
    g = Grams(c.tokens, np.zeros(n, np.int32), np.arange(n, dtype=np.int32), np.zeros(n, np.int32), c.own(), c.counts, c.words, _part(c.words, model.parts), c.sole)
    logs, shorter = model.root(g.counts)[c.tokens], g
    for got in answers:
        shorter, g = g, _deeper(c, g, follows, training, model.least)
        # Of what is not asked for, the chunk has all.
        g.counts, g.ids, g.sole = g.own.astype(np.int64), np.zeros(len(g.own), np.uint64), np.ones(len(g.own), bool)
        if any(one["ids"] is not None for one in got.values()):
            g.part = _next_part(shorter.ids, shorter.part, g.context, c.words[g.word], model.parts)
        types = np.zeros(len(shorter.own), np.uint32)
        for p, asked in _by_context(g, shorter, model):
            at, codes = asked.grams, unpacked(got[p]["counts"], np.int64)
            g.counts[at], g.sole[at] = _told(codes, g.own[at]), codes == 0
            if got[p]["ids"] is not None:
                at = at[g.counts[at] >= model.least]
                order, bounds = _ranges(g.part[at], model.parts)
                g.ids[at[order]] = _summed(unpacked(got[p]["ids"], np.uint64), np.diff(bounds)) * np.uint64(model.parts) + np.uint64(p)
            types[asked.contexts] = unpacked(got[p]["types"], np.uint32)
        # Where an n-gram ends, so does its suffix: the token's probability so far is that of the suffix.
        found = model.probabilities(g.counts, shorter.counts[g.context], types[g.context], logs[g.at])
        at = np.flatnonzero(g.of >= 0)
        logs[at] = found[g.of[at]]
    if longer:
        shorter, g = g, _deeper(c, g, follows, training, model.least)
    return Grown(shorter, g, logs)


def _written(spark: SparkSession, df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """A table written and read again; what was shuffled for it is removed from the disks."""
    place = scratch_path(spark, label)
    with small_batches(spark), settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place), place


def _place(chunk: str, level: int) -> str:
    """Where a chunk's words and tokens (level 0) and its answers of other levels are kept."""
    folder, _, name = chunk.rpartition("/read/")
    return f"{folder}/{name}.{level}"


def _keep(spark: SparkSession, chunks: DataFrame, answers: DataFrame, place: str, level: int, tasks: int, parts: int) -> None:
    """Put the answers of a level, written at `place`, into a file for each chunk and remove them there.

    A chunk's answers are as many as its n-grams at most. Those on words are put into its file.
    """

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("counts", pa.binary()), ("ids", pa.binary()), ("types", pa.binary())])
        for batch in batches:
            for i, chunk in enumerate(batch.column(0).to_pylist()):
                known = batch.column(1)[i].values
                rows = pa.Table.from_struct_array(known) if known is not None and len(known) else schema.empty_table()
                # Every attempt writes the same content under a name of its own, which then takes the place of the file.
                goal = _place(chunk, level)
                folder = goal.rpartition("/")[0]
                if level == 0:
                    part = Chunk.read(chunk).numbered({row["part"]: row for row in rows.to_pylist()}, parts).write(folder)
                else:
                    part, out = new_file(folder, ".part")
                    with out, pa.ipc.new_stream(out, schema) as writer:
                        writer.write_table(rows.cast(schema))
                system, path = store(part)
                system.move(path, store(goal)[1])
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["chunk"])

    rows = chunks.select("chunk", F.lit(None).cast("struct<part:int,counts:binary,ids:binary,types:binary>").alias("a"))
    found = answers.where("kind = 'chunk'").select("chunk", F.struct("part", "counts", "ids", "types").alias("a"))
    rows = rows.unionByName(found).repartition(tasks, "chunk").groupBy("chunk").agg(F.collect_list("a").alias("known"))
    _written(spark, rows.mapInArrow(put, "chunk string"), "kept")
    system, path = store(place)
    system.delete_dir(path)


def _kept(chunk: str, levels: int) -> list[dict[int, dict]]:
    """The answers to a chunk up to this level, by part."""
    answers = []
    for level in range(1, levels + 1):
        with open_input(_place(chunk, level)) as source:
            rows = pa.ipc.open_stream(source).read_all().to_pylist()
        answers.append({row["part"]: row for row in rows})
    return answers


def count_words(chunks: DataFrame, parts: int, tasks: int) -> DataFrame:
    """Counts of single words: per chunk and part the sums of its words in their order, and their
    numbers; per part (kind "kinds") the number of words seen once, twice and at all."""

    def give(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                c = Chunk.read(place)
                counts = c.own()
                order, bounds = _ranges(_part(c.words, parts), parts)
                rows = [(p, place, packed(c.words[at], True), packed(counts[at].astype(np.uint32))) for p in range(parts) if len(at := order[bounds[p] : bounds[p + 1]])]
                kinds = [pa.int32(), pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=["part", "chunk", "words", "counts"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        words = [unpacked(w, np.uint64, True) for w in rows["words"]]
        counts = np.concatenate([unpacked(n, np.uint32) for n in rows["counts"]])
        kept, _, inverse = distinct(np.concatenate(words))
        sums = np.bincount(inverse, weights=counts, minlength=len(kept)).astype(np.int64)
        codes = _codes(sums, np.bincount(inverse, minlength=len(kept)))
        kinds = np.array([(sums == 1).sum(), (sums == 2).sum(), (sums > 0).sum()], np.int64)
        out = [("kinds", None, 0, key[0], packed(kinds), None, None)]
        ids = np.empty(len(kept), np.uint64)
        ids[np.argsort(-sums, kind="stable")] = np.arange(len(kept), dtype=np.uint64) * np.uint64(parts) + np.uint64(key[0])
        bounds = np.cumsum([0, *map(len, words)])
        for i, chunk in enumerate(rows["chunk"]):
            at = inverse[bounds[i] : bounds[i + 1]]
            out.append(("chunk", chunk, 0, key[0], packed(codes[at]), packed(ids[at]), None))
        return pd.DataFrame(out, columns=ANSWER_NAMES)

    given = chunks.select("chunk").repartition(tasks, "chunk").mapInArrow(give, "part int, chunk string, words binary, counts binary")
    return given.groupBy("part").applyInPandas(add, ANSWERS)


def grow(chunks: DataFrame, level: int, model: Model, tasks: int, last: bool = False) -> DataFrame:
    """Answers to the n-grams of `level` words of context, each part and chunk in the order of
    `_by_context`: their counts, the numbers of candidates, and the types of contexts. Those of
    the levels before are kept by chunk."""
    names = [f.split()[0] for f in MESSAGE.split(", ")]

    def give(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                c = Chunk.read(_place(chunk, 0))
                grown = _grown(c, _kept(chunk, level - 1), model)
                g, shorter, rows = grown.deeper, grown.shorter, []
                if level == 1:  # after one word it depends on the last word alone
                    suffix = np.clip(np.round(-model.root(c.counts) * _STEPS), 0, 65535).astype(np.uint16)
                else:  # the test asks for those of training n-grams that may occur twice
                    suffix = np.clip(np.round(-grown.logs[g.at] * _STEPS), 0, 65535).astype(np.uint16)
                    suffix[(g.own == 0) | (shorter.counts[shorter.of[g.at]] < 2)] = 0
                for p, asked in _by_context(g, shorter, model):
                    at = asked.grams
                    words = g.word[at]
                    if level == 1:
                        there = np.zeros(len(c.words), bool)
                        there[words] = True
                    rows.append(
                        (
                            p,
                            chunk,
                            packed(shorter.ids[asked.contexts], True),
                            packed(asked.sizes),
                            packed(asked.alone),
                            packed(_steps(c.words[words], asked.sizes)),
                            packed(g.own[at]),
                            packed(suffix[there] if level == 1 else suffix[at]),
                        )
                    )
                kinds = [pa.int32(), pa.string(), *[pa.binary()] * 6]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        contexts = [unpacked(x, np.uint64, True) for x in rows["contexts"]]
        sizes = [unpacked(x, np.int64) for x in rows["followers"]]
        words = [_summed(unpacked(x, np.uint64), n) for x, n in zip(rows["words"], sizes)]
        suffix = [unpacked(x, np.uint16) for x in rows["suffix"]]
        known, _, number = distinct(np.concatenate(contexts))
        alone = np.bincount(number, weights=np.concatenate([unpacked(x, np.int64) for x in rows["alone"]]), minlength=len(known))
        of_gram = np.repeat(number, np.concatenate(sizes))
        vocabulary, _, of_word = distinct(np.concatenate(words))
        bounds = np.cumsum([0, *map(len, words)])
        if level == 1:
            of_words = np.zeros(len(vocabulary), np.uint16)
            for i, x in enumerate(suffix):
                there = np.zeros(len(vocabulary), bool)
                there[of_word[bounds[i] : bounds[i + 1]]] = True
                of_words[there] = x
            suffix = of_words[of_word]
        else:
            suffix = np.concatenate(suffix)
        own = np.concatenate([unpacked(x, np.int64) for x in rows["counts"]])
        bits = max(len(vocabulary) - 1, 1).bit_length()
        grams, first, inverse = distinct(of_gram << bits | of_word)
        training = np.flatnonzero(own)
        first[inverse[training]] = training  # equal n-grams have equal suffixes, in training
        sums = np.bincount(inverse, weights=own, minlength=len(grams)).astype(np.int64)
        codes = _codes(sums, np.bincount(inverse, minlength=len(grams)))
        often = sums >= model.least
        # Candidates are numbered by range to which they go, so that their numbers are dense there.
        part = _next_part(known, np.uint64(key[0]), grams >> bits, vocabulary[grams & ((1 << bits) - 1)], model.parts)
        candidates = np.flatnonzero(often)
        order, ends = _ranges(part[candidates], model.parts)
        ids = np.zeros(len(grams), np.uint64)
        ids[candidates[order]] = np.arange(len(order)) - np.repeat(ends[:-1], np.diff(ends))
        types = model.types_of(grams >> bits, sums, suffix[first] / -_STEPS, alone)
        out, a = [], 0
        for i, (chunk, some) in enumerate(zip(rows["chunk"], contexts)):
            at = inverse[bounds[i] : bounds[i + 1]]
            numbers = None
            if not last:
                asked = at[often[at]]
                order, ends = _ranges(part[asked], model.parts)
                numbers = packed(_steps(ids[asked[order]], np.diff(ends)))
            out.append(("chunk", chunk, level, key[0], packed(codes[at]), numbers, packed(types[number[a : a + len(some)]])))
            a += len(some)
        return pd.DataFrame(out, columns=ANSWER_NAMES)

    asked = chunks.select("chunk").repartition(tasks, "chunk").mapInArrow(give, MESSAGE)
    return asked.groupBy("part").applyInPandas(add, ANSWERS)


def scored(docs: DataFrame, held_out: str = "held_out", least: int = LEAST, depth: int = DEPTH, divergence: float = DIVERGENCE) -> DataFrame:
    """Scores of `docs(doc_id, text, held_out)`: one row per document.

    Learns from rows where `held_out` is false. Columns: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score (unigrams with one added) and score.

    Null and empty texts have the end token alone. Null held_out counts as held out.
    Repeated documents count and are scored each. Null doc_id: kept. If nothing is learned,
    every token is the unseen symbol, of probability 1. Other columns are ignored.

    A document lies in one chunk, a context's n-grams in one range: at most one entry per
    chunk and distinct word that follows the context.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(held_out), F.lit(True)).alias("held"),
        F.col("text").cast("string").alias("text"),
    )
    folder = f"{scratch_path(spark, 'chunk-files')}/read"
    chunks, _ = _written(spark, chunked(narrow, folder), "chunks")
    size = chunks.agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    least_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A chunk gives at most one n-gram per distinct word or token.
    parts, tasks = max(least_tasks, -(-max(size[1], size[2]) // KEYS_PER_TASK)), max(least_tasks, size[0])
    answers, place = _written(spark, count_words(chunks, parts, tasks), "words")
    kinds = np.zeros(3, np.int64)
    for row in answers.where("kind = 'kinds'").select("counts").toLocalIterator():
        kinds += unpacked(row[0], np.int64)
    discount = float(np.clip(kinds[0] / max(kinds[0] + 2 * kinds[1], 1), 0.1, 0.9))
    model = Model(parts, least, divergence, size[2], int(kinds[2]), discount)
    _keep(spark, chunks, answers, place, 0, tasks, parts)
    if size[0]:
        system, path = store(folder)
        system.delete_dir(path)
    for level in range(1, depth + 1):
        answers, place = _written(spark, grow(chunks, level, model, tasks, level == depth), f"level-{level}")
        _keep(spark, chunks, answers, place, level, tasks, parts)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                c = Chunk.read(_place(chunk, 0))
                grown = _grown(c, _kept(chunk, depth), model, False)
                counts, logs = c.counts, grown.logs.astype(float)
                base = np.log10((counts + 1) / (model.tokens + model.types + 1))
                begins = np.cumsum(c.lengths) - c.lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c.doc_ids, mask=c.nulls),
                        pa.array(c.held),
                        pa.array(c.lengths),
                        pa.array(np.add.reduceat((counts > 0)[c.tokens].astype(np.int64), begins)),
                        pa.array(np.add.reduceat(base[c.tokens], begins)),
                        pa.array(np.add.reduceat(logs, begins)),
                    ],
                    names=names,
                )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = chunks.select("chunk").repartition(tasks, "chunk").mapInArrow(score, schema)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
