"""Near-duplicates by one-permutation hashing, banded buckets and star-shaped candidates.

1. Each text becomes the set of its word shingles, as 64-bit hashes. Texts with equal sets
   are one class; from here on only one text per class is used.
2. One-permutation hashing: one hash per shingle, whose high bits choose one of
   bands * rows bins and whose low bits compete for the minimum there. Empty bins borrow
   from a bin that a second hash family picks at random for each (bin, attempt) until a
   filled one is met (optimal densification).
3. Each band of `rows` bins is a bucket key. In a bucket, every class is a candidate of the
   smallest class only: n - 1 pairs for n classes, a star.
4. Candidates are confirmed on the full sets; confirmed links give components.
5. What stars can miss are links between two classes of a bucket of which neither was its
   centre. In buckets that hold several components every class outside the largest one
   therefore meets all members, block by block: classes of different components that could
   reach the threshold (by size, and by their minima four deviations around it) are
   compared on the full sets. A meeting returns a spanning forest.

With 30 bands of 5 rows, two sets at a similarity of 0.8 share a bucket with probability
1 - (1 - 0.8^5)^30 > 0.99999.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from attrspark.llm.components import components
from attrspark.llm.words import mix, shingle_hashes, slices, word_hashes
from attrspark.session import scratch_path

BANDS, ROWS = 30, 5
#: Bytes of text handled at a time; memory goes with it, not with the size of a batch.
SLICE = 1 << 20
SKETCHES = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n_shingles", LongType()),
        StructField("set_a", LongType()),
        StructField("set_b", LongType()),
        StructField("minima", BinaryType()),
        StructField("buckets", ArrayType(LongType())),
    ]
)
_BLOCK = 512
DEVIATIONS = 4


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text's word hashes."""
    return np.unique(shingle_hashes(words, size))


class Sketcher:
    """Densified one-permutation minima and band keys of shingle sets."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.probes: list[np.ndarray] = []

    def _probe(self, attempt: int) -> np.ndarray:
        while len(self.probes) <= attempt:
            seed = np.uint64(len(self.probes) + 1) << np.uint64(32)
            self.probes.append((mix(np.arange(self.bins, dtype=np.uint64) + seed) % np.uint64(self.bins)).astype(np.int64))
        return self.probes[attempt]

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """32-bit minima per bin of a sorted, non-empty set."""
        chosen = ((shingles >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        value = mix(shingles).astype(np.uint32)
        begins = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        out = np.zeros(self.bins, dtype=np.uint32)
        filled = np.zeros(self.bins, dtype=bool)
        filled[chosen[begins]] = True
        out[chosen[begins]] = np.minimum.reduceat(value, begins)
        empty = np.flatnonzero(~filled)
        attempt = 0
        while len(empty):
            source = self._probe(attempt)[empty]
            met = filled[source]
            out[empty[met]] = out[source[met]]
            empty = empty[~met]
            attempt += 1
        return out

    def buckets(self, minima: np.ndarray) -> np.ndarray:
        """Band keys of a matrix of minima, one row per set."""
        cells = minima.reshape(len(minima), self.bands, self.rows).astype(np.uint64)
        keys = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), cells.shape[:2]).copy()
        for r in range(self.rows):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, r])
        return keys


def sketches(docs: DataFrame, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, set size, 128-bit set hash, minima and bucket keys of `docs(doc_id, text)`."""

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands, rows)
        for batch in batches:
            for first, end, data, offsets in slices(batch.column(1), SLICE):
                words, of_row = word_hashes(data, offsets)
                n = end - first
                size, set_a, set_b = (np.zeros(n, np.uint64) for _ in range(3))
                minima = np.zeros((n, sketcher.bins), dtype=np.uint32)
                for i in range(n):
                    found = shingle_set(words[of_row[i] : of_row[i + 1]], shingle)
                    size[i] = len(found)
                    if len(found):
                        set_a[i] = found.sum(dtype=np.uint64)
                        set_b[i] = mix(found).sum(dtype=np.uint64)
                        minima[i] = sketcher.minima(found)
                keys = sketcher.buckets(minima).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(size.view(np.int64)),
                        pa.array(set_a.view(np.int64)),
                        pa.array(set_b.view(np.int64)),
                        pa.array([row.tobytes() for row in minima], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(n + 1) * sketcher.bands, pa.int32()), pa.array(keys.ravel())
                        ),
                    ],
                    names=SKETCHES.names,
                )

    return docs.mapInArrow(sketch, SKETCHES)


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of `pairs(a, b)` whose full shingle sets reach the threshold.

    Rows of `texts(id, text)` are joined to both sides by id and compared as they pass by;
    a pair costs the two texts, whatever the size of its group. An id may have several
    texts; the pair is confirmed once for each combination that reaches the threshold.
    """
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[list[np.ndarray]] = []
            for column in (batch.column(2), batch.column(3)):
                sets.append([])
                for first, end, data, offsets in slices(column, SLICE):
                    words, of_row = word_hashes(data, offsets)
                    sets[-1] += [shingle_set(words[of_row[i] : of_row[i + 1]], shingle) for i in range(end - first)]
            keep = []
            for x, y in zip(*sets):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(verify, "a long, b long")


def _block_links(shingle: int, percent: int, bands: int, rows: int):
    """Confirmed links between different components of two blocks: a spanning forest of them.

    Of the buckets that two classes share only the first compares them.
    """
    share = percent / 100
    least = share - DEVIATIONS * (share * (1 - share) / (bands * rows)) ** 0.5

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sets: dict[int, np.ndarray] = {}

        def full(i: int) -> np.ndarray:
            if ids[i] not in sets:
                raw = (group.text.iat[i] or "").encode()
                words, _ = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                sets[ids[i]] = shingle_set(words, shingle)
            return sets[ids[i]]

        top: dict[int, int] = {}

        def root(c: int) -> int:
            while top.get(c, c) != c:
                c = top[c]
            return c

        n, part, ids = group.n_shingles.to_numpy(), group.component.to_numpy(), group.id.to_numpy()
        side, rest, band = group.side.to_numpy(), group.rest.to_numpy(bool), group.band.iat[0]
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        minima = np.stack([np.frombuffer(m, np.uint32) for m in group.minima])
        out = []
        for i in left:
            fits = (part[right] != part[i]) & (100 * np.minimum(n[right], n[i]) >= percent * np.maximum(n[right], n[i]))
            at = right[fits & ~(rest[right] & (ids[right] >= ids[i]))]
            equal = minima[at] == minima[i]
            shared = equal.reshape(len(at), bands, rows).all(axis=2)
            at = at[(equal.mean(axis=1) >= least) & (shared.argmax(axis=1) == band)]
            for k in at:
                x, y = root(int(part[i])), root(int(part[k]))
                if x == y:
                    continue
                common = len(np.intersect1d(full(i), full(k), assume_unique=True))
                if 100 * common >= percent * (len(full(i)) + len(full(k)) - common):
                    top[x] = y
                    out.append((max(ids[i], ids[k]), min(ids[i], ids[k])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return compare


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per row of `docs(doc_id, text)`: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of
    distinct `shingle`-word shingles (fewer words: the whole sequence). component_id is the
    smallest doc_id reachable over links, the document's own if it has none; kept marks
    that document.

    Null, empty and blank texts have the empty set and no links. Rows with equal doc_id are
    one node, which has the links of all their texts; all of them come back. Null doc_id: null component, kept. Other columns are ignored. Empty input: no
    rows.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    place = scratch_path(spark, "sketches")
    sketches(narrow, shingle, bands, rows).write.parquet(place)
    sketched = spark.read.schema(SKETCHES).parquet(place)
    usable = sketched.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))

    # One row per class of equal sets; its id is the smallest doc_id in it.
    key = ["set_a", "set_b", "n_shingles"]
    smallest = usable.groupBy(*key).agg(F.min("doc_id").alias("doc_id"))
    classes = usable.join(smallest, [*key, "doc_id"], "left_semi").dropDuplicates([*key, "doc_id"])
    classes = classes.withColumnRenamed("doc_id", "id")
    place = scratch_path(spark, "classes")
    classes.write.parquet(place)
    classes = spark.read.schema(classes.schema).parquet(place)

    members = classes.select("id", "n_shingles", F.posexplode("buckets").alias("band", "bucket"))
    centers = members.groupBy("bucket").agg(
        F.min("id").alias("center"), F.count("*").alias("n"), F.min_by("n_shingles", "id").alias("n_center")
    ).where("n > 1")
    shared = members.join(centers, "bucket")
    place = scratch_path(spark, "stars")
    shared.write.parquet(place)
    shared = spark.read.schema(shared.schema).parquet(place)

    fits = F.expr(f"100 * least(n_shingles, n_center) >= {percent} * greatest(n_shingles, n_center)")
    stars = shared.where((F.col("id") != F.col("center")) & fits)
    stars = stars.select(F.col("id").alias("a"), F.col("center").alias("b")).distinct()
    texts = narrow.join(classes.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    texts = texts.select(F.col("doc_id").alias("id"), "text")
    links = _confirm_written(spark, stars, texts, shingle, percent)
    reached = components(links)

    mixed = _mixed_buckets(spark, shared, reached)
    rest = _beyond_stars(mixed, classes, texts, _block_links(shingle, percent, bands, rows))
    place = scratch_path(spark, "rest")
    rest.write.parquet(place)
    rest = spark.read.schema("a long, b long").parquet(place)
    if not rest.isEmpty():
        reached = components(links.union(rest))

    by_class = classes.select(*key, "id").join(reached, "id", "left")
    by_class = by_class.select(*key, F.coalesce("component", "id").alias("_component"))
    out = sketched.select("doc_id", *key).join(by_class, key, "left")
    component = F.coalesce("_component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _confirm_written(spark: SparkSession, pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Confirm pairs; only the texts of documents that are in a pair are shuffled."""
    place = scratch_path(spark, "pairs")
    pairs.write.parquet(place)
    pairs = spark.read.schema("a long, b long").parquet(place)
    named = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    used = texts.join(named, "id", "left_semi").distinct()
    place = scratch_path(spark, "confirmed")
    confirmed(pairs, used, shingle, percent).distinct().write.parquet(place)
    return spark.read.schema("a long, b long").parquet(place)


def _mixed_buckets(spark: SparkSession, shared: DataFrame, reached: DataFrame) -> DataFrame:
    """Members of buckets of three or more that are in several components.

    `main` is the component with most members, `n` counts all and `others` those outside it.
    """
    named = shared.where("n > 2").join(reached, "id", "left")
    named = named.select("band", "bucket", "id", "n_shingles", F.coalesce("component", "id").alias("component"))
    place = scratch_path(spark, "buckets")
    named.write.parquet(place)
    named = spark.read.schema(named.schema).parquet(place)
    parts = named.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    whole = parts.groupBy("bucket").agg(F.max(F.struct("k", "component")).alias("most"), F.sum("k").alias("n"))
    whole = whole.where("most.k < n").select("bucket", F.col("most.component").alias("main"), "n", (F.col("n") - F.col("most.k")).alias("others"))
    place = scratch_path(spark, "mixed")
    named.join(whole, "bucket").write.parquet(place)
    return spark.read.parquet(place)


def _beyond_stars(mixed: DataFrame, classes: DataFrame, texts: DataFrame, compare) -> DataFrame:
    """Links (a, b) between different components of the same bucket that no star has tested.

    One of two such classes is outside the bucket's main component. These are cut into
    blocks, and so are all members; every block of the first meets every one of the second,
    with their texts. A meeting holds two blocks and returns fewer links than it has members.
    """
    blocks = F.ceil(F.col("n") / _BLOCK).cast("int")
    rows = F.ceil(F.col("others") / _BLOCK).cast("int")
    rest = F.col("component") != F.col("main")
    spread = F.xxhash64("id")

    own_row, own_column = F.pmod(spread, rows).cast("int"), F.pmod(spread, blocks).cast("int")

    def place(row: Column, column: Column, side: int) -> Column:
        return F.struct(row.alias("row"), column.alias("column"), F.lit(side).alias("side"))

    as_member = F.transform(F.sequence(F.lit(0), rows - 1), lambda j: place(j, own_column, 1))
    as_rest = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: place(own_row, j, 0))
    every = F.when(rest, F.concat(as_member, as_rest)).otherwise(as_member)
    used = texts.join(mixed.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    used = used.join(classes.select("id", "minima"), "id")
    dealt = mixed.select("band", "bucket", "id", "n_shingles", "component", rest.alias("rest"), F.explode(every).alias("meet"))
    dealt = dealt.join(used, "id").select("band", "bucket", "id", "n_shingles", "component", "rest", "minima", "text", "meet.*")
    return dealt.groupBy("bucket", "row", "column").applyInPandas(compare, "a long, b long").distinct()
