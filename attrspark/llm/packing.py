"""Packing documents into sequences: dominance reduction, then best fit.

Item sizes are whole numbers up to the capacity, so an instance is fully described by how
many items each size has. That histogram has at most `capacity` rows whatever the number
of documents; it is reduced and packed on the driver as classes of equal sequences, and
Spark then gives every document its place by its rank among the items of its size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from attrspark.llm.bpe import Encoder, binary_rows
from attrspark.session import scratch_path, small_batches

PIECES = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids", BinaryType()),
    ]
)


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """Token pieces of `docs(doc_id, text)`: doc_id, piece, start, length, ids.

    Each document is its ids and the end id. One that is longer than `capacity` is cut into
    pieces of `capacity`, of which only the first may be shorter. Null text: the end id
    alone. Null and repeated doc_id: kept. Other columns are ignored.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            doc_ids = batch.column(0)
            for first, ids, bounds in encoder.encode(batch.column(1), end):
                total = np.diff(bounds)
                count = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = total - (count - 1) * capacity
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(row + first)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        binary_rows(ids, np.append(bounds[row] + start, bounds[-1])),
                    ],
                    names=PIECES.names,
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(cut, PIECES)


class Bins:
    """Classes of equal bins: how much room is left, and which bins (a range of numbers)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.made = 0
        self.open: dict[int, list[tuple[int, int]]] = {}  # room -> [(first bin, number of bins)]
        self.taken: dict[int, int] = {}  # size -> items placed so far
        self.runs: list[tuple[int, int, int, int, int, int]] = []

    def place(self, size: int, first: int, bins: int, each: int, room: int) -> None:
        """Put `each` items of `size` into each of `bins` bins that have `room`."""
        rank = self.taken.get(size, 0)
        self.runs.append((size, rank, rank + bins * each, first, each, self.capacity - room))
        self.taken[size] = rank + bins * each
        left = room - each * size
        if left:
            self.open.setdefault(left, []).append((first, bins))

    def fresh(self, bins: int) -> int:
        self.made += bins
        return self.made - bins


def dominance(counts: dict[int, int], bins: Bins) -> None:
    """Martello-Toth reduction: fix sets {a} or {a, b} that dominate every other set with a.

    {a, b} dominates if no set of remaining items that fits beside a has a larger sum than
    b: each such set can be exchanged for b without needing room elsewhere. Sums that items
    can reach are found once per pass; items only go, so a later test can miss a reduction
    but never makes a wrong one. {a} dominates if nothing fits beside a.
    """
    capacity = bins.capacity
    changed = True
    while changed:
        changed = False
        reach = 1
        for size, n in counts.items():
            left, step = min(n, capacity // size), 1
            while left:
                take = min(step, left)
                reach |= reach << (take * size)
                left, step = left - take, step * 2
        reach &= (1 << (capacity + 1)) - 1
        for a in sorted(counts, reverse=True):
            n = counts.get(a, 0)
            if not n:
                continue
            room = capacity - a
            most = (reach & ((1 << (room + 1)) - 1)).bit_length() - 1
            b = next((s for s in range(room, 0, -1) if counts.get(s, 0) - (s == a) > 0), 0)
            if b and b < most:
                continue
            k = n if not b else n // 2 if a == b else min(n, counts[b])
            if not k:
                continue
            first = bins.fresh(k)
            bins.place(a, first, k, 1 if a != b else 2, capacity)
            counts[a] -= k * (2 if a == b else 1)
            if b and a != b:
                bins.open[room].pop()
                bins.place(b, first, k, 1, room)
                counts[b] -= k
            elif room and not b:
                bins.open[room].pop()  # nothing left fits here
            changed = True
    for size in [s for s, n in counts.items() if not n]:
        del counts[size]


def best_fit(counts: dict[int, int], bins: Bins) -> None:
    """Best-fit decreasing over the histogram, whole classes of bins at a time."""
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r, classes in bins.open.items() if r >= size and classes), default=0)
            if room:
                first, have = bins.open[room].pop()
            else:
                room, first, have = bins.capacity, None, None
            each = min(room // size, left)
            use = left // each if have is None else min(have, left // each)
            if first is None:
                first = bins.fresh(use)
            elif use < have:
                bins.open[room].append((first + use, have - use))
            bins.place(size, first, use, each, room)
            left -= use * each


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs (size, from rank, to rank, first bin, items per bin, offset) and the number of bins.

    Item number r of a run is in bin `first + r // each` at `offset + (r % each) * size`.
    Every size adds a few runs, so their number is bounded by the capacity.
    """
    bins = Bins(capacity)
    counts = {s: n for s, n in counts.items() if n}
    dominance(counts, bins)
    best_fit(counts, bins)
    return bins.runs, bins.made


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add sequence_id and offset to pieces with doc_id, piece and length (1 to capacity).

    `pieces` is read several times and must return the same rows each time: give a written
    table. Pieces as long as the capacity fill a sequence alone (the simplest dominating
    set) and get odd numbers without any shuffle; the others get even ones. Ranks within a
    size come from per-salt counts, so a size that very many pieces share is split over
    `spark.sql.shuffle.partitions` salts. The histogram and the runs are bounded by the
    capacity; nothing that grows with the documents reaches the driver.

    Repeated rows are separate items. Nulls in doc_id and extra columns are kept.
    """
    spark = pieces.sparkSession
    full = pieces.where(F.col("length") >= capacity).select(
        "*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.where(F.col("length") < capacity).withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts))
    )
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    by_salt = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("length").alias("_length"),
        F.col("_salt").alias("_of"),
        F.coalesce(F.sum("_n").over(by_salt), F.lit(0)).alias("_before"),
    )
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}
    runs, _ = plan(histogram, capacity)
    table = spark.createDataFrame(
        runs,
        "_size long, _from long, _to long, _bin long, _each long, _at long",
    )
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = (
        salted.withColumn("_rank", F.row_number().over(within) - 1)
        .join(before, (F.col("length") == F.col("_length")) & (F.col("_salt") == F.col("_of")))
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    placed = ranked.join(
        F.broadcast(table),
        (F.col("length") == F.col("_size")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    number = F.col("_rank") - F.col("_from")
    other = placed.select(
        *pieces.columns,
        ((F.col("_bin") + F.floor(number / F.col("_each"))) * 2).cast("long").alias("sequence_id"),
        (F.col("_at") + number % F.col("_each") * F.col("length")).cast("long").alias("offset"),
    )
    return full.unionByName(other)


def packed_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 1024) -> DataFrame:
    """Pack documents; of the ids only their CRC-32 is kept, so the written table is narrow."""
    place = scratch_path(spark, "pieces")
    pieces = document_pieces(docs, tokenizer, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    with small_batches(spark):
        pieces.write.parquet(place)
    return pack(spark.read.schema(pieces.schema).parquet(place), capacity)
