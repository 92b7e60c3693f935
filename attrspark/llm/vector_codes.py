"""Product codes of vectors, trained by Lloyd rounds that look at moved entries only.

Each component x becomes the integer floor(1024 x), so all sums and distances are exact and the
same on any cluster. A vector is cut into equal parts; every part position has a codebook of
at most 256 entries. A round assigns each part to the nearest entry and replaces every entry by
the floored mean of its parts.

Vectors are kept in blocks with the assigned entries and their exact distances. A part whose
entry did not move compares the moved entries with its stored distance; any other part looks at
all entries. Ties go to the lower index, as in a full scan. Each task of a round also writes the
sums of its parts by entry, so a round reads the vectors once and what reaches the driver is
one row per entry: its size is set by the parameters, not by the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrspark.llm.hot import with_value
from attrspark.session import scratch_path

SCALE = 1024
#: Components up to this size have exact distances in a long, errors of whole vectors too.
LARGEST = 1 << 17
BLOCK = 4096


def _kept(vector: Column) -> Column:
    """No null vector, no null, infinite or undefined component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _scaled(values: np.ndarray) -> np.ndarray:
    return np.floor(values.astype(np.float64) * SCALE).astype(np.int64)


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer entries."""
    largest = max(int(np.abs(x).max(initial=0)) for x in (parts, entries))
    if 4 * parts.shape[1] * largest**2 < 1 << 53:  # every sum below is exact in doubles
        p, e = parts.astype(np.float64), entries.astype(np.float64)
        found = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)
        return found.astype(np.int64)
    out = np.empty((len(parts), len(entries)), np.int64)
    for i, entry in enumerate(entries):
        away = parts - entry
        out[:, i] = (away * away).sum(axis=1)
    return out


def assigned(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part, the lowest if several are, and its distance."""
    found = distances(parts, entries)
    at = found.argmin(axis=1)
    return at, found[np.arange(len(parts)), at]


def reassigned(
    parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, stored: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """`assigned` from the last round's `at` and `stored`; `moved` marks entries that changed since."""
    at, stored = at.copy(), stored.copy()
    again = moved[at]
    if again.any():
        at[again], stored[again] = assigned(parts[again], entries)
    rest = np.flatnonzero(~again)
    active = np.flatnonzero(moved)
    if len(rest) and len(active):
        which, best = assigned(parts[rest], entries[active])
        which = active[which]
        won = (best < stored[rest]) | ((best == stored[rest]) & (which < at[rest]))
        at[rest[won]], stored[rest[won]] = which[won], best[won]
    return at, stored


def _sums(codebooks: list[np.ndarray], parts: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Per part position and entry: the number of its parts and their sum."""
    out = np.zeros((len(codebooks), len(codebooks[0]), 1 + parts[0].shape[1]), np.int64)
    for k, part in enumerate(parts):
        order = np.argsort(codes[:, k], kind="stable")
        used, first, n = np.unique(codes[order, k], return_index=True, return_counts=True)
        if len(used):
            out[k, used, 0] = n
            out[k, used, 1:] = np.add.reduceat(part[order], first, axis=0)
    return out


State = "ids array<long>, labels {label}, vectors binary, codes binary, errors binary, sums binary"


def _pass(
    codebooks: list[np.ndarray], moved: list[np.ndarray] | None, schema: pa.Schema
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One assignment of all blocks, then a row with the sums of the task."""

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = codebooks[0].shape[1]
        total = np.zeros((len(codebooks), len(codebooks[0]), 1 + width), np.int64)
        seen = False
        for batch in batches:
            for i in range(len(batch)):
                seen = True
                vectors, codes, errors = (batch.column(k)[i].as_py() for k in ("vectors", "codes", "errors"))
                values = _scaled(np.frombuffer(vectors, np.float64)).reshape(-1, width * len(codebooks))
                parts = np.split(values, len(codebooks), axis=1)
                if moved is None:
                    found = [assigned(p, e) for p, e in zip(parts, codebooks)]
                else:
                    at = np.frombuffer(codes, np.int16).reshape(len(values), -1)
                    stored = np.frombuffer(errors, np.int64).reshape(len(values), -1)
                    found = [
                        reassigned(p, codebooks[k], moved[k], at[:, k].astype(np.int64), stored[:, k])
                        for k, p in enumerate(parts)
                    ]
                codes = np.column_stack([f[0] for f in found])
                total += _sums(codebooks, parts, codes)
                row = [
                    batch.column("ids").slice(i, 1),
                    batch.column("labels").slice(i, 1),
                    pa.array([vectors], pa.binary()),
                    pa.array([codes.astype(np.int16).tobytes()], pa.binary()),
                    pa.array([np.column_stack([f[1] for f in found]).tobytes()], pa.binary()),
                    pa.nulls(1, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(row, schema)], schema=schema)
        if seen:
            last = [pa.nulls(1, f.type) for f in schema][:-1] + [pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(last, schema=schema)

    return assign


def _blocks(schema: pa.Schema) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), BLOCK):
                part = batch.slice(first, BLOCK)
                vectors = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                lists = []
                for k in (0, 1):
                    values = part.column(k)
                    ends = pa.array([0, len(values)], pa.int32())
                    lists.append(pa.ListArray.from_arrays(ends, pa.concat_arrays([values])))
                row = [*lists, pa.array([vectors.tobytes()], pa.binary()), *[pa.nulls(1, pa.binary())] * 3]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(row, schema)], schema=schema)

    return pack


def _codes(parts: int, label: pa.DataType) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                codes = np.frombuffer(batch.column("codes")[i].as_py(), np.int16).reshape(-1, parts)
                errors = np.frombuffer(batch.column("errors")[i].as_py(), np.int64).reshape(-1, parts)
                digits = codes.astype(np.uint8).tobytes().hex()
                step = 2 * parts
                columns = [
                    batch.column("ids").slice(i, 1).flatten(),
                    batch.column("labels").slice(i, 1).flatten().cast(label),
                    pa.array([digits[k : k + step] for k in range(0, len(digits), step)], pa.string()),
                    pa.array(errors.sum(axis=1)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return rows


def first_entries(kept: DataFrame, entries: int) -> list[list[float]]:
    """Vectors of the smallest distinct ids; of several vectors with one id the smallest. Ids
    alone are shuffled to find them."""
    ids = kept.select("vec_id").where("vec_id IS NOT NULL").distinct().orderBy("vec_id").limit(entries)
    last = ids.agg(F.max("vec_id")).first()[0]
    if last is None:
        return []
    first = kept.where(F.col("vec_id") <= last).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return [r["embedding"] for r in first.orderBy("vec_id").collect()]


def vector_codes(vectors: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of `vectors(vec_id, embedding, label)`.

    Rows whose vector is null or has a null or non-finite component are dropped. Codebooks start
    from the smallest vec_ids; with fewer than `entries` of them they are smaller. `code` has two
    hex digits per part, `error` is the squared distance, `label_error` its sum over a label.

    Null vec_id: coded, never a first entry. Repeated ids and rows: each coded and counted.
    Null label: a label of its own. A vector with another length than the one with the smallest
    vec_id, or with a component beyond 2^17, takes no part; its code and error are null, and so is
    the label_error of a label with such vectors only. Vectors whose length is no multiple of
    `parts`, or no id at all: no codes, codebooks_sha256 of the empty text. Empty table: no rows.
    Other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    spark = vectors.sparkSession
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    kept = narrow.where(_kept(F.col("embedding")))
    small = ~F.exists("embedding", lambda x: F.abs(x) > LARGEST)
    start = first_entries(kept.where(small), entries)
    length = len(start[0]) if start else 0
    fits = small & (F.size("embedding") == length) & F.lit(length > 0 and length % parts == 0)
    if any(len(v) != length for v in start):
        start = first_entries(kept.where(fits), entries)
    if length % parts:
        start = []
    label = narrow.schema["label"].dataType
    codebooks = [
        np.ascontiguousarray(x)
        for x in (np.split(_scaled(np.array(start, np.float64)), parts, axis=1) if start and length else [])
    ]
    odd = kept.where(~fits).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    if codebooks:
        state = State.format(label=f"array<{label.simpleString()}>")
        schema = spark.createDataFrame([], state).limit(0).toArrow().schema
        place = scratch_path(spark, "blocks")
        kept.where(fits).select("vec_id", "label", "embedding").mapInArrow(_blocks(schema), state).write.parquet(place)
        moved = None
        for turn in range(rounds + 1):
            blocks = spark.read.schema(state).parquet(place).where("vectors IS NOT NULL").drop("sums")
            blocks = blocks.withColumn("sums", F.lit(None).cast("binary"))
            place = scratch_path(spark, "blocks")
            blocks.mapInArrow(_pass(codebooks, moved, schema), state).write.parquet(place)
            if turn < rounds:
                codebooks, moved = _updated(spark.read.schema(state).parquet(place).select("sums"), codebooks)
        found = spark.read.schema(state).parquet(place).where("vectors IS NOT NULL")
        arrow = schema.field("labels").type.value_type
        rows = found.select("ids", "labels", "codes", "errors").mapInArrow(
            _codes(parts, arrow), f"vec_id long, label {label.simpleString()}, code string, error long"
        )
        rows = rows.unionByName(odd)
    else:
        rows = odd
    place = scratch_path(spark, "codes")
    rows.write.parquet(place)
    rows = spark.read.parquet(place)
    numbers = ",".join(str(v) for book in codebooks for v in book.ravel().tolist())
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    return with_value(rows, sums, "label", rows.count()).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _updated(sums: DataFrame, codebooks: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Entries as floored means of their parts, and which of them moved. Sums of tasks are added
    in Spark; the driver gets one row per entry."""
    parts, entries, width = len(codebooks), len(codebooks[0]), codebooks[0].shape[1]

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, 1 + width), np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_py(), np.int64).reshape(total.shape)
        used = np.flatnonzero(total[:, 0])
        columns = [pa.array(used), *(pa.array(np.ascontiguousarray(total[used, k])) for k in range(1 + width))]
        yield pa.RecordBatch.from_arrays(columns, names=["entry", *(f"s{k}" for k in range(1 + width))])

    names = [f"s{k}" for k in range(1 + width)]
    schema = "entry long, " + ", ".join(f"{n} long" for n in names)
    rows = sums.where("sums IS NOT NULL").mapInArrow(spread, schema)
    new = np.concatenate(codebooks).copy()
    for row in rows.groupBy("entry").agg(*(F.sum(n).alias(n) for n in names)).collect():
        new[row["entry"]] = np.array(row[2:], np.int64) // row["s0"]
    books = np.split(new, parts)
    return books, [(a != b).any(axis=1) for a, b in zip(books, codebooks)]
