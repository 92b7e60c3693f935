"""Narrow decisions about wide rows: what is decided elsewhere finds its rows where they are read.

Resume, limits and cache look-ups shuffle. They do so on narrow rows here, which know the place
of the row they stand for (Parquet file and row in it); what they decide is written by file, and
the tasks that read the wide rows look it up. Images and texts are then in no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrspark.session import scratch_path
from attrspark.sources.files import resolve

#: Decisions are written to at most so many folders, by file.
BUCKETS = 256
#: So many rows are worth a task of their own.
ROWS_PER_TASK = 1_000
PLACE = ["__file", "__row", "__key"]

_held: dict[tuple[str, int], pa.Table] = {}


def with_places(df: DataFrame, key: str = "id") -> DataFrame | None:
    """Add the place of each row: hashes of its file and of `key`, and its row number. None if the
    rows do not come from Parquet files by projections and filters."""
    try:
        return df.withColumns(
            {
                "__file": F.xxhash64("_metadata.file_path"),
                "__row": F.col("_metadata.row_index").cast("long"),
                "__key": F.xxhash64(key),
            }
        )
    except AnalysisException:
        return None


def spread_out(df: DataFrame, places: DataFrame, rows: int | None = None) -> DataFrame:
    """`df`, which is read by the scan of `places`, over all cores where that scan has fewer tasks.

    A row group is read by one task, which would also do whatever follows. `rows` is about how
    many there are, if that is known.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = cores if rows is None else min(cores, rows // ROWS_PER_TASK)
    # Reads no columns.
    if tasks < 2 or places.select(F.spark_partition_id().alias("p")).distinct().count() >= tasks:
        return df
    return df.repartition(tasks)


def _decisions(folder: str, bucket: int, file: int) -> pa.Table:
    """What was decided on the rows of a file, by row; a worker keeps that of the last file."""
    if (folder, file) not in _held:
        _held.clear()
        store, path = resolve(f"{folder}/bucket={bucket}")
        if store.get_file_info(path).type.name == "NotFound":
            found = ds.dataset([], schema=pa.schema([(c, pa.int64()) for c in PLACE])).to_table()
        else:
            found = ds.dataset(path, filesystem=store, format="parquet").to_table(filter=pc.field("__file") == file)
        _held[folder, file] = found.sort_by([("__row", "ascending"), ("__key", "ascending")])
    return _held[folder, file]


def _found(table: pa.Table, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each row and key the place in the table, -1 if it is not there."""
    of_rows, of_keys = (table[c].to_numpy() for c in PLACE[1:])
    at = np.searchsorted(of_rows, rows)
    out = np.full(len(rows), -1)
    left = np.flatnonzero(at < len(of_rows))
    while len(left):  # a second step only where several rows were made of one
        same = of_rows[at[left]] == rows[left]
        hit = same & (of_keys[at[left]] == keys[left])
        out[left[hit]] = at[left[hit]]
        left = left[same & ~hit]
        at[left] += 1
        left = left[at[left] < len(of_rows)]
    return out


def chosen_in_place(rows: DataFrame, decided: DataFrame, keep: list[str]) -> DataFrame:
    """The rows of `rows` (from `with_places`) that `decided` has, with its `keep` columns.

    `decided` has the place columns, one row per place, and may be of any size. It is shuffled
    by file and written; `rows` are neither shuffled nor copied. Rows made of one file row
    (as by explode) are told apart by their key.
    """
    spark = rows.sparkSession
    folder = scratch_path(spark, "decided")
    bucket = F.pmod("__file", F.lit(BUCKETS)).cast("int")
    given = decided.select(*PLACE, *keep).withColumn("bucket", bucket)
    given = given.repartition("bucket", "__file").sortWithinPartitions("bucket", "__file", "__row")
    given.write.partitionBy("bucket").parquet(folder)
    kinds = [decided.schema[c] for c in keep]
    result = "struct<" + ", ".join(["__chosen: boolean", *(f"{f.name}: {f.dataType.simpleString()}" for f in kinds)]) + ">"
    schema = spark.createDataFrame([], f"r {result}").limit(0).toArrow().schema.field("r").type

    @F.arrow_udf(result)
    def look_up(buckets: pa.Array, files: pa.Array, places: pa.Array, keys: pa.Array) -> pa.Array:
        files, places, keys = (x.to_numpy(zero_copy_only=False) for x in (files, places, keys))
        buckets = buckets.to_numpy(zero_copy_only=False)
        at = np.flatnonzero(np.concatenate(([True], files[1:] != files[:-1]))) if len(files) else []
        parts = []
        for first, end in zip(at, [*at[1:], len(files)]):  # rows of a file follow each other
            table = _decisions(folder, int(buckets[first]), int(files[first]))
            where = _found(table, places[first:end], keys[first:end])
            index = pa.array(where, mask=where < 0)
            columns = [pa.array(where >= 0)]
            for k, field in enumerate(kinds):
                wanted = schema.field(1 + k).type
                if field.name in table.column_names:
                    values = table[field.name].take(index).combine_chunks()
                    columns.append(values.cast(wanted) if values.type != wanted else values)
                else:
                    columns.append(pa.nulls(end - first, wanted))
            parts.append(pa.StructArray.from_arrays(columns, fields=list(schema)))
        return pa.concat_arrays(parts) if parts else pa.nulls(0, schema)

    seen = rows.withColumn("__decided", look_up(bucket, *PLACE)).where("__decided.__chosen")
    return seen.withColumns({c: F.col("__decided")[c] for c in keep}).drop("__decided", *PLACE)
