"""Skip what earlier runs have done: processed ids, anti-join, cursor, limit, progress."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrspark.operators.positions import literal, take
from attrspark.session import freeze


def processed_ids(lines: DataFrame, fields: tuple[str, ...] = ("id", "item_id"), line: str = "value"):
    """Distinct ids found in JSON lines; lines that are no JSON object are skipped.

    The first of `fields` that is not null is the id; numbers are read as strings.
    """
    schema = ", ".join(f"{f} string" for f in fields) + ", _bad string"
    record = F.from_json(line, schema, {"columnNameOfCorruptRecord": "_bad"})
    objects = lines.where(F.rlike(F.col(line), F.lit(r"^\s*\{"))).select(record.alias("r"))
    return (
        objects.where(F.col("r._bad").isNull())
        .select(F.coalesce(*[F.col(f"r.{f}") for f in fields]).alias("id"))
        .where(F.col("id").isNotNull())
        .distinct()
    )


def not_done(items: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Items whose key is not among the done ones.

    Spark broadcasts `done` when its size is known to be small; otherwise the rows
    meet in a shuffle, where a hot item key is split at run time.
    """
    return items.join(done.select(key), key, "left_anti")


def resume_limit(items: DataFrame, done: DataFrame, order: list[str], n: int, key: str = "id"):
    """The first n items that are not done yet; skipped items do not count.

    Order columns of what is left are written once, as the search for the n-th reads them again.
    """
    left = not_done(items, done, key)
    return take(left, order, n, freeze(left.select(*order)))


def last_processed(done: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """One row: the id of the last record in the given order."""
    return done.agg(F.max_by(key, F.struct(*order)).alias(key))


def after_cursor(
    items: DataFrame, done: DataFrame, cursor: str, order: list[str], key: str = "id"
) -> DataFrame:
    """Items after the cursor item, without those done; an unknown cursor is an error."""
    at = F.struct(*order)
    # Aggregates to one row whatever the size of the table.
    found = items.where(F.col(key) == F.lit(cursor)).agg(F.max(at).alias("at")).first()["at"]
    if found is None:
        raise ValueError(f"cursor id {cursor!r} is not among the items")
    return not_done(items.where(at > literal(found, items, order)), done, key)


def progress(items: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """One row: total, processed and remaining items. Ids not among the items do not count."""
    seen = done.select(key).distinct().withColumn("__done", F.lit(True))
    hit = F.col("__done").isNotNull()
    return items.join(seen, key, "left").agg(
        F.count("*").alias("total"),
        F.count_if(hit).alias("processed"),
        F.count_if(~hit).alias("remaining"),
    )


def remaining_ids(items: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids that are not done."""
    return not_done(items.select(key).distinct(), done, key)


def with_row_ids(df: DataFrame) -> DataFrame:
    """Add `id` as a string: `id`, else `image_id`, else one that stays the same when rows
    are added: file and row in it for Parquet files, a digest of the row for anything else.
    """
    given = [F.col(c).cast("string") for c in ("id", "image_id") if c in df.columns]
    try:
        made = F.concat_ws(
            "_", F.lit("row"), F.hex(F.xxhash64("_metadata.file_path")), F.col("_metadata.row_index")
        )
        return df.withColumn("id", F.coalesce(*given, made))
    except AnalysisException:  # no file metadata
        pass
    digest = F.concat_ws("_", F.lit("row"), F.md5(F.to_json(F.struct(*df.columns))))
    return df.withColumn("id", F.coalesce(*given, digest))
