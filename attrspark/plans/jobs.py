"""Whole jobs: read, skip what is done, extract, append result lines, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.functions.tags import (
    DATASET_RULES,
    SHARD_RULES,
    TagRules,
    split_commas,
    tag_source,
    with_tags,
)
from attrspark.operators.cache import (
    CacheTable,
    cache_key,
    extract_cached,
    extract_seen,
    lookup,
    new_entries,
    reuse_cached,
)
from attrspark.operators.chosen import PLACE, chosen_in_place, spread_out, with_places
from attrspark.operators.extract import (
    extract_sources,
    image_bytes,
    marked_empty,
    to_results,
    with_source,
)
from attrspark.operators.pairing import pair_positions, shard_stats
from attrspark.operators.positions import take, take_in_place
from attrspark.operators.results import throughput
from attrspark.operators.resume import after_cursor, not_done, progress, with_row_ids
from attrspark.operators.scorers import Extractor, LexicalExtractor, ModelExtractor
from attrspark.session import freeze
from attrspark.sources.files import exists, list_files
from attrspark.sources.id_log import IdLog
from attrspark.sources.images import image_files
from attrspark.sources.tables import prior_ids, write_with_summary
from attrspark.sources.tar_shard import (
    ENDINGS,
    by_stretch,
    read_tasks,
    tar_members,
    with_digests,
    with_member_scores,
    with_texts,
)


@dataclass(frozen=True)
class Resume:
    """How a run treats an output that is already there.

    mode "anti" skips the ids found in it, "cursor" also everything up to `cursor`,
    "none" starts over and replaces it.
    """

    mode: str = "anti"
    cursor: str | None = None
    id_fields: tuple[str, ...] = ("id", "item_id")

    def __post_init__(self) -> None:
        if self.mode not in ("anti", "cursor", "none"):
            raise ValueError(f"unknown resume mode {self.mode!r}")
        if (self.mode == "cursor") != (self.cursor is not None):
            raise ValueError("a cursor goes with mode 'cursor', and only with it")


def _remaining(items: DataFrame, output: str, resume: Resume, order: list[str]) -> DataFrame:
    spark = items.sparkSession
    if resume.mode == "none" or not exists(spark, output):
        return items
    done = IdLog(spark, output, resume.id_fields).read()
    if resume.mode == "cursor":
        return after_cursor(items, done, resume.cursor, order)
    return not_done(items, done)


def _finish(
    extracted: DataFrame, output: str, append: bool, cache: CacheTable | None, vocabulary
) -> dict:
    """Write the results and, with a cache, the records computed in this run."""
    if cache is not None:
        # Results and cache both need the rows; the extraction must not run twice.
        extracted = freeze(extracted)
    results = to_results(extracted, keep=["hit"])
    summary = write_with_summary(results, output, append, vocabulary, F.col("hit"), drop=("hit",))
    if cache is not None:
        cache.put(new_entries(extracted))
    return summary


def shard_pairs(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """tar, id, image_at, text_at, at: where the first image and text of each id are.

    One row per id over all shards, from the first shard that has it: results are told
    apart by id, so a resumed run and a single one must mean the same by it.
    """
    pairs = pair_positions(tar_members(spark, path), prefix)
    pairs = pairs.withColumn("at", F.least("image_at", "text_at"))
    first = pairs.groupBy("id").agg(F.min(F.struct("tar", "at", "image_at", "text_at")).alias("p"))
    return first.select("p.tar", "id", "p.image_at", "p.text_at", "p.at")


def shard_job(
    spark: SparkSession,
    path: str,
    output: str,
    images: ModelExtractor,
    texts: Extractor | None = None,
    prefix: str = "item",
    samples: int | None = None,
    resume: Resume = Resume(),
    cache: CacheTable | None = None,
    rules: TagRules = SHARD_RULES,
) -> dict:
    """Extract the image-text pairs of tar shards into JSON lines.

    Only (shard, id, offsets) rows are grouped, joined and limited. Content is read
    for the rows that remain, by the task that scores them.
    """
    texts = texts or LexicalExtractor(images.vocabulary)
    pairs = shard_pairs(spark, path, prefix)
    todo = _remaining(pairs, output, resume, ["tar", "at", "id"])
    if samples is not None:
        todo = freeze(todo)  # narrow rows, read again by each step of the search
        todo = take(todo, ["tar", "at", "id"], samples)
    # Both halves of a pair usually lie next to each other: one arrangement serves both reads.
    tasks = read_tasks(spark, path)
    rows = by_stretch(todo, "at", tasks)
    has_image = F.col("image_at").isNotNull()
    rows = rows.withColumn("source", F.when(has_image, "image").otherwise("text"))
    if cache is not None:
        # The keys are taken where the content is read, so only keys meet the cache.
        rows = with_digests(rows, "image_at", "image", "__image_key")
        rows = rows.withColumn("__text_at", F.when(~has_image, F.col("text_at")))
        rows = with_digests(rows, "__text_at", "text", "__text_key")
        rows = rows.withColumn("hash_key", F.coalesce("__image_key", "__text_key"))
        rows = rows.drop("__image_key", "__text_key", "__text_at")
        rows = by_stretch(lookup(rows, cache.read()), "at", tasks)
    else:
        rows = rows.withColumn("hit", F.lit(False)).withColumn("hash_key", F.lit(None).cast("string"))
    rows = with_texts(rows, "text_at", error="__text_error")
    rows = rows.withColumn("__image_at", F.when(~F.col("hit"), F.col("image_at")))
    rows = rows.withColumn("text_input", F.when(~has_image & ~F.col("hit"), F.col("text")))
    rows = with_member_scores(rows, "__image_at", images.scorer, "__scored", "tar", images.batch_size, images.batch_bytes)
    rows = images.from_scores(rows, "__scored", rows.columns, "__image")
    rows = texts.apply(rows, "text_input", "__text")
    unread = ~has_image & F.col("__text_error").isNotNull()
    text_outcome = F.col("__text")
    text_outcome = F.when(unread, text_outcome.withField("error", F.col("__text_error"))).otherwise(text_outcome)
    outcome = F.when(has_image, F.col("__image")).otherwise(text_outcome)
    if cache is not None:
        outcome = reuse_cached(outcome)
    rows = rows.withColumn("outcome", outcome)
    tagged = ~has_image | (F.length("text") > 0)
    rows = with_tags(rows, split_commas(F.col("text")), rules, only_if=tagged)
    kept = rows.select("id", "source", "outcome", "tags", "hit", "hash_key")
    return _finish(kept, output, resume.mode != "none", cache, images.vocabulary)


def in_waves(run: Callable[[int], dict], wave: int, samples: int | None = None) -> dict:
    """Run a resumable job `wave` items at a time, until nothing is left or `samples` are done.

    `run` takes the number of items, e.g. `lambda n: shard_job(..., samples=n)`. A batch write
    is committed as a whole, so a crash loses the wave at hand and no more. Every item of a
    wave must end up in the output, or the next wave would take it again; the jobs write
    items that cannot be used as error rows. A wave may be short or, where items share an
    id, long: only one that finds nothing is the last. Each wave lists the input anew: let
    one take hours, not minutes.
    """
    if wave <= 0:
        raise ValueError("wave must be positive")
    totals: dict = {}
    while samples is None or totals.get("total", 0) < samples:
        left = wave if samples is None else min(wave, samples - totals.get("total", 0))
        summary = run(left)
        for name, value in summary.items():
            if isinstance(value, (int, float)):
                totals[name] = totals.get(name, 0) + value
            else:
                totals[name] = value
        if summary["total"] == 0:
            break
    if totals:
        totals["samples_per_second"] = throughput(totals["total"], totals["processing_time"])
    return totals


def shard_report(spark: SparkSession, path: str, prefix: str, output: str | None = None) -> DataFrame:
    """Shard statistics, with progress when there is an output; the size is that of the shards."""
    size = sum(size for _, size in list_files(path, ENDINGS)) / (1024 * 1024)
    stats = shard_stats(tar_members(spark, path), prefix).withColumn("size_mb", F.lit(size))
    if output is None or not exists(spark, output):
        return stats
    ids = shard_pairs(spark, path, prefix).select("id").distinct()
    # Two one-row tables side by side.
    return stats.withColumn("__one", F.lit(1)).join(
        progress(ids, prior_ids(spark, output)).withColumn("__one", F.lit(1)), "__one"
    ).drop("__one")


def dataset_job(
    dataset: DataFrame,
    output: str,
    images: Extractor | None,
    texts: Extractor | None = None,
    order: list[str] | None = None,
    samples: int | None = None,
    resume: Resume = Resume(id_fields=("item_id", "id")),
    cache: CacheTable | None = None,
    rules: TagRules = DATASET_RULES,
    memoise: bool = False,
) -> dict:
    """Extract dataset rows (image, else text, else caption) into JSON lines.

    Ids come from `id`, else `image_id`. A row with neither is named after what does not
    change when others are added: its Parquet file and row in it, or else its content, so
    that equal rows are then one item. `samples` counts by `order`, by id if there is none;
    rows that tie with the last one are taken too, so an id is never half done. Rows of one
    id must therefore have one value of `order`; else limited runs are refused.

    Rows without image, text and caption become error rows.

    A dataset of Parquet files, also projected or filtered, is decided on by narrow rows: ids,
    order columns and content digests are shuffled, images are not, and texts only where there is
    nothing but texts in fewer row groups than cores. Any other dataset goes through the joins as
    it is.
    """
    texts = texts or LexicalExtractor()
    rows = with_row_ids(dataset)
    if order and samples is not None:
        split = rows.groupBy("id").agg(F.min(F.struct(*order)).alias("a"), F.max(F.struct(*order)).alias("b"))
        if not split.where(~F.col("a").eqNullSafe(F.col("b"))).isEmpty():
            raise ValueError(f"rows of one id differ in {order}: a limited run would leave some out")
    order = [*(c for c in order or [] if c != "id"), "id"]
    stored = cache.read() if cache is not None else None

    def sourced(df: DataFrame) -> DataFrame:
        """With source, text_input, plain image bytes and, for the cache, hash_key."""
        # Without an image extractor the texts of all rows are used.
        df = with_source(df if images is not None else df.drop("image"), keep_empty=True)
        key = cache_key("text", F.col("text_input"))
        if images is not None and "image" in df.columns:
            df = df.withColumn("image", image_bytes(df))
            key = F.when(F.col("source") == "image", cache_key("image", F.col("image"))).otherwise(key)
        return df.withColumn("hash_key", key if cache is not None else F.lit(None).cast("string"))

    def selected(df: DataFrame) -> DataFrame:
        df = _remaining(df, output, resume, order)
        if samples is not None:
            keys = df.select(*order)
            df = take_in_place(df, order, samples, freeze(keys if places is None else spread_out(keys, places)))
        return lookup(df, stored)

    places = with_places(rows)
    scanned = places
    if samples is None and cache is None and resume.mode == "none":
        places = None
    if places is None:
        if images is None and scanned is not None:
            rows = spread_out(rows, scanned)
        rows = sourced(with_row_tags(rows, rules))
        rows = selected(rows)
    else:
        # Decided on narrow rows; images and texts are read again by the tasks that use them.
        narrow = sourced(places).select(*dict.fromkeys([*order, "hash_key", *PLACE]))
        found = selected(narrow)
        kept = ["hit", "cached", "__known"] if stored is not None else ["hit"]
        found = found.withColumn("__known", F.col("hash_key"))
        chosen = chosen_in_place(places, found, kept)
        if images is None:  # texts to extract weigh less than the work on them; images stay
            chosen = spread_out(chosen, places, samples)
        rows = sourced(with_row_tags(chosen, rules))
        if stored is not None:  # rows made of one row under one id may differ in content
            rows = rows.withColumn("hit", F.col("hit") & F.col("__known").eqNullSafe(F.col("hash_key"))).drop("__known")
    keep = ["id", "source", "outcome", "tags", "hit", "hash_key"]
    if images is None:
        done = marked_empty(extract_seen(rows, texts, "text_input", stored is not None, memoise))
        return _finish(done.select(*keep), output, resume.mode != "none", cache, texts.vocabulary)
    if stored is not None:
        for column in {"image", "text_input"} & set(rows.columns):
            rows = rows.withColumn(column, F.when(~F.col("hit"), F.col(column)))
    done = extract_sources(rows, images, texts)
    if stored is not None:
        done = done.withColumn("outcome", reuse_cached(F.col("outcome")))
    return _finish(marked_empty(done).select(*keep), output, resume.mode != "none", cache, texts.vocabulary)


def with_row_tags(rows: DataFrame, rules: TagRules) -> DataFrame:
    """With `tags`, from the column that has them."""
    tags = tag_source(rows)
    return with_tags(rows, tags, rules, only_if=tags.isNotNull())


def directory_job(
    spark: SparkSession,
    path: str,
    output: str,
    images: Extractor,
    suffixes: tuple[str, ...],
    cache: CacheTable | None = None,
    vocabulary=None,
) -> dict:
    """Extract the images below a folder; files that cannot be used become error rows."""
    files = image_files(spark, path, suffixes)
    if cache is None:
        done = images.apply(files, "content", "outcome")
        done = done.withColumn("hit", F.lit(False)).withColumn("hash_key", F.lit(None).cast("string"))
    else:
        keyed = files.withColumn("hash_key", cache_key("image", F.col("content")))
        done = extract_cached(keyed, images, "content", cache.read(), memoise=False)
    kept = done.select("id", "outcome", "hit", "hash_key")
    return _finish(kept, output, False, cache, vocabulary or images.vocabulary)
