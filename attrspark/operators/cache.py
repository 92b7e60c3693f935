"""Results by content hash: keys, lookup, score-once, and a table of cached records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrspark.operators.scorers import Extractor
from attrspark.sources.files import exists, folders
from attrspark.vocabulary import IMAGE_VOCABULARY, Vocabulary


def cache_key(modality: str, content: Column) -> Column:
    """MD5 of modality and content, so equal names or ids of different items never meet."""
    return F.md5(F.concat(F.lit(f"{modality}:").cast("binary"), content.cast("binary")))


def latest(log: DataFrame, key: list[str], recency: list[str]) -> DataFrame:
    """The last row per key. A partial aggregate: a hot key shrinks before the shuffle."""
    values = [c for c in log.columns if c not in key]
    newest = F.max_by(F.struct(*values), F.struct(*recency)).alias("__newest")
    return log.groupBy(*key).agg(newest).select(*key, "__newest.*")


def lookup(items: DataFrame, cache: DataFrame | None) -> DataFrame:
    """Add `hit` and `cached`; items and cache meet on `hash_key`, unique in the cache.

    A cached record whose attributes are all null is a hit too. Without a cache
    there is no join.
    """
    if cache is None:
        return items.withColumn("hit", F.lit(False)).withColumn("cached", F.lit(None))
    entries = cache.select("hash_key", F.col("attributes").alias("cached"), F.lit(True).alias("__hit"))
    return (
        items.join(entries, "hash_key", "left")
        .withColumn("hit", F.col("__hit").isNotNull())
        .drop("__hit")
    )


def reuse_cached(computed: Column) -> Column:
    """The cached record as an outcome where there was a hit, else the computed outcome."""
    reused = F.struct(
        F.col("cached").alias("attributes"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0.0).alias("seconds"),
    )
    return F.when(F.col("hit"), reused).otherwise(computed)


def score_distinct(
    items: DataFrame, extractor: Extractor, payload: str, out: str = "outcome", key: str = "hash_key"
) -> DataFrame:
    """Extract once per distinct key and hand the outcome to every item that has it.

    Worth its shuffle for model scorers; column-expression scorers are cheaper than
    the shuffle and are applied directly instead.
    """
    distinct = items.groupBy(key).agg(F.any_value(payload, F.lit(True)).alias("__payload"))
    outcomes = extractor.apply(distinct, "__payload", out).select(key, out)
    return items.join(outcomes, key, "left")


def extract_cached(
    items: DataFrame,
    extractor: Extractor,
    payload: str,
    cache: DataFrame | None,
    memoise: bool = True,
    out: str = "outcome",
) -> DataFrame:
    """Reuse cached records, extract the rest; needs `hash_key`. Adds `hit` and `out`."""
    return extract_seen(lookup(items, cache), extractor, payload, cache is not None, memoise, out)


def extract_seen(
    seen: DataFrame, extractor: Extractor, payload: str, reuse: bool, memoise: bool = True, out: str = "outcome"
) -> DataFrame:
    """`extract_cached` for items that `lookup` has seen; `reuse` if there was a cache."""
    wanted = seen.withColumn("__todo", F.when(~F.col("hit"), F.col(payload)))
    if memoise:
        misses = wanted.where(~F.col("hit"))
        distinct = misses.groupBy("hash_key").agg(F.any_value("__todo", F.lit(True)).alias("__todo"))
        outcomes = extractor.apply(distinct, "__todo", "__new").select("hash_key", "__new")
        scored = wanted.join(outcomes, "hash_key", "left")
    else:
        scored = extractor.apply(wanted, "__todo", "__new")
    if not reuse:
        return scored.withColumn(out, F.col("__new")).drop("__todo", "__new", "cached")
    return scored.withColumn(out, reuse_cached(F.col("__new"))).drop("__todo", "__new", "cached")


def new_entries(extracted: DataFrame, out: str = "outcome") -> DataFrame:
    """Rows to add to the cache: extracted in this run and without error, once per key."""
    fresh = ~F.col("hit") & F.col(out)["error"].isNull() & F.col("hash_key").isNotNull()
    return (
        extracted.where(fresh)
        .groupBy("hash_key")
        .agg(F.any_value(F.col(out)["attributes"]).alias("attributes"))
        .withColumn("ts", F.current_timestamp())
    )


def cache_stats(cache: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """One row: enabled, entries, oldest, newest."""
    if cache is None:
        return spark.sql(
            "SELECT false AS enabled, 0L AS entries, timestamp(null) AS oldest, timestamp(null) AS newest"
        )
    return cache.agg(
        F.lit(True).alias("enabled"),
        F.count("*").alias("entries"),
        F.min("ts").alias("oldest"),
        F.max("ts").alias("newest"),
    )


class CacheTable:
    """Cached records in a folder of Parquet files.

    `gen=<g>/batch=<b>` holds the rows one write added. Writing adds a batch and never
    rewrites older ones; reading keeps the row of the latest batch per key; `compact`
    and `clear` start the next generation. A write that carries a token replaces the
    batch with the same token, so a retried streaming batch leaves one copy. Folders
    without a `_SUCCESS` file are unfinished writes and are not read. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, vocabulary: Vocabulary = IMAGE_VOCABULARY):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType(
            [
                T.StructField("hash_key", T.StringType()),
                T.StructField("attributes", vocabulary.schema),
                T.StructField("ts", T.TimestampType()),
            ]
        )

    def _batches(self, generation: int) -> dict[str, int]:
        """Finished batches of a generation: folder name and number."""
        folder = f"{self.path}/gen={generation}"
        done = [n for n in folders(self.spark, folder, "batch=") if exists(self.spark, f"{folder}/{n}/_SUCCESS")]
        return {n: int(n[len("batch=") :].split("-", 1)[0]) for n in done}

    def _generation(self) -> int | None:
        """The latest generation whose first batch is complete."""
        numbers = sorted((int(n[len("gen=") :]) for n in folders(self.spark, self.path, "gen=")), reverse=True)
        return next((g for g in numbers if 0 in self._batches(g).values()), None)

    def _write(self, rows: DataFrame, generation: int, batch: str) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.path}/gen={generation}/{batch}")

    def _start(self, rows: DataFrame) -> int:
        current = self._generation()
        generation = 0 if current is None else current + 1
        self._write(rows, generation, "batch=0")
        return generation

    def put(self, rows: DataFrame, token: str | None = None) -> None:
        """Insert or replace rows with `hash_key`, `attributes` and `ts`.

        Give a token to make a retried write replace its first attempt.
        """
        generation = self._generation()
        if generation is None:
            generation = self._start(rows.limit(0))
        batches = self._batches(generation)
        name = f"batch={max(batches.values()) + 1}"
        if token is not None:
            if not token.isalnum():
                raise ValueError("a token is made of letters and digits")
            name = next((n for n in batches if n.endswith(f"-{token}")), f"{name}-{token}")
        self._write(rows, generation, name)

    def read(self) -> DataFrame:
        """The newest record per key."""
        generation = self._generation()
        if generation is None:
            return self.spark.createDataFrame([], self.schema)
        folder = f"{self.path}/gen={generation}"
        batches = self._batches(generation)
        if len(batches) == 1:
            return self.spark.read.schema(self.schema).parquet(f"{folder}/batch=0")
        log = (
            self.spark.read.schema(T.StructType([*self.schema, T.StructField("batch", T.StringType())]))
            .option("basePath", folder)
            .parquet(*[f"{folder}/{name}" for name in batches])
        )
        # The batch number decides: a later write replaces, whatever the clocks said.
        log = log.withColumn("batch", F.substring_index("batch", "-", 1).cast("bigint"))
        return latest(log, ["hash_key"], ["batch", "ts"]).drop("batch")

    def compact(self) -> None:
        """Fold all batches into one; old generations stay readable until removed."""
        self._start(self.read())

    def clear(self) -> None:
        self._start(self.spark.createDataFrame([], self.schema))
