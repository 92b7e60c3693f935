"""Structured Streaming forms: pairing, de-duplication, extraction, cache updates, progress."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from attrspark.functions.names import STREAM_IMAGE_SUFFIXES, TEXT_SUFFIXES, member_kind, stem, strip
from attrspark.operators.cache import CacheTable, latest
from attrspark.operators.results import summary_metrics
from attrspark.vocabulary import IMAGE_VOCABULARY, Vocabulary


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Halves(StatefulProcessor):
    """Per stem, the position of the half that waits for its counterpart.

    Halves of a stem are taken in the order of their positions; a repeated half replaces the
    one that waits, and a match frees the state. A timer frees it when nothing has come for
    `wait` of event time. The state of a stem is one row, however often a half is repeated.
    """

    def __init__(self, kind: str, wait: int):
        self.kind, self.wait = kind, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", f"image {self.kind}, text {self.kind}, until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = self.waiting.get() if self.waiting.exists() else None
        image, text, until = found if found is not None else (None, None, None)
        latest, out = None, []
        for half in sorted(rows, key=lambda r: r["at"]):
            latest = max(latest or 0, half["time"])
            if half["is_image"]:
                image = half["at"]
            else:
                text = half["at"]
            if image is not None and text is not None:
                out.append(Row(stem=key[0], image_at=image, text_at=text))
                image = text = None
        if until is not None:
            self.handle.deleteTimer(until)
        if image is not None or text is not None:
            until = max(latest, timerValues.getCurrentWatermarkInMs()) + self.wait
            self.waiting.update((image, text, until))
            self.handle.registerTimer(until)
        elif found is not None:
            self.waiting.clear()
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.waiting.clear()
        return iter(())

    def close(self) -> None:
        pass


def pair_stream(members: DataFrame, at: str, time: str, delay: str, wait: str, name: str = "name") -> DataFrame:
    """Emit (stem, image_at, text_at) as soon as both halves of a stem have arrived.

    `members` is a stream of files with a position `at` (a number or a string), in whose order
    they count: of repeated halves the last before the match does, and each half is in one pair
    at most. `delay` is how late a member may come in event time, `wait` how long a half waits for
    the other. Members carry no content; read it for the pairs, by position.

    State is kept in RocksDB: start the stream with `append_stream`.
    """
    kind = member_kind(F.col(name), STREAM_IMAGE_SUFFIXES, TEXT_SUFFIXES)
    halves = members.where(kind != "other").withWatermark(time, delay).select(
        stem(F.col(name)).alias("stem"), (kind == "image").alias("is_image"), F.col(at).alias("at"),
        F.unix_millis(time).alias("time"), F.col(time).alias("event_time"),
    )
    position = halves.schema["at"].dataType.simpleString()
    milliseconds = members.sparkSession.range(1).select(
        (F.expr(f"unix_millis(timestamp'1970-01-01 00:00:00Z' + INTERVAL {wait})")).alias("w")
    )
    return halves.groupBy("stem").transformWithState(
        Halves(position, milliseconds.first()["w"]),
        f"stem string, image_at {position}, text_at {position}",
        "Append",
        "EventTime",
    )


def with_halves(pairs: DataFrame, members: DataFrame, at: str, image: Column, text: Column) -> DataFrame:
    """(stem, image, text) of pairs of positions, from the members they were found in."""
    images = members.select(F.col(at).alias("image_at"), image.alias("image"))
    texts = members.select(F.col(at).alias("text_at"), strip(text).alias("text"))
    return pairs.join(images, "image_at").join(texts, "text_at").select("stem", "image", "text")


def new_only(stream: DataFrame, done: DataFrame, time: str, delay: str, key: str = "id") -> DataFrame:
    """Drop ids that are done, and repeats within the watermark delay."""
    fresh = stream.join(done.select(key).distinct(), key, "left_anti")
    return fresh.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def append_stream(
    results: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append result rows as JSON lines; restarted from its checkpoint, nothing is written twice.

    New streams keep their state in RocksDB, on local disk with changes in the checkpoint, so
    that it does not have to fit the heap.
    """
    results.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    writer = (
        results.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("ignoreNullFields", "false")
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def cache_stream(
    entries: DataFrame,
    cache: CacheTable,
    checkpoint: str,
    recency: tuple[str, ...] = ("ts",),
    available_now: bool = True,
) -> StreamingQuery:
    """Add cache entries as they arrive; a retried micro-batch replaces its first attempt."""
    # The checkpoint names the stream: other writers of the cache never share its tokens.
    stream = hashlib.md5(checkpoint.encode()).hexdigest()

    def add(batch: DataFrame, number: int) -> None:
        cache.put(latest(batch, ["hash_key"], list(recency)), token=f"{stream}x{number}")

    writer = entries.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def observed(results: DataFrame, name: str = "progress", vocabulary: Vocabulary = IMAGE_VOCABULARY):
    """Attach run counters to a stream; a `ProgressLog` receives them per micro-batch."""
    return results.observe(name, *summary_metrics(vocabulary))


class ProgressLog(StreamingQueryListener):
    """Running totals of the observed counters, and the rate of the last micro-batch."""

    def __init__(self, name: str = "progress"):
        self.name = name
        self.totals: dict[str, int] = {}
        self.rows_per_second = 0.0
        self.last: dict[str, int] = {}  # per run, the last micro-batch that was counted

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run, batch = str(progress.runId), progress.batchId
        row = progress.observedMetrics.get(self.name)
        if row is None or batch <= self.last.get(run, -1):
            return
        self.last[run] = batch
        self.rows_per_second = progress.processedRowsPerSecond or 0.0
        for counter, value in row.asDict().items():
            self.totals[counter] = self.totals.get(counter, 0) + value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
