"""Streams: pairing, de-duplication across restarts, cache updates, progress."""

import time
from datetime import timedelta

from pyspark.sql import functions as F

from attrspark.functions.attributes import from_json
from attrspark.operators.cache import CacheTable
from attrspark.operators.extract import to_results
from attrspark.operators.pairing import pair_by_stem
from attrspark.operators.scorers import LexicalExtractor
from attrspark.session import scratch_path
from attrspark.sources.tables import dataset, read_results
from attrspark.streaming import streams as S


def feed(spark, path, rows, schema):
    """Add one file to a streamed folder."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_restart_repeats_nothing(spark):
    source, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    schema = "id string, text string, at timestamp"
    done = spark.createDataFrame([("old",)], "id string")
    rows = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS t").first()["t"]

    def run():
        stream = S.new_only(dataset(spark, source, streaming=True), done, "at", "1 day")
        stream = stream.withColumn("source", F.lit("text"))
        finish(S.append_stream(to_results(LexicalExtractor().apply(stream, "text", "outcome")), out, state))

    feed(spark, source, [("a", "a teen", rows), ("a", "a teen", rows), ("old", "x", rows)], schema)
    run()
    run()
    assert [r["id"] for r in read_results(spark, out).collect()] == ["a"]
    feed(spark, source, [("a", "a teen", rows), ("b", "red hair", rows)], schema)
    run()
    got = {r["id"]: r["attributes"]["Hair_Color"] for r in read_results(spark, out).collect()}
    assert got == {"a": None, "b": "red"} and read_results(spark, out).count() == 2


def test_halves_that_arrive_in_different_batches(spark):
    source, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    schema = "pos long, name string, v string, at timestamp"
    t = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS t").first()["t"]
    everything = [
        [(0, "x_1.jpg", "i1", t), (1, "x_2.txt", " t2 ", t), (2, "x_3.png", "i3", t)],
        [(3, "x_1.txt", "t1", t), (4, "x_2.jpeg", "i2", t), (5, "x_4.txt", "t4", t)],
    ]
    for rows in everything:
        feed(spark, source, rows, schema)
        members = dataset(spark, source, streaming=True)
        finish(S.append_stream(S.pair_stream(members, "pos", "at", "1 hour", "1 hour"), out, state))
    pairs = spark.read.schema("stem string, image_at long, text_at long").json(out)
    table = spark.read.parquet(source)
    streamed = {tuple(r) for r in S.with_halves(pairs, table, "pos", F.col("v"), F.col("v")).collect()}
    batch = pair_by_stem(table, F.col("v"), F.col("v"))
    assert streamed == {tuple(r) for r in batch.collect()} == {("x_1", "i1", "t1"), ("x_2", "i2", "t2")}


def test_halves_pair_one_to_one_and_are_freed(spark):
    """Repeated halves: the last one counts, each is in one pair; a match and time free the state."""
    source, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    schema = "pos long, name string, at timestamp"
    day = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS t").first()["t"]

    def run(rows, hours):
        feed(spark, source, [(p, n, day + timedelta(hours=hours)) for p, n in rows], schema)
        query = S.append_stream(S.pair_stream(dataset(spark, source, streaming=True), "pos", "at", "1 hour", "6 hours"), out, state)
        finish(query)
        found = spark.read.schema("stem string, image_at long, text_at long").json(out)
        left = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
        return sorted(map(tuple, found.collect())), left

    first = [(n, "hot.jpg") for n in range(40)] + [(40, "a.png"), (41, "a.txt"), (42, "b.txt"), (43, "late.jpg"), (44, "x.json")]
    assert run(first, 0)[0] == [("a", 40, 41)]
    # The last of forty images waits; one pair, not forty. A pair that is done does not come again.
    second = [(50, "hot.txt"), (51, "b.jpg"), (52, "a.txt")]
    assert run(second, 1)[0] == [("a", 40, 41), ("b", 51, 42), ("hot", 39, 50)]
    # A second image of a finished stem waits for a text of its own, which has come.
    third = run([(60, "a.jpg"), (61, "hot.txt")], 2)[0]
    assert third == [("a", 40, 41), ("a", 60, 52), ("b", 51, 42), ("hot", 39, 50)]
    # `late.jpg` has waited for more than six hours when its text comes: nothing is left to match.
    run([(70, "other.txt")], 20)
    run([(71, "another.txt")], 21)
    assert run([(72, "late.txt")], 22)[0] == third


def test_cache_stream_is_idempotent(spark):
    source, state = scratch_path(spark, "in"), scratch_path(spark, "state")
    cache = CacheTable(spark, scratch_path(spark, "cache"))
    schema = "hash_key string, j string, ts timestamp"
    t = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS t").first()["t"]

    def run(checkpoint):
        entries = dataset(spark, source, streaming=True).withColumn("attributes", from_json(F.col("j"))).drop("j")
        finish(S.cache_stream(entries, cache, checkpoint))

    feed(spark, source, [("a", '{"Age":"teen"}', t)], schema)
    run(state)
    later = spark.sql("SELECT timestamp'2024-01-02 00:00:00' AS t").first()["t"]
    feed(spark, source, [("a", '{"Age":"child"}', later), ("b", "{}", t)], schema)
    run(state)
    got = {r["hash_key"]: r["attributes"]["Age"] for r in cache.read().collect()}
    assert got == {"a": "child", "b": None}
    before = sorted(map(str, cache.read().drop("ts").collect()))
    # A lost checkpoint writes everything again, and changes nothing.
    run(scratch_path(spark, "state"))
    assert sorted(map(str, cache.read().drop("ts").collect())) == before


def test_progress(spark):
    source, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    feed(spark, source, [("1", "a teen"), ("2", "nothing")], "id string, text string")
    log = S.ProgressLog()
    spark.streams.addListener(log)
    try:
        results = to_results(LexicalExtractor().apply(dataset(spark, source, streaming=True), "text", "outcome"))
        finish(S.append_stream(S.observed(results), out, state))
        for _ in range(100):
            if log.totals:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert log.totals["total"] == 2 and log.totals["successful"] == 1 and log.totals["failed"] == 1
