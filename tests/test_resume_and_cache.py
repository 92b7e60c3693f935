"""Resuming, and the cache table."""

import pytest
from pyspark.sql import functions as F

from attrspark.functions.attributes import empty_record, from_json
from attrspark.operators import resume as R
from attrspark.operators.cache import (
    CacheTable,
    cache_key,
    cache_stats,
    extract_cached,
    latest,
    lookup,
    new_entries,
    score_distinct,
)
from attrspark.operators.scorers import LexicalExtractor
from attrspark.session import scratch_path
from attrspark.sources.tables import prior_ids

LINES = [
    '{"id": "a"}',
    "",
    "{bad",
    "5",
    "[1]",
    '[{"id": "inlist"}]',
    '"text"',
    '{"id": null, "item_id": "b"}',
    '{"id": null}',
    '{"id": 12}',
    '  {"id": "c", "Shoe": 1}',
    '{"item_id": "d", "id": "e"}',
    '{"other": 1}',
    '{"id": "a"}',
    '{"id": "torn", "attributes": {"Age": ',
    '{"id": "torn',
]


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


@pytest.fixture
def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_ids_of_earlier_output(lines):
    assert ids(R.processed_ids(lines)) == ["12", "a", "b", "c", "e"]
    assert ids(R.processed_ids(lines, ("item_id", "id"))) == ["12", "a", "b", "c", "d"]


def test_ids_from_files(spark, lines):
    path = scratch_path(spark, "lines")
    assert ids(prior_ids(spark, path)) == []
    lines.write.text(path)
    assert ids(prior_ids(spark, path)) == ["12", "a", "b", "c", "e"]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(f"i{n}", n) for n in range(10)], "id string, at int")


def done(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def test_anti_join_and_limit(spark, items):
    known = done(spark, "i0", "i3", "i3", "elsewhere")
    assert ids(R.not_done(items, known)) == ["i1", "i2", "i4", "i5", "i6", "i7", "i8", "i9"]
    assert ids(R.resume_limit(items, known, ["at"], 3)) == ["i1", "i2", "i4"]
    assert ids(R.remaining_ids(items, known)) == ids(R.not_done(items, known))
    row = R.progress(items, known).first().asDict()
    assert row == {"total": 10, "processed": 2, "remaining": 8}


def test_cursor(spark, items):
    known = done(spark, "i1", "i7")
    assert ids(R.after_cursor(items, known, "i5", ["at"])) == ["i6", "i8", "i9"]
    with pytest.raises(ValueError):
        R.after_cursor(items, known, "nowhere", ["at"])


def test_last_processed(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 3)], "id string, at int")
    assert R.last_processed(df, ["at"]).first()["id"] == "b"


def record(text):
    return from_json(F.lit(text))


def entries(spark, rows):
    df = spark.createDataFrame(rows, "hash_key string, j string, t long")
    return df.select("hash_key", from_json(F.col("j")).alias("attributes"), F.timestamp_seconds("t").alias("ts"))


def ages(cache):
    return {r["hash_key"]: r["attributes"]["Age"] for r in cache.read().collect()}


def test_cache_table(spark):
    cache = CacheTable(spark, scratch_path(spark, "cache"))
    assert ages(cache) == {}
    cache.put(entries(spark, [("a", '{"Age":"teen"}', 5), ("b", "{}", 5)]))
    assert ages(cache) == {"a": "teen", "b": None}
    # The later write replaces, even with an older clock.
    cache.put(entries(spark, [("a", '{"Age":"child"}', 1)]))
    assert ages(cache) == {"a": "child", "b": None}
    # Writing a batch again changes nothing.
    cache.put(entries(spark, [("a", '{"Age":"elderly"}', 9)]), token="t7")
    cache.put(entries(spark, [("a", '{"Age":"elderly"}', 9)]), token="t7")
    assert ages(cache) == {"a": "elderly", "b": None}
    # A retry takes the place of its first attempt, before what came later.
    cache.put(entries(spark, [("b", '{"Age":"teen"}', 1)]))
    cache.put(entries(spark, [("a", '{"Age":"elderly"}', 9), ("b", '{"Age":"child"}', 9)]), token="t7")
    assert ages(cache) == {"a": "elderly", "b": "teen"}
    row = cache_stats(cache.read()).first()
    assert row["enabled"] and row["entries"] == 2
    before = ages(cache)
    cache.compact()
    assert ages(cache) == before
    cache.put(entries(spark, [("c", "{}", 1)]))
    assert set(ages(cache)) == {"a", "b", "c"}
    cache.clear()
    assert ages(cache) == {}
    with pytest.raises(ValueError):
        cache.put(entries(spark, [("c", "{}", 1)]), token="a-b")


def test_unfinished_writes_are_not_read(spark):
    path = scratch_path(spark, "cache")
    cache = CacheTable(spark, path)
    cache.put(entries(spark, [("a", "{}", 1)]))
    unfinished = entries(spark, [("torn", "{}", 1)]).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    )
    unfinished.parquet(f"{path}/gen=0/batch=9")
    unfinished.parquet(f"{path}/gen=1/batch=0")
    assert set(ages(cache)) == {"a"}


def test_no_cache(spark):
    items = spark.createDataFrame([("k",)], "hash_key string")
    assert lookup(items, None).first()["hit"] is False
    assert "Join" not in lookup(items, None)._jdf.queryExecution().optimizedPlan().toString()
    assert cache_stats(None, spark).first().asDict() == {
        "enabled": False, "entries": 0, "oldest": None, "newest": None
    }


def test_keys_differ_by_modality(spark):
    row = spark.sql("SELECT 'x' AS t").select(
        cache_key("text", F.col("t")).alias("a"), cache_key("image", F.col("t")).alias("b")
    ).first()
    assert row["a"] != row["b"]


def test_empty_record_is_a_hit(spark):
    items = spark.createDataFrame([("k", "red hair"), ("m", "red hair")], "hash_key string, t string")
    cache = spark.createDataFrame([("k",)], "hash_key string").withColumn("attributes", empty_record())
    for memoise in (True, False):
        out = extract_cached(items, LexicalExtractor(), "t", cache, memoise).orderBy("hash_key").collect()
        assert [r["hit"] for r in out] == [True, False]
        assert [r["outcome"]["attributes"]["Hair_Color"] for r in out] == [None, "red"]


def test_only_new_successes_are_cached(spark):
    items = spark.createDataFrame(
        [("k", "a teen"), ("m", "red hair"), ("m", "red hair"), (None, None)], "hash_key string, t string"
    )
    cache = spark.createDataFrame([("k",)], "hash_key string").withColumn("attributes", empty_record())
    out = extract_cached(items, LexicalExtractor(), "t", cache)
    assert [r["hash_key"] for r in new_entries(out).collect()] == ["m"]


def test_one_text_held_by_a_third_of_all_rows(spark):
    rows = [(i, "a teen" if i % 3 == 0 else f"red hair {i}") for i in range(600)]
    df = spark.createDataFrame(rows, "i int, t string").withColumn("hash_key", cache_key("text", F.col("t")))
    done = score_distinct(df, LexicalExtractor(), "t").collect()
    assert len(done) == 600
    assert {r["i"] for r in done if r["outcome"]["attributes"]["Age"] == "teen"} == set(range(0, 600, 3))


def test_latest_is_idempotent(spark):
    log = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 3, 1)], "k string, ts int, seq int")
    once = latest(log, ["k"], ["ts", "seq"])
    twice = latest(once, ["k"], ["ts", "seq"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 1, 2), ("b", 3, 1)]
