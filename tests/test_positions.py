"""Positions, batches and numbering against plain Python, with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from attrspark.operators import positions as P
from attrspark.session import scratch_path


def hot_rows(n=3000, seed=5):
    """A third of all rows share one key."""
    draw = random.Random(seed)
    return [("hot" if i % 3 == 0 else f"k{draw.randrange(400)}", i) for i in range(n)]


@pytest.fixture(scope="module")
def hot(spark):
    rows = hot_rows()
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "k string, i int").repartition(7)


def test_position_follows_the_order(hot):
    placed = P.with_position(hot, ["k", F.desc("i")])
    got = [(r["k"], r["i"], r["pos"]) for r in placed.orderBy("pos").collect()]
    expected = sorted(hot_rows(), key=lambda r: (r[0], -r[1]))
    assert got == [(k, i, n) for n, (k, i) in enumerate(expected)]


def test_position_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k string")
    assert P.with_position(empty, ["k"]).count() == 0


def test_number_within_groups(hot):
    got = {(r["k"], r["i"]): (r["member_no"], r["n_members"]) for r in P.number_within(hot, ["k"], ["i"]).collect()}
    groups: dict = {}
    for k, i in sorted(hot_rows()):
        groups.setdefault(k, []).append(i)
    assert got == {(k, i): (n, len(m)) for k, m in groups.items() for n, i in enumerate(m)}


def test_no_unpartitioned_window_over_the_rows(hot):
    plan = P.with_position(hot, ["k", "i"])._jdf.queryExecution().executedPlan().toString()
    # The single-partition step sees one row per partition: it comes after the count.
    assert "SinglePartition" in plan and plan.index("Window") < plan.index("HashAggregate")


def test_batches(hot):
    got = P.assign_batches(hot, ["i"], 16).groupBy("batch").agg(F.count("*").alias("n")).orderBy("batch").collect()
    assert [r["batch"] for r in got] == list(range(188))
    assert [r["n"] for r in got] == [16] * 187 + [3000 - 187 * 16]
    with pytest.raises(ValueError):
        P.assign_batches(hot, ["i"], 0)


@pytest.mark.parametrize("skip,n", [(0, 5), (10, 7), (2995, 50), (4000, 3), (0, 0)])
@pytest.mark.parametrize("few", [0, 40, 10_000])
def test_ranges_whatever_the_passes(hot, monkeypatch, skip, n, few):
    monkeypatch.setattr(P, "FEW_ROWS", few)
    expected = [i for _, i in sorted(hot_rows(), key=lambda r: r[1])][skip : skip + n]
    assert sorted(r["i"] for r in P.skip_take(hot, ["i"], skip, n).collect()) == expected


def in_order(rows):
    """By k (nulls first), then i descending (nulls last)."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is None, -(r[1] or 0)))


@pytest.mark.parametrize("few", [0, 10_000])
def test_ranges_with_nulls_ties_and_mixed_directions(spark, monkeypatch, few):
    monkeypatch.setattr(P, "FEW_ROWS", few)
    draw = random.Random(9)
    rows = [(draw.choice([None, "a", "b", "hot", "hot"]), draw.choice([None, *range(12)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(5)
    order = ["k", F.desc("i")]
    for skip, n in ((0, 400), (0, 1), (17, 60), (130, 3), (399, 9), (90, 250)):
        got = [tuple(r) for r in P.skip_take(df, order, skip, n).collect()]
        assert in_order(got) == in_order(rows)[skip : skip + n]
    for rank in (0, 57, 399):
        key, before = P.key_at(df, order, rank)
        assert tuple(key) == in_order(rows)[rank] and before == in_order(rows).index(tuple(key))
    assert P.key_at(df, order, 400) == (None, 400)
    # An order that ties throughout: the number of rows is right, and each row comes once.
    wide = df.withColumn("no", F.monotonically_increasing_id())
    got = [r["no"] for r in P.skip_take(wide, ["k"], 100, 150).collect()]
    assert len(got) == len(set(got)) == 150


def test_selection_moves_and_sorts_no_rows(hot):
    wide = hot.withColumn("payload", F.repeat(F.lit("x"), 100))
    plan = P.skip_take(wide, ["i"], 5, 900)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in plan for word in ("Sort", "Limit", "Join", "Window"))


def test_positions_copy_keys_only(hot, monkeypatch):
    seen = []
    monkeypatch.setattr(P, "freeze", lambda df, keep=P.freeze: seen.append(df.columns) or keep(df))
    wide = hot.withColumn("payload", F.repeat(F.lit("x"), 100))
    placed = P.with_position(wide, ["k", "i"])
    assert seen == [["k", "i", "__n", "__row"]] and placed.columns == ["k", "i", "payload", "pos"]
    got = [(r["k"], r["i"]) for r in placed.orderBy("pos").collect()]
    assert got == sorted(hot_rows())
    assert P.number_within(wide, ["k"], ["i"]).columns == ["k", "i", "payload", "member_no", "n_members"]


def test_positions_of_rows_that_tie(spark):
    rows = [("a", n % 3, n) for n in range(60)] + [(None, None, 60), (None, None, 61)]
    df = spark.createDataFrame(rows, "k string, i int, no int").repartition(4)
    got = sorted((r["pos"], r["k"], r["i"]) for r in P.with_position(df, ["k", "i"]).collect() if r["k"])
    assert [p for p, *_ in got] == list(range(2, 62)) and [i for *_, i in got] == [n for n in range(3) for _ in range(20)]
    numbered = P.number_within(df, ["k"], ["i"]).collect()
    assert sorted(r["member_no"] for r in numbered if r["k"]) == list(range(60)) and {r["n_members"] for r in numbered} == {2, 60}


def test_order_by_expressions_is_refused(hot):
    with pytest.raises(ValueError):
        P.take(hot, [F.col("i") + 1], 3)


def test_bad_ranges(hot):
    with pytest.raises(ValueError):
        P.skip_take(hot, ["i"], -1, 5)


def test_default_ids(spark):
    df = spark.createDataFrame([("x", 0), (None, 1), (None, 9)], "g string, pos bigint").coalesce(1)
    got = [tuple(r) for r in df.select(
        P.default_id(F.col("g"), F.col("pos")), P.default_batch_id(F.col("g"), F.col("pos"), 8)
    ).collect()]
    assert got == [("x", "x"), ("sample_1", "batch_0_1"), ("sample_9", "batch_8_1")]


def test_scan_positions(spark):
    path = scratch_path(spark, "scan")
    spark.range(0, 5000, 1, 5).withColumn("wide", F.repeat(F.lit("x"), 50)).write.parquet(path)
    df = spark.read.parquet(path).withColumn("file", F.input_file_name())
    placed = P.with_scan_position(df)
    assert "repartition" not in placed._jdf.queryExecution().toString().lower()
    rows = placed.where("id % 2 = 0 OR true").select("file", "pos", "id").collect()
    evens = placed.where("id % 2 = 0").select("pos", "id").collect()
    assert {(r["pos"], r["id"]) for r in evens} == {(r["pos"], r["id"]) for r in rows if r["id"] % 2 == 0}
    assert sorted(r["pos"] for r in rows) == list(range(5000))
    for file in {r["file"] for r in rows}:
        mine = sorted((r["pos"], r["id"]) for r in rows if r["file"] == file)
        # Rows of a file keep their order.
        assert [i for _, i in mine] == sorted(i for _, i in mine)


def test_take_in_place(hot, spark):
    rows = sorted(hot_rows())
    for n in (0, 1, 700, 2999, 3000, 9999):
        got = sorted((r["k"], r["i"]) for r in P.take_in_place(hot, ["k", "i"], n).collect())
        assert got == rows[:n]
    # The border key is there a thousand times: rows that tie are kept together.
    assert P.take_in_place(hot, ["k"], 500).count() == 1000
    assert P.take_in_place(hot.limit(0), ["k"], 5).count() == 0
    nulls = spark.createDataFrame([(None, 1), ("a", 2), (None, 0)], "k string, i int")
    assert [r["i"] for r in P.take_in_place(nulls, ["k", "i"], 2).orderBy("i").collect()] == [0, 1]
