"""Decisions on narrow rows: wide rows are neither shuffled nor copied."""

import re

import pytest
from pyspark.sql import functions as F

from attrspark.operators.cache import CacheTable
from attrspark.operators.chosen import PLACE, chosen_in_place, with_places
from attrspark.operators.scorers import ModelExtractor
from attrspark.plans import jobs
from attrspark.plans.inputs import MarkerScorer
from attrspark.session import scratch_path
from attrspark.sources.tables import read_results


@pytest.fixture
def dataset(spark):
    path = scratch_path(spark, "images")
    rows = spark.range(0, 60, 1, 4).select(
        F.when(F.col("id") != 7, F.col("id").cast("string")).alias("id"),
        F.col("id").alias("at"),
        F.concat(F.lit("img:"), F.md5((F.col("id") % 9).cast("string"))).cast("binary").alias("image"),
        F.lit("a teen").alias("text"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def exchanged(df):
    """Columns that go into any exchange of the plan."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    found = set()
    for section in re.split(r"\n\n+", plan):
        if re.match(r"\(\d+\) (Exchange|BroadcastExchange|Sort)", section):
            inputs = re.search(r"Input \[\d+\]: \[(.*)\]", section)
            found |= {c.split("#")[0].strip() for c in inputs[1].split(",")} if inputs else set()
    return found


def test_chosen_rows_are_found_where_they_are(spark, dataset):
    places = with_places(dataset)
    decided = places.where("at % 3 = 1 OR id IS NULL").select(*PLACE, (F.col("at") * 2).alias("twice"), F.struct("at").alias("s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = chosen_in_place(places, decided, ["twice", "s"])
        assert exchanged(got) == set()
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["at"] for r in rows) == sorted({i for i in range(60) if i % 3 == 1} | {7})
    assert all(r["twice"] == 2 * r["at"] == 2 * r["s"]["at"] and r["image"].startswith(b"img:") for r in rows)
    assert got.columns == [*dataset.columns, "twice", "s"]
    assert chosen_in_place(places, decided.limit(0), []).count() == 0


def test_rows_made_of_one_row_are_told_apart(spark, dataset):
    several = dataset.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).withColumn("id", F.concat("id", F.lit("-"), "n"))
    places = with_places(several)
    got = chosen_in_place(places, places.where("n = 2 AND at < 20").select(*PLACE), [])
    # Row 7 has no id: its three rows have one key.
    assert sorted((r["at"], r["n"]) for r in got.collect()) == sorted([(i, 2) for i in range(20)] + [(7, 1), (7, 3)])


def test_other_tables_have_no_places(spark):
    assert with_places(spark.createDataFrame([("a",)], "id string")) is None


@pytest.mark.parametrize("cached", [False, True])
def test_image_bytes_are_in_no_exchange_of_a_job(spark, dataset, monkeypatch, cached):
    plans, finish = [], jobs._finish
    monkeypatch.setattr(jobs, "_finish", lambda extracted, *rest: plans.append(exchanged(extracted)) or finish(extracted, *rest))
    images, path = ModelExtractor(MarkerScorer()), scratch_path(spark, "out")
    cache = CacheTable(spark, scratch_path(spark, "cache")) if cached else None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = jobs.dataset_job(dataset, path, images, order=["at"], samples=25, cache=cache)
        second = jobs.dataset_job(dataset, path, images, cache=cache)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans == [set(), set()]
    assert (first["total"], second["total"]) == (25, 35)
    assert second["cache_hits"] == (35 if cached else 0)
    rows = read_results(spark, path).collect()
    assert len({r["id"] for r in rows}) == 60 and {r["source"] for r in rows} == {"image"}
    same = jobs.dataset_job(dataset, scratch_path(spark, "out"), images, resume=jobs.Resume("none"))
    assert same["total"] == 60


def test_placed_and_plain_jobs_agree(spark, dataset):
    plain = spark.createDataFrame(dataset.where("id IS NOT NULL").collect(), dataset.schema)
    out = [scratch_path(spark, "out") for _ in range(2)]
    for data, path in zip((dataset.where("id IS NOT NULL"), plain), out):
        for n in (10, 100):
            jobs.dataset_job(data, path, ModelExtractor(MarkerScorer()), order=["at"], samples=n)
    a, b = (read_results(spark, p).drop("processing_time") for p in out)
    assert a.count() == 59 and a.exceptAll(b).count() == 0


def test_texts_of_one_row_group_are_extracted_by_all_cores(spark, tmp_path):
    rows = spark.range(9000).selectExpr("string(id) AS id", "concat('a girl with red hair ', id) AS caption")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    table = spark.read.parquet(f"{tmp_path}/one")

    def written(name, **options):
        jobs.dataset_job(table, f"{tmp_path}/{name}", None, **options)
        out = spark.read.json(f"{tmp_path}/{name}")
        assert out.select("id").distinct().count() == out.count()
        return len(out.inputFiles()), {r["id"] for r in out.collect()}

    files, ids = written("limited", samples=6000)
    assert files >= 4 and ids == set(sorted(map(str, range(9000)))[:6000])
    files, ids = written("whole", resume=jobs.Resume("none"))
    assert files >= 4 and len(ids) == 9000
    files, ids = written("few", samples=100)
    assert files <= 4 and len(ids) == 100
