"""A training-data pipeline over documents: toxic texts out, one of each group of near
copies kept, benchmark passages out, the rest packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrspark.llm.decontaminate import contaminated
from attrspark.llm.kneser_ney import toxicity
from attrspark.llm.minhash import near_duplicates
from attrspark.llm.packing import packed_documents
from attrspark.llm.queries import TOKENIZER
from attrspark.session import scratch_path, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without(spark: SparkSession, docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents whose id is not in `rejected(doc_id)`; rows without an id stay.

    The rejected ids are written first, so that Spark knows their size when it chooses how
    to join.
    """
    place = scratch_path(spark, "rejected")
    rejected.select("doc_id").where("doc_id IS NOT NULL").distinct().write.parquet(place)
    return docs.select(*COLUMNS).join(spark.read.schema("doc_id long").parquet(place), "doc_id", "left_anti")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not predict toxic."""
    with small_batches(spark):
        judged = toxicity(docs, table(spark, sf_dir, "labels"))
        return without(spark, docs, judged.where("predicted = 1"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), the
    one with the smallest id; of rows with that id all."""
    with small_batches(spark):
        return without(spark, docs, near_duplicates(docs).where("NOT kept"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item within its error budget."""
    with small_batches(spark):
        return without(spark, docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 1024 tokens."""
    return packed_documents(spark, docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("minhash near-dedup", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]
#: Models, edit distance and packing are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        place = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
