"""What tasks hold and what jobs leave on disk."""

import time
import uuid

import numpy as np
import pyarrow as pa

from attrspark.llm import packing, suffix_tree
from attrspark.session import settings


def test_packing_hands_small_batches_to_python(spark, monkeypatch):
    def sized(docs, tokenizer, capacity=1024, end=2):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([0] * n, pa.int32()), pa.array([batch.nbytes] * n), pa.array([capacity] * n), pa.array([b""] * n)],
                    names=packing.PIECES.names,
                )

        return docs.select("doc_id", "text").mapInArrow(run, packing.PIECES)

    monkeypatch.setattr(packing, "document_pieces", sized)
    docs = spark.range(0, 12, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 400000) AS text")
    rows = packing.packed_documents(spark, docs, "none").collect()
    assert len(rows) == 12 and max(r["start"] for r in rows) < 8_000_000


def test_settings_are_put_back(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    try:
        with settings(spark, spark__sql__execution__arrow__maxBytesPerBatch="4m"):
            assert spark.conf.get(name) == "4m"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(name, None) == before


def test_language_model_leaves_no_shuffle_files(spark):
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {n for n in disks.getAllFiles().mkString("\n").split("\n") if n.endswith(".data")}
    before = shuffled()
    written, _ = suffix_tree._written(spark, spark.range(1000).repartition(3, "id"), "test")
    assert len(written.collect()) == 1000
    until = time.time() + 20
    while shuffled() - before and time.time() < until:  # removed in the background
        time.sleep(0.2)
    assert not shuffled() - before


def test_language_model_keeps_no_word_hashes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_tree, "scratch_path", lambda _, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    docs = spark.range(0, 60, 1, 5).selectExpr("id AS doc_id", "concat('a b w', id, ' c') AS text", "id % 7 = 0 AS held_out")
    assert suffix_tree.scored(docs).count() == 60
    files = [p for p in tmp_path.rglob("*.chunk*") if not p.name.startswith(".")]
    assert {p.name.rpartition(".")[2] for p in files} == set("0123")
    for place in tmp_path.rglob("*.chunk.0"):  # words by number, frequent ones first
        c = suffix_tree.Chunk.read(str(place))
        assert (np.diff(c.words.astype(np.int64)) > 0).all() and c.words.max() < 100 * 8


def test_language_model_asks_for_no_word_that_only_one_chunk_can_have():
    def message(lonely):
        # Two words of context "a a"; the third word of some n-grams ends what no other chunk has.
        n = 2000
        c = suffix_tree.Chunk(
            np.arange(n), np.zeros(n, bool), np.zeros(n, bool), np.full(n, 3), np.arange(n + 1, dtype=np.uint64),
            np.column_stack([np.zeros(n, int), np.zeros(n, int), np.arange(1, n + 1)]).ravel(), np.concatenate(([9 * n], np.full(n, 1 + (not lonely)))),
            np.concatenate(([False], np.full(n, lonely))),
        )
        model = suffix_tree.Model(4, 2, 0.02, 9 * n, n + 1)
        grown = suffix_tree._grown(c, [], model)
        return [asked for _, asked in suffix_tree._by_context(grown.deeper, grown.shorter, model)]

    for lonely, asked in ((False, 2001), (True, 1)):
        got = message(lonely)
        assert sum(len(x.grams) for x in got) == asked and sum(x.alone.sum() for x in got) == 2001 - asked


def test_arrays_come_back_as_packed():
    rng = np.random.default_rng(4)
    for values in ([], [0], [5, 5, 5], [1 << 63, 3, 0], rng.integers(0, 1 << 20, 1000)):
        values = np.array(values, np.uint64)
        assert (suffix_tree.unpacked(suffix_tree.packed(values), np.uint64) == values).all()
        assert (suffix_tree.unpacked(suffix_tree.packed(np.sort(values), True), np.uint64, True) == np.sort(values)).all()
    signed = np.array([-3, 1 << 40, 7])
    assert (suffix_tree.unpacked(suffix_tree.packed(signed), np.int64) == signed).all()
    sizes = np.array([3, 0, 1, 4, 0])
    runs = np.array([2, 5, 9, 1, 0, 3, 4, 1 << 40], np.uint64)
    assert (suffix_tree._summed(suffix_tree._steps(runs, sizes), sizes) == runs).all()
    for keys in (rng.integers(0, 50, 400), rng.integers(0, 1 << 62, 400) // (1 << 55) * (1 << 55), rng.integers(0, 9, 400) + (1 << 62), np.zeros(0, np.int64)):
        want = np.unique(keys, return_index=True, return_inverse=True)
        assert all((a == b).all() for a, b in zip(suffix_tree.distinct(keys), want))
