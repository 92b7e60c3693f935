"""Score arrays to attributes: twins, ties, missing values, plug-in scorers."""

import math
import random
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from attrspark.functions.scoring import long_scores, with_attributes
from attrspark.operators.lexical import extract_text
from attrspark.operators.scorers import (
    IMAGE_MISSING,
    EmbeddingScorer,
    ModelExtractor,
    VectorExtractor,
    item_batches,
    score_batches,
    scored,
)
from attrspark.operators.zero_shot import LabelVectors, cosine_scores
from attrspark.plans import inputs as IN
from attrspark.vocabulary import IMAGE_VOCABULARY, TEXT_VOCABULARY, Vocabulary

# Scorers defined here reach the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMALL = Vocabulary({"A": ("a0", "a1", "a2"), "B": ("b0", "b1", "b2", "b3", "b4")})


def labels_of(spark, rows, vocabulary=SMALL, threshold=0.3):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, scores array<double>")
    done = with_attributes(df, vocabulary, threshold=threshold).orderBy("i").collect()
    return [tuple(r["attributes"]) for r in done]


def brute(scores, vocabulary=SMALL, threshold=0.3):
    found = []
    for a in vocabulary.attributes:
        cells = scores[a.start : a.stop]
        peak = max(cells)
        p = 1 / sum(math.exp(c - peak) for c in cells)
        found.append(a.options[cells.index(peak)] if p > threshold else None)
    return tuple(found)


def test_against_plain_python(spark):
    draw = random.Random(1)
    rows = [[draw.choice([0.0, 0.5, 1.0, 3.0]) for _ in range(SMALL.size)] for _ in range(300)]
    assert labels_of(spark, rows) == [brute(r) for r in rows]


def test_first_option_wins_ties_and_threshold_is_strict(spark):
    assert labels_of(spark, [[1.0, 1.0, 1.0] + [0.0] * 5]) == [("a0", None)]
    two = Vocabulary({"A": ("x", "y")})
    assert labels_of(spark, [[0.0, 0.0]], two, threshold=0.5) == [(None,)]
    assert labels_of(spark, [[0.0, 0.0]], two, threshold=0.49) == [("x",)]
    assert labels_of(spark, [[0.0]], Vocabulary({"A": ("x",)})) == [("x",)]


def test_one_failed_attribute_leaves_the_others(spark):
    good = [9.0, 0.0, 0.0]
    rows = [
        good + [None, 9.0, 0.0, 0.0, 0.0],
        good + [float("nan"), 9.0, 0.0, 0.0, 0.0],
        good,
        None,
        [1e308, -1e308, 0.0] + [0.0, 800.0, 0.0, 0.0, 0.0],
    ]
    assert labels_of(spark, rows) == [("a0", None), ("a0", None), ("a0", None), (None, None), ("a0", "b1")]


def test_array_form_equals_window_form(spark, tables):
    vectors = IN.table(spark, tables, "embeddings")
    scores = cosine_scores(F.col("embedding"), IN.label_vectors(vectors), IN.LOGIT_SCALE)
    scored = vectors.select("vec_id", scores.alias("scores"))
    long = long_scores(scored, IMAGE_VOCABULARY, ["vec_id"])
    group = Window.partitionBy("vec_id", "attribute")
    e = F.exp(F.col("score") - F.max("score").over(group))
    twin = long.withColumn("e", e).withColumn("p", F.col("e") / F.sum("e").over(group))
    assert twin.where(F.abs(F.col("p") - F.col("probability")) > 1e-12).count() == 0
    sums = long.groupBy("vec_id", "attribute").agg(F.sum("probability").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    ranked = twin.withColumn(
        "rn", F.row_number().over(group.orderBy(F.desc("probability"), "opt_idx"))
    ).where((F.col("rn") == 1) & (F.col("p") > 0.3))
    ours = IN.classified(vectors).select("vec_id", F.explode(F.map_filter(
        F.create_map(*[x for n in IMAGE_VOCABULARY.names for x in (F.lit(n), F.col("attributes")[n])]),
        lambda _, v: v.isNotNull(),
    )).alias("attribute", "option"))
    theirs = ranked.select("vec_id", "attribute", "option")
    assert ours.exceptAll(theirs).count() == 0 and theirs.exceptAll(ours).count() == 0


def test_three_options_always_name_one(spark, tables):
    done = IN.classified(IN.table(spark, tables, "embeddings"))
    assert done.where(F.col("attributes.Gender").isNull()).count() == 0


def test_unusable_vectors_have_no_scores(spark):
    labels = LabelVectors(np.eye(8), SMALL)
    one = [1.0] + [0.0] * 7
    rows = [one, None, [1.0], [0.0] * 8, [float("nan")] + [0.0] * 7, [None] + [1.0] * 7, one]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, v array<float>").coalesce(1)
    got = [r["s"] for r in df.select(cosine_scores(F.col("v"), labels, 2.0).alias("s")).collect()]
    assert [g is not None for g in got] == [True, False, False, False, False, False, True]
    assert got[0] == [2.0] + [0.0] * 7
    sliced = df.where("i >= 3").select(cosine_scores(F.col("v"), labels).alias("s")).collect()
    assert [r["s"] is not None for r in sliced] == [False, False, False, True]
    out = VectorExtractor(labels, 5.0).apply(df, "v", "o").orderBy("i").collect()
    assert [r["o"]["error"] for r in out] == [None] + [IMAGE_MISSING] * 5 + [None]


def test_label_vectors_are_checked(spark):
    with pytest.raises(ValueError):
        LabelVectors(np.ones((3, 4)), SMALL)
    with pytest.raises(ValueError):
        LabelVectors(np.zeros((8, 4)), SMALL)
    with pytest.raises(ValueError):
        LabelVectors(np.ones((8, 2_000_000)), SMALL)
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "ordinal int, vector array<double>")
    with pytest.raises(ValueError):
        LabelVectors.from_frame(df, SMALL)
    assert LabelVectors.from_frame(df.where("ordinal < 8"), SMALL).matrix.shape == (2, 8)


def test_text_scorer(spark):
    texts = [
        "A Young Adult FEMALE with long red hair and hazel eyes",
        "males and redhead, haired",
        "red is the hair",
        "red one two three hair",
        "   ",
        None,
        "child teen elderly middle-aged people",
        "teené",
        "non-binary",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r["attributes"].asDict() for r in extract_text(df, "t").orderBy("i").collect()]
    found = [{k: v for k, v in g.items() if v} for g in got]
    assert found == [
        {"Age": "young adult", "Gender": "female", "Hair_Color": "red", "Eye_Color": "hazel"},
        {},
        {"Hair_Color": "red"},
        {},
        {},
        {},
        {},
        {},
        {"Gender": "non-binary"},
    ]
    assert len(got[0]) == len(IMAGE_VOCABULARY.names)


class Picky:
    """Fails on 'bad', says nothing on 'none', miscounts on 'short'."""

    def setup(self):
        self.ready = True

    def score(self, inputs):
        assert self.ready
        if "short" in inputs:
            return []
        if "bad" in inputs:
            raise ValueError("bad input")
        return [None if x == "none" else [9.0] + [0.0] * 7 for x in inputs]


def test_scorer_failures_stay_with_their_item(spark):
    df = spark.createDataFrame(
        list(enumerate(["ok", "bad", "none", None, "short", "ok"])), "i int, x string"
    ).coalesce(1)
    done = ModelExtractor(Picky(), SMALL, missing="gone").apply(df, "x", "o").orderBy("i").collect()
    outcomes = [(tuple(r["o"]["attributes"]), r["o"]["error"]) for r in done]
    assert outcomes[0] == (("a0", None), None) == outcomes[5]
    assert outcomes[1] == ((None, None), "bad input")
    assert outcomes[2] == ((None, None), None)
    assert outcomes[3] == ((None, None), "gone")
    assert outcomes[4][0] == (None, None) and "0 results for 1" in outcomes[4][1]
    assert all(r["o"]["seconds"] >= 0 for r in done)


def test_scorer_with_a_smaller_vocabulary(spark):
    class Fixed:
        def setup(self):
            pass

        def score(self, inputs):
            return [[9.0] + [0.0] * (TEXT_VOCABULARY.size - 1) for _ in inputs]

    df = spark.createDataFrame([("x",)], "t string")
    row = ModelExtractor(Fixed(), scored_vocabulary=TEXT_VOCABULARY).apply(df, "t", "o").first()
    assert row["o"]["attributes"]["Age"] == "child" and row["o"]["attributes"]["Dress"] is None


class Halves:
    """Embeds a text of eight numbers; 'dull' has no direction."""

    def setup(self):
        self.ready = True

    def embed(self, inputs):
        assert self.ready
        return [[0.0] * 8 if x == "dull" else [float(n) for n in x.split()] for x in inputs]


def test_embedder_equals_vectors(spark):
    labels = LabelVectors.from_encoder(
        lambda prompts: [[float(len(p)), float(i), 1.0, i % 3, 0, 0, 1, i % 2] for i, p in enumerate(prompts)], SMALL
    )
    rows = [[float((i * k) % 7 + 1) for k in range(8)] for i in range(20)]
    texts = [" ".join(map(str, r)) for r in rows] + ["dull"]
    df = spark.createDataFrame(
        [(i, t, r) for i, (t, r) in enumerate(zip(texts, [*rows, [0.0] * 8]))], "i int, t string, v array<double>"
    )
    scorer = EmbeddingScorer(Halves(), labels, 5.0)
    a = ModelExtractor(scorer, SMALL, partitions=3).apply(df, "t", "o").orderBy("i").collect()
    b = VectorExtractor(labels, 5.0).apply(df, "v", "o").orderBy("i").collect()
    assert [r["o"]["attributes"] for r in a] == [r["o"]["attributes"] for r in b]
    assert a[20]["o"]["error"] == "embedding without direction" and a[19]["o"]["error"] is None


class Batches:
    """Scores by size and notes, in the scores, how many inputs it got at once."""

    def setup(self):
        pass

    def score(self, inputs):
        if any(value == "bad" for value in inputs):
            raise ValueError("bad input")
        return [[float(len(inputs)), float(len(value))] for value in inputs]


def test_batches_keep_to_items_and_bytes():
    assert list(item_batches([1, 1, 1, 9, 1, 1], 2, 5)) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert list(item_batches([], 2, 5)) == [] and list(item_batches([0] * 5, 2, 5)) == [(0, 2), (2, 4), (4, 5)]
    inputs = ["a", None, "bb", "x" * 50, "c", None, "bad", "d"]
    done = score_batches(Batches(), inputs, "gone", 3, 20)
    assert done["error"].tolist() == [None, "gone", None, None, None, "gone", "bad input", None]
    assert [None if s is None else s[1] for s in done["scores"]] == [1, None, 2, 50, 1, None, None, 1]
    assert max(s[0] for s in done["scores"] if s is not None) <= 3 and done["scores"][3][0] == 1
    assert len(score_batches(Batches(), [], None, 3, 20)) == 0
    assert len(score_batches(Batches(), [None, None], "gone", 3, 20)) == 2


@pytest.mark.parametrize("size, most", [(4, 4), (1, 1)])
def test_scorers_get_batches_of_the_asked_size(spark, size, most):
    rows = spark.createDataFrame([(i, "t" * (i % 7)) for i in range(50)], "id int, text string").coalesce(1)
    got = rows.select("id", F.length("text").alias("n"), scored(F.col("text"), Batches(), None, size, 1000).alias("s")).collect()
    assert len(got) == 50 and {r.s.scores[0] for r in got} <= set(range(1, most + 1)) and max(r.s.scores[0] for r in got) == most
    assert all(r.s.scores[1] == r.n for r in got)
    with pytest.raises(ValueError):
        ModelExtractor(Batches(), batch_size=0)
