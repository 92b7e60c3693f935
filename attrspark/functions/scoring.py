"""From a score array to attributes: soft-max, first maximum, threshold.

A row holds one array with a score per option of the vocabulary. The options of
an attribute are known when the plan is built, so the soft-max and the maximum
are spelled out over array cells: plain expressions that compile with the rest
of the stage, and no explode, window or shuffle per attribute. They are written as
SQL text, which is parsed in one go; hundreds of Column calls would take seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrspark.functions.names import quote
from attrspark.vocabulary import CONFIDENCE_THRESHOLD, PROMPT_TEMPLATE, Attribute, Vocabulary


def _cells(scores: str, attribute: Attribute) -> list[str]:
    return [f"get({scores}, {i})" for i in range(attribute.start, attribute.stop)]


def _best(cells: list[str]) -> str:
    return f"greatest({', '.join(cells)})" if len(cells) > 1 else cells[0]


def _mass(cells: list[str], best: str) -> str:
    """Sum of exp(score - best); null as soon as one score is missing."""
    return " + ".join(f"exp({c} - {best})" for c in cells)


def _record(fields: dict[str, str]) -> Column:
    inner = ", ".join(f"{quote(name)}, {value}" for name, value in fields.items())
    return F.expr(f"named_struct({inner})")


def with_attributes(
    df: DataFrame,
    vocabulary: Vocabulary,
    scores: str = "scores",
    threshold: float = CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """Add `attributes` and `confidence` structs, one field per attribute.

    The first option with the highest score wins. An attribute is null when its
    probability does not exceed the threshold, or when one of its scores is missing or
    not a number; the others are unaffected.
    """
    best, confidence, labels = {}, {}, {}
    for a in vocabulary.attributes:
        cells, top, sure = _cells(f"`{scores}`", a), f"__best.`{a.name}`", f"confidence.`{a.name}`"
        best[a.name] = _best(cells)
        confidence[a.name] = f"nanvl(1D / ({_mass(cells, top)}), CAST(NULL AS DOUBLE))"
        options = " ".join(f"WHEN {c} = {top} THEN {quote(o)}" for c, o in zip(cells, a.options))
        labels[a.name] = f"CASE WHEN {sure} > {float(threshold)!r}D THEN CASE {options} END END"
    return (
        df.withColumn("__best", _record(best))
        .withColumn("confidence", _record(confidence))
        .withColumn("attributes", _record(labels))
        .drop("__best")
    )


def long_scores(df: DataFrame, vocabulary: Vocabulary, keep: list[str], scores: str = "scores"):
    """One row per item and option: attribute, opt_idx, option, score, probability.

    Items without scores have no rows. Maximum and mass are computed once per item and
    attribute; names, maxima and masses are then looked up by position, so the
    vocabulary is neither joined nor repeated in the compiled code.
    """
    cells = [_cells(f"`{scores}`", a) for a in vocabulary.attributes]
    peaks = F.expr(f"array({', '.join(_best(c) for c in cells)})")
    masses = F.expr(f"array({', '.join(_mass(c, _best(c)) for c in cells)})")

    def constant(field: int) -> str:
        found = [
            (i, a.name, j, o)[field] for i, a in enumerate(vocabulary.attributes) for j, o in enumerate(a.options)
        ]
        return f"get(array({', '.join(quote(x) if isinstance(x, str) else str(x) for x in found)}), pos)"

    rows = df.select(*keep, peaks.alias("__peak"), masses.alias("__mass"), F.posexplode(F.col(scores)))
    at = constant(0)
    return rows.select(
        *keep,
        F.expr(constant(1)).alias("attribute"),
        F.expr(constant(2)).alias("opt_idx"),
        F.expr(constant(3)).alias("option"),
        F.col("col").alias("score"),
        F.expr(f"exp(col - get(__peak, {at})) / get(__mass, {at})").alias("probability"),
    )


def prompt(option: Column) -> Column:
    """The sentence that stands for an option in an image-text model."""
    return F.replace(F.lit(PROMPT_TEMPLATE), F.lit("{option}"), option)
