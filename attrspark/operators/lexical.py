"""A text scorer made of column expressions.

It looks for option words and is a stand-in, not a language model: it knows
nothing of synonyms or negation. Model scorers plug in through `scorers`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrspark.functions.attributes import widen
from attrspark.functions.names import quote, strip
from attrspark.functions.scoring import with_attributes
from attrspark.vocabulary import (
    CONFIDENCE_THRESHOLD,
    IMAGE_VOCABULARY,
    TEXT_VOCABULARY,
    Vocabulary,
)

# The noun an option has to stand before (at most two words between), where there is one.
HEAD_NOUNS = {"Hair_Color": "hair", "Eye_Color": "eyes"}
MATCH_SCORE = 5.0


# A letter, digit or underscore of any script; spelled out because engines differ on \b and \w.
WORD = r"\p{L}\p{N}_"


def option_pattern(attribute: str, option: str) -> str:
    """Pattern for an option as whole words in lower-cased text."""
    word = "".join("\\" + c if c in r".^$*+?()[]{}|\\" else c for c in option.lower())
    head = HEAD_NOUNS.get(attribute)
    tail = rf"(?: [{WORD}]+){{0,2}} {head}" if head else ""
    return rf"(?:^|[^{WORD}]){word}{tail}(?:$|[^{WORD}])"


def _mentions(low: str, attribute: str, option: str) -> str:
    # Plain substring tests first: most texts end there, without a pattern match.
    words = [HEAD_NOUNS[attribute]] if attribute in HEAD_NOUNS else []
    tests = [f"contains({low}, {quote(w)})" for w in [*words, option.lower()]]
    return " AND ".join([*tests, f"rlike({low}, {quote(option_pattern(attribute, option))})"])


def with_lexical_scores(df: DataFrame, text: str, vocabulary: Vocabulary = TEXT_VOCABULARY):
    """Add `scores`: 5 where the option is mentioned, else 0; null without any mention.

    Null or blank text has null scores throughout, hence an empty record.
    """
    masks, cells = [], []
    for a in vocabulary.attributes:
        bits = [
            f"CASE WHEN {_mentions('__low', a.name, option)} THEN {1 << i} ELSE 0 END"
            for i, option in enumerate(a.options)
        ]
        masks.append(f"{quote(a.name)}, {' + '.join(bits)}")
        mask = f"__found.`{a.name}`"
        cells += [
            f"CASE WHEN {mask} != 0 THEN CASE WHEN {mask} & {1 << i} != 0 THEN {MATCH_SCORE}D ELSE 0D END END"
            for i in range(len(a.options))
        ]
    blank = F.coalesce(strip(F.col(text)) == "", F.lit(True))
    scores = F.when(~blank, F.expr(f"array({', '.join(cells)})"))
    return (
        df.withColumn("__low", F.lower(F.col(text)))
        # One small integer per attribute, so that each pattern runs once per text.
        .withColumn("__found", F.expr(f"named_struct({', '.join(masks)})"))
        .withColumn("scores", scores)
        .drop("__low", "__found")
    )


def extract_text(
    df: DataFrame,
    text: str,
    vocabulary: Vocabulary = IMAGE_VOCABULARY,
    text_vocabulary: Vocabulary = TEXT_VOCABULARY,
    threshold: float = CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """Add `attributes`: those the text vocabulary covers, the others null. No shuffle."""
    scored = with_attributes(
        with_lexical_scores(df, text, text_vocabulary), text_vocabulary, "scores", threshold
    )
    record = widen("attributes", text_vocabulary.names, vocabulary)
    return scored.withColumn("attributes", record).drop("scores", "confidence")
